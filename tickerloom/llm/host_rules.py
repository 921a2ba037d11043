"""Quality rules with verdicts on hosts.

Each text is measured by itself; failures are counted per host (the ``source`` column); the
host's failure rate is shrunk towards the corpus by a beta prior that is fitted to all
hosts; hosts whose shrunk rate is high lose all their documents.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import ASCII_SPACE, map_texts

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A host is dropped when its shrunk failure rate reaches this.
HOST_RATE = 0.8


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    """(words, characters in words, symbols, repeated lines, words in repeated 3-word windows)."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    chars = len(text) - (len(data) - len(data.translate(None, ASCII_SPACE)))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    lines = 0
    for line in data.split(b"\n"):
        if line.strip(ASCII_SPACE):
            lines += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    covered = 0
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        reach = 0  # words before this one are counted
        for i, window in enumerate(windows):
            if counts[window] > 1:
                covered += i + 3 - max(i, reach)
                reach = i + 3
    return len(words), chars, symbols, lines, covered


def _start():
    return lambda texts: list(zip(*map(measure, texts), strict=True))


def features(docs: DataFrame, source: str = "source") -> DataFrame:
    """Per row: doc_id, source, the five measures, and ``base_failed``."""
    named = docs.select("doc_id", F.col(source).cast("string").alias("source"), "text")
    made = map_texts(
        named, ["doc_id", "source"], "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long", _start
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return made.withColumn("base_failed", failed)


def host_rates(measured: DataFrame, failed: str = "base_failed") -> DataFrame:
    """Per host: documents, failures, and the failure rate shrunk by an empirical beta prior.

    The prior's mean is the corpus rate; its weight is fitted by moments to the spread of the
    hosts' rates beyond what counts of their size show by chance.  Hosts that differ no more
    than by chance all get the corpus rate.  Rows without a host form no host.
    """
    hosts = (
        measured.filter(F.col("source").isNotNull())
        .groupBy("source")
        .agg(F.count("*").alias("host_docs"), F.sum(F.col(failed).cast("long")).alias("host_failures"))
    )
    corpus = hosts.agg(
        F.sum("host_docs").alias("n"),
        F.sum("host_failures").alias("f"),
        F.count("*").alias("h"),
        F.sum(F.lit(1.0) * F.col("host_failures") * F.col("host_failures") / F.col("host_docs")).alias("ff"),
    )
    # Spread of the rates around the mean m, weighted by size: ff / n - m * m.
    m = F.col("f") / F.col("n")
    spread = F.greatest(F.col("ff") / F.col("n") - m * m, F.lit(0.0))
    chance = m * (1 - m)
    # E[spread] = chance / (1 + w) + (chance - chance / (1 + w)) * h / n for a prior of weight w,
    # so the share of variance between hosts, 1 / (1 + w), is:
    noise = chance * F.col("h") / F.col("n")
    share = F.when(chance > noise, F.greatest((spread - noise) / (chance - noise), F.lit(0.0))).otherwise(F.lit(0.0))
    prior = corpus.select(m.alias("prior_rate"), share.alias("host_share"))
    weight = (1 - F.col("host_share")) / F.col("host_share")
    shrunk = F.when(F.col("host_share") <= 0, F.col("prior_rate")).otherwise(
        (F.col("host_failures") + weight * F.col("prior_rate")) / (F.col("host_docs") + weight)
    )
    # The prior is one row.
    return hosts.join(F.broadcast(prior)).withColumn("host_rate", shrunk).drop("host_share")


def apply_rules(docs: DataFrame, source: str = "source", host_rate: float = HOST_RATE) -> DataFrame:
    """Verdicts on documents: ``base_failed``, the host's figures, and ``kept``.

    Null text has no words and so fails; a null host has no verdict, and its documents stand
    or fall alone.  Repeated rows count each.  Rows keep their number.

    The measured rows are narrow and written once: the counts and the verdicts read them, not
    the texts.  Counts are combined before the shuffle, so a host of any size is one row per
    task; the join back is an equi-join whose skewed partitions adaptive execution splits.
    """
    from ..sources.workspace import materialize

    measured = materialize(features(docs, source), "host-measures")
    verdicts = host_rates(measured).select(
        "source", "host_docs", "host_failures", "host_rate", (F.col("host_rate") >= host_rate).alias("host_dropped")
    )
    joined = measured.join(verdicts, "source", "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(F.col("host_dropped"), F.lit(False)))
