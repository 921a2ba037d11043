"""Audit of document filters that act together, from one relation of failing ids per filter.

A table of ids is stored for each filter.  What survives a prefix of an order is the left
anti-join of all rows with the relations of the prefix, and depends on the set of its filters
only; what a filter fails is the left semi-join with its relation.  Removals, redundancies and
label losses of all orders follow from the counts of these joins.

Survivors of all sets of filters grow filter by filter, with one anti-join each over rows of a
few bytes: a set of n filters takes n of them and not one for each prefix.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import materialize, workspace

#: ASCII white space, which separates words.
SPACES = "[\\x20\\x09-\\x0D]+"
#: The filters of ``failing_ids`` in alphabetical order.
FILTERS = "ABCDE"


def _conditions(text: Column, words: Column) -> dict[str, Column]:
    """When a single text fails; filter E compares texts and is not among them."""
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.char_length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def measured_rows(docs: DataFrame, labels: DataFrame, folder: str) -> DataFrame:
    """One narrow stored row per document: number, id, part, labels, text key, conditions A to D.

    A null text counts as an empty one, a null lang as the empty part.  A document is good (toxic) if
    any row of its id in ``labels`` says quality = 1 (toxic = 1).
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
        words.alias("words"),
    )
    conditions = _conditions(F.col("text"), F.col("words"))
    rows = read.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("text_key"), *[c.alias(f"fails_{f}") for f, c in conditions.items()])
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")
    )
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("good", "toxic")}
    joined = rows.join(marks, "doc_id", "left").withColumns(zero)
    return materialize(joined.withColumn("row", F.monotonically_increasing_id()), "measured", folder)


def failing_ids(measured: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Per filter, a stored table with the numbers of the rows that fail it.

    E keeps, of equal texts, the rows with the smallest doc_id; a row without an id is neither
    smaller nor greater than others and passes.  Smallest ids are combined before the shuffle,
    and the join back has the id in its key, so copies of one text do not meet in a task.
    """
    known = measured.filter("doc_id IS NOT NULL").select("row", "text_key", "doc_id")
    first = known.groupBy("text_key").agg(F.min("doc_id").alias("doc_id"))
    fails = {f: measured.filter(f"fails_{f}").select("row") for f in FILTERS[:-1]}
    fails["E"] = known.join(first, ["text_key", "doc_id"], "left_anti").select("row")
    return {f: materialize(ids, f"fails_{f}", folder) for f, ids in fails.items()}


def interactions(rows: DataFrame, failing: Mapping[str, DataFrame], folder: str) -> DataFrame:
    """What each filter does at each step of every order, per part.

    ``rows`` has a unique ``row``, ``part``, ``good`` and ``toxic`` (0 or 1); ``failing`` has, by
    one-letter name, the ``row`` of those that fail.  One result row per part, order of the
    filters and step, zeros included; no rows give no result.
    """
    names = list(failing)
    every = (1 << len(names)) - 1
    narrow = rows.select("row", "part", "good", "toxic")

    # Places 0 to ``every``: survivors of the set of filters with these bits.  Each filter adds, to the
    # survivors of all sets of the filters before it, those that it leaves of them.
    counted = narrow.withColumn("at", F.lit(0))
    for i, name in enumerate(names):
        left = counted.join(failing[name], "row", "left_anti").withColumn("at", F.col("at") + (1 << i))
        counted = counted.unionByName(left)
        if i + 1 < len(names):
            counted = materialize(counted, f"survivors_{i}", folder)
    # The places behind: what each filter fails.
    for i, name in enumerate(names):
        fails = narrow.join(failing[name], "row", "left_semi")
        counted = counted.unionByName(fails.withColumn("at", F.lit(every + 1 + i)))
    figures = counted.groupBy("part", "at").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )
    by_part = figures.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("at", F.struct("n", "good", "toxic")))).alias("figures"))

    def value(at: Column, field: str) -> Column:
        return F.coalesce(F.col("figures")[at][field], F.lit(0).cast("long"))

    def bits(letters: Column) -> Column:
        return sum((F.when(F.instr(letters, name) > 0, 1 << i).otherwise(0) for i, name in enumerate(names)), F.lit(0))

    def shapley(i: int) -> Column:
        """Removals by one filter, weighted by the number of orders that put each set before it."""
        total = F.lit(0).cast("long")
        for prefix in range(every + 1):
            if not prefix >> i & 1:
                before = prefix.bit_count()
                weight = factorial(before) * factorial(len(names) - 1 - before)
                total = total + weight * (value(F.lit(prefix), "n") - value(F.lit(prefix | 1 << i), "n"))
        return total

    orders = F.explode(F.array(*[F.lit("".join(p)) for p in permutations(names)]))
    by_part = by_part.withColumn("values", F.array(*[shapley(i) for i in range(len(names))]))
    steps = by_part.withColumn("filter_order", orders).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(names)))))
    own = F.col("filter_order").substr(F.col("step"), F.lit(1))
    before = F.col("filter_order").substr(F.lit(1), F.col("step") - 1)
    steps = steps.withColumns({"before": bits(before), "own": bits(own), "number": F.instr(F.lit("".join(names)), own)})
    after = F.col("before") + F.col("own")
    lost = {field: value(F.col("before"), field) - value(after, field) for field in ("n", "good", "toxic")}
    return steps.select(
        "part",
        "filter_order",
        "step",
        value(after, "n").alias("kept"),
        lost["n"].alias("removed"),
        (value(every + F.col("number"), "n") - lost["n"]).alias("redundant"),
        (value(every - F.col("own"), "n") - value(F.lit(every), "n")).alias("unique_fails"),
        lost["good"].alias("good_lost"),
        lost["toxic"].alias("toxic_lost"),
        F.element_at("values", F.col("number")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters over all documents: one row per part, order and step.

    Null and empty texts have no words and fail A; texts of any length are measured whole by
    SQL functions.  Repeated rows count each, and rows of one doc_id never make each other
    fail E.  Other columns of either table do not matter.  No documents give no rows; no
    labels give no losses.
    """
    folder = workspace(docs.sparkSession)
    measured = measured_rows(docs, labels, folder)
    return interactions(measured, failing_ids(measured, folder), folder)
