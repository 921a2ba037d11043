"""Language identification by character language models.

For each language an interpolated Kneser-Ney model of four characters is counted over all
training texts.  The model's entries are keyed by the sequences themselves: in sorted arrays
that every task gets, or, when these outgrow ``SHARED_CELLS``, in a table that the sequences
of the texts are joined with.  A text gets the language whose model gives it the lowest
cross-entropy per character, with a probability from a fitted temperature and a flag on texts
that no model explains.

Characters are lower-cased letters; everything else is one space.  A character is 16 bits
(rarer planes fold onto the first), so four are a 64-bit number.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..sources.workspace import materialize
from .texts import few_collections, map_texts, pieces

ORDER = 4
#: Numbers (rows times languages) of a model that is sent to every task; larger ones stay a
#: table on Spark.  Both ways give the same results.
SHARED_CELLS = 32_000_000
#: Range of ``place``, which spreads sequences; models do not use it.
PLACES = 1_048_573
FACTOR = 65_599
#: Distinct sequences a task holds before it hands them on.
HELD = 400_000
#: Most training rows that the temperature is fitted to.
CALIBRATION = 1500
#: Share of the training rows that lies beyond a language's rejection limit.
REJECTED = 0.002
UNKNOWN = "und"
SPACE = 32
_FLOOR = np.log(1 / 65536.0)

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def grams(text: str) -> np.ndarray:
    """The overlapping four-character sequences of a text; none if it has no letter."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), "<u4")
    is_letter = letters()[codes]
    kept = is_letter.copy()
    kept[1:] |= is_letter[:-1]  # a space after each run of letters, and one before the first
    kept[0] = True
    x = np.where(is_letter, codes & 0xFFFF, SPACE)[kept].astype(np.uint64)
    if len(x) < ORDER or not is_letter.any():
        return np.zeros(0, np.uint64) if not is_letter.any() else _joined(np.concatenate([np.full(ORDER - len(x), SPACE, np.uint64), x]))
    return _joined(x)


def _joined(x: np.ndarray) -> np.ndarray:
    out = x[: len(x) - ORDER + 1].copy()
    for i in range(1, ORDER):
        out = out << np.uint64(16) | x[i : len(x) - ORDER + 1 + i]
    return out


def place(sequence: np.ndarray) -> np.ndarray:
    """Hash of sequences of up to four characters (numpy and SQL forms agree)."""
    out = np.zeros(len(sequence), np.int64)
    for shift in (48, 32, 16, 0):
        out = (out * FACTOR + ((sequence >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.int64)) % PLACES
    return out


def place_sql(sequence):
    out = F.lit(0).cast("long")
    for shift in (48, 32, 16, 0):
        out = (out * FACTOR + F.shiftrightunsigned(sequence, shift).bitwiseAND(0xFFFF)) % PLACES
    return out


def count_sequences(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows with text and language, combined before the shuffle."""

    def run(batches):
        few_collections()
        held: dict[str, list] = {}

        def give():
            for lang, parts in held.items():
                keys, counts = _merged(parts)
                for low in range(0, len(keys), 50_000):
                    k = keys[low : low + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(k), pa.string()), pa.array(k.view(np.int64)), pa.array(counts[low : low + 50_000])],
                        names=["lang", "gram", "n"],
                    )
            held.clear()

        size = 0
        for batch in batches:
            for part in pieces(batch, limit=2 << 20):
                by: dict[str, list[np.ndarray]] = {}
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                    by.setdefault(lang, []).append(grams(text))
                for lang, found in by.items():
                    keys, counts = np.unique(np.concatenate(found), return_counts=True)
                    held.setdefault(lang, []).append((keys, counts.astype(np.int64)))
                    if len(held[lang]) >= 8:
                        held[lang] = [_merged(held[lang])]
                size = sum(len(k) for parts in held.values() for k, _ in parts)
                if size > HELD:
                    held.update({lang: [_merged(parts)] for lang, parts in held.items()})
                    if sum(len(p[0][0]) for p in held.values()) > HELD // 2:
                        yield from give()
        yield from give()

    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(inverse, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    #: Per order: sorted sequences, and log probabilities by language (NaN where unseen).
    entries: dict[int, tuple[np.ndarray, np.ndarray]]
    #: Per order the same for contexts and their log back-off weights.
    contexts: dict[int, tuple[np.ndarray, np.ndarray]]
    temperature: float = 0.1
    limits: np.ndarray = field(default_factory=lambda: np.zeros(0))
    #: The table of ``_smoothed`` if it is too large for the arrays above, which are then empty.
    table: DataFrame | None = None

    def log_probabilities(self, sequences: np.ndarray) -> np.ndarray:
        n = len(self.languages)
        out = np.full((len(sequences), n), np.nan, np.float32)
        back = np.zeros((len(sequences), n), np.float32)
        open_ = np.arange(len(sequences))
        for order in range(ORDER, 0, -1):
            mask = np.uint64((1 << 16 * order) - 1)
            seq = sequences[open_] & mask
            values = _found(self.entries[order], seq, n)
            here = out[open_]
            fill = np.isnan(here) & ~np.isnan(values)
            here[fill] = (back[open_] + values)[fill]
            out[open_] = here
            left = np.isnan(here).any(1)
            open_, seq = open_[left], seq[left]
            if not len(open_):
                return out
            # Languages that have not seen the context back off at no cost.
            back[open_] += np.nan_to_num(_found(self.contexts[order], seq >> np.uint64(16), n))
        return np.where(np.isnan(out), back + _FLOOR, out).astype(np.float32)

    def cross_entropies(self, texts: list[str | None]) -> np.ndarray:
        """Nats per sequence of each text (rows) and language; NaN for texts without a letter."""
        result = np.full((len(texts), len(self.languages)), np.nan)
        keys, weights, owners = [], [], []
        for i, text in enumerate(texts):
            if text and len(g := grams(text)):
                k, c = np.unique(g, return_counts=True)
                keys.append(k)
                weights.append(c / len(g))
                owners.append(i)
        if owners and self.languages:
            values = self.log_probabilities(np.concatenate(keys)) * np.concatenate(weights)[:, None]
            starts = np.cumsum([0, *map(len, keys)])[:-1]
            result[owners] = -np.add.reduceat(values, starts, axis=0)
        return result

    def decide(self, entropies: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, probability and rejection of each row of cross-entropies."""
        known = ~np.isnan(entropies).all(1) if len(self.languages) else np.zeros(len(entropies), bool)
        best = np.zeros(len(entropies), int)
        if known.any():
            best[known] = entropies[known].argmin(1)
        score = np.zeros(len(entropies))
        if known.any():
            x = entropies[known]
            score[known] = 1 / np.exp(-(x - x.min(1, keepdims=True)) / self.temperature).sum(1)
        rejected = ~known
        if len(self.limits):
            rejected[known] = entropies[known].min(1) > self.limits[best[known]]
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], score, rejected


def _found(table: tuple[np.ndarray, np.ndarray], sequences: np.ndarray, n: int) -> np.ndarray:
    keys, values = table
    if not len(keys):
        return np.full((len(sequences), n), np.nan, np.float32)
    at = np.minimum(np.searchsorted(keys, sequences), len(keys) - 1)
    out = values[at]
    out[keys[at] != sequences] = np.nan
    return out


def _smoothed(counts: DataFrame) -> DataFrame:
    """(order, kind, lang, key, value): log probabilities of sequences, log back-off weights of contexts.

    The highest order has counts of occurrences; a lower one counts the different characters
    before each sequence.  Each order is discounted by n1 / (n1 + 2 n2) of its language.
    """
    levels = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << 16 * order) - 1))
        levels[order] = levels[order + 1].groupBy("lang", suffix.alias("gram")).agg(F.count("*").alias("n"))
    lower = None
    parts = []
    for order in range(1, ORDER + 1):
        level = levels[order]
        context = F.shiftrightunsigned(F.col("gram"), 16) if order > 1 else F.lit(0).cast("long")
        rows = level.withColumn("context", context)
        once = F.sum((F.col("n") == 1).cast("double"))
        twice = F.sum((F.col("n") == 2).cast("double"))
        discount = level.groupBy("lang").agg(F.least(F.lit(0.95), F.greatest(F.lit(0.05), F.coalesce(F.try_divide(once, once + 2 * twice), F.lit(0.5)))).alias("d"))
        after = rows.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        after = after.join(discount, "lang").withColumn("weight", F.col("d") * F.col("kinds") / F.col("total"))
        joined = rows.join(after, ["lang", "context"])
        if order == 1:
            rest = F.lit(float(np.exp(_FLOOR)))
        else:
            joined = joined.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1))).join(
                lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("rest")), ["lang", "suffix"]
            )
            rest = F.col("rest")
        p = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total") + F.col("weight") * rest
        lower = joined.select("lang", "gram", p.alias("p"))
        parts.append(lower.select(F.lit(order).alias("order"), F.lit("entry").alias("kind"), "lang", F.col("gram").alias("key"), F.log("p").cast("float").alias("value")))
        parts.append(after.select(F.lit(order).alias("order"), F.lit("context").alias("kind"), "lang", F.col("context").alias("key"), F.log("weight").cast("float").alias("value")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionAll(part)
    return rows


def train(docs: DataFrame) -> Model:
    """Models of all languages of the rows given, counted over all their texts.

    Rows with a null text or language teach nothing.  Without any row the model has no
    languages and answers ``und``.
    """
    counts = materialize(count_sequences(docs), "character-sequences")
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    smoothed = materialize(_smoothed(counts), "language-models")
    # Of few languages the rows weigh more than the numbers.
    if smoothed.count() * max(8, len(languages)) > SHARED_CELLS:
        model = Model(languages, {}, {}, table=smoothed)
    else:
        model = _shared(languages, smoothed.toArrow())
    if languages:
        calibrate(model, docs)
    return model


def _shared(languages: list[str], table: pa.Table) -> Model:
    """A model whose entries are arrays, from at most ``SHARED_CELLS`` / 8 rows."""
    order = table.column("order").to_numpy()
    kind = pc.equal(table.column("kind"), "entry").to_numpy()
    lang = pc.index_in(table.column("lang"), value_set=pa.array(languages, pa.string())).to_numpy()
    where, value = table.column("key").to_numpy().view(np.uint64), table.column("value").to_numpy()

    def arrays(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(where[rows], return_inverse=True)
        values = np.full((len(keys), len(languages)), np.nan, np.float32)
        values[at, lang[rows]] = value[rows]
        return keys, values

    return Model(
        languages,
        {o: arrays(kind & (order == o)) for o in range(1, ORDER + 1)},
        {o: arrays(~kind & (order == o)) for o in range(1, ORDER + 1)},
    )


def calibrate(model: Model, docs: DataFrame) -> None:
    """Fits each language's rejection limit to a quantile of all its training rows, and the
    temperature to log loss on the ``CALIBRATION`` ones with the smallest hashes of their ids."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    model.limits = rejection_limits(model, rows)
    chosen = rows.filter("doc_id IS NOT NULL").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(CALIBRATION)
    got = entropies(rows.join(F.broadcast(chosen), "doc_id"), model, ["doc_id", "lang"]).collect()
    x = np.array([r["entropies"] for r in got if r["entropies"] is not None])
    truth = np.array([model.languages.index(r["lang"]) for r in got if r["entropies"] is not None], int)
    if not len(x):
        return
    losses = {}
    for t in np.geomspace(0.01, 2, 24):
        z = -(x - x.min(1, keepdims=True)) / t
        losses[t] = float(np.mean(np.log(np.exp(z).sum(1)) - z[np.arange(len(x)), truth]))
    model.temperature = float(min(losses, key=losses.get))


def rejection_limits(model: Model, rows: DataFrame) -> np.ndarray:
    """A limit per language; one with fewer than 20 training rows takes the quantile of all rows."""
    at = F.array_position(F.lit(model.languages), F.col("lang")).cast("int") - 1
    own = entropies(rows, model, ["lang"]).select("lang", F.get("entropies", at).alias("own")).filter("own IS NOT NULL")
    quantile = F.percentile_approx("own", 1 - REJECTED, 10_000)
    got = {r["lang"]: r for r in own.rollup("lang").agg(F.count("*").alias("n"), quantile.alias("q")).collect()}
    if None not in got or not got[None]["n"]:
        return np.zeros(0)
    chosen = [r if (r := got.get(lang)) and r["n"] >= 20 else got[None] for lang in model.languages]
    # One fifth of room beyond the quantile, because short texts scatter more.
    return np.array([1.2 * r["q"] for r in chosen])


def _sequence_values(sequences: DataFrame, model: Model) -> DataFrame:
    """(key, values): the log probability of each distinct sequence in all languages."""
    number = F.array_position(F.lit(model.languages), F.col("lang")).cast("int")
    rows = sequences
    for order in range(ORDER, 0, -1):
        key = F.col("key") if order == ORDER else F.col("key").bitwiseAND(F.lit((1 << 16 * order) - 1))
        context = F.shiftrightunsigned(key, 16) if order > 1 else F.lit(0).cast("long")
        for kind, at in (("entry", key), ("context", context)):
            part = model.table.filter((F.col("order") == order) & (F.col("kind") == kind))
            pairs = F.collect_list(F.struct(number.alias("number"), F.col("value").cast("double").alias("value")))
            found = part.groupBy(F.col("key").alias("_at")).agg(F.map_from_entries(pairs).alias(f"{kind}{order}"))
            if order == 1 and kind == "context":
                found = F.broadcast(found)  # one row
            rows = rows.join(found, at == F.col("_at"), "left").drop("_at")

    def value(i):
        back, choices = F.lit(0.0), []
        for order in range(ORDER, 0, -1):
            choices.append(back + F.try_element_at(F.col(f"entry{order}"), i))
            # Languages that have not seen the context back off at no cost.
            back = back + F.coalesce(F.try_element_at(F.col(f"context{order}"), i), F.lit(0.0))
        return F.coalesce(*choices, back + F.lit(float(_FLOOR)))

    return rows.select("key", F.transform(F.sequence(F.lit(1), F.lit(len(model.languages))), value).alias("values"))


def _joined_entropies(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """``entropies`` by a join of each text's distinct sequences with the model's table."""

    def start():
        def call(texts):
            found = [np.unique(grams(t or ""), return_counts=True) for t in texts]
            return [[k.view(np.int64) for k, _ in found], [c / max(1, c.sum()) for _, c in found]]

        return call

    numbered = docs.select(*columns, F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("_row"))
    rows = materialize(map_texts(numbered, [*columns, "_row"], "_keys array<long>, _weights array<double>", start), "text-sequences")
    pairs = rows.select("_row", F.explode(F.arrays_zip("_keys", "_weights")).alias("_pair"))
    pairs = pairs.select("_row", F.col("_pair._keys").alias("key"), F.col("_pair._weights").alias("weight"))
    values = materialize(_sequence_values(pairs.select("key").distinct(), model), "sequence-values")
    each = pairs.join(values, "key").select("_row", "weight", F.posexplode("values").alias("_pos", "_value"))
    sums = each.groupBy("_row", "_pos").agg(F.sum(F.col("weight") * -F.col("_value")).alias("_sum"))
    whole = sums.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_pos", "_sum"))).alias("_sums"))
    whole = whole.select("_row", F.col("_sums._sum").alias("entropies"))
    return rows.join(whole, "_row", "left").select(*columns, "entropies")


def entropies(docs: DataFrame, model: Model, columns) -> DataFrame:
    """``columns`` and the cross-entropies by language of every text; null if it has no letter."""
    if model.table is not None:
        return _joined_entropies(docs, model, list(columns))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        def call(texts):
            return [[None if np.isnan(r).any() else r.tolist() for r in shared.value.cross_entropies(texts)]]

        return call

    return map_texts(docs, list(columns), "entropies array<double>", start)


def map_rows(df: DataFrame, columns: list[str], name: str, added: str, call) -> DataFrame:
    """``columns`` of ``df`` and the columns ``added`` that ``call`` makes from lists of ``name``."""
    schema = StructType([*df.select(*columns).schema.fields, *StructType.fromDDL(added).fields])
    arrow = to_arrow_schema(schema)
    n = len(columns)

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                made = call(part.column(n).to_pylist())
                arrays = [part.column(i) for i in range(n)]
                arrays += [pa.array(x, type=f.type) for x, f in zip(made, list(arrow)[n:], strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=arrow.names)

    return df.select(*columns, name).mapInArrow(run, schema)


def identify(docs: DataFrame, model: Model, columns=("doc_id",)) -> DataFrame:
    """``columns``, ``lang_pred``, ``score`` and ``rejected`` of every whole text.

    Null texts and texts without a letter get ``und``, score 0, rejected.  A rejected text
    keeps its nearest language.
    """
    added = "lang_pred string, score double, rejected boolean"
    # Bounded by SHARED_CELLS.
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, table=None))
    if model.table is not None:
        n = len(model.languages)

        def decide(rows):
            known = np.array([[np.nan] * n if r is None else r for r in rows], float).reshape(len(rows), n)
            return shared.value.decide(known)

        return map_rows(entropies(docs, model, columns), list(columns), "entropies", added, decide)

    def start():
        return lambda texts: shared.value.decide(shared.value.cross_entropies(texts))

    return map_texts(docs, list(columns), added, start)
