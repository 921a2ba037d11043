"""Order MinHash fingerprints, in DataFrame functions.

A text's words are numbered by occurrence in runs of ``RUN``; each of ``TUPLES`` hash orders
picks the ``2`` smallest of these occurrence-numbered runs, they are put in text order, and
their hash is one component.  Moving or changing text changes what is picked or its order, so
the share of equal components follows edit distance and not only shared content.

All orders come from one hash: order i ranks by the distance of the hash from point i of
``TUPLES`` equally spaced points, going up and around.  Each is a uniformly random order, and
one sort serves all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .native import let, upto

#: Words per run, and components (a power of two).
RUN = 2
TUPLES = 64
#: A longer stretch without white space counts as several words.
WORD = r"[^\x20\x09-\x0D]{1,16}"
#: Places of runs take the low bits of a number and hashes the 39 bits above.
PLACE_BITS = 24
PLACE = (1 << PLACE_BITS) - 1
BITS = 24
EMPTY = (1 << BITS) - 1
#: Rows per bucket of the ordering by doc_id, and most buckets.
BUCKET_ROWS, MOST_BUCKETS, CUTS = 4096, 65_536, 63


def _placed(hashed: Column, place: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(hashed, 63 - 38), PLACE_BITS).bitwiseOR(place.bitwiseAND(PLACE))


def _hash(x: Column) -> Column:
    return F.shiftright(x, PLACE_BITS)


def fingerprint(text: Column) -> Column:
    """``TUPLES`` numbers of ``BITS`` bits; equal texts have equal ones, and so have texts that
    differ in white space only.  Without words all are ``EMPTY``; a text of fewer words than a
    run is one run."""

    def runs(words: Column) -> Column:
        n = F.greatest(F.size(words) - (RUN - 1), F.least(F.size(words), F.lit(1)))
        made = F.transform(
            upto(n), lambda i: _placed(F.xxhash64(*(F.get(words, i + k) for k in range(RUN))), i.cast("long"))
        )
        return F.sort_array(made)

    def numbered(s: Column) -> Column:
        """Sorted runs to sorted occurrence-numbered runs: the first occurrence keeps the run's
        hash, so only the others move."""
        again = lambda x, j: (j > 0) & (_hash(x) == _hash(F.get(s, j - 1)))

        def renumber(others: Column) -> Column:
            n = F.size(others)
            new = lambda j: (j == 0) | (_hash(F.get(others, j)) != _hash(F.get(others, j - 1)))
            spread = lambda starts: F.flatten(
                F.transform(
                    starts,
                    lambda b, r: F.transform(
                        F.slice(others, b + 1, F.coalesce(F.get(starts, r + 1), n) - b),
                        lambda x, k: _placed(F.xxhash64(_hash(x), k), x.bitwiseAND(PLACE)),
                    ),
                )
            )
            kept = F.filter(s, lambda x, j: ~again(x, j))
            moved = F.sort_array(F.concat(kept, let(F.filter(upto(n), new), spread)))
            return F.when(n == 0, s).otherwise(moved)

        return let(F.filter(s, again), renumber)

    point = lambda x: F.shiftright(x, 63 - (TUPLES.bit_length() - 1)).cast("int")

    def components(o: Column) -> Column:
        n = F.size(o)
        first = lambda j: (j == 0) | (point(F.get(o, j)) != point(F.get(o, j - 1)))

        def smallest(starts: Column) -> Column:
            """For each point the place of the first run at or above it, or the first of all."""
            before = lambda r: F.when(r == 0, F.lit(-1)).otherwise(point(F.get(o, F.get(starts, r - 1))))
            reached = F.flatten(F.transform(starts, lambda b, r: F.array_repeat(b, point(F.get(o, b)) - before(r))))
            return F.concat(reached, F.array_repeat(F.lit(0), F.lit(TUPLES - 1) - point(F.get(o, n - 1))))

        def tuple_hash(b: Column) -> Column:
            one, two = F.get(o, b), F.get(o, (b + 1) % n)
            ordered = one.bitwiseAND(PLACE) <= two.bitwiseAND(PLACE)
            hashed = F.when(n == 1, F.xxhash64(_hash(one))).when(ordered, F.xxhash64(_hash(one), _hash(two))).otherwise(
                F.xxhash64(_hash(two), _hash(one))
            )
            return F.shiftrightunsigned(hashed, 64 - BITS).cast("int")

        made = F.transform(let(F.filter(upto(n), first), smallest), tuple_hash)
        return F.when(n == 0, F.array_repeat(F.lit(EMPTY), TUPLES)).otherwise(made)

    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return let(words, lambda w: let(runs(w), lambda s: let(numbered(s), components)))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal components."""
    equal = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(equal, F.lit(0), lambda s, x: s + x) / F.lit(float(TUPLES))


def written(components: Column) -> Column:
    return F.array_join(F.transform(components, lambda x: F.lpad(F.lower(F.hex(x)), BITS // 4, "0")), "")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, components, and those of the next row by ascending doc_id; the last row's
    next is the first.  Rows of one doc_id follow each other by text, null ids come first.

    Rows are dealt into buckets of neighbouring ids, so texts are shuffled once and sorted
    within buckets; the first rows of each bucket also go, as a copy, to the bucket before.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    shares = [(i + 1) / (CUTS + 1) for i in range(CUTS)]
    facts = rows.agg(
        F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.percentile_approx("doc_id", shares, 10_000).alias("cuts")
    ).first()
    edges = sorted({facts["low"] or 0, *(facts["cuts"] or [])})
    n = min(MOST_BUCKETS, max(1, -(-facts["n"] // BUCKET_ROWS)))
    fine = -(-n // len(edges))
    ends = [*edges[1:], (facts["high"] or 0) + 1]
    # Between two cuts ids are dealt evenly by value.
    steps = [max(1, -(-(b - a) // fine)) for a, b in zip(edges, ends, strict=True)]
    constant = lambda xs: F.lit(xs).cast("array<bigint>")
    doc_id = F.coalesce(F.col("doc_id"), F.lit(edges[0]))
    coarse = F.greatest(F.size(F.filter(constant(edges), lambda e: e <= doc_id)) - 1, F.lit(0))
    within = F.floor((doc_id - F.get(constant(edges), F.col("_coarse"))) / F.get(constant(steps), F.col("_coarse")))
    placed = rows.withColumn("_coarse", coarse).withColumn("_bucket", F.col("_coarse") * fine + F.least(within, F.lit(fine - 1)))
    placed = placed.select("doc_id", "text", "_bucket")

    ordered = Window.orderBy("_bucket")
    firsts = placed.groupBy("_bucket").agg(F.min(F.struct("doc_id"))["doc_id"].alias("_first"))  # nulls are smallest
    # At most MOST_BUCKETS rows, so one task orders them and all tasks may hold them.
    firsts = firsts.select(
        "_bucket",
        "_first",
        F.coalesce(F.lag("_bucket").over(ordered), F.max("_bucket").over(Window.partitionBy())).alias("_to"),
        F.lag("_bucket").over(ordered).isNull().cast("int").alias("_around"),
    ).withColumnRenamed("_bucket", "_from")
    match = (F.col("_bucket") == F.col("_from")) & F.col("doc_id").eqNullSafe(F.col("_first"))
    copies = placed.join(F.broadcast(firsts), match).select("doc_id", "text", F.col("_to").alias("_bucket"), F.col("_around"), F.lit(True).alias("_copy"))
    both = placed.select("doc_id", "text", "_bucket", F.lit(0).alias("_around"), F.lit(False).alias("_copy")).unionAll(copies)
    both = both.withColumn("components", fingerprint(F.col("text")))
    window = Window.partitionBy("_bucket").orderBy("_around", "doc_id", "text", "_copy")
    following = both.select(
        "doc_id", "text", "components", "_copy", F.lead("text").over(window).alias("next_text"), F.lead("components").over(window).alias("next_components")
    )
    return following.filter(~F.col("_copy")).drop("_copy")


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last floor(n / 2) code points replaced by the first of ``following``."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likenesses.

    Null text is empty; repeated rows are compared each; with one row, the next row is itself.
    """
    rows = with_next(docs).withColumn("edited_text", edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("edited_components", fingerprint(F.col("edited_text")))
    return rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("components")).alias("fingerprint"),
        written(F.col("edited_components")).alias("edited_fingerprint"),
        likeness(F.col("components"), F.col("edited_components")).alias("near_edited"),
        likeness(F.col("components"), F.col("next_components")).alias("near_next"),
    )
