"""Exact join of texts whose sets of word n-grams have a Jaccard similarity of a threshold.

Texts with equal sets form a class and take part once.  Classes meet by prefixes: hashes of
n-grams are in random order, and two sets that link share at least T of their smallest ones
(``shared_least``).  What has fewer shared hashes links with nothing.  In a large table most
of the rest shares single n-grams with many texts, but never a stretch of n-grams: the range
of hashes is cut into so many buckets that two sets that link hold the same elements in some
of them (``bucket_signs``).  Equal buckets group the sets into parts that hold all links, and each part is searched for T
occurrences with inverted lists over whole sets: short lists are merged with a heap, long
ones are probed by binary search (or counted, where they are too many to be set aside), and a pair links by its exact overlap.

Links inside a component already found add nothing and are not looked for, so copies of one
text that all differ a little cost a search each and not a pair each.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.workspace import materialize, workspace
from .components import connected_components
from .texts import discard, few_collections, mix, pieces, release, shingle_set

WORDS, PERCENT = 3, 90
#: Sent buckets that two sets that link have in common at least.
SHARED = 2
#: Bytes of text whose buckets are made at once.
SIGN_BYTES = 1 << 20
#: Lists up to this length are merged; longer ones are probed where the count allows it.
SHORT = 8
#: Bytes of sets that one search holds; larger parts are searched in blocks.
PART_BYTES = 16 << 20
#: Most bits of the bitmap of ids (16 MB in each executor).
MOST_BITS = 1 << 27
#: Entries of lists that can be counted in the time of one probe.
PROBE = 24

_UPPER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))


def words_of(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(_UPPER)


def least_overlap(n, percent: int):
    """No set of size ``n`` links with a smaller overlap than this."""
    return -(-percent * n // 100)


def shared_least(n, percent: int):
    """T of a set of size ``n``; it grows with ``n``."""
    alpha = least_overlap(n, percent)
    return np.minimum(alpha, (n - alpha) // 2 + 2)


def prefix_length(n, percent: int):
    return n - least_overlap(n, percent) + shared_least(n, percent)


def shingle_prefixes(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n, k1, k2, prefix): size, hash and smallest elements of each text's set."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("prefix", pa.list_(pa.int64()))])

    def run(batches):
        few_collections()
        for batch in batches:
            for part in pieces(batch):
                out: list[list] = [[], [], [], []]
                for text in part.column("text").to_pylist():
                    s = shingle_set(words_of(text), words)
                    k1, k2 = set_key(s)
                    for column, value in zip(out, (len(s), k1, k2, s[: prefix_length(len(s), percent)].view(np.int64)), strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(out, list(schema)[1:], strict=True))], schema=schema)

    return docs.mapInArrow(run, "doc_id long, n long, k1 long, k2 long, prefix array<long>")


def set_key(s: np.ndarray) -> tuple[int, int]:
    key = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(key[:8], "little", signed=True), int.from_bytes(key[8:], "little", signed=True)


@cache
def bands(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lows, differ, buckets) of each band of sizes, from its smallest size on.

    A pair belongs to the band of its smaller set; ``differ`` is the most elements that only
    one set of a pair that links has.  With so many buckets, all but ``differ`` hold the same
    elements in both sets; one in four more than that must, so that small ones are not sent.
    """
    lows = [1]
    while lows[-1] < 1 << 40:
        lows.append(max(lows[-1] + 1, lows[-1] * 5 // 4))
    smaller = np.array(lows[1:], np.int64) - 1
    differ = (smaller + 100 * smaller // percent) * (100 - percent) // (100 + percent)
    return np.array(lows[:-1], np.int64), differ, differ + SHARED + differ // 4


def bucket_signs(sets: list[np.ndarray], percent: int) -> list[np.ndarray]:
    """Hashes of the fullest buckets of each set; two different sets that link share ``SHARED``.

    In a band of sizes every set has equally many buckets, and all but ``differ`` of them are
    equal in two sets that link.  By one order of all buckets, the fullest first, the first
    ``differ + SHARED`` then have ``SHARED`` in common.  A set may be the smaller or the larger
    of a pair, so it sends buckets for each band in which it can have a partner.
    """
    lows, differ, buckets = bands(percent)
    sizes = np.array([len(s) for s in sets], np.int64)
    first, last = (np.searchsorted(lows, n, "right") - 1 for n in (least_overlap(sizes, percent), sizes))
    owner = np.repeat(np.arange(len(sets)), last - first + 1)
    band = np.arange(len(owner)) - np.searchsorted(owner, owner) + first[owner]
    pairs = (sizes[owner] > 0) & (differ[band] > 0)  # where nothing may differ only equal sets link
    owner, band = owner[pairs], band[pairs]
    if not len(owner):
        return [np.zeros(0, np.uint64) for _ in sets]
    elements = np.concatenate([sets[i] for i in owner])
    count, of = buckets[band], np.repeat(np.arange(len(owner)), sizes[owner])
    start = np.cumsum(count) - count
    high = elements >> np.uint64(32)
    full = np.bincount(start[of] + (high * count[of].astype(np.uint64) >> np.uint64(32)).astype(np.int64), minlength=int(count.sum()))
    sums = np.r_[np.uint64(0), np.cumsum(mix(elements))]
    ends = np.cumsum(full)
    of = np.repeat(np.arange(len(owner)), count)
    place = np.arange(len(of)) - start[of]
    signs = mix(sums[ends] - sums[ends - full] + mix((band[of] << 40 | place).astype(np.uint64)))
    order = np.lexsort((signs, -full, of))
    sent = order[place < differ[band][of] + SHARED]  # sorted by owner, as place is
    return np.split(signs[sent], np.searchsorted(owner[of[sent]], np.arange(1, len(sets))))


def set_signs(texts: DataFrame, ids: DataFrame, words: int, percent: int) -> DataFrame:
    """(rep, k1, k2, signs): hash of each text's set and of its fullest buckets.

    Of the texts whose doc_id is in ``ids`` (rep), and a few others.
    """
    known, wanted = _id_filter(texts, ids)
    schema = pa.schema([("rep", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("signs", pa.list_(pa.int64()))])

    def run(batches):
        few_collections()
        for batch in map(wanted, batches):
            for part in pieces(batch, limit=SIGN_BYTES):
                sets = [shingle_set(words_of(text), words) for text in part.column("text").to_pylist()]
                keys = [set_key(s) for s in sets]
                signs = [s.view(np.int64) for s in bucket_signs(sets, percent)]
                columns = ([k for k, _ in keys], [k for _, k in keys], signs)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True))], schema=schema)

    return known.mapInArrow(run, "rep long, k1 long, k2 long, signs array<long>")


class Lists:
    """Inverted lists over some sets: for each element the ascending numbers of its sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.n = len(sets)
        owner = np.repeat(np.arange(self.n), self.sizes)
        elements, rank = np.unique(np.concatenate(sets), return_inverse=True)
        #: Element and set in one number, sorted: all lists one after another.
        self.keys = np.sort(rank * np.int64(self.n) + owner)
        self.sets = self.keys % self.n
        self.start = np.searchsorted(self.keys, np.arange(len(elements) + 1) * np.int64(self.n))
        ends = np.cumsum(self.sizes)
        self.ranks = [rank[e - k : e] for e, k in zip(ends.tolist(), self.sizes.tolist(), strict=True)]

    def occurrences(self, query: int, least: int, wanted: np.ndarray) -> list[tuple[int, int]]:
        """(set, overlap) of the ``wanted`` sets that share ``least`` elements with one set.

        Up to ``least - 1`` of the long lists are set aside: a set in question is then in the
        others ``least`` less their number times.  Short lists are merged with a heap; a long
        one that could not be set aside is counted.  The lists set aside are probed for each
        set in question, or counted where that reads less.
        """
        ranks = self.ranks[query]
        length = self.start[ranks + 1] - self.start[ranks]
        ranks, length = ranks[length > 1], length[length > 1]
        if len(ranks) < least:
            return []
        others = np.flatnonzero(wanted)
        if len(others) * len(ranks) * PROBE < length.sum():
            return self._complete(others, np.zeros(self.n, np.int64), ranks, least)
        order = np.argsort(length, kind="stable")
        ranks, length = ranks[order], length[order]
        aside = min(least - 1, int((length > SHORT).sum()))
        merged, probed = ranks[: len(ranks) - aside], ranks[len(ranks) - aside :]
        few = np.searchsorted(length[: len(merged)], SHORT, "right")
        count = self._counted(merged[few:])
        for other, hits in groupby(heapq.merge(*(self.sets[self.start[r] : self.start[r + 1]].tolist() for r in merged[:few]))):
            count[other] += sum(1 for _ in hits)
        found = np.flatnonzero(wanted & (count >= max(1, least - aside)))
        return self._complete(found, count, probed, least)

    def _counted(self, ranks: np.ndarray) -> np.ndarray:
        """How many of these lists each set is in."""
        lists = [self.sets[self.start[r] : self.start[r + 1]] for r in ranks]
        return np.bincount(np.concatenate(lists), minlength=self.n) if lists else np.zeros(self.n, np.int64)

    def _complete(self, found: np.ndarray, count: np.ndarray, ranks: np.ndarray, least: int) -> list[tuple[int, int]]:
        """The sets among ``found`` whose count with these lists reaches ``least``."""
        if not len(found):
            return []
        total = count[found]
        if len(found) * len(ranks) * PROBE < (self.start[ranks + 1] - self.start[ranks]).sum():
            probes = (np.sort(ranks) * np.int64(self.n))[:, None] + found
            at = np.minimum(np.searchsorted(self.keys, probes.ravel()), len(self.keys) - 1)
            total = total + (self.keys[at] == probes.ravel()).reshape(probes.shape).sum(0)
        elif len(ranks):
            total = total + self._counted(ranks)[found]
        kept = total >= least
        return list(zip(found[kept].tolist(), total[kept].tolist(), strict=True))


def search(sets: list[np.ndarray], sides: np.ndarray, percent: int, across: bool, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join the components of some sets (numbers into ``sets``).

    ``across``: only pairs with one set of either side, looked for from side 1.
    ``known``: components found before; links inside them are not looked for.
    """
    lists = Lists(sets)
    label = np.arange(lists.n) if known is None else np.unique(known, return_inverse=True)[1]
    members: dict[int, list[int]] = {}
    for i, x in enumerate(label.tolist()):
        members.setdefault(x, []).append(i)
    links = []
    for query in np.flatnonzero(sides).tolist() if across else range(lists.n):
        size = int(lists.sizes[query])
        wanted = label != label[query]
        wanted &= (100 * lists.sizes >= percent * size) & (100 * size >= percent * lists.sizes)
        if across:
            wanted &= sides != sides[query]
        if not wanted.any():
            continue
        for other, overlap in lists.occurrences(query, int(least_overlap(size, percent)), wanted):
            a, b = label[query], label[other]
            if a == b or 100 * overlap < percent * (size + int(lists.sizes[other]) - overlap):
                continue
            links.append((query, other))
            if len(members[a]) < len(members[b]):
                a, b = b, a
            label[members[b]] = a
            members[a] += members.pop(b)
    return links


def link_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id.

    Two texts link when ``100 * intersection >= percent * union`` of their sets of runs of
    ``words`` words (ASCII letters lower-cased); a component's id is its smallest doc_id.
    A text of fewer words has one element, all its words; null texts and texts without words
    have none and stand alone.  Rows with a null doc_id link with nothing and have a null
    component.  Repeated rows and equal texts are in one component.  A doc_id with several texts
    is several texts: each links by itself, and each of its rows has that text's component.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    folder = workspace(docs.sparkSession)
    prefixes = materialize(shingle_prefixes(texts, words, percent), "shingle-prefixes", folder)
    rows = materialize(prefixes.drop("prefix"), "set-keys", folder)
    usable = rows.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = usable.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "classes", folder)
    enough = materialize(_meeting_sets(prefixes, classes, percent), "meeting-sets", folder)
    discard(docs.sparkSession, f"{folder}/shingle-prefixes")
    parts = materialize(_parts(texts, enough, words, percent), "parts", folder)
    release(docs.sparkSession)
    links = materialize(_search_parts(texts, parts, words, percent), "found-links", folder)
    release(docs.sparkSession)
    found = connected_components(links)
    rest = materialize(_rest(parts, found), "rest", folder)
    if not rest.isEmpty():
        found = connected_components(links.unionAll(materialize(_find_links(texts, rest, words, percent), "rest-links", folder)))
        release(docs.sparkSession)
    # Links are between classes; a component of them is named by the smallest doc_id in it.
    found = found.withColumnRenamed("node", "cid")
    known = classes.select("cid", "k1", "k2", "rep").join(found, "cid", "left")
    known = known.withColumn("component", F.coalesce("component", "cid"))
    named = known.groupBy("component").agg(F.min("rep").alias("component_id"))
    labelled = known.join(named, "component").select("k1", "k2", "component_id")
    joined = rows.select("doc_id", "n", "k1", "k2").join(labelled, ["k1", "k2"], "left")
    found_id = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), found_id.alias("component_id"))


def _least_t(percent: int) -> Column:
    """The least T that any partner of a set of size ``n`` brings."""
    alpha = lambda n: F.ceil(percent * n / F.lit(100.0))
    n = alpha(F.col("n"))
    return F.least(alpha(n), F.floor((n - alpha(n)) / 2) + 2)


def _met(entries: DataFrame) -> DataFrame:
    """The rows (cid, h) whose h another class has too.

    What a hash's classes have in common is combined before the shuffle and joined back, so
    the classes of a frequent hash do not meet in one task.
    """
    shared = entries.groupBy("h").agg(F.min("cid").alias("low"), F.max("cid").alias("high")).filter("low <> high")
    return entries.join(shared.select("h"), "h", "left_semi")


def _meeting_sets(prefixes: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(cid, rep, n, k1, k2) of the classes that share enough hashes of their prefix with any other."""
    usable = prefixes.filter((F.col("n") > 0) & F.col("doc_id").isNotNull()).withColumnRenamed("doc_id", "rep")
    own = usable.select("rep", "k1", "k2", "prefix").join(classes.select("k1", "k2", "rep", "cid"), ["k1", "k2", "rep"])
    met = _met(own.select("cid", F.explode("prefix").alias("h"))).groupBy("cid").agg(F.count(F.lit(1)).alias("met"))
    return met.join(classes, "cid").filter(F.col("met") >= _least_t(percent)).drop("met")


def _parts(texts: DataFrame, enough: DataFrame, words: int, percent: int) -> DataFrame:
    """(cid, part, rep, n, k1, k2): classes that may link are in one part.

    Of a class's buckets that others have too, rarest first, those but the last
    ``SHARED - 1`` must hold one that a partner's also hold.
    """
    signs = set_signs(texts, enough.select("rep"), words, percent)
    own = signs.join(enough.select("rep", "k1", "k2", "cid"), ["k1", "k2", "rep"])
    each = own.select("cid", F.explode("signs").alias("h"))
    often = each.groupBy("h").agg(F.count(F.lit(1)).alias("df"), F.min("cid").alias("low"), F.max("cid").alias("high")).filter("low <> high")
    ranked = each.join(often, "h").groupBy("cid").agg(F.array_sort(F.collect_set(F.struct("df", "h"))).alias("hs")).filter(F.size("hs") >= SHARED)
    routes = ranked.select("cid", F.explode(F.slice("hs", F.lit(1), F.size("hs") - (SHARED - 1))).alias("x"))
    routes = routes.select("cid", F.col("x.h").alias("h"))
    least = routes.groupBy("h").agg(F.min("cid").alias("b"))
    star = routes.join(least, "h").select(F.col("cid").alias("a"), "b")
    parts = connected_components(star).withColumnRenamed("node", "cid").withColumnRenamed("component", "part")
    return parts.join(enough, "cid")


def _id_filter(texts: DataFrame, ids: DataFrame) -> tuple[DataFrame, Callable[[pa.RecordBatch], pa.RecordBatch]]:
    """``texts`` with a slot of their doc_id, and a function that keeps the wanted rows of a batch.

    Those are all whose doc_id is in ``ids``, and a few others.
    A bitmap of hashed ids, of at most ``MOST_BITS`` bits, spares most other texts a shuffle.
    With so many ids that it fills up it spares none, and nothing else changes.
    """
    count = ids.count()
    bits = min(MOST_BITS, 1 << max(10, (16 * count).bit_length()))
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    slots = ids.select(slot("rep").alias("slot"))
    one = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    filled = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[filled.column("word").to_numpy()] = filled.column("bits").to_numpy()
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def wanted(batch: pa.RecordBatch) -> pa.RecordBatch:
        slots = batch.column("slot").to_numpy(zero_copy_only=False)
        found = (shared.value[slots >> 6] >> (slots & 63)) & 1
        return batch.select(["doc_id", "text"]).filter(pa.array(found.astype(bool)))

    return texts.filter("doc_id IS NOT NULL").select("doc_id", "text", slot("doc_id").alias("slot")), wanted


def _only_wanted(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``texts`` whose doc_id may be in ``ids``: all that are, and a few others."""
    known, wanted = _id_filter(texts, ids)
    return known.mapInArrow(lambda batches: map(wanted, batches), "doc_id long, text string")


def _in_blocks(parts: DataFrame) -> DataFrame:
    """``parts`` with the number of blocks of each part, and each class's own block."""
    weight = parts.groupBy("part").agg(F.ceil(F.sum("n") * 8 / F.lit(float(PART_BYTES))).alias("blocks"))
    return parts.join(weight, "part").withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")))


def _unit(one: Column, two: Column, side: Column) -> Column:
    return F.struct(one.cast("long").alias("one"), two.cast("long").alias("two"), side.cast("int").alias("side"))


def _below(n: Column) -> Column:
    return F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)


def _search_parts(texts: DataFrame, parts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): links that join the components of all parts.

    Each block of a large part is searched by itself and against the first block, so a class is
    copied twice, and those of the first block once for each block; ``_rest`` has what is left.
    """
    own, zero, one = F.col("own"), F.lit(0), F.lit(1)
    first = F.transform(_below(F.col("blocks")), lambda b: _unit(zero, b, b == 0))
    units = F.when(own == 0, first).otherwise(F.array(_unit(own, own, one), _unit(zero, own, one)))
    placed = _in_blocks(parts).withColumn("units", units).withColumn("known", F.col("cid"))
    return _find_links(texts, placed, words, percent)


def _rest(parts: DataFrame, found: DataFrame) -> DataFrame:
    """(cid, rep, part, k1, k2, known, units) of the large parts that are not one component yet.

    What is not in the largest component so far is searched against all blocks of its part.
    """
    known = found.select(F.col("node").alias("cid"), F.col("component").alias("known"))
    large = _in_blocks(parts).filter("blocks > 1").join(known, "cid", "left").withColumn("known", F.coalesce("known", "cid"))
    sizes = large.groupBy("part", "known").agg(F.sum("n").alias("size"))
    main = sizes.groupBy("part").agg(F.max(F.struct("size", "known")).alias("main"), F.sum("size").alias("size"))
    others = F.ceil((F.col("size") - F.col("main.size")) * 8 / F.lit(float(PART_BYTES)))
    open_parts = large.join(main.select("part", F.col("main.known").alias("main"), others.alias("others")).filter("others > 0"), "part")
    blocks = F.col("blocks")  # those of the others are numbered after them
    as_member = F.transform(_below(F.col("others")), lambda c: _unit(F.col("own"), blocks + c, F.lit(0)))
    as_other = F.transform(_below(blocks), lambda b: _unit(b, blocks + F.pmod(F.xxhash64("cid"), F.col("others")), F.lit(1)))
    units = F.when(F.col("known") == F.col("main"), as_member).otherwise(F.concat(as_member, as_other))
    return open_parts.select("cid", "rep", "part", "k1", "k2", "known", units.alias("units"))


def _find_links(texts: DataFrame, placed: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): links that join known components, from a search in each unit of ``placed``.

    Texts travel and not their sets, which are larger and do not compress.
    """
    wanted = placed.select("cid", "rep", "part", "k1", "k2", "known", "units")
    read = _only_wanted(texts, placed.select("rep")).join(wanted, F.col("doc_id") == F.col("rep")).drop("doc_id")
    dealt = read.select("part", "cid", "k1", "k2", "known", "text", F.explode("units").alias("unit"))
    dealt = dealt.select("part", "unit.one", "unit.two", "unit.side", "cid", "k1", "k2", "known", "text")

    def find(table: pa.Table) -> pa.Table:
        few_collections()
        sets: dict[tuple[int, int], np.ndarray] = {}
        known: dict[int, int] = {}
        columns = (table.column(c) for c in ("cid", "side", "k1", "k2", "known", "text"))
        for cid, side, k1, k2, component, text in zip(*columns, strict=True):
            s = shingle_set(words_of(text.as_py()), words)
            if set_key(s) == (k1.as_py(), k2.as_py()):  # another row may have the same doc_id
                sets[cid.as_py(), side.as_py()], known[cid.as_py()] = s, component.as_py()
        across = table.column("one")[0].as_py() != table.column("two")[0].as_py()
        ids = sorted(sets)
        components = np.array([known[i] for i, _ in ids], np.int64)
        links = search([sets[i] for i in ids], np.array([side for _, side in ids]), percent, across, components) if ids else []
        return pa.table({"a": pa.array([ids[i][0] for i, _ in links], pa.int64()), "b": pa.array([ids[j][0] for _, j in links], pa.int64())})

    return dealt.groupBy("part", "one", "two").applyInArrow(find, StructType.fromDDL("a long, b long"))
