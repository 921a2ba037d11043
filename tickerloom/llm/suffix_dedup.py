"""Removal of byte strings that occur more than once, by a difference cover.

Every two places i and j have a shift below the cover's modulus v that takes both to sampled
places (place modulo v in the cover).  If the ``length`` bytes at i and j are equal, so are
the ``length - v + 1`` bytes at the shifted, sampled places.  So:

1. Sampled places are named by the bytes that follow, names are sorted, and only places whose
   name is not unique go on.
2. The full ``length`` bytes at those places are hashed directly by two rolling hashes, and
   equal names give repeated strings.  There is no recursion, no order of suffixes and no
   comparison of the bytes of neighbours: equal names alone decide.
3. The remaining suffixes are merged in: of the places between the sampled ones only those can
   matter whose strings reach beyond what is covered by now, and those that share a name with
   one of them.  They get full names too, and equal ones give repeated strings.

The texts lie in batches of bounded size that are written once, bucketed, and read by each
step; what is shuffled is names and places as packed arrays.  A batch sends each name once,
so a passage that a third of all texts share is one entry per batch.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from ..sources.workspace import materialize, workspace
from .texts import Rolling, few_collections, mix, release

LENGTH = 200
#: A perfect difference set, the powers of two: each difference modulo 73 occurs once.
MODULUS = 73
COVER = tuple(sorted(pow(2, i, MODULUS) for i in range(9)))
#: Bytes of text in a batch, and of names in one sorting task.
BATCH_BYTES, SORT_BYTES = 4 << 20, 4 << 20
#: Bytes hashed at once.
BLOCK = 1 << 18
FLAG = np.uint32(1 << 31)

_FIRST, _SECOND = Rolling(21), Rolling(22)


def difference_cover(length: int) -> tuple[int, tuple[int, ...]]:
    """A modulus below ``length`` and residues whose differences are all residues."""
    if length >= MODULUS + 50:
        return MODULUS, COVER
    modulus = max(1, min(length // 2, MODULUS))
    cover, missing = [0], set(range(1, modulus))
    while missing:
        gain = lambda x: len(missing & {d for c in cover for d in ((x - c) % modulus, (c - x) % modulus)})  # noqa: B023, E731
        best = max(range(modulus), key=lambda x: (gain(x), -x))
        missing -= {d for c in cover for d in ((best - c) % modulus, (c - best) % modulus)}
        cover.append(best)
    return modulus, tuple(sorted(cover))


class Batch:
    """The texts of a batch as one byte array with the places where they begin and end."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.begins = self.ends - np.array([len(t) for t in texts], np.int64)

    def sampled(self, width: int, modulus: int, cover: tuple[int, ...]) -> np.ndarray:
        residues = np.array(cover, np.int64)
        out = []
        for begin, end in zip(self.begins.tolist(), self.ends.tolist(), strict=True):
            if end - begin >= width:
                at = (np.arange(begin, end, modulus)[:, None] + residues).ravel()
                out.append(at[at <= end - width])
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def names(self, places: np.ndarray, width: int, rolling: Rolling) -> np.ndarray:
        """Hashes of the ``width`` bytes at ascending ``places``."""
        out = np.empty(len(places), np.uint64)
        edges = np.searchsorted(places, np.arange(0, len(self.data) + BLOCK, BLOCK))
        for k in np.flatnonzero(np.diff(edges)).tolist():
            low, high = edges[k], edges[k + 1]
            here = places[low:high]
            first = int(here[0])
            sums = rolling.prefix(self.data[first : int(here[-1]) + width])
            out[low:high] = rolling.spans(sums, here - first, here - first + width)
        return out

    def covered(self, starts: np.ndarray, length: int) -> np.ndarray:
        """Which bytes lie in a string that begins at one of ``starts``."""
        change = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + length, -1)
        return np.cumsum(change[:-1]) > 0

    def open_starts(self, covered: np.ndarray, length: int) -> np.ndarray:
        """Which places begin a whole string, inside one text, that is not all covered."""
        free = np.zeros(len(self.data) + 1, np.int32)
        np.cumsum(~covered, out=free[1:])
        out = np.zeros(len(self.data), bool)
        last = len(self.data) - length + 1
        if last > 0:
            out[:last] = free[length:] > free[:last]
        return out & self.whole_starts(length)

    def whole_starts(self, length: int) -> np.ndarray:
        change = np.zeros(len(self.data) + 1, np.int32)
        stops = np.maximum(self.begins, self.ends - length + 1)
        np.add.at(change, self.begins, 1)
        np.add.at(change, stops, -1)
        return np.cumsum(change[:-1]) > 0


_PACKED = pa.schema([("bucket", pa.int64()), ("batch", pa.int64()), ("local", pa.bool_()), ("data", pa.binary())])
_PACKED_DDL, _PLACES_DDL = "bucket long, batch long, local boolean, data binary", "batch long, places binary, ranges binary"


def planes(values: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones, and so on: the high bytes of sorted
    or small numbers are then runs, which the compression of shuffles and tables takes out."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def unplanes(data, kind: str, n: int, at: int = 0) -> np.ndarray:
    """``n`` numbers from the ``planes`` that begin at byte ``at``."""
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T).view(kind).ravel()


def pack(batch: int, places: np.ndarray, h1: np.ndarray, h2: np.ndarray | None, ranges: np.ndarray | None, buckets: int) -> pa.RecordBatch:
    """Rows that send the names of a batch to their sorting tasks.

    Each name is sent once, with its first place.  Without ``ranges`` a flag goes with it that
    says that the name occurs again in the batch, whose places are all kept here.  With
    ``ranges`` (first and last of each place, first above last for none) their union goes.
    A name is its bucket (the highest bits of the first hash), the 32 bits of the first hash
    that follow, and 32 bits of the second one if given.
    """
    order = np.argsort(h1, kind="stable") if h2 is None else np.lexsort((h2, h1))
    places, h1 = places[order], h1[order]
    h2 = None if h2 is None else h2[order]
    new = np.ones(len(places), bool)
    new[1:] = h1[1:] != h1[:-1] if h2 is None else (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    first = np.flatnonzero(new)
    kept = places[:0]
    extra = [] if h2 is None else [(h2[first] >> np.uint64(32)).astype("<u4")]
    sent = places[first].astype(np.uint32)
    if ranges is None:
        again = np.diff(np.append(first, len(places))) > 1
        kept = places[again[np.cumsum(new) - 1]]
        sent |= np.where(again, FLAG, np.uint32(0))
    else:
        low, high = ranges[order].T
        extra += [np.minimum.reduceat(low, first).astype(np.uint8), np.maximum.reduceat(high, first).astype(np.uint8)]
    h1 = h1[first]
    bits = (buckets - 1).bit_length()
    bucket = (h1 >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h1), np.int64)
    edges = np.searchsorted(bucket, np.arange(buckets + 1))  # h1 ascends, and so do buckets
    columns = [((h1 << np.uint64(bits)) >> np.uint64(32)).astype("<u4"), sent, *extra]
    numbers, data = [], []
    for b in np.flatnonzero(np.diff(edges)).tolist():
        numbers.append(b)
        data.append(b"".join(planes(c[edges[b] : edges[b + 1]]) for c in columns))
    local = [False] * len(numbers)
    if len(kept):
        numbers.append(int(mix(np.array([batch], np.uint64))[0] % np.uint64(buckets)))
        data.append(planes(np.sort(kept.astype("<u4"))))
        local.append(True)
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int64()), pa.array([batch] * len(numbers), pa.int64()), pa.array(local), pa.array(data, pa.binary())], schema=_PACKED
    )


def sort_names(packed: DataFrame, twice: bool, ranged: bool) -> DataFrame:
    """(batch, places, ranges) of names that occur in several batches, one row per sorting task and batch.

    ``ranged``: of all names that have a range in any batch, with the union of their ranges.
    """
    types = ["<u4", "<u4", *(["<u4"] if twice else []), *(["u1", "u1"] if ranged else [])]
    size = sum(np.dtype(t).itemsize for t in types)

    def run(table: pa.Table) -> pa.Table:
        batches, out, out_ranges = [], [], []
        held: list[list[np.ndarray]] = [[] for _ in types]
        owner = []
        for batch, local, data in zip(*(table.column(c).to_pylist() for c in ("batch", "local", "data")), strict=True):
            if local:
                batches.append(batch)
                out.append(data)
                out_ranges.append(b"")
                continue
            n, at = len(data) // size, 0
            for column, t in zip(held, types, strict=True):
                column.append(unplanes(data, t, n, at))
                at += n * np.dtype(t).itemsize
            owner.append(np.full(n, batch, np.int64))
        if owner:
            columns, owner = [np.concatenate(c) for c in held], np.concatenate(owner)
            names = columns[0].astype(np.uint64)
            if twice:
                names |= columns[2].astype(np.uint64) << np.uint64(32)
            order = np.argsort(names, kind="stable")
            names, owner, places = names[order], owner[order], columns[1][order]
            first = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
            size_of = np.diff(np.append(first, len(names)))
            if ranged:
                low, high = (f.reduceat(c[order], first) for f, c in zip((np.minimum, np.maximum), columns[-2:], strict=True))
                chosen = np.repeat(low <= high, size_of)
                found = np.stack([np.repeat(low, size_of), np.repeat(high, size_of)], axis=1)[chosen]
            else:
                chosen = np.repeat(size_of > 1, size_of) & ((places & FLAG) == 0)
                found = np.zeros((int(chosen.sum()), 0), np.uint8)
            owner, places = owner[chosen], places[chosen]
            order = np.lexsort((places, owner))
            owner, places, found = owner[order], places[order], found[order]
            for b in np.unique(owner).tolist():
                s = slice(*np.searchsorted(owner, [b, b + 1]))
                batches.append(b)
                out.append(planes(places[s]))
                out_ranges.append(found[s].tobytes())
        return pa.table({"batch": pa.array(batches, pa.int64()), "places": pa.array(out, pa.binary()), "ranges": pa.array(out_ranges, pa.binary())})

    return packed.groupBy("bucket").applyInArrow(run, _PLACES_DDL)


def _ranged(lists: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    """Ascending places and their ranges."""
    places = _places([x["places"] for x in lists or []])
    ranges = np.frombuffer(b"".join(x["ranges"] for x in lists or []), np.uint8).reshape(-1, 2)
    order = np.argsort(places)
    return places[order], ranges[order].astype(np.int64)


def _places(lists: list[bytes]) -> np.ndarray:
    return np.concatenate([np.zeros(0, "<u4"), *(unplanes(x, "<u4", len(x) // 4) for x in lists)]).astype(np.int64)


def _joined(lists: list[dict] | None) -> np.ndarray:
    return np.sort(_places([x["places"] for x in lists or []]))


class RepeatFinder:
    """The steps over a table of batches."""

    def __init__(self, docs: DataFrame, columns: tuple[str, ...], length: int):
        self.length = length
        self.modulus, self.cover = difference_cover(length)
        self.width = length - self.modulus + 1
        self.columns = columns
        self.kept = docs.select(*columns).schema
        self.folder = workspace(docs.sparkSession)
        size = docs.agg(F.sum(F.octet_length("text").cast("long")).alias("b")).first()["b"] or 0
        sent = size * len(self.cover) / self.modulus * 8
        self.buckets = 1 << max(6, math.ceil(math.log2(max(1, sent / SORT_BYTES))))
        self.batches = self._write(docs, size)

    def _write(self, docs: DataFrame, size: int) -> DataFrame:
        """Batches as a bucketed table: joins by batch then move only the other side."""
        spark = docs.sparkSession
        n = len(self.columns)
        fields = list(to_arrow_schema(self.kept))

        def run(batches):
            few_collections()
            number = TaskContext.get().partitionId() << 32
            texts: list[bytes] = []
            parts: list[pa.RecordBatch] = []
            held = 0

            def give():
                nonlocal number, held
                table = pa.Table.from_batches(parts).combine_chunks()
                columns = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in table.columns]
                others = pa.StructArray.from_arrays(columns, fields=fields)
                made = pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        pa.array([texts], pa.list_(pa.binary())),
                        pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), others),
                    ],
                    names=["batch", "texts", "others"],
                )
                number += 1
                held = 0
                texts.clear()
                parts.clear()
                return made

            for batch in batches:
                low = 0
                for i, value in enumerate(batch.column(n)):
                    data = value.as_py() or b""
                    if held and held + len(data) > BATCH_BYTES:
                        parts.append(batch.select(range(n)).slice(low, i - low))
                        low = i
                        yield give()
                    texts.append(data)
                    held += len(data)
                parts.append(batch.select(range(n)).slice(low))
            if texts:
                yield give()

        schema = StructType(
            [StructField("batch", LongType()), StructField("texts", ArrayType(BinaryType())), StructField("others", ArrayType(self.kept))]
        )
        made = docs.select(*self.columns, F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8").alias("text")).mapInArrow(run, schema)
        self.parts = int(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * size // BATCH_BYTES))
        name = f"tickerloom_batches_{uuid.uuid4().hex}"
        made.write.bucketBy(self.parts, "batch").option("path", f"{self.folder}/batches").option("compression", "zstd").format("parquet").saveAsTable(name)
        return spark.table(name)

    def _with(self, *lists: DataFrame, columns=("batch", "texts")) -> DataFrame:
        """Batches with what tasks found in them.  The lists are brought to the buckets of the
        batches by one exchange, in which they are also put together."""
        out = self.batches.select(*columns)
        for i, x in enumerate(lists):
            found = F.collect_list(F.struct("places", "ranges")).alias(f"places{i}")
            out = out.join(x.repartition(self.parts, "batch").groupBy("batch").agg(found).hint("shuffle_hash"), "batch", "left")
        return out

    def _names(self, rows: DataFrame, send, twice: bool, ranged: bool, name: str) -> DataFrame:
        """Runs ``send`` on each batch and its lists and sorts what it sends."""
        buckets = self.buckets

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            few_collections()
            for rows in batches:
                for i in range(rows.num_rows):
                    number, texts, *lists = (c[i].as_py() for c in rows.columns)
                    sent = send(Batch(texts), *lists)
                    if sent is not None:
                        yield pack(number, *sent, buckets)

        return materialize(sort_names(rows.mapInArrow(run, _PACKED_DDL), twice, ranged), name, self.folder)

    def repeated(self) -> list[DataFrame]:
        """Tables of (batch, places, ranges): together, enough starts of repeated strings to cover all."""
        length, width, modulus, cover = self.length, self.width, self.modulus, self.cover
        spark = self.batches.sparkSession

        def name_sampled(batch: Batch):
            at = batch.sampled(width, modulus, cover)
            return (at, batch.names(at, width, _FIRST), None, None) if len(at) else None

        shared = self._names(self._with(), name_sampled, False, False, "shared-names")
        release(spark)

        def full(batch: Batch, at: np.ndarray):
            return (at, batch.names(at, length, _FIRST), batch.names(at, length, _SECOND), None) if len(at) else None

        def name_tuples(batch: Batch, shared):
            at = _joined(shared)
            return full(batch, at[batch.whole_starts(length)[at]]) if len(at) else None

        tuples = self._names(self._with(shared), name_tuples, True, False, "repeated-tuples")
        release(spark)

        def name_open(batch: Batch, shared, tuples):
            """How far before each place the strings begin that are not covered: nearest, farthest."""
            at = _joined(shared)
            if not len(at):
                return None
            open_ = np.flatnonzero(batch.open_starts(batch.covered(_joined(tuples), length), length))
            text = np.searchsorted(batch.ends, at, "right")
            low = np.searchsorted(open_, np.maximum(batch.begins[text], at - modulus + 1))
            high = np.searchsorted(open_, at, "right")
            some = high > low
            ranges = np.empty((len(at), 2), np.int64)
            ranges[:] = 255, 0
            ranges[some, 0] = at[some] - open_[high[some] - 1]
            ranges[some, 1] = at[some] - open_[low[some]]
            return at, batch.names(at, width, _FIRST), None, ranges

        wanted = self._names(self._with(shared, tuples), name_open, False, True, "open-names")
        release(spark)

        def name_rest(batch: Batch, shared, wanted):
            chosen, ranges = _ranged(wanted)
            if not len(chosen):
                return None
            at = _joined(shared)
            names = batch.names(at, width, _FIRST)
            known = names[np.searchsorted(at, chosen)]  # the first place of each name in this batch
            order = np.argsort(known)
            known, ranges = known[order], ranges[order]
            where = np.minimum(np.searchsorted(known, names), len(known) - 1)
            hit = known[where] == names
            at, ranges = at[hit], ranges[where[hit]]
            begin = batch.begins[np.searchsorted(batch.ends, at, "right")]
            low, high = np.maximum(begin, at - ranges[:, 1]), at - ranges[:, 0]
            some = high >= low
            change = np.zeros(len(batch.data) + 1, np.int32)
            np.add.at(change, low[some], 1)
            np.add.at(change, high[some] + 1, -1)
            return full(batch, np.flatnonzero((np.cumsum(change[:-1]) > 0) & batch.whole_starts(length)))

        rest = self._names(self._with(shared, wanted), name_rest, True, False, "repeated-rest")
        release(spark)
        return [tuples, rest]

    def cut(self, as_text: bool) -> DataFrame:
        """``columns`` of each row, what is ``kept`` and the removed ``spans``."""
        rows = self._with(*self.repeated(), columns=("batch", "texts", "others"))
        length = self.length
        span = StructType.fromDDL("spans array<struct<begin: long, end: long>>").fields[0]
        schema = StructType([*self.kept.fields, StructField("kept", StringType() if as_text else BinaryType()), span])
        arrow = to_arrow_schema(schema)
        fields = list(to_arrow_schema(self.kept))

        def run(batches):
            few_collections()
            for rows in batches:
                for i in range(rows.num_rows):
                    texts = rows.column("texts")[i].as_py()
                    batch = Batch(texts)
                    starts = np.union1d(_joined(rows.column("places0")[i].as_py()), _joined(rows.column("places1")[i].as_py()))
                    covered = batch.covered(starts, length)
                    kept, spans = [], []
                    for text, begin, end in zip(texts, batch.begins.tolist(), batch.ends.tolist(), strict=True):
                        here = covered[begin:end]
                        if not here.any():
                            kept.append(text)
                            spans.append([])
                            continue
                        edges = np.diff(np.concatenate([[0], here.view(np.int8), [0]]))
                        low, high = np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()
                        kept.append(batch.data[begin:end][~here].tobytes())
                        spans.append([{"begin": a, "end": b} for a, b in zip(low, high, strict=True)])
                    others = pa.StructArray.from_arrays(rows.column("others")[i].values.flatten(), fields=fields)
                    yield pa.RecordBatch.from_arrays(
                        [*others.flatten(), pa.array([k.decode("utf-8", "ignore") for k in kept] if as_text else kept, arrow.field("kept").type), pa.array(spans, arrow.field("spans").type)], schema=arrow
                    )

        return rows.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",), length: int = LENGTH, as_text: bool = False) -> DataFrame:
    """``columns`` of each row, ``kept`` (bytes) and ``spans`` (removed stretches, in bytes).

    ``as_text`` gives ``kept`` as a string, without what is left of characters cut in two.

    A byte is removed if it lies in a string of ``length`` bytes that also begins anywhere else,
    in this text or another; strings are judged on the texts as given and do not cross texts.
    Null texts are empty; texts shorter than ``length`` stay; all copies of a repeated row lose
    what they share; rows keep their number and order does not matter.
    """
    return RepeatFinder(docs, tuple(columns), length).cut(as_text)
