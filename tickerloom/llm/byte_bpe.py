"""Byte-level BPE with a two-tier lookup.

A minimal perfect hash resolves whole pre-tokens that are in the vocabulary; the others are
merged with a heap over linked bytes.  Ids are those of the usual rank files: an entry's
rank is its id and the lowest rank merges first.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import uuid
from itertools import chain

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession

from .texts import map_texts

#: Pre-tokens, and as many units, remembered by a worker before it forgets them all.
MEMO = 500_000
#: Longer ones are rare and large, and not remembered.
MEMO_CHARS = 1_000
#: The pattern of the multi-language vocabulary (a fixed value).
UNIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, lines)))}


class PerfectHash:
    """Minimal perfect hash: n keys to n slots, by a displacement per bucket of keys.

    Keys fall into buckets; large buckets are placed first, each with the first displacement
    that puts all its keys on free slots; buckets of one key point at a free slot directly.
    """

    KEYS_PER_BUCKET = 3
    PRIME = (1 << 31) - 1

    def __init__(self, keys: list[bytes]):
        self.n = max(1, len(keys))
        self.buckets = max(1, len(keys) // self.KEYS_PER_BUCKET)
        self.displacement = np.zeros(self.buckets, np.int64)
        self.slot_of = np.zeros(self.n, np.int64)  # slot -> key's place in ``keys``
        if not keys:
            return
        low, high, bucket = (x.tolist() for x in self._parts(keys))
        members: dict[int, list[int]] = {}
        for i, b in enumerate(bucket):
            members.setdefault(b, []).append(i)
        taken = bytearray(self.n)
        singles = []
        for b, group in sorted(members.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(group) == 1:
                singles.append((b, group[0]))
                continue
            d = 0
            while True:
                slots = [(low[i] + d * high[i]) % self.PRIME % self.n for i in group]
                if len(set(slots)) == len(slots) and not any(taken[s] for s in slots):
                    break
                d += 1
                if d > 1_000_000:
                    raise ValueError("keys are not distinct")
            self.displacement[b] = d
            for i, s in zip(group, slots, strict=True):
                taken[s] = 1
                self.slot_of[s] = i
        free = (s for s in range(self.n) if not taken[s])
        for b, i in singles:
            s = next(free)
            self.displacement[b] = -1 - s
            self.slot_of[s] = i

    def _parts(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        digest = xxhash.xxh3_64_intdigest
        h = np.fromiter(map(digest, keys), np.uint64, len(keys))
        low = (h & np.uint64(0xFFFFFFFF)).astype(np.int64)
        high = (h >> np.uint64(40)).astype(np.int64) | 1
        bucket = ((h >> np.uint64(20)) % np.uint64(self.buckets)).astype(np.int64)
        return low, high, bucket

    def tables(self) -> tuple[list[int], list[int]]:
        """Displacements and slots as lists, which are faster to index one by one."""
        return self.displacement.tolist(), self.slot_of.tolist()


def lookup(hashed: PerfectHash):
    """A function from a key to the place of the only entry that it can equal."""
    displacement, slot_of = hashed.tables()
    n, buckets, prime, digest = hashed.n, hashed.buckets, hashed.PRIME, xxhash.xxh3_64_intdigest

    def place(key: bytes) -> int:
        h = digest(key)
        d = displacement[(h >> 20) % buckets]
        return slot_of[-1 - d if d < 0 else ((h & 0xFFFFFFFF) + d * (h >> 40 | 1)) % prime % n]

    return place


class Merger:
    """Ids of pre-tokens by merging: the lowest-ranked neighbours first, the leftmost of equals.

    Parts of a token are linked by their ends; the heap holds rank, start and end of each
    mergeable neighbour pair as one number, and pairs whose parts have changed are skipped.
    Ranks are held shifted to their place in that number, which is small for short tokens.
    """

    def __init__(self, ranks: dict[bytes, int], shift: int):
        self.ranks, self.shift = ranks, shift
        self.scaled = {k: r << 2 * shift for k, r in ranks.items()}
        self.pairs = {(k[0], k[1]): r for k, r in self.scaled.items() if len(k) == 2}

    def __call__(self, token: bytes) -> list[int]:
        n = len(token)
        ranks = self.ranks
        if n < 2:
            return [ranks[token]] if n else []
        shift, get, pop, push = self.shift, self.scaled.get, heapq.heappop, heapq.heappush
        mask = (1 << shift) - 1
        end = list(range(1, n + 1))  # end of the part that starts here; 0 once merged away
        before = list(range(-1, n - 1))
        found = map(self.pairs.get, zip(token, token[1:], strict=False))
        heap = [r + (i << shift) + i + 2 for i, r in enumerate(found) if r is not None]
        heapq.heapify(heap)
        while heap:
            x = pop(heap)
            stop, i = x & mask, x >> shift & mask
            middle = end[i]
            if middle >= stop or not middle or end[middle] != stop:
                continue
            end[i], end[middle] = stop, 0
            if stop < n:
                before[stop] = i
                after = end[stop]
                if (r := get(token[i:after])) is not None:
                    push(heap, r + (i << shift) + after)
            left = before[i]
            if left >= 0 and (r := get(token[left:stop])) is not None:
                push(heap, r + (left << shift) + stop)
        ids, i = [], 0
        while i < n:
            stop = end[i]
            ids.append(ranks[token[i:stop]])
            i = stop
        return ids


#: Bits of a place in tokens of fewer than 64 bytes, and in all others.
SHORT, LONG = 6, 40


class Memo(dict):
    """Remembers what a function made of a key; forgets all when it holds ``limit`` keys."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        made = self.make(key)
        if len(key) > MEMO_CHARS:
            return made
        if len(self) >= self.limit:
            self.clear()
        self[key] = made
        return made


#: A single space between two characters that are none: it and what follows up to the next such
#: space is a unit whose pre-tokens do not depend on its neighbours, because white space joins only
#: what follows it.  Texts without runs or an end of white space hold no other spaces.
_DEPENDENT = regex.compile(r"\s\s|\s\Z")
_SINGLE = regex.compile(r"(?<=\S) (?=\S)")


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str, hashed: PerfectHash | None = None):
        self.ranks = ranks
        self.merge_short, self.merge_long = Merger(ranks, SHORT), Merger(ranks, LONG)
        self.keys = list(ranks)
        self.ids = list(ranks.values())
        self.place = lookup(hashed or PerfectHash(self.keys))
        self.split = regex.compile(pattern).findall
        #: Whether units are independent is a property of this pattern.
        self.by_unit = pattern == UNIT_PATTERN
        self.words = {i: k for k, i in ranks.items()}
        self.tokens = Memo(self.token, MEMO)
        self.units = Memo(self.unit, MEMO)
        self.name = {i: str(i) for i in self.words}.__getitem__
        self.spellings = Memo(self.spelling, MEMO)

    def token(self, token: str) -> tuple[int, ...]:
        key = token.encode("utf-8", "replace")
        place = self.place(key)
        if self.keys[place] == key:
            return (self.ids[place],)
        return tuple((self.merge_short if len(key) >> SHORT == 0 else self.merge_long)(key))

    def unit(self, unit: str) -> tuple[int, ...]:
        if unit.isascii() and unit[1:].isalpha() and (unit[0] == " " or unit[0].isalpha()):  # one pre-token
            return self.tokens[unit]
        return tuple(chain.from_iterable(map(self.tokens.__getitem__, self.split(unit))))

    def spelling(self, unit: str) -> tuple[str, bytes]:
        """The ids of a unit as decimals, and the bytes that they decode to."""
        ids = self.unit(unit)
        return ",".join(map(self.name, ids)), self.decode(ids)

    def parts(self, text: str) -> list[str]:
        """The units of a text, none of them empty; one where the pattern is not known."""
        if not text or not self.by_unit:
            return [text] if text else []
        first, *rest = _SINGLE.split(text) if _DEPENDENT.search(text) else text.split(" ")
        units = [" " + x for x in rest]
        return [first, *units] if first else units

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.units.__getitem__, self.parts(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.words.__getitem__, ids))


def _digest(text: str | None, codec: Codec) -> tuple[int, str, str]:
    made = list(map(codec.spellings.__getitem__, codec.parts(text or "")))
    joined = ",".join([ids for ids, _ in made])
    decoded = b"".join([data for _, data in made])
    return joined.count(",") + bool(joined), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()


#: The codec of this worker, by the key of its broadcast: Spark gives a worker one task after
#: another, and what a task has merged, the next ones need not merge again.
_CODEC: dict[str, Codec] = {}


def codec_starter(spark: SparkSession, path: str, pattern: str):
    """Builds the perfect hash once and shares it; the vocabulary file bounds its size.

    A worker keeps the codec with its memos, which have a limit of their own, for the tasks that
    follow; the codec of another vocabulary takes its place.
    """
    ranks = load_ranks(path)
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, ranks, PerfectHash(list(ranks))))

    def start() -> Codec:
        key, table, hashed = shared.value
        if key not in _CODEC:
            _CODEC.clear()
            _CODEC[key] = Codec(table, pattern, hashed)
        return _CODEC[key]

    return start


def encode(docs: DataFrame, path: str, pattern: str, columns=("doc_id",)) -> DataFrame:
    """``columns`` and ``ids``, the token ids of every whole text (null is empty)."""
    make = codec_starter(docs.sparkSession, path, pattern)

    def start():
        codec = make()
        return lambda texts: [[codec.encode(t or "") for t in texts]]

    return map_texts(docs, list(columns), "ids array<int>", start)


def decode(encoded: DataFrame, path: str, pattern: str, columns=("doc_id",)) -> DataFrame:
    """``columns`` and ``data``, the bytes of each row's ``ids`` (null is empty)."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import BinaryType, StructType

    make = codec_starter(encoded.sparkSession, path, pattern)
    n = len(columns)
    schema = StructType([*encoded.select(*columns).schema.fields]).add("data", BinaryType())
    names = to_arrow_schema(schema).names

    def run(batches):
        codec = make()
        for batch in batches:
            data = [codec.decode(x or []) for x in batch.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(data, pa.binary())], names=names)

    return encoded.select(*columns, "ids").mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode every whole text, decode its ids, and return counts and digests of both.

    Null text is empty and has no ids; a text of any length is encoded whole.
    """
    make = codec_starter(docs.sparkSession, path, pattern)

    def start():
        codec = make()
        return lambda texts: list(zip(*(_digest(t, codec) for t in texts), strict=True))

    return map_texts(docs, ["doc_id"], "n_tokens long, ids_sha256 string, decoded_sha256 string", start)
