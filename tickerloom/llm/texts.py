"""Helpers shared by the operators: whole texts in bounded pieces, and byte hashes.

A document table is any DataFrame with ``doc_id`` and ``text``; operators select the
columns that they need first, so other columns, whatever their names, do not matter.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Bytes of text handed to a function at once (one longer text is handed over alone).
PIECE_BYTES = 4 << 20

#: White space that separates words: the six ASCII characters of ``[\x20\x09-\x0D]``.
#: ``bytes.split()`` separates at exactly these.
ASCII_SPACE = b" \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``limit`` bytes of ``column``."""
    if not batch.num_rows:
        return
    sizes = np.array([len(x) if (x := v.as_buffer()) is not None else 0 for v in batch.column(column)])
    group = np.cumsum(sizes) // limit
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    for low, high in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield batch.slice(int(low), int(high - low))


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of steps whose results are written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a scratch table that nothing reads any more, and the shuffle files behind it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    release(spark)


def few_collections() -> None:
    """Lets Python look for reference cycles seldom: large memos hold none, and cost time."""
    gc.set_threshold(200_000, 20, 100)


def map_texts(
    df: DataFrame,
    columns: Sequence[str],
    added: str,
    start: Callable[[], Callable[[list], Sequence[Iterable]]],
) -> DataFrame:
    """``columns`` of ``df`` and the columns ``added`` that a function makes from ``text``.

    ``start`` is called once in each task and gives a function from a list of texts to one
    list per added column.
    """
    kept = df.select(*columns).schema
    schema = StructType([*kept.fields, *StructType.fromDDL(added).fields])
    arrow = to_arrow_schema(schema)
    n = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        few_collections()
        call = start()
        for batch in batches:
            for part in pieces(batch):
                made = call(part.column("text").to_pylist())
                arrays = [part.column(i) for i in range(n)]
                arrays += [pa.array(x, type=f.type) for x, f in zip(made, list(arrow)[n:], strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=arrow.names)

    text = [] if "text" in columns else [F.col("text").cast("string").alias("text")]
    return df.select(*columns, *text).mapInArrow(run, schema)


class Rolling:
    """64-bit polynomial hashes of any stretch of a byte string, from one prefix sum.

    Bytes are first replaced by random odd numbers; the sum runs modulo 2**64, where every
    power of an odd base has an inverse, so a stretch has the same hash wherever it starts.
    """

    def __init__(self, seed: int):
        random = np.random.default_rng(seed)
        self.table = random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(random.integers(1 << 61, 1 << 62)) * 8 + 3
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        while len(self.up) <= n:
            size = len(self.up)
            for name, base in (("up", self.base), ("down", self.inverse)):
                have = getattr(self, name)
                step = np.uint64(pow(base, size, 1 << 64))
                setattr(self, name, np.concatenate([have, have * step]))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Sums before each byte and after the last one."""
        n = len(data)
        self._grow(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[:n], out=sums[1:])
        return sums

    def spans(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[begin]) * self.down[begin])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on all higher and lower ones."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_SPACE = np.zeros(256, bool)
_SPACE[list(ASCII_SPACE)] = True
_WORDS = Rolling(11)


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a byte string, in order."""
    codes = np.frombuffer(data, np.uint8)
    if not len(codes):
        return np.zeros(0, np.uint64)
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = ~_SPACE[codes]
    edges = np.diff(inside)
    begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return _WORDS.spans(_WORDS.prefix(codes), begin, end) + mix((end - begin).astype(np.uint64))


def shingle_set(data: bytes, words: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; shorter texts are one shingle."""
    hashes = word_hashes(data)
    n = len(hashes)
    if not n:
        return hashes
    width = min(words, n)
    total = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        total = mix(total ^ hashes[i : n - width + 1 + i]) + np.uint64(i)
    return np.unique(total)
