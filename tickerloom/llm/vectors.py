"""Helpers for operators on vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of the sample that places of a partition are fitted to.
SAMPLE = 4096


def is_finite(vector: str) -> Column:
    """Whether a vector is there and all its components are numbers."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))), F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles; shorter ones are filled up with zeros."""
    lengths = np.asarray(column.value_lengths())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def sample_vectors(rows: DataFrame, vector: str, *key: str) -> list:
    """At most ``SAMPLE`` vectors, spread by the hash of a key."""
    chosen = rows.select(vector, F.xxhash64(*key).alias("_order")).orderBy("_order").limit(SAMPLE)
    return [r[0] for r in chosen.collect()]


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Slices of the batches in which all ``keys`` (numbers) are constant."""
    for batch in batches:
        if batch.num_rows:
            values = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            change = np.zeros(batch.num_rows, bool)
            for v in values:
                change[1:] |= v[1:] != v[:-1]
            starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            for low, high in zip(starts, starts[1:], strict=False):
                yield batch.slice(low, high - low)


def stream_groups(df: DataFrame, keys: list[str], start: Callable, schema: str) -> DataFrame:
    """Per group of ``keys``, rows in the order of ``kind`` (0 before 1), past one object.

    ``start()`` makes the object of a group; ``add(slice)`` gets its rows of kind 0,
    ``answer(slice)`` those of kind 1, a slice at a time, and ``finish()`` ends the group; the last two
    yield record batches.  Only rows of kind 0 are held, so only they need a bound per group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, group = None, None
        for part in runs(batches, [*keys, "kind"]):
            key = tuple(part.column(k)[0].as_py() for k in keys)
            if key != here:
                if group is not None:
                    yield from group.finish()
                here, group = key, start(key)
            if part.column("kind")[0].as_py() == 0:
                group.add(part)
            else:
                yield from group.answer(part)
        if group is not None:
            yield from group.finish()

    return df.repartition(*keys).sortWithinPartitions(*keys, "kind").mapInArrow(run, schema)
