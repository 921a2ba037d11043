"""Deduplication that survives hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], laid_out: bool = False) -> DataFrame:
    """The first row per key under a total order.

    Written as ``row_number() = 1`` so that Spark plans a partial group limit below the
    exchange: every map task sends at most one row per key, however many copies it holds.
    A 64-bit hash leads the partition key: it decides nearly all comparisons of both sorts
    from their 8-byte prefix, and the true keys behind it keep the result exact.  Rows that are
    ``laid_out`` by (some of) the keys have no exchange, and stay sorted by the keys instead.
    """
    by_key = Window.partitionBy(*([] if laid_out else ["_hash"]), *keys).orderBy(*order)
    rows = df if laid_out else df.withColumn("_hash", F.xxhash64(*keys))
    return (
        rows
        .withColumn("_position", F.row_number().over(by_key))
        .filter("_position = 1")
        .drop("_position", "_hash")
    )


def daily_rows_once(
    df: DataFrame, keys: Sequence[str], tiebreak: Sequence[str], laid_out: bool = False
) -> DataFrame:
    """One row per security and date; among copies the greatest ``tiebreak`` values win."""
    return keep_first(df, keys, [F.desc_nulls_last(c) for c in tiebreak], laid_out)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], latest: Sequence[str], laid_out: bool = False
) -> DataFrame:
    """The row with the greatest ``latest`` columns per key, NULLs last."""
    return keep_first(df, keys, [F.desc_nulls_last(c) for c in latest], laid_out)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")
