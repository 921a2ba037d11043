"""Tables laid out by key, so that whatever runs per key later plans no exchange.

A laid-out table is bucketed by its keys and sorted within each bucket, one file per bucket.
Windows, aggregations, deduplication, as-of scans and joins by these keys then read their
bucket and shuffle nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .. import SECURITY
from .workspace import workspace


#: Rows that a task sorts in memory while it also sorts what it writes: some hundred MB.
ROWS_PER_BUCKET = 1_200_000


def bucket_count(spark: SparkSession, rows: int = 0) -> int:
    """Buckets of tables with ``rows`` rows.

    The session's number of shuffle partitions, or two per core of the cluster if that is less;
    more of them where the rows ask for it, so that buckets do not grow with the table.
    """
    cores = spark.sparkContext.defaultParallelism
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(8, 2 * cores))
    return max(least, -(-rows // ROWS_PER_BUCKET))


def store_by_key(
    df: DataFrame,
    name: str,
    keys: Sequence[str] = SECURITY,
    sort_by: Sequence[str] = (),
    buckets: int | None = None,
    folder: str | None = None,
    table: str | None = None,
) -> DataFrame:
    """Store ``df`` laid out by ``keys`` and read it back.

    ``buckets`` should make a bucket some hundred MB; tables that meet in joins need the same
    number, see ``bucket_count`` for the default.  The rows are
    dealt by the buckets' own hash, so each task writes one file.  The table is known to the
    session's catalog as ``table``, by default a name of its own (``drop_layout`` forgets it); its
    files are in the workspace, as those of any intermediate table.

    A key's rows are in one bucket: lay out by keys whose rows are bounded, such as a
    security's, which has at most one row per day after deduplication; repeated rows of a
    raw table should be few, or be dropped first.
    """
    spark = df.sparkSession
    keys, order = list(keys), [*keys, *sort_by]
    if buckets is None:
        buckets = bucket_count(spark)
    table = table or f"{name}_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, *keys)
        .sortWithinPartitions(*order)
        .write.format("parquet")
        .option("compression", "zstd")
        .option("path", f"{folder or workspace(spark)}/{name}")
        .bucketBy(buckets, *keys)
        .sortBy(*order)
        .saveAsTable(table)
    )
    return spark.table(table)


def drop_layout(spark: SparkSession, table: str) -> None:
    """Forget a laid-out table; its files stay until the workspace is cleared."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
