"""Partitioned writes and key-based table updates."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import SECURITY
from .partitions import DATE_PARTITIONS, Folder, ReplaceError, replace_partitions, unique_keys

MAX_RECORDS_PER_FILE = 20_000_000


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Plain ZSTD Parquet."""
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def write_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = SECURITY
) -> None:
    """Replace exactly the partitions that occur in ``df``.

    The rebalance hint lays rows out by partition (one file for a normal one) and lets
    adaptive execution split a partition that is too large for one task.  Rows are ordered
    by key within a file, so that row-group statistics serve filters on a security.  A table
    that is not there yet needs no replacement of single partitions, which costs several
    calls to the file system for each.
    """
    order = [*partition_by, *[c for c in sort_by if c in df.columns]]
    mode = "dynamic" if Folder(df.sparkSession, path).exists() else "static"
    (
        df.hint("rebalance", *partition_by)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .option("compression", "zstd")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_daily(df: DataFrame, path: str, date: str = "date") -> None:
    """Date-partitioned layout ``year=/month=/date=``."""
    parts = {"year": F.year(date), "month": F.date_format(date, "MM")}
    write_partitions(df.withColumns(parts), path, ["year", "month", date])


def write_weekly(df: DataFrame, path: str) -> None:
    """Week-partitioned layout keyed by the stable week start."""
    rows = df.withColumn("year", F.year("week_start_date"))
    write_partitions(rows, path, ["year", "week_start_date"])


def split_yearly_file(spark: SparkSession, source: str, path: str, date: str = "date") -> None:
    """Turn a yearly file into date partitions."""
    write_daily(spark.read.parquet(source).withColumn(date, F.col(date).cast("date")), path, date)


def write_screen(
    annotated: DataFrame,
    summary: DataFrame,
    folder: str,
    universe_filter: bool = True,
    unfiltered_audit: bool = False,
) -> None:
    """Screen results under a tag folder: Parquet, CSV, JSON summary and audits."""
    kept = annotated.filter("NOT is_excluded_universe") if universe_filter else annotated
    outputs = {
        "screening_results": kept,
        "excluded_universe/excluded_universe": annotated.filter("is_excluded_universe"),
    }
    if unfiltered_audit:
        outputs["unfiltered/screening_results_unfiltered"] = annotated
    for name, df in outputs.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")
    summary.write.mode("overwrite").json(f"{folder}/screening_summary.json")


def export_table(df: DataFrame, folder: str, name: str) -> None:
    """JSON (ISO dates, NULL fields kept) and CSV export."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(f"{folder}/{name}.json")
    df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")


# --- key-based updates ----------------------------------------------------------------


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    preserve: Sequence[str] = ("created_at",),
) -> DataFrame:
    """Target with ``updates`` applied: a matched row takes all updated columns except
    ``preserve``; columns that the updates lack keep their value."""
    keys = list(keys)
    new = updates.select(*keys, F.struct(*updates.columns).alias("_new"))
    merged = target.withColumn("_old", F.lit(True)).join(new, keys, "full")
    columns = []
    for c in target.columns:
        if c in keys:
            columns.append(F.col(c))
        elif c not in updates.columns:
            columns.append(F.col(c))
        elif c in preserve:
            inserted = F.col("_old").isNull()
            columns.append(F.when(inserted, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c))
        else:
            updated = F.col("_new").isNotNull()
            columns.append(F.when(updated, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c))
    return merged.select(*columns)


BUCKET = "bucket"


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Store a table by the hash of its keys, as the target of ``upsert_buckets``.

    A few hundred MB per bucket are a good size; the number is kept beside the data.
    """
    write_partitions(_bucketed(df, keys, buckets), path, [BUCKET], sort_by=keys)
    Folder(df.sparkSession, path).write_text("_buckets", str(buckets))


def _bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def upsert_buckets(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    preserve: Sequence[str] = ("created_at",),
    deactivate: str | None = None,
    rename=None,
) -> int:
    """``upsert`` into a table stored by ``write_buckets``; returns the buckets rewritten.

    Only buckets with updates are read, joined and replaced, all of them or none; the files of
    the others stay as they are.  With ``deactivate``, the column of that name is first set
    to false in all rows, which rewrites every bucket.  No updates, updates without their keys,
    columns that the table does not have and a key that occurs twice are refused.
    """
    table = Folder(spark, path)
    buckets = int(table.read_text("_buckets"))
    stored = spark.read.parquet(path)
    missing = [k for k in keys if k not in updates.columns]
    strange = [c for c in updates.columns if c not in stored.columns]
    if missing or strange:
        raise ReplaceError(f"updates lack {missing} and have unknown columns {strange}")
    new = _bucketed(updates, keys, buckets)
    touched = sorted(r[BUCKET] for r in new.select(BUCKET).distinct().collect())  # at most one row per bucket
    if not touched:
        raise ReplaceError("there are no updates")
    old = stored
    if deactivate:
        old, touched = stored.withColumn(deactivate, F.lit(False)), list(range(buckets))
    rows = upsert(old.filter(F.col(BUCKET).isin(touched)), new, [BUCKET, *keys], preserve)
    names = {str(b) for b in touched}
    return replace_partitions(
        spark,
        path,
        [BUCKET],
        lambda stage: write_partitions(rows, stage, [BUCKET], sort_by=keys),
        lambda values: values[BUCKET] in names,
        unique_keys(keys),
        rename,
    )


def deactivate_then_upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], active: str = "is_active"
) -> DataFrame:
    """All rows become inactive, then the updates are applied."""
    return upsert(target.withColumn(active, F.lit(False)), updates, keys)


def replace_date_window(target: DataFrame, new: DataFrame, date: str) -> DataFrame:
    """Target without the date range that ``new`` spans, plus ``new``."""
    first = new.select(F.min(date)).scalar()
    last = new.select(F.max(date)).scalar()
    outside = (F.col(date) < first) | (F.col(date) > last) | first.isNull()
    return target.filter(outside).unionByName(new, allowMissingColumns=True)


def replace_sets(
    target: DataFrame, new: DataFrame, set_ids: DataFrame, key: str = "parameter_set_id"
) -> DataFrame:
    """Target without any row of the given sets, plus their new rows (possibly none)."""
    return target.join(set_ids, key, "left_anti").unionByName(new)


def upsert_parameters(target: DataFrame, grid: DataFrame, key: Sequence[str]) -> DataFrame:
    """Upsert of the parameter table: known keys keep their id, new ones continue the numbering.

    The table has one row per parameter set (hundreds), so the global numbering is bounded
    by the grid and not by the data.
    """
    known = target.select("parameter_set_id", *key)
    rows = grid.drop("parameter_set_id").join(known, [*key], "left")
    top = target.select(F.coalesce(F.max("parameter_set_id"), F.lit(0))).scalar()
    order = Window.orderBy(F.col("parameter_set_id").isNotNull(), *key)
    numbered = rows.withColumn("_n", F.row_number().over(order)).withColumn(
        "parameter_set_id", F.coalesce("parameter_set_id", top + F.col("_n")).cast("long")
    )
    return upsert(target, numbered.select(*target.columns), key, preserve=("parameter_set_id",))


class SwapError(RuntimeError):
    """A table could not be put in place; the table before it is still there."""


def replace_table(df: DataFrame, path: str, rename=None) -> None:
    """Overwrite a table that ``df`` may itself read: write aside, then swap by rename.

    Renames report failure by their result.  If the new table cannot be moved in, the old one is
    moved back; it is deleted only when the new one is in place.
    """
    spark = df.sparkSession
    tag = uuid.uuid4().hex
    staged, retired = f"{path.rstrip('/')}.next-{tag}", f"{path.rstrip('/')}.old-{tag}"
    write_parquet(df, staged)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rename = rename or (lambda a, b: fs.rename(hadoop(a), hadoop(b)))
    had = fs.exists(hadoop(path))
    if had and not rename(path, retired):
        raise SwapError(f"{path} could not be set aside; the new table is at {staged}")
    if not rename(staged, path):
        if had and not rename(retired, path):
            raise SwapError(f"{path} is at {retired} and could not be moved back; the new table is at {staged}")
        raise SwapError(f"{staged} could not be moved to {path}, which is as it was")
    if had:
        fs.delete(hadoop(retired), True)


def store_date_window(
    new: DataFrame,
    path: str,
    first: str,
    last: str,
    date: str = "date",
    keys: Sequence[str] | None = None,
    rename=None,
) -> int:
    """Replace the dates ``first`` to ``last`` of a date-partitioned table by ``new``, or leave it as it is.

    The window is staged, checked for ``keys`` that are null or occur twice, and moved in
    partition by partition; a failure puts the old partitions back.  Dates of the window
    that ``new`` does not have go.  A date outside the window is an error.
    """
    inside = lambda values: first <= values[date] <= last
    columns = [*DATE_PARTITIONS, date]
    check = unique_keys([*keys, date]) if keys else None
    return replace_partitions(new.sparkSession, path, columns, lambda stage: write_daily(new, stage, date), inside, check, rename)


def append_event(spark: SparkSession, path: str, event: DataFrame) -> None:
    """Add rows to a log; earlier rows are never rewritten."""
    event.coalesce(1).write.mode("append").option("compression", "zstd").parquet(path)


def write_sets(
    df: DataFrame, path: str, set_ids: Sequence[int] | None = None, key: str = "parameter_set_id", rename=None
) -> int:
    """Replace the rows of the parameter sets that were run, or leave the table as it is.

    ``set_ids`` are the sets of the run (a list on the driver); one without rows loses those of
    its last run.  Without it, the sets that occur in ``df`` are replaced.
    """
    ran = None if set_ids is None else {str(i) for i in set_ids}

    def write(stage: str) -> None:
        write_partitions(df, stage, [key], sort_by=("screen_type", *SECURITY))
        nonlocal ran
        if ran is None:
            ran = {values[key] for values in Folder(df.sparkSession, stage).partitions([key]).values()}

    return replace_partitions(df.sparkSession, path, [key], write, lambda values: values[key] in ran, rename=rename)
