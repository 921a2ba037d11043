"""Partitioned Parquet reads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import months_before
from ..operators.daily import target_bounds
from .partitions import DATE_PARTITIONS, Folder


def read_parquet(
    spark: SparkSession, *paths: str, schema=None, merge: bool = True, provenance: bool = False
) -> DataFrame:
    """Parquet files united by column name; ``provenance`` adds the source file.

    Pass ``schema`` where it is known: it saves reading the footers of all files.
    """
    reader = spark.read
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", merge)
    df = reader.parquet(*paths)
    if provenance:
        df = df.withColumn("source_path", F.col("_metadata.file_path"))
    return df


def read_dual_layout(yearly: DataFrame, dated: DataFrame, cutoff_year: int, date: str = "date") -> DataFrame:
    """Yearly history up to ``cutoff_year`` plus date partitions after it, without overlap."""
    first_after = F.lit(dt.date(cutoff_year + 1, 1, 1))
    old = yearly.filter(F.col(date) < first_after)
    new = dated.filter(F.col(date) >= first_after)
    return old.unionByName(new, allowMissingColumns=True)


def window_for_targets(df: DataFrame, target_days: int = 5, warmup_days: int = 250) -> DataFrame:
    """Rows from the warm-up start to the latest date of the target days."""
    bounds = target_bounds(df, target_days, warmup_days)
    return df.filter(
        (F.col("date") >= bounds["warmup_start"]) & (F.col("date") <= bounds["last_target"])
    )


def window_for_weeks(df: DataFrame, warmup_days: int = 500) -> DataFrame:
    """Rows of the latest ``warmup_days`` calendar days."""
    latest = df.select(F.max("date")).scalar()
    return df.filter(F.col("date") >= F.date_sub(latest, warmup_days))


def window_for_backtest(df: DataFrame, start: str, end: str, warmup_days: int = 420) -> DataFrame:
    """Rows from ``start`` minus the warm-up to ``end``."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    return df.filter(F.col("date").between(F.date_sub(first, warmup_days), last))


def window_for_lookback(df: DataFrame, months: int = 3, date: str = "date") -> DataFrame:
    """Rows of the latest calendar months."""
    latest = df.select(F.max(date)).scalar()
    return df.filter(F.col(date) >= months_before(latest, months))


class DatedTable:
    """A table in ``year=/month=/date=`` partitions, whose windows come from folder names.

    The latest dates are known without reading data, so the bounds of a window are literals
    and prune partitions when the query is planned.
    """

    def __init__(self, spark: SparkSession, path: str, date: str = "date"):
        self._spark, self._date = spark, date
        columns = [*DATE_PARTITIONS, date]
        found = Folder(spark, path).partitions(columns).values()
        #: All dates that have a partition, ascending.
        self.dates = sorted(dt.date.fromisoformat(p[date]) for p in found if p[date][:1].isdigit())
        self.rows = spark.read.parquet(path).drop(*DATE_PARTITIONS)

    @property
    def latest(self) -> dt.date | None:
        return self.dates[-1] if self.dates else None

    def between(self, first: dt.date | None, last: dt.date | None = None) -> DataFrame:
        """Rows from ``first`` to ``last``, or to the end; none if there is no first date."""
        if first is None:
            return self.rows.limit(0)
        rows = self.rows.filter(F.col(self._date) >= F.lit(first))
        return rows if last is None else rows.filter(F.col(self._date) <= F.lit(last))

    def target_window(self, target_days: int = 5, warmup_days: int = 250) -> DataFrame:
        """As ``window_for_targets``."""
        targets = self.dates[-target_days:]
        return self.between(targets[0] - dt.timedelta(warmup_days) if targets else None, self.latest)

    def week_window(self, warmup_days: int = 500) -> DataFrame:
        """As ``window_for_weeks``."""
        return self.between(self.latest and self.latest - dt.timedelta(warmup_days))

    def backtest_window(self, start: dt.date, end: dt.date, warmup_days: int = 420) -> DataFrame:
        """As ``window_for_backtest``."""
        return self.between(start - dt.timedelta(warmup_days), end)

    def lookback_window(self, months: int = 3) -> DataFrame:
        """As ``window_for_lookback``."""
        if self.latest is None:
            return self.rows.limit(0)
        return self.rows.filter(F.col(self._date) >= months_before(F.lit(self.latest), months))


def freshness(layers: dict[str, DataFrame], date: str = "date", reference: str | None = None) -> DataFrame:
    """Latest date per layer, rows and securities on it, and whether it matches the reference layer.

    Each layer is aggregated by date first, so only (layer, date) rows are shuffled further.
    """
    names: Sequence[str] = list(layers)
    rows = None
    for name in names:
        per_day = layers[name].groupBy(F.col(date).alias("latest_date")).agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("gvkey").alias("unique_gvkeys"),
        )
        last = per_day.agg(F.max_by(F.struct(*per_day.columns), "latest_date").alias("last"))
        one = last.select(F.lit(name).alias("layer"), "last.*")
        rows = one if rows is None else rows.unionByName(one)
    against = reference or names[0]
    target = rows.filter(F.col("layer") == against).select("latest_date").scalar()
    return rows.withColumn("up_to_date", F.col("latest_date").eqNullSafe(target))

