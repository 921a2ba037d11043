"""Rebuild only what changed: from re-downloaded dates to the metric rows that depend on them.

A change of one raw row changes that security's metrics on its date and on as many later rows
as the longest frame looks back, and nothing else.  So the securities that differ are found by
comparing the re-downloaded dates with what is stored, each with its first and last changed
date; the rows from there to the reach of the frames are computed again, from rows that start
a frame earlier, and take the place of the stored ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import SECURITY
from ..functions.dates import week_start
from ..sources import sinks
from ..sources.workspace import materialize, workspace
from . import weekly
from .daily import MEANS, TIEBREAK, clean_daily, history_of_clean
from .rolling import add_previous, by_time

#: Rows after a changed one whose metrics it takes part in: the longest average, then the previous row's.
REACH = max(MEANS.values())
#: As many bars: their averages leave out the bar itself, and so reach one further.
WEEKLY_REACH = max(weekly.MEANS.values()) + 1


def changed_keys(old: DataFrame, new: DataFrame, date: str = "date", keys: Sequence[str] = SECURITY) -> DataFrame:
    """Per key its first and last changed date, between two versions of the same dates.

    Rows are compared whole, over the columns of ``old``, by a hash that is summed per key and
    date: copies, their order and their number count, and one partial aggregation replaces
    a join of both versions.
    """
    columns = old.columns
    # Two hashes of each row, summed: equal for equal collections of rows.
    digest = [F.xxhash64(*columns), F.xxhash64(F.lit(1), *reversed(columns))]

    def side(df: DataFrame, sign: int) -> DataFrame:
        signed = [(F.lit(sign) * h.cast("decimal(20,0)")).alias(f"_h{i}") for i, h in enumerate(digest)]
        return df.select(*keys, date, *signed, F.lit(sign).alias("_n"))

    both = side(old, -1).unionByName(side(new.select(*columns), 1))
    sums = [F.sum(c).alias(c) for c in ("_h0", "_h1", "_n")]
    changed = both.groupBy(*keys, date).agg(*sums).filter("_h0 <> 0 OR _h1 <> 0 OR _n <> 0")
    return changed.groupBy(*keys).agg(F.min(date).alias("first_changed"), F.max(date).alias("last_changed"))


def daily_refresh(
    raw: DataFrame, changed: DataFrame, tiebreak: Sequence[str] = TIEBREAK
) -> tuple[DataFrame, DataFrame]:
    """(recomputed metric rows, range per changed security) after a change of raw rows.

    ``raw`` has the rows as they are now.  The range (``first_changed``, ``last_affected``) is what
    the recomputed rows stand for: stored rows in it that were not recomputed are gone.
    """
    metrics = _daily_recomputed(raw, changed, tiebreak)
    return _without_marks(metrics), _ranges(metrics, changed, "date")


def _daily_recomputed(raw: DataFrame, changed: DataFrame, tiebreak: Sequence[str]) -> DataFrame:
    rows = clean_daily(raw.join(changed, [*SECURITY]), tiebreak)
    return history_of_clean(_within_reach(rows, "date", REACH)).filter("_row >= _from")


def weekly_refresh(
    old: DataFrame,
    raw: DataFrame,
    changed: DataFrame,
    calendar: DataFrame | None = None,
    tiebreak: Sequence[str] = TIEBREAK,
) -> tuple[DataFrame, DataFrame]:
    """(recomputed weekly rows, range of weeks per changed security) after a change of raw rows.

    ``old`` has all raw rows before the change and ``raw`` all of them after it: a change of one
    security may complete a week, or undo that, for the whole market.  Then all securities
    that traded in that week have changed in it.
    """
    changes, weeks = _changed_weeks(old, raw, changed, calendar), weekly.market_weeks(raw, calendar)
    metrics = _weekly_recomputed(raw, changes, weeks, calendar, tiebreak)
    return _without_marks(metrics), _ranges(metrics, changes, "week_start_date")


def _changed_weeks(old: DataFrame, raw: DataFrame, changed: DataFrame, calendar: DataFrame | None) -> DataFrame:
    """Per security its first and last changed week, those included that changed for the whole market."""
    weeks = weekly.market_weeks(raw, calendar)
    before = weekly.market_weeks(old, calendar)
    # Few rows: weeks that are complete in one of the two only, or end on another day.
    keys = ["week_start_date", "week_end_date"]
    flipped = weeks.select(*keys).exceptAll(before.select(*keys)).unionByName(before.select(*keys).exceptAll(weeks.select(*keys)))
    flipped = F.broadcast(flipped.select("week_start_date").distinct())
    traded = old.select(*SECURITY, "date").unionByName(raw.select(*SECURITY, "date"))
    traded = traded.select(*SECURITY, week_start("date").alias("week_start_date")).join(flipped, "week_start_date").distinct()
    own = changed.select(*SECURITY, *[week_start(c).alias(c) for c in ("first_changed", "last_changed")])
    market = traded.select(*SECURITY, F.col("week_start_date").alias("first_changed"), F.col("week_start_date").alias("last_changed"))
    return own.unionByName(market).groupBy(*SECURITY).agg(F.min("first_changed").alias("first_changed"), F.max("last_changed").alias("last_changed"))


def _weekly_recomputed(
    raw: DataFrame, changes: DataFrame, weeks: DataFrame, calendar: DataFrame | None, tiebreak: Sequence[str]
) -> DataFrame:
    history = weekly.weekly_history(raw.join(changes.select(*SECURITY), [*SECURITY], "left_semi"), calendar, tiebreak, weeks)
    # Stores that derive their ratios on reading keep this one instead of the previous row's ratios.
    history = add_previous(history, ["wma5"], "week_end_date")
    return _within_reach(history.join(changes, [*SECURITY]), "week_start_date", WEEKLY_REACH).filter("_row >= _from")


def _within_reach(rows: DataFrame, date: str, reach: int) -> DataFrame:
    """Rows of changed securities that a change affects, and those before them that a frame needs."""
    whole = Window.partitionBy(*SECURITY)
    rows = rows.withColumn("_row", F.row_number().over(by_time(date)))
    rows = rows.withColumns(
        {
            "_from": F.min(F.when(F.col(date) >= F.col("first_changed"), F.col("_row"))).over(whole),
            # A change before the first row that is left reaches as far as one in that row.
            "_to": F.coalesce(F.max(F.when(F.col(date) <= F.col("last_changed"), F.col("_row"))).over(whole), F.lit(0)) + reach,
        }
    )
    return rows.filter(F.col("_row").between(F.col("_from") - reach, F.col("_to")))


def _ranges(metrics: DataFrame, changed: DataFrame, date: str) -> DataFrame:
    last = metrics.groupBy(*SECURITY).agg(F.max(date).alias("_last"))
    return changed.join(last, [*SECURITY], "left").select(
        *SECURITY, "first_changed", F.greatest("last_changed", "_last").alias("last_affected")
    )


def _without_marks(metrics: DataFrame) -> DataFrame:
    return metrics.drop("_row", "_from", "_to", "first_changed", "last_changed")


def merged(stored: DataFrame, recomputed: DataFrame, ranges: DataFrame, date: str = "date") -> DataFrame:
    """Stored metric rows with the recomputed ones in the place of all rows in the ranges."""
    kept = stored.join(ranges, [*SECURITY], "left").filter(
        F.col("first_changed").isNull() | ~F.col(date).between(F.col("first_changed"), F.col("last_affected"))
    )
    return kept.select(*stored.columns).unionByName(recomputed.select(*stored.columns))


def refresh_daily_store(
    spark: SparkSession,
    path: str,
    raw: DataFrame,
    changed: DataFrame,
    tiebreak: Sequence[str] = TIEBREAK,
) -> int:
    """Bring a date-partitioned table of daily metrics up to date; returns the dates rewritten.

    Only the dates with a row in the range of a changed security are read and replaced, all of
    them or none.  Rows of other securities on those dates are copied as they are.
    """
    folder = workspace(spark)
    changed = materialize(changed, "changed", folder)
    metrics = _daily_recomputed(raw, changed, tiebreak)
    columns = [*sinks.DATE_PARTITIONS, "date"]
    return _replace_affected(spark, path, metrics, changed, columns, sinks.write_daily, folder)


def refresh_weekly_store(
    spark: SparkSession,
    path: str,
    old: DataFrame,
    raw: DataFrame,
    changed: DataFrame,
    calendar: DataFrame | None = None,
    tiebreak: Sequence[str] = TIEBREAK,
) -> int:
    """As ``refresh_daily_store``, for a table of weekly metrics by week; returns the weeks rewritten."""
    folder = workspace(spark)
    # Stored, so that its true size is known and the raw rows of other securities go before any exchange.
    changes = materialize(_changed_weeks(old, raw, materialize(changed, "changed", folder), calendar), "changes", folder)
    metrics = _weekly_recomputed(raw, changes, weekly.market_weeks(raw, calendar), calendar, tiebreak)
    return _replace_affected(spark, path, metrics, changes, ["year", "week_start_date"], sinks.write_weekly, folder)


def _replace_affected(
    spark: SparkSession, path: str, metrics: DataFrame, changed: DataFrame, partitions: list[str], write, folder: str
) -> int:
    date = partitions[-1]
    stored = spark.read.parquet(path).drop(*partitions[:-1])
    metrics = materialize(metrics.select(*stored.columns), "recomputed", folder)
    # From the stored rows: these are computed once.
    ranges = materialize(_ranges(metrics, changed, date), "ranges", folder)
    bounds = ranges.agg(F.min("first_changed").alias("first"), F.max("last_affected").alias("last")).first()
    if bounds["first"] is None:
        return 0
    near = stored.filter(F.col(date).between(bounds["first"], bounds["last"]))
    inside = near.join(ranges, [*SECURITY]).filter(F.col(date).between(F.col("first_changed"), F.col("last_affected")))
    dates = inside.select(date).unionByName(metrics.select(date)).distinct()
    touched = [r[date] for r in dates.collect()]  # calendar days of the ranges
    rows = merged(near.filter(F.col(date).isin(touched)), metrics, ranges, date)
    names = {d.isoformat() for d in touched}
    check = sinks.unique_keys([*SECURITY, date])
    return sinks.replace_partitions(spark, path, partitions, lambda stage: write(rows, stage), lambda p: p[date] in names, check)
