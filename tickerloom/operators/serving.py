"""Serving snapshots: current-state master and date-keyed features with future inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import SECURITY
from ..functions.dates import months_before
from .calendar import with_official_week_end
from .dedup import keep_first
from .universe import annotate_universe

DAILY_FUTURE = {
    "daily_f_confirmed_using_date": "snapshot_date",
    "future_daily_ma20": "ma20",
    "future_daily_ma50": "ma50",
    "future_daily_ma100": "ma100",
    "future_daily_close_price": "close_price",
    "future_daily_adjusted_close_price": "adjusted_close_price",
}
WEEKLY_FUTURE = {
    "weekly_h_confirmed_using_date": "week_end_date",
    "future_weekly_ma5": "weekly_ma5",
    "future_weekly_ma10": "weekly_ma10",
    "future_weekly_ma30": "weekly_ma30",
    "future_weekly_close_price": "weekly_close_price",
}
WEEKLY_OPTIONAL = ("weekly_open_price", "weekly_high_price", "weekly_low_price", "weekly_volume")


def add_confirmation(df: DataFrame, date: str, columns: dict[str, str]) -> DataFrame:
    """Next row's values per security, only where that row is really later.

    NULL means the confirming row does not exist yet.
    """
    w = Window.partitionBy(*SECURITY).orderBy(date)
    later = F.lead(date).over(w) > F.col(date)
    return df.withColumns(
        {new: F.when(later, F.lead(old).over(w)) for new, old in columns.items()}
    )


def in_lookback(df: DataFrame, months: int = 3, date: str = "date") -> DataFrame:
    """Rows of the latest ``months`` calendar months."""
    latest = df.select(F.max(date)).scalar()
    return df.filter(F.col(date) >= months_before(latest, months))


def security_master(daily: DataFrame) -> DataFrame:
    """Current state per security: latest identity, first and last seen, activity, universe.

    First and last dates are a hash aggregate over fixed-width values; the identity is fetched
    by a join on the security, of which the row at the last date stays (no other is as late).
    Rows laid out by security meet without an exchange.  Of rows that share the last date
    the one with the greatest identity counts.
    """
    identity = ("ticker", "company_name", "exchange_code", "security_status", "issue_type_code")
    carried = [*identity, *(["source_path"] if "source_path" in daily.columns else [])]
    seen = daily.groupBy(*SECURITY).agg(F.min("date").alias("first_seen_date"), F.max("date").alias("last_seen_date"))
    last = daily.select(*SECURITY, "date", *carried).join(seen, [*SECURITY]).filter("date >= last_seen_date")
    rows = keep_first(last, SECURITY, [F.desc_nulls_last(c) for c in carried], laid_out=True)
    latest = daily.select(F.max("date")).scalar()
    rows = rows.select(*SECURITY, *carried, "first_seen_date", "last_seen_date")
    rows = rows.withColumnRenamed("issue_type_code", "security_type")
    return annotate_universe(rows.withColumn("is_active", F.col("last_seen_date") == latest))


def daily_snapshot(daily: DataFrame, lookback_months: int = 3) -> DataFrame:
    """Daily serving rows of the lookback window with their future inputs."""
    rows = in_lookback(daily, lookback_months).select(
        F.col("date").alias("snapshot_date"),
        *[F.col(c).cast("string").alias(c) for c in SECURITY],
        F.col("close_price_raw").alias("close_price"),
        "adjusted_close_price",
        "volume",
        "volume_ma30",
        "volume_ratio",
        months_before("date", lookback_months).alias("volume_lookback_start_date"),
        F.col("date").alias("volume_lookback_end_date"),
        "ma20",
        "ma50",
        "ma100",
        *_source(daily),
    )
    return add_confirmation(rows, "snapshot_date", DAILY_FUTURE)


def weekly_snapshot(weekly: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Weekly serving rows of official weeks with their future inputs.

    Weeks that the calendar does not know, or that end on another day, are dropped.
    """
    for column in WEEKLY_OPTIONAL:
        if column not in weekly.columns:
            weekly = weekly.withColumn(column, F.lit(None).cast("double"))
    kept = with_official_week_end(weekly, calendar, "inner").filter(
        "week_end_date = official_week_end_date"
    )
    rows = kept.select(
        "week_start_date",
        "week_end_date",
        *[F.col(c).cast("string").alias(c) for c in SECURITY],
        "weekly_open_price",
        "weekly_high_price",
        "weekly_low_price",
        "weekly_close_price",
        "weekly_volume",
        F.col("wma5").alias("weekly_ma5"),
        F.col("wma10").alias("weekly_ma10"),
        F.col("wma30").alias("weekly_ma30"),
        *_source(weekly),
    )
    return add_confirmation(rows, "week_end_date", WEEKLY_FUTURE)


def weekly_compat(snapshot: DataFrame) -> DataFrame:
    """The weekly snapshot under its compatibility names."""
    renames = {f"weekly_ma{k}": f"wma{k}" for k in (5, 10, 30)}
    renames |= {f"future_weekly_ma{k}": f"future_weekly_wma{k}" for k in (5, 10, 30)}
    return snapshot.withColumnsRenamed(renames)


def snapshot_with_master(snapshot: DataFrame, master: DataFrame, universe_filter: bool = True) -> DataFrame:
    """Display join of a snapshot with its security identity."""
    identity = master.select(
        *SECURITY, "ticker", "company_name", "is_excluded_universe", "exclusion_reason"
    )
    if universe_filter:
        identity = identity.filter(~F.col("is_excluded_universe"))
    return snapshot.join(identity, [*SECURITY])


def availability(snapshot: DataFrame, date: str, confirmed: str, n: int | None = None) -> DataFrame:
    """Confirmed and pending rows per snapshot date, latest first."""
    rows = snapshot.groupBy(date).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(confirmed).alias("confirmed_rows"),
        F.count_if(F.col(confirmed).isNull()).alias("pending_rows"),
    )
    rows = rows.orderBy(F.desc(date))
    return rows if n is None else rows.limit(n)


def _source(df: DataFrame) -> list[Column]:
    known = "source_path" in df.columns
    return [F.col("source_path") if known else F.lit(None).cast("string").alias("source_path")]
