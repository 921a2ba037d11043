"""Weekly market metrics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import SECURITY
from ..functions.aggregates import value_at_earliest, value_at_latest
from ..functions.dates import week_start
from ..functions.flags import crossed_above, or_false, ratios_within
from ..functions.prices import cluster_ratio, safe_ratio
from .calendar import completed_weeks
from .daily import TIEBREAK, clean_daily, priced_rows
from .rolling import add_previous, add_trailing_means, by_time

MEANS = {"wma5": 5, "wma10": 10, "wma30": 30}
RATIOS = ("wma5_wma10_ratio", "wma5_wma30_ratio", "wma10_wma30_ratio")
HELPER_BAND = (0.98, 1.02)


def weekly_bars(daily: DataFrame, weeks: DataFrame, laid_out: bool = False) -> DataFrame:
    """One bar per security and completed week.

    ``weeks`` has one row per calendar week, so it is broadcast; the daily rows are laid
    out by security once, and both this aggregation and the later windows use that layout.
    ``laid_out``: they are stored so already.
    """
    rows = daily.withColumn("week_start_date", week_start("date")).join(
        F.broadcast(weeks), "week_start_date"
    )
    return (
        (rows if laid_out else rows.repartition(*SECURITY))
        .groupBy(*SECURITY, "week_start_date", "week_end_date")
        .agg(
            value_at_latest("ticker", "date").alias("ticker"),
            value_at_latest("company_name", "date").alias("company_name"),
            value_at_latest("currency", "date").alias("currency"),
            F.max("date").alias("security_week_last_trade_date"),
            value_at_earliest("adjusted_close_price", "date").alias("weekly_open_price"),
            F.max("adjusted_close_price").alias("weekly_high_price"),
            F.min("adjusted_close_price").alias("weekly_low_price"),
            value_at_latest("adjusted_close_price", "date").alias("weekly_close_price"),
            value_at_latest("close_price_raw", "date").alias("weekly_close_price_raw"),
            F.sum("volume").alias("weekly_volume"),
        )
    )


def add_weekly_averages(
    bars: DataFrame, names: dict[str, int] | None = None, with_current: bool = False
) -> DataFrame:
    """Averages of the weekly close; the current week is excluded by default."""
    return add_trailing_means(
        bars, "weekly_close_price", names or MEANS, "week_end_date", with_current=with_current
    )


def add_weekly_ratios(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "wma5_wma10_ratio": safe_ratio("wma5", "wma10"),
            "wma5_wma30_ratio": safe_ratio("wma5", "wma30"),
            "wma10_wma30_ratio": safe_ratio("wma10", "wma30"),
            "weekly_ma_cluster_ratio": cluster_ratio("wma5", "wma10", "wma30"),
        }
    )


def flag_g(low: float = HELPER_BAND[0], high: float = HELPER_BAND[1]) -> Column:
    return ratios_within(RATIOS, low, high)


def flag_h(low: float = HELPER_BAND[0], high: float = HELPER_BAND[1]) -> Column:
    """Previous week clustered and the middle average crossed above the slow one."""
    clustered = ratios_within([f"prev_{r}" for r in RATIOS], low, high)
    return or_false(clustered & crossed_above("prev_wma10", "prev_wma30", "wma10", "wma30"))


def weekly_history(
    raw: DataFrame,
    calendar: DataFrame | None = None,
    tiebreak: Sequence[str] = TIEBREAK,
    weeks: DataFrame | None = None,
    laid_out: bool = False,
) -> DataFrame:
    """Weekly metrics for every completed week of ``raw``.

    Copies of a row do not change the latest date of a week, so the completed weeks come
    from the rows before deduplication: a plain partial aggregation.  ``weeks`` gives them where
    ``raw`` does not have the whole market.  ``laid_out``: ``raw`` is stored by security, and
    only the weeks need an exchange.
    """
    rows = clean_daily(raw, tiebreak, need_volume=False, laid_out=laid_out)
    if weeks is None:
        weeks = market_weeks(raw, calendar)
    bars = add_weekly_ratios(add_weekly_averages(weekly_bars(rows, weeks, laid_out)))
    bars = add_previous(bars, ["wma10", "wma30", *RATIOS], "week_end_date")
    return bars.withColumns({"flag_g": flag_g(), "flag_h": flag_h()})


def market_weeks(raw: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """The weeks whose official last session the market has reached."""
    return completed_weeks(priced_rows(raw, need_volume=False), calendar)


def latest_weeks(weekly: DataFrame, n: int) -> DataFrame:
    return weekly.select("week_start_date").distinct().orderBy(F.desc("week_start_date")).limit(n)


def weekly_metrics(
    raw: DataFrame,
    calendar: DataFrame | None = None,
    target_weeks: int = 8,
    start_week: dt.date | str | None = None,
    warmup_days: int = 500,
    tiebreak: Sequence[str] = TIEBREAK,
) -> DataFrame:
    """Metrics of the latest ``target_weeks`` weeks, or of all weeks from ``start_week`` on.

    Rows are read from ``warmup_days`` before the latest date, or before ``start_week`` if that
    is earlier, so that the first week asked for has its averages.
    """
    latest = raw.select(F.max("date")).scalar()
    first = F.date_sub(latest, warmup_days)
    if start_week is not None:
        first = F.least(first, F.date_sub(week_start(F.lit(start_week).cast("date")), warmup_days))
    in_window = raw.filter(F.col("date") >= first)
    rows = weekly_history(in_window, calendar, tiebreak)
    if start_week is None:
        # Every completed week has bars, so the latest bars are those of the latest weeks.
        weeks = market_weeks(in_window, calendar)
        kept = rows.join(F.broadcast(latest_weeks(weeks, target_weeks)), "week_start_date", "left_semi")
    else:
        monday = week_start(F.lit(start_week).cast("date"))
        kept = rows.filter(F.col("week_start_date") >= monday)
    return kept.withColumn("data_as_of_date", latest)


def legacy_weekly_metrics(daily: DataFrame, limit: float = 0.02) -> DataFrame:
    """Local variant: last daily row of any week, averages including the current week."""
    last = Window.partitionBy(*SECURITY, "week_start_date").orderBy(F.desc("date"))
    closes = (
        daily.filter("adjusted_close_price IS NOT NULL")
        .withColumn("week_start_date", week_start("date"))
        .repartition(*SECURITY)
        .withColumn("_row", F.row_number().over(last))
        .filter("_row = 1")
        .select(
            *SECURITY,
            "ticker",
            "company_name",
            "week_start_date",
            F.col("date").alias("week_end_date"),
            F.col("adjusted_close_price").alias("weekly_close_price"),
            F.col("close_price_raw").alias("weekly_close_price_raw"),
            "currency",
        )
    )
    rows = add_weekly_averages(closes, with_current=True)
    rows = rows.withColumn("flag_g", or_false(cluster_ratio("wma5", "wma10", "wma30") <= limit))
    w = by_time("week_end_date")
    rows = rows.withColumns(
        {
            "prev_wma10": F.lag("wma10").over(w),
            "prev_wma30": F.lag("wma30").over(w),
            "prev_flag_g": F.lag("flag_g").over(w),
        }
    )
    crossed = crossed_above("prev_wma10", "prev_wma30", "wma10", "wma30")
    return rows.withColumn("flag_h", or_false(F.col("prev_flag_g") & crossed))
