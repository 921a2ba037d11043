"""Daily market metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import SECURITY
from ..functions.dates import months_before
from ..functions.flags import crossed_above, or_false, ratios_within
from ..functions.prices import adjusted_close, cluster_ratio, safe_ratio
from .dedup import daily_rows_once
from .rolling import add_previous, add_trailing_means, by_time, trailing_mean

TIEBREAK = ("volume", "close_price_raw", "adjusted_close_price", "adjustment_factor")
MEANS = {"ma20": 20, "ma50": 50, "ma100": 100}
RATIOS = ("ma20_ma50_ratio", "ma20_ma100_ratio", "ma50_ma100_ratio")
HELPER_BAND = (0.99, 1.01)


def latest_dates(df: DataFrame, n: int, date: str = "date") -> DataFrame:
    """The latest ``n`` distinct dates (partial aggregation, then a top-n)."""
    return df.select(date).distinct().orderBy(F.desc(date)).limit(n)


def target_window(df: DataFrame, target_days: int, warmup_days: int, date: str = "date") -> DataFrame:
    """One row: warm-up start, first and last target date."""
    return latest_dates(df, target_days, date).agg(
        F.date_sub(F.min(date), warmup_days).alias("warmup_start"),
        F.min(date).alias("first_target"),
        F.max(date).alias("last_target"),
    )


def target_bounds(df: DataFrame, target_days: int, warmup_days: int) -> dict[str, Column]:
    """The window bounds as fields of one scalar subquery, which is computed once."""
    window = target_window(df, target_days, warmup_days)
    row = window.select(F.struct(*window.columns)).scalar()
    return {c: row.getField(c) for c in window.columns}


def priced_rows(raw: DataFrame, need_volume: bool = True, keep_raw: bool = False) -> DataFrame:
    """Rows with a known adjusted close (and volume).

    ``keep_raw`` is the backtest variant of the adjusted close (last resort: raw close).
    """
    rows = raw.withColumn(
        "adjusted_close_price",
        adjusted_close("adjusted_close_price", "close_price_raw", "adjustment_factor", keep_raw),
    ).filter("adjusted_close_price IS NOT NULL")
    return rows.filter("volume IS NOT NULL") if need_volume else rows


def clean_daily(
    raw: DataFrame,
    tiebreak: Sequence[str] = TIEBREAK,
    need_volume: bool = True,
    keep_raw: bool = False,
    laid_out: bool = False,
) -> DataFrame:
    """Adjusted, filtered and deduplicated daily rows.

    ``laid_out``: the rows are stored by security, so one sort by security and date serves the
    deduplication and every window after it, and nothing is shuffled.
    """
    rows = priced_rows(raw, need_volume, keep_raw)
    return daily_rows_once(rows, [*SECURITY, "date"], tiebreak, laid_out)


def add_daily_indicators(rows: DataFrame, date: str = "date") -> DataFrame:
    """Moving averages of the adjusted close and the volume ratio against its prior 30 rows."""
    rows = add_trailing_means(rows, "adjusted_close_price", MEANS, date)
    rows = rows.withColumn("volume_ma30", trailing_mean("volume", 30, date, with_current=False))
    return rows.withColumn("volume_ratio", safe_ratio("volume", "volume_ma30"))


def add_daily_ratios(rows: DataFrame) -> DataFrame:
    """Pairwise moving-average ratios and the cluster ratio."""
    return rows.withColumns(
        {
            "ma20_ma50_ratio": safe_ratio("ma20", "ma50"),
            "ma20_ma100_ratio": safe_ratio("ma20", "ma100"),
            "ma50_ma100_ratio": safe_ratio("ma50", "ma100"),
            "daily_ma_cluster_ratio": cluster_ratio("ma20", "ma50", "ma100"),
        }
    )


def flag_e(low: float = HELPER_BAND[0], high: float = HELPER_BAND[1]) -> Column:
    return ratios_within(RATIOS, low, high)


def flag_f(low: float = HELPER_BAND[0], high: float = HELPER_BAND[1]) -> Column:
    """Previous row clustered and the fast average crossed above the middle one."""
    clustered = ratios_within([f"prev_{r}" for r in RATIOS], low, high)
    return or_false(clustered & crossed_above("prev_ma20", "prev_ma50", "ma20", "ma50"))


def daily_history(raw: DataFrame, tiebreak: Sequence[str] = TIEBREAK, laid_out: bool = False) -> DataFrame:
    """Metrics for every date of ``raw``."""
    return history_of_clean(clean_daily(raw, tiebreak, laid_out=laid_out))


def history_of_clean(rows: DataFrame) -> DataFrame:
    """Metrics of cleaned rows, one per security and date."""
    rows = add_daily_ratios(add_daily_indicators(rows))
    rows = add_previous(rows, [*MEANS, *RATIOS], "date")
    return rows.withColumns({"flag_e": flag_e(), "flag_f": flag_f()})


def daily_metrics(
    raw: DataFrame,
    target_days: int = 5,
    warmup_days: int = 250,
    tiebreak: Sequence[str] = TIEBREAK,
) -> DataFrame:
    """Metrics of the latest ``target_days`` dates, computed from a warm-up window only.

    The window bounds are scalar subqueries below the row-frame windows, so they prune
    files and row groups of a date-laid-out source; the target filter stays above them.
    """
    bounds = target_bounds(raw, target_days, warmup_days)
    in_window = raw.filter(
        (F.col("date") >= bounds["warmup_start"]) & (F.col("date") <= bounds["last_target"])
    )
    return daily_history(in_window, tiebreak).filter(F.col("date") >= bounds["first_target"])


def legacy_daily_flags(rows: DataFrame, limit: float = 0.01) -> DataFrame:
    """Cluster-ratio flags of the local variant, from rows with daily indicators.

    The raw source column decides which rows enter in the local script; here rows are
    filtered after the factor fallback, as in the server variant.
    """
    w = by_time("date")
    rows = rows.withColumn("flag_e", or_false(F.col("daily_ma_cluster_ratio") <= limit))
    rows = rows.withColumns(
        {
            "prev_ma20": F.lag("ma20").over(w),
            "prev_ma50": F.lag("ma50").over(w),
            "prev_flag_e": F.lag("flag_e").over(w),
        }
    )
    crossed = crossed_above("prev_ma20", "prev_ma50", "ma20", "ma50")
    return rows.withColumn("flag_f", or_false(F.col("prev_flag_e") & crossed))


def recent_volume(daily: DataFrame, months: int = 3) -> DataFrame:
    """Rows of the last ``months`` calendar months with a known volume ratio."""
    latest = daily.select(F.max("date")).scalar()
    return (
        daily.filter("volume_ratio IS NOT NULL")
        .withColumn("latest_date", latest)
        .withColumn("window_start_date", months_before("latest_date", months))
        .filter("date >= window_start_date AND date <= latest_date")
    )
