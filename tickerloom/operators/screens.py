"""Production and dynamic A-H screens."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import SECURITY
from ..functions.dates import months_before
from ..functions.flags import cluster_flag, or_false
from ..functions.prices import cluster_ratio
from ..sources.workspace import materialize
from .growth import recent_growth_flag, recent_pass_count


def surge_day_counts(
    daily: DataFrame, on_or_before, ratio: float, months: int = 3, date: str = "date"
) -> DataFrame:
    """Per security: rows with a surge in the ``months`` before a date (a scalar column)."""
    window = (F.col(date) >= months_before(on_or_before, months)) & (F.col(date) <= on_or_before)
    return (
        daily.filter(window)
        .groupBy(*SECURITY)
        .agg(F.count_if(F.col("volume_ratio") >= ratio).alias("surge_day_count_3m"))
    )


def latest_daily_screen(daily: DataFrame, q: float, m: int) -> DataFrame:
    """Conditions C and D on the latest date.

    One aggregation over the trailing window yields both the surge count and the latest
    row of each security, so the window is read and shuffled once.
    """
    latest = daily.select(F.max("date")).scalar()
    payload = [
        "ticker",
        "company_name",
        "currency",
        "adjusted_close_price",
        "close_price_raw",
        "volume",
        "volume_ma30",
        "volume_ratio",
        "ma20",
        "ma50",
        "ma100",
        "flag_e",
        "flag_f",
    ]
    rows = (
        daily.filter(F.col("date") >= months_before(latest, 3))
        .select(*SECURITY, "date", *payload)
        .withColumn("screening_date", latest)
    )
    counts = rows.groupBy(*SECURITY).agg(
        F.count_if(F.col("volume_ratio") >= q).alias("surge_day_count_3m")
    )
    today = rows.filter("date = screening_date").drop("date")
    return today.join(counts, [*SECURITY], "left").withColumns(
        {
            "surge_day_count_3m": F.coalesce("surge_day_count_3m", F.lit(0)),
            "flag_c": or_false(F.col("volume_ratio") >= q),
            "flag_d": F.coalesce("surge_day_count_3m", F.lit(0)) >= m,
            "daily_ma_cluster_ratio": cluster_ratio("ma20", "ma50", "ma100"),
        }
    )


def latest_weekly_rows(weekly: DataFrame, on_or_before) -> DataFrame:
    """Rows of the latest week that ended on or before a date (a scalar column)."""
    last = weekly.filter(F.col("week_end_date") <= on_or_before).select(F.max("week_end_date")).scalar()
    return weekly.filter(F.col("week_end_date") == last).select(
        *SECURITY,
        "week_start_date",
        "week_end_date",
        "weekly_close_price",
        "wma5",
        "wma10",
        "wma30",
        cluster_ratio("wma5", "wma10", "wma30").alias("weekly_ma_cluster_ratio"),
        "flag_g",
        "flag_h",
    )


def screen_latest(
    daily: DataFrame,
    weekly: DataFrame,
    annual: DataFrame,
    quarterly: DataFrame,
    n_pct: float = 10,
    annual_years: int = 3,
    quarter_count: int = 4,
    q: float = 5,
    m: int = 3,
) -> DataFrame:
    """All conditions on the latest date, one row per security."""
    n = float(n_pct) / 100.0
    latest = daily.select(F.max("date")).scalar()
    a = recent_growth_flag(annual, "annual", annual_years, n, "flag_a")
    b = recent_growth_flag(quarterly, "quarterly", quarter_count, n, "flag_b")
    rows = (
        latest_daily_screen(daily, q, m)
        .join(latest_weekly_rows(weekly, latest), [*SECURITY], "left")
        .join(a, "gvkey", "left")
        .join(b, "gvkey", "left")
    )
    defaults = ("flag_a", "flag_b", "flag_g", "flag_h")
    rows = rows.withColumns({f: or_false(F.col(f)) for f in defaults})
    return rows.withColumns(
        {
            "n_pct": F.lit(float(n_pct)),
            "annual_years": F.lit(int(annual_years)),
            "quarter_count": F.lit(int(quarter_count)),
            "q": F.lit(float(q)),
            "m": F.lit(int(m)),
            "flag_ab": F.col("flag_a") & F.col("flag_b"),
            "flag_cd": F.col("flag_c") & F.col("flag_d"),
            "flag_all": or_false(
                F.col("flag_a")
                & F.col("flag_b")
                & F.col("flag_c")
                & F.col("flag_d")
                & F.col("flag_f")
                & F.col("flag_h")
            ),
        }
    )


def _report_order() -> list[Column]:
    flags = ("flag_all", "flag_ab", "flag_cd", "flag_f", "flag_h")
    return [
        *[F.desc(f) for f in flags],
        F.desc_nulls_last("volume_ratio"),
        F.asc_nulls_last("ticker"),
        *[F.asc(c) for c in SECURITY],
    ]


def ranked_screen(screen: DataFrame, n: int | None = None) -> DataFrame:
    """A screen in report order; with ``n`` only its first rows, numbered.

    A plain sort is range-partitioned.  Only the ``n`` rows of a top-n meet in one window
    partition to be numbered.
    """
    ordered = screen.orderBy(*_report_order())
    if n is None:
        return ordered
    position = F.row_number().over(Window.orderBy(*_report_order()))
    return ordered.limit(n).withColumn("report_rank", position)


def numbered_screen(screen: DataFrame) -> DataFrame:
    """The whole screen with its position in report order."""
    return numbered(screen.orderBy(*_report_order()), "report_rank")


def numbered(ordered: DataFrame, rank: str) -> DataFrame:
    """The rows of a sorted DataFrame with their position in it.

    Rows are sorted in ranges and numbered within each, and the ranges' sizes, a row per
    task, give where each begins; no task sees all rows.
    """
    rows = materialize(ordered.withColumn("_at", F.monotonically_increasing_id()), rank)
    placed = rows.withColumns({"_range": F.shiftright("_at", 33), "_row": F.col("_at").bitwiseAND((1 << 33) - 1)})
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    found = placed.join(F.broadcast(starts), "_range")
    return found.withColumn(rank, F.col("_start") + F.col("_row") + 1).drop("_at", "_range", "_row", "_start")


def top_candidates(screen: DataFrame, n: int = 30, passing: str = "flag_all") -> DataFrame:
    """The first ``n`` rows that pass everything, or another of the screen's flags."""
    return ranked_screen(screen.filter(passing), n)


def parameter_tag(n_pct: float, annual_years: int, quarter_count: int, q: float, m: int) -> str:
    """Folder tag of a parameter choice; fractions are kept so that tags cannot collide."""
    return f"n{n_pct:g}_annual{annual_years}_quarter{quarter_count}_q{q:g}_m{m}"


def screen_dynamic(
    daily: DataFrame,
    weekly: DataFrame,
    annual: DataFrame,
    quarterly: DataFrame,
    master: DataFrame,
    selected_date: dt.date | str | Column | None = None,
    annual_growth: float = 0.10,
    quarterly_growth: float = 0.10,
    annual_years: int = 3,
    quarter_count: int = 4,
    daily_band: tuple[float, float] = (0.98, 1.02),
    weekly_band: tuple[float, float] = (0.98, 1.02),
    q: float = 5,
    m: int = 3,
    include_weekly: bool = False,
    universe_filter: bool = True,
) -> DataFrame:
    """User-parameterised screen over the serving snapshots, three-valued flags."""
    if selected_date is None:
        selected = daily.select(F.max("snapshot_date")).scalar()
    elif isinstance(selected_date, Column):
        selected = selected_date  # of one row, as a scalar subquery
    else:
        selected = F.lit(selected_date).cast("date")
    rows = daily.filter(F.col("snapshot_date") == selected)
    unknown = F.lit(None)
    weekly_flags = {
        "flag_g": unknown.cast("boolean"),
        "flag_h": unknown.cast("boolean"),
        "weekly_h_confirmed_using_date": unknown.cast("date"),
    }
    if include_weekly:
        week = weekly.filter(F.col("week_end_date") == selected).select(
            *SECURITY,
            cluster_flag("weekly_ma5", "weekly_ma10", "weekly_ma30", *weekly_band).alias("flag_g"),
            cluster_flag(
                "future_weekly_ma5",
                "future_weekly_ma10",
                "future_weekly_ma30",
                *weekly_band,
                required=["weekly_h_confirmed_using_date"],
            ).alias("flag_h"),
            "weekly_h_confirmed_using_date",
        )
        rows = rows.join(week, [*SECURITY])
    else:
        rows = rows.withColumns(weekly_flags)
    identity = master.select(
        *SECURITY, "ticker", "company_name", "is_excluded_universe", "exclusion_reason"
    )
    if universe_filter:
        identity = identity.filter(~F.col("is_excluded_universe"))
    surges = surge_day_counts(daily, selected, q, date="snapshot_date").withColumnRenamed(
        "surge_day_count_3m", "recent_c_count"
    )
    a = recent_pass_count(annual, "annual", annual_years, annual_growth)
    b = recent_pass_count(quarterly, "quarterly", quarter_count, quarterly_growth)
    return (
        rows.join(identity, [*SECURITY])
        .join(a, "gvkey", "left")
        .join(b, "gvkey", "left")
        .join(surges, [*SECURITY], "left")
        .select(
            "snapshot_date",
            "ticker",
            "company_name",
            *SECURITY,
            "volume_ratio",
            "recent_c_count",
            (F.coalesce("annual_pass_count", F.lit(0)) >= annual_years).alias("flag_a"),
            (F.coalesce("quarterly_pass_count", F.lit(0)) >= quarter_count).alias("flag_b"),
            (F.col("volume_ratio") >= q).alias("flag_c"),
            (F.coalesce("recent_c_count", F.lit(0)) >= m).alias("flag_d"),
            cluster_flag("ma20", "ma50", "ma100", *daily_band).alias("flag_e"),
            cluster_flag(
                "future_daily_ma20",
                "future_daily_ma50",
                "future_daily_ma100",
                *daily_band,
                required=["daily_f_confirmed_using_date"],
            ).alias("flag_f"),
            "daily_f_confirmed_using_date",
            "flag_g",
            "flag_h",
            "weekly_h_confirmed_using_date",
            "is_excluded_universe",
            "exclusion_reason",
        )
    )


def dynamic_sample(screen: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows of a dynamic screen in report order."""
    return screen.orderBy(
        F.desc("flag_a"),
        F.desc("flag_b"),
        F.desc("flag_d"),
        F.desc_nulls_last("volume_ratio"),
        *SECURITY,
    ).limit(n)
