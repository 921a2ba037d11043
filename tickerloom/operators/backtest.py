"""Parameter-grid backtest: features, signals for all sets at once, forward outcomes."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, fields
from itertools import product
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import SECURITY
from ..functions.aggregates import value_at_earliest, value_at_latest
from ..functions.dates import week_start
from ..functions.flags import strict_cluster_flag, tolerance_band
from ..functions.prices import percent_return
from ..sources.sinks import append_event
from .asof import asof_join
from .calendar import with_official_week_end
from .daily import TIEBREAK, add_daily_indicators, clean_daily
from .dedup import keep_first
from .rolling import add_next, add_trailing_means, surge_days

HORIZONS = {"6m": 6, "1y": 12, "2y": 24}
PARAMETER_KEY = (
    "annual_growth_pct",
    "quarterly_growth_pct",
    "annual_years",
    "quarter_count",
    "volume_ratio_threshold",
    "volume_surge_min_days",
    "daily_ma_tolerance_pct",
    "weekly_ma_tolerance_pct",
)
SELECTION_COLUMNS = (
    "parameter_set_id",
    "screen_type",
    "signal_date",
    "f_confirmation_date",
    "g_confirmation_date",
    "h_confirmation_date",
    "selected_date",
    "gvkey",
    "iid",
    "ticker",
    "company_name",
    "selected_price",
    "selected_adjusted_price",
    *[f"flag_{c}" for c in "abcdefgh"],
)


@dataclass(frozen=True)
class ParameterSet:
    """One row of the grid."""

    parameter_set_id: int
    parameter_set_name: str
    start_date: dt.date
    end_date: dt.date | None
    annual_growth_pct: float
    quarterly_growth_pct: float
    annual_years: int
    quarter_count: int
    volume_ratio_threshold: float
    volume_surge_min_days: int
    daily_ma_tolerance_pct: float
    weekly_ma_tolerance_pct: float

    @property
    def technical(self) -> tuple:
        return (
            self.start_date,
            self.end_date,
            self.volume_ratio_threshold,
            self.volume_surge_min_days,
            self.daily_ma_tolerance_pct,
        )

    @property
    def annual(self) -> tuple:
        return (self.annual_years, self.annual_growth_pct)

    @property
    def quarterly(self) -> tuple:
        return (self.quarter_count, self.quarterly_growth_pct)


@dataclass(frozen=True)
class GridAxes:
    """Value lists whose product is the grid; the defaults give 192 sets."""

    annual_growth_pct: Sequence[float] = (2, 3)
    quarterly_growth_pct: Sequence[float] = (2, 3)
    annual_years: Sequence[int] = (2, 3)
    quarter_count: Sequence[int] = (2, 3, 4)
    volume_ratio_threshold: Sequence[float] = (2, 3, 4, 5)
    volume_surge_min_days: Sequence[int] = (2, 3)
    daily_ma_tolerance_pct: float = field(default=1)
    weekly_ma_tolerance_pct: float = field(default=2)

    def sets(self, start_date: dt.date, end_date: dt.date | None = None) -> list[ParameterSet]:
        """All sets in axis order, numbered from 1."""
        axes = (
            self.annual_growth_pct,
            self.quarterly_growth_pct,
            self.annual_years,
            self.quarter_count,
            self.volume_ratio_threshold,
            self.volume_surge_min_days,
        )
        out = []
        for number, (ag, qg, ay, qc, vr, vd) in enumerate(product(*axes), 1):
            name = f"ag{ag}_qg{qg}_ay{ay}_qc{qc}_vr{vr}_vd{vd}"
            bands = (float(self.daily_ma_tolerance_pct), float(self.weekly_ma_tolerance_pct))
            numbers = (float(ag), float(qg), int(ay), int(qc), float(vr), int(vd), *bands)
            out.append(ParameterSet(number, name, start_date, end_date, *numbers))
        return out


def parameter_frame(spark: SparkSession, grid: Sequence[ParameterSet]) -> DataFrame:
    """The grid as rows."""
    names = [f.name for f in fields(ParameterSet)]
    schema = (
        "parameter_set_id long, parameter_set_name string, start_date date, end_date date, "
        "annual_growth_pct double, quarterly_growth_pct double, annual_years int, "
        "quarter_count int, volume_ratio_threshold double, volume_surge_min_days int, "
        "daily_ma_tolerance_pct double, weekly_ma_tolerance_pct double"
    )
    return spark.createDataFrame([tuple(getattr(p, n) for n in names) for p in grid], schema)


# --- features -------------------------------------------------------------------------


def daily_features(
    raw: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    warmup_days: int = 420,
    tiebreak: Sequence[str] = TIEBREAK,
    laid_out: bool = False,
) -> DataFrame:
    """Daily features with next-row confirmation columns, warm-up rows dropped at the end.

    ``laid_out``: ``raw`` is stored by security, and no step needs an exchange.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    rows = raw.filter(
        F.col("date").between(F.date_sub(first, warmup_days), last)
        & F.col("gvkey").isNotNull()
        & F.col("iid").isNotNull()
    )
    rows = clean_daily(rows, tiebreak, keep_raw=True, laid_out=laid_out).select(
        F.col("date").alias("snapshot_date"),
        *[F.col(c).cast("string").alias(c) for c in SECURITY],
        "ticker",
        "company_name",
        F.col("close_price_raw").alias("close_price"),
        "adjusted_close_price",
        "volume",
    )
    rows = add_next(
        add_daily_indicators(rows, "snapshot_date"),
        {
            "future_daily_confirmation_date": "snapshot_date",
            "future_daily_close_price": "close_price",
            "future_daily_adjusted_close_price": "adjusted_close_price",
            "future_daily_ma20": "ma20",
            "future_daily_ma50": "ma50",
            "future_daily_ma100": "ma100",
        },
        "snapshot_date",
    )
    return rows.filter(F.col("snapshot_date") >= first)


def weekly_features(daily: DataFrame, calendar: DataFrame | None = None, laid_out: bool = False) -> DataFrame:
    """Weekly bars of weeks whose official last session this security traded.

    A bar carries its traded weekdays as a bit mask, so "traded on the official date" is
    decided on the bar itself and needs no semi-join back to the daily rows.
    ``laid_out``: ``daily`` is stored by security, and no step needs an exchange.
    """
    rows = daily.withColumn("week_start_date", week_start("snapshot_date"))
    bars = (
        (rows if laid_out else rows.repartition(*SECURITY))
        .groupBy(*SECURITY, "week_start_date")
        .agg(
            F.max("snapshot_date").alias("week_end_date"),
            value_at_earliest("adjusted_close_price", "snapshot_date").alias("weekly_open_price"),
            F.max("adjusted_close_price").alias("weekly_high_price"),
            F.min("adjusted_close_price").alias("weekly_low_price"),
            value_at_latest("adjusted_close_price", "snapshot_date").alias("weekly_close_price"),
            F.sum("volume").alias("weekly_volume"),
            F.bit_or(_weekday_bit("snapshot_date")).alias("_traded"),
        )
    )
    bars = with_official_week_end(bars, calendar, "inner")
    official = _weekday_bit("official_week_end_date")
    bars = bars.filter(F.col("_traded").bitwiseAND(official) != 0)
    bars = bars.drop("_traded", "official_week_end_date")
    means = {"weekly_ma5": 5, "weekly_ma10": 10, "weekly_ma30": 30}
    bars = add_trailing_means(
        bars, "weekly_close_price", means, "week_end_date", with_current=False
    )
    return add_next(
        bars,
        {
            "future_weekly_confirmation_date": "week_end_date",
            "future_weekly_close_price": "weekly_close_price",
            "future_weekly_ma5": "weekly_ma5",
            "future_weekly_ma10": "weekly_ma10",
            "future_weekly_ma30": "weekly_ma30",
        },
        "week_end_date",
    )


def _weekday_bit(date: str) -> Column:
    """One bit per weekday, Monday lowest."""
    return F.expr(f"shiftleft(1, weekday({date}))")


# --- point-in-time fundamentals -------------------------------------------------------


def point_in_time_passes(
    history: DataFrame,
    revenue: str,
    income: str,
    tests: Sequence[tuple[int, float]],
    ids: str,
    order: Sequence[str] = ("datadate",),
) -> DataFrame:
    """Per company and validity interval: which (periods, growth percent) tests pass.

    A row is in force from its ``datadate`` until the next valid row.  A test passes when
    the last N valid rows all reach its threshold.  Computed once on the small fundamentals
    table (one row per company and fiscal period), for all tests in one window pass.
    """
    by_company = Window.partitionBy("gvkey").orderBy(*order)
    both = F.least(revenue, income)
    passes = []
    for number, (periods, percent) in enumerate(tests):
        frame = by_company.rowsBetween(-(periods - 1), 0)
        enough = F.count(F.lit(1)).over(frame) == periods
        passed = F.min(both).over(frame) >= float(percent) / 100.0
        passes.append(F.when(enough & passed, F.lit(number)))
    valid = history.filter(F.col(revenue).isNotNull() & F.col(income).isNotNull())
    return valid.select(
        F.col("gvkey").cast("string").alias("gvkey"),
        F.col("datadate").alias("valid_from"),
        F.lead("datadate").over(by_company).alias("valid_to"),
        F.array_compact(F.array(*passes)).alias(ids),
    )


def in_force(signals: DataFrame, intervals: DataFrame, date: str) -> DataFrame:
    """Attach the interval in force on ``date``: an equi join with at most one match."""
    right = intervals.withColumnRenamed("gvkey", "_company")
    match = (
        (F.col("gvkey") == F.col("_company"))
        & (F.col("valid_from") <= F.col(date))
        & (F.col("valid_to").isNull() | (F.col(date) < F.col("valid_to")))
    )
    return signals.join(right, match).drop("_company", "valid_from", "valid_to")


# --- signals --------------------------------------------------------------------------


def select_signals(
    daily: DataFrame,
    weekly: DataFrame,
    annual: DataFrame,
    quarterly: DataFrame,
    grid: Sequence[ParameterSet],
    annual_order: Sequence[str] = ("datadate",),
    quarterly_order: Sequence[str] = ("datadate",),
) -> DataFrame:
    """First A_F and A_H selection per parameter set and security, for the whole grid at once.

    A set is a point in four axes (technical, annual, quarterly, weekly tolerance), and each
    axis is ordered: a stricter value implies the weaker ones.  So a candidate stands for
    its *strictest* passing points only, and the first date of every other point is a minimum
    over the points that imply it.  Candidates are reduced to the earliest one per strictest
    point before anything is multiplied; then the minimum runs down one axis after the other.

    The daily data is scanned and windowed once, and all reductions use the layout by security
    that the as-of match leaves, so none of them shuffles.
    """
    spark = daily.sparkSession
    technical = Axis((p.technical for p in grid), _technical_implies)
    annual_tests = Axis((p.annual for p in grid), _periods_imply)
    quarterly_tests = Axis((p.quarterly for p in grid), _periods_imply)
    tolerances = Axis((p.weekly_ma_tolerance_pct for p in grid), lambda a, b: a <= b)

    signals = technical_candidates(daily, technical.values)
    annual_pass = point_in_time_passes(
        annual,
        "annual_revenue_growth",
        "annual_operating_income_growth",
        annual_tests.values,
        "annual_ids",
        annual_order,
    )
    quarterly_pass = point_in_time_passes(
        quarterly,
        "quarterly_revenue_growth",
        "quarterly_operating_income_growth",
        quarterly_tests.values,
        "quarterly_ids",
        quarterly_order,
    )
    annual_pass = annual_pass.filter(F.size("annual_ids") > 0)
    quarterly_pass = quarterly_pass.filter(F.size("quarterly_ids") > 0)
    signals = signals.withColumn("technical_ids", technical.strictest("technical_ids"))
    annual_pass = annual_pass.withColumn("annual_ids", annual_tests.strictest("annual_ids"))
    quarterly_pass = quarterly_pass.withColumn("quarterly_ids", quarterly_tests.strictest("quarterly_ids"))
    signals = in_force(signals, annual_pass, "snapshot_date")
    signals = in_force(signals, quarterly_pass, "snapshot_date")

    passing_weeks = _passing_ids([_weekly_pass(t) for t in tolerances.values])
    weeks = weekly.select(
        *SECURITY,
        "week_end_date",
        F.col("future_weekly_confirmation_date").alias("h_date"),
        F.col("future_weekly_close_price").alias("h_price"),
        passing_weeks.alias("weekly_ids"),
    ).withColumn("weekly_ids", tolerances.strictest("weekly_ids"))
    matched = asof_join(
        signals,
        weeks,
        by=SECURITY,
        left_time="future_daily_confirmation_date",
        right_time="week_end_date",
        direction="forward",
        how="left",
    )
    # Which weekly axis values select under each screen: all of them under A_F.
    a_f, a_h = "A_F", "A_H"
    screens = F.array(
        F.struct(F.lit(a_f).alias("screen_type"), _ints(tolerances.top).alias("weekly_ids")),
        F.struct(
            F.lit(a_h).alias("screen_type"),
            F.coalesce("weekly_ids", F.array().cast("array<int>")).alias("weekly_ids"),
        ),
    )
    points = (
        matched.withColumn("_screen", F.explode(screens))
        .withColumn("screen_type", F.col("_screen.screen_type"))
        .withColumn("weekly_id", F.explode("_screen.weekly_ids"))
        .withColumn("technical_id", F.explode("technical_ids"))
        .withColumn("annual_id", F.explode("annual_ids"))
        .withColumn("quarterly_id", F.explode("quarterly_ids"))
        .drop("_screen", "weekly_ids", "technical_ids", "annual_ids", "quarterly_ids")
    )
    axes = {
        "technical_id": technical,
        "annual_id": annual_tests,
        "quarterly_id": quarterly_tests,
        "weekly_id": tolerances,
    }
    first = lattice_first(points, axes, [*SECURITY, "screen_type"], "snapshot_date")
    ids = spark.createDataFrame(
        [
            (
                p.parameter_set_id,
                technical.ids[p.technical],
                annual_tests.ids[p.annual],
                quarterly_tests.ids[p.quarterly],
                tolerances.ids[p.weekly_ma_tolerance_pct],
            )
            for p in grid
        ],
        "parameter_set_id long, technical_id int, annual_id int, quarterly_id int, weekly_id int",
    )
    ids = F.broadcast(ids)  # the grid is a list on the driver
    confirmed = F.col("screen_type") == a_h
    f_price = F.coalesce("future_daily_adjusted_close_price", "future_daily_close_price")
    passed, unknown = F.lit(True), F.lit(None).cast("boolean")
    return first.join(ids, list(axes)).select(
        "parameter_set_id",
        "screen_type",
        F.col("snapshot_date").alias("signal_date"),
        F.col("future_daily_confirmation_date").alias("f_confirmation_date"),
        F.when(confirmed, F.col("week_end_date")).alias("g_confirmation_date"),
        F.when(confirmed, F.col("h_date")).alias("h_confirmation_date"),
        F.when(confirmed, F.col("h_date"))
        .otherwise(F.col("future_daily_confirmation_date"))
        .alias("selected_date"),
        *SECURITY,
        "ticker",
        "company_name",
        F.when(confirmed, F.col("h_price")).otherwise(f_price).alias("selected_price"),
        F.when(confirmed, F.col("h_price"))
        .otherwise(F.col("future_daily_adjusted_close_price"))
        .alias("selected_adjusted_price"),
        *[passed.alias(f"flag_{c}") for c in "abcdef"],
        *[F.when(confirmed, passed).otherwise(unknown).alias(f"flag_{c}") for c in "gh"],
    )


class Axis:
    """Distinct values of a grid axis, numbered in order of appearance, with their order.

    ``implies(a, b)`` says whether every row that passes value a passes b.
    """

    def __init__(self, values: Iterable, implies: Callable[[Any, Any], bool]):
        self.values = list(dict.fromkeys(values))
        self.ids = {v: i for i, v in enumerate(self.values)}
        numbered = list(enumerate(self.values))
        #: Per value the numbers that it implies, itself included, and those that imply it.
        self.implied = [[j for j, b in numbered if implies(a, b)] for a in self.values]
        self.stricter = [[j for j, a in numbered if implies(a, b) and not implies(b, a)] for b in self.values]
        #: Values that no other one implies.
        self.top = [i for i, s in enumerate(self.stricter) if not s]

    def strictest(self, passed: str) -> Column:
        """Of the numbers of passed values, those that no other passed value implies."""
        if len(self.values) == 1:
            return F.col(passed)
        stricter = F.array(*[_ints(s) for s in self.stricter])
        return F.filter(passed, lambda i: ~F.arrays_overlap(F.col(passed), F.element_at(stricter, i + 1)))


def _ints(numbers: Sequence[int]) -> Column:
    return F.array(*[F.lit(i) for i in numbers]).cast("array<int>")


def _technical_implies(a: tuple, b: tuple) -> bool:
    """Starts later and ends earlier, and asks for a larger ratio, more days, a narrower band."""
    (start, end, ratio, days, tolerance), (other_start, other_end, other_ratio, other_days, other_tolerance) = a, b
    ends = other_end is None or (end is not None and end <= other_end)
    return start >= other_start and ends and ratio >= other_ratio and days >= other_days and tolerance <= other_tolerance


def _periods_imply(a: tuple, b: tuple) -> bool:
    """As much growth in as many of the last periods."""
    return a[0] >= b[0] and a[1] >= b[1]


def lattice_first(points: DataFrame, axes: dict[str, Axis], keys: Sequence[str], date: str) -> DataFrame:
    """The earliest row per key and lattice point, over all points that imply it.

    ``points`` has one column per axis with the number of a value.  Rows are reduced to one
    per key and point that occurs; then each axis in turn hands its rows to the values that
    they imply and keeps the earliest again, so no key ever has more rows than lattice points
    times the values of one axis.  Dates are unique per key; rows keep all their columns.
    """
    order = Window.partitionBy(*keys, *axes).orderBy(date)

    def earliest(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_position", F.row_number().over(order)).filter("_position = 1").drop("_position")

    rows = earliest(points)
    for name, axis in axes.items():
        if len(axis.values) > 1:
            implied = F.array(*[_ints(i) for i in axis.implied])
            rows = earliest(rows.withColumn(name, F.explode(F.element_at(implied, F.col(name) + 1))))
    return rows


def technical_candidates(daily: DataFrame, tests: Sequence[tuple]) -> DataFrame:
    """Rows that pass C, D, E and F for at least one technical axis value, with those ids.

    Only rows at or above the smallest ratio threshold can pass C or count towards D, so
    all others are dropped before the range window.
    """
    ratios = sorted({t[2] for t in tests})
    tolerances = sorted({t[4] for t in tests})
    surges = daily.filter(F.col("volume_ratio") >= ratios[0]).withColumns(
        {f"_surges_{i}": surge_days("volume_ratio", r, "snapshot_date") for i, r in enumerate(ratios)}
    )
    near = {t: f"_near_{i}" for i, t in enumerate(tolerances)}
    surges = surges.withColumns({name: _daily_pass(t) for t, name in near.items()})
    conditions = []
    for start, end, ratio, days, tolerance in tests:
        condition = (
            (F.col("snapshot_date") >= F.lit(start).cast("date"))
            & (F.col("volume_ratio") >= ratio)
            & (F.col(f"_surges_{ratios.index(ratio)}") >= days)
            & F.col(near[tolerance])
        )
        if end is not None:
            condition = condition & (F.col("snapshot_date") <= F.lit(end).cast("date"))
        conditions.append(condition)
    rows = surges.filter(
        F.coalesce("future_daily_adjusted_close_price", "future_daily_close_price").isNotNull()
    ).withColumn("technical_ids", _passing_ids(conditions))
    return rows.filter(F.size("technical_ids") > 0).select(
        "snapshot_date",
        *SECURITY,
        "ticker",
        "company_name",
        "future_daily_confirmation_date",
        "future_daily_close_price",
        "future_daily_adjusted_close_price",
        "technical_ids",
    )


def _daily_pass(tolerance: float) -> Column:
    band = tolerance_band(tolerance)
    now = strict_cluster_flag("ma20", "ma50", "ma100", *band)
    future = ("future_daily_ma20", "future_daily_ma50", "future_daily_ma100")
    return now & strict_cluster_flag(*future, *band, required=["future_daily_confirmation_date"])


def _weekly_pass(tolerance: float) -> Column:
    band = tolerance_band(tolerance)
    now = strict_cluster_flag("weekly_ma5", "weekly_ma10", "weekly_ma30", *band)
    future = ("future_weekly_ma5", "future_weekly_ma10", "future_weekly_ma30")
    required = ["future_weekly_confirmation_date", "future_weekly_close_price"]
    return now & strict_cluster_flag(*future, *band, required=required)


def _passing_ids(conditions: Sequence[Column]) -> Column:
    """Positions of the conditions that hold, as a short array."""
    return F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(conditions)]))


# --- outcomes -------------------------------------------------------------------------


def price_paths(entries: DataFrame, daily: DataFrame, buckets: int | None = None) -> DataFrame:
    """Forward price path of each (security, entry date).

    Outcomes depend on the entry only, so they are computed once per distinct entry and not
    once per parameter set.  Entries are stacked with the prices of their securities as
    probe rows (one at the entry date, one per horizon) and answered by a single scan in
    descending time, in which every "from here to the end" frame is a running one.  ``buckets``: ``daily`` is
    stored by security in so many buckets, to which the entries are dealt instead of shuffling it too.
    """
    probes = {"entry": 0, **HORIZONS}
    entries = entries.select(*SECURITY, "selected_date").distinct()
    if buckets is not None:
        entries = entries.repartition(buckets, *SECURITY)
    price_type = "struct<price_date: date, price: double>"
    asked = entries.select(
        *SECURITY,
        "selected_date",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(n).alias("probe"), F.add_months("selected_date", k).alias("t"))
                    for n, k in probes.items()
                ]
            )
        ).alias("_p"),
    ).select(
        *SECURITY,
        F.col("_p.t").alias("_time"),
        F.lit(1).alias("_side"),
        F.col("_p.probe").alias("_probe"),
        "selected_date",
        F.lit(None).cast("date").alias("price_date"),
        F.lit(None).cast("double").alias("price"),
        F.lit(None).cast("double").alias("adjusted"),
    )
    prices = daily.join(entries.select(*SECURITY).distinct(), [*SECURITY], "left_semi").select(
        *SECURITY,
        F.col("snapshot_date").alias("_time"),
        F.lit(0).alias("_side"),
        F.lit(None).cast("string").alias("_probe"),
        F.lit(None).cast("date").alias("selected_date"),
        F.col("snapshot_date").alias("price_date"),
        F.coalesce("adjusted_close_price", "close_price").cast("double").alias("price"),
        F.col("adjusted_close_price").cast("double").alias("adjusted"),
    )
    later = (
        Window.partitionBy(*SECURITY)
        .orderBy(F.desc("_time"), "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    priced = F.when(F.col("price").isNotNull(), F.struct("price_date", "price").cast(price_type))
    seen = asked.unionByName(prices).select(
        *SECURITY,
        "selected_date",
        "_probe",
        F.max("price_date").over(later).alias("latest_price_date"),
        F.first("price", ignorenulls=True).over(later).alias("latest_price"),
        F.first("adjusted", ignorenulls=True).over(later).alias("latest_adjusted_price"),
        F.max("price").over(later).alias("high_price"),
        F.min("price").over(later).alias("low_price"),
        F.min_by("price_date", F.when(F.col("price").isNotNull(), F.struct(-F.col("price"), "price_date")))
        .over(later)
        .alias("high_price_date"),
        F.min_by("price_date", F.when(F.col("price").isNotNull(), F.struct("price", "price_date")))
        .over(later)
        .alias("low_price_date"),
        F.count("price_date").over(later).cast("int").alias("trading_days_after_selection"),
        F.last("price_date", ignorenulls=True).over(later).alias("next_date"),
        F.last(priced, ignorenulls=True).over(later).alias("next_price"),
    )
    at_entry = F.col("_probe") == "entry"
    path = (
        "latest_price_date",
        "latest_price",
        "latest_adjusted_price",
        "high_price",
        "high_price_date",
        "low_price",
        "low_price_date",
        "trading_days_after_selection",
    )
    horizons = []
    for name in HORIZONS:
        at = F.col("_probe") == name
        horizons.append(F.max(F.when(at, F.col("next_date"))).alias(f"return_{name}_date"))
        horizons.append(F.max(F.when(at, F.col("next_price.price"))).alias(f"price_{name}"))
    return (
        seen.filter("_probe IS NOT NULL")
        .groupBy(*SECURITY, "selected_date")
        .agg(*[F.max(F.when(at_entry, F.col(c))).alias(c) for c in path], *horizons)
        .filter("trading_days_after_selection > 0")
    )


def price_outcomes(
    selections: DataFrame, daily: DataFrame, source_result_path: str | None = None, buckets: int | None = None
) -> DataFrame:
    """Selections with their forward path, total and fixed-horizon percent returns.

    ``buckets`` as in ``price_paths``.
    """
    rows = selections.join(price_paths(selections, daily, buckets), [*SECURITY, "selected_date"])
    returns = {
        "return_pct": percent_return("latest_price", "selected_price"),
        "max_return_pct": percent_return("high_price", "selected_price"),
        "max_drawdown_pct": percent_return("low_price", "selected_price"),
    }
    returns |= {f"return_{h}_pct": percent_return(f"price_{h}", "selected_price") for h in HORIZONS}
    return rows.withColumns(returns).withColumn(
        "source_result_path", F.lit(source_result_path).cast("string")
    )


def run_event(
    spark: SparkSession,
    run_id: str,
    run_name: str,
    start: dt.date,
    end: dt.date,
    set_count: int,
    status: str,
    outcome_count: int | None = None,
    error: str | None = None,
) -> DataFrame:
    """One event of a run: ``running``, then ``succeeded`` or ``failed`` with its error."""
    now = dt.datetime.now(dt.timezone.utc)
    finished = None if status == "running" else now
    row = (run_id, run_name, start, end, set_count, status, outcome_count, error, now, finished)
    return spark.createDataFrame(
        [row],
        "run_id string, run_name string, start_date date, end_date date, parameter_set_count int, status string, "
        "outcome_count long, error string, logged_at timestamp, finished_at timestamp",
    )


def run_log(events: DataFrame) -> DataFrame:
    """The state of each run: its final event, or ``running`` while it has none."""
    final = F.col("finished_at").isNotNull()
    return keep_first(events, ["run_id"], [F.desc(final.cast("int")), F.desc("logged_at")])


def recorded_run(
    spark: SparkSession,
    log_path: str,
    run_name: str,
    start: dt.date,
    end: dt.date,
    set_count: int,
    work: Callable[[], int],
) -> str:
    """Runs ``work``, which returns the number of stored outcomes, and logs how it went.

    A failure is logged with its error and raised again.  Returns the run's id.
    """
    run_id = uuid.uuid4().hex

    def log(status: str, count: int | None = None, error: str | None = None) -> None:
        event = run_event(spark, run_id, run_name, start, end, set_count, status, count, error)
        append_event(spark, log_path, event)

    log("running")
    try:
        count = work()
    except Exception as error:
        log("failed", error=f"{type(error).__name__}: {error}")
        raise
    log("succeeded", count)
    return run_id
