"""Data-quality checks.

Each check table has one row per check with its number of failures, from one aggregation
pass, so a caller can assert on it before publishing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import SECURITY
from ..functions.flags import any_of
from .calendar import with_official_week_end
from .backtest import HORIZONS, PARAMETER_KEY


class QualityError(ValueError):
    """A check failed."""


def check_table(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Failing rows per check, counted in one pass."""
    cells = [
        F.struct(F.lit(name).alias("check_name"), F.count_if(bad).alias("failures"))
        for name, bad in checks.items()
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def duplicate_check(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number of keys that occur more than once."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return check_table(counts, {name: F.col("row_count") > 1})


def require(checks: DataFrame) -> None:
    """Raise when any check has failures (the check table has one row per check)."""
    failed = checks.filter("failures > 0").collect()
    if failed:
        raise QualityError(", ".join(f"{r['check_name']}={r['failures']}" for r in failed))


def require_columns(df: DataFrame, columns: Sequence[str], table: str) -> None:
    """Schema check; reads no data."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise QualityError(f"{table} misses columns: {missing}")


def require_rows(df: DataFrame, table: str) -> None:
    if df.isEmpty():
        raise QualityError(f"{table} is empty")


def load_checks(tables: dict[str, DataFrame], required: dict[str, Sequence[str]]) -> DataFrame:
    """One check row per table and requirement: columns that it lacks, and whether it is empty.

    Missing columns come from the schema; one row is enough to know that a table has some.
    """
    checks = None
    for name, df in tables.items():
        lacking = sum(c not in df.columns for c in required[name])
        rows = df.limit(1).agg((1 - F.count(F.lit(1))).alias("empty"))
        cells = F.array(
            F.struct(F.lit(f"{name}_missing_columns").alias("check_name"), F.lit(lacking).cast("long").alias("failures")),
            F.struct(F.lit(f"{name}_empty").alias("check_name"), F.col("empty").alias("failures")),
        )
        found = rows.select(F.inline(cells))
        checks = found if checks is None else checks.unionByName(found)
    return checks


# --- profiles -------------------------------------------------------------------------


def profile(
    df: DataFrame, distinct: Sequence[str] = (), ranges: Sequence[str] = (), nulls: Sequence[str] = ()
) -> DataFrame:
    """Row count, distinct counts, ranges and NULL counts in one row.

    Each distinct count is an aggregate of its own over one column: several in one pass would
    copy every row once per column.
    """
    rows = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.min(c).alias(f"min_{c}") for c in ranges],
        *[F.max(c).alias(f"max_{c}") for c in ranges],
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in nulls],
    )
    for c in distinct:
        rows = rows.join(F.broadcast(df.agg(F.count_distinct(c).alias(f"distinct_{c}"))))  # one row each
    return rows


def exchange_histogram(daily: DataFrame) -> DataFrame:
    """Rows and distinct companies per exchange code."""
    return (
        daily.groupBy("exchange_code")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("gvkey").alias("company_count"),
        )
        .orderBy(F.desc("row_count"))
    )


def weekly_coverage(weekly: DataFrame, minimum: float = 0.9) -> DataFrame:
    """Distinct tickers per week and whether a week falls short of the best one."""
    counts = weekly.groupBy("week_start_date").agg(F.count_distinct("ticker").alias("tickers"))
    best = counts.select(F.max("tickers")).scalar()
    expected = F.floor(best * F.lit(minimum))
    return counts.withColumn("below_expected", F.col("tickers") < expected)


def week_end_counts(weekly: DataFrame) -> DataFrame:
    """Distinct week ends per week start; more than one is an error."""
    return weekly.groupBy("week_start_date").agg(
        F.count_distinct("week_end_date").alias("week_end_count")
    )


def snapshot_coverage(snapshot: DataFrame, date: str, measure: str | None = None) -> DataFrame:
    """Date range and rows of a snapshot, with known values of one measure."""
    known = [] if measure is None else [F.count(measure).alias(f"{measure}_rows")]
    return snapshot.agg(
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.count(F.lit(1)).alias("row_count"),
        *known,
    )


def lookback_coverage(snapshot: DataFrame, date: str = "snapshot_date", months: int = 3) -> DataFrame:
    """Distinct dates and days covered by the trailing lookback."""
    latest = snapshot.select(F.max(date)).scalar()
    return snapshot.filter(F.col(date) >= F.add_months(latest, -months)).agg(
        F.count_distinct(date).alias("distinct_dates"),
        F.date_diff(F.max(date), F.min(date)).alias("covered_days"),
    )


def master_coverage(snapshot: DataFrame, master: DataFrame, date: str = "snapshot_date") -> DataFrame:
    """Rows on the latest date and how many of them find their security."""
    latest = snapshot.select(F.max(date)).scalar()
    keys = master.select(*SECURITY, F.lit(1).alias("known"))
    return (
        snapshot.filter(F.col(date) == latest)
        .select(*SECURITY)
        .join(keys, [*SECURITY], "left")
        .agg(F.count(F.lit(1)).alias("latest_rows"), F.count("known").alias("joined_master_rows"))
    )


def active_master_check(snapshot: DataFrame, master: DataFrame, date: str = "snapshot_date") -> DataFrame:
    """Active securities must cover the keys of the latest date."""
    latest = snapshot.select(F.max(date)).scalar()
    keys = snapshot.filter(F.col(date) == latest).select(*SECURITY).distinct()
    active = master.filter("is_active").select(F.count(F.lit(1))).scalar()
    return keys.agg(F.count(F.lit(1)).alias("latest_keys")).withColumn("active_master_rows", active)


def load_count_check(after: DataFrame, loaded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows after a load and the distinct keys that were loaded."""
    rows = after.select(F.count(F.lit(1))).scalar()
    distinct = loaded.select(*keys).distinct()
    return distinct.agg(F.count(F.lit(1)).alias("loaded_keys")).withColumn("rows_after_load", rows)


# --- rules ----------------------------------------------------------------------------


def raw_filter_checks(
    raw: DataFrame, exchange: int = 14, status: str = "A", issue_type: str = "0"
) -> DataFrame:
    """Rows that break the ingest filters."""

    def differs(column: str, value) -> Column:
        return ~F.col(column).eqNullSafe(F.lit(value))

    return check_table(
        raw,
        {
            "wrong_exchange": differs("exchange_code", exchange),
            "wrong_status": differs("security_status", status),
            "wrong_issue_type": differs("issue_type_code", issue_type),
            "missing_close": F.col("close_price_raw").isNull(),
            "missing_volume": F.col("volume").isNull(),
        },
    )


def daily_future_checks(snapshot: DataFrame) -> DataFrame:
    return check_table(
        snapshot,
        {
            "bad_daily_future_date_rows": F.col("daily_f_confirmed_using_date")
            <= F.col("snapshot_date"),
            "bad_daily_null_rows": _values_without_date(
                "daily_f_confirmed_using_date", [f"future_daily_ma{k}" for k in (20, 50, 100)]
            ),
        },
    )


def weekly_future_checks(snapshot: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Official week ends, future dates and values, and confirming weeks that are not there."""
    missing = missing_future_links(snapshot).agg(F.count(F.lit(1)).alias("failures"))
    missing = missing.select(F.lit("bad_missing_future_week_rows").alias("check_name"), "failures")
    checks = check_table(
        with_official_week_end(snapshot, calendar),
        {
            "bad_official_week_end_rows": ~F.col("week_end_date").eqNullSafe(
                F.col("official_week_end_date")
            ),
            "bad_weekly_future_date_rows": F.col("weekly_h_confirmed_using_date")
            <= F.col("week_end_date"),
            "bad_weekly_null_rows": _values_without_date(
                "weekly_h_confirmed_using_date", [f"future_weekly_ma{k}" for k in (5, 10, 30)]
            ),
        },
    )
    return checks.unionByName(missing)


def missing_future_links(
    snapshot: DataFrame, date: str = "week_end_date", link: str = "weekly_h_confirmed_using_date"
) -> DataFrame:
    """Rows whose confirming date has no row of the same security.

    Each row stands once at its own date and once at the confirming one, so the table is passed once
    and, if it is stored by security, nothing is shuffled.  Unknown keys match nothing.
    """
    known = F.lit(True)
    for c in (*SECURITY, date):
        known = known & F.col(c).isNotNull()
    sides = F.array(
        F.struct(F.col(date).alias("at"), known.alias("there")),
        F.struct(F.col(link).alias("at"), F.lit(None).cast("boolean").alias("there")),
    )
    same = Window.partitionBy(*SECURITY, "_at")
    return (
        snapshot.withColumn("_side", F.explode(sides))
        .withColumns({"_at": F.col("_side.at"), "_there": F.col("_side.there")})
        .filter("_at IS NOT NULL")
        .withColumn("_found", F.coalesce(F.max("_there").over(same), F.lit(False)))
        .filter("_there IS NULL AND NOT _found")
        .select(*snapshot.columns)
    )


def latest_completed_week(weekly: DataFrame, daily: DataFrame) -> DataFrame:
    """Latest week end on which its security also has a daily row."""
    days = daily.select(*SECURITY, F.col("snapshot_date").alias("week_end_date"))
    return weekly.join(days, [*SECURITY, "week_end_date"], "left_semi").agg(
        F.max("week_end_date").alias("latest_completed_week_date")
    )


def outcome_checks(outcomes: DataFrame) -> DataFrame:
    """Integrity of outcome prices, dates and horizons."""
    core = (
        "selected_price",
        "latest_price",
        "high_price",
        "low_price",
        "high_price_date",
        "low_price_date",
    )
    dates = ("latest_price_date", "high_price_date", "low_price_date")
    inconsistent, misdated = [], []
    for name, months in HORIZONS.items():
        unknown_date = F.col(f"return_{name}_date").isNull()
        inconsistent.append(unknown_date != F.col(f"price_{name}").isNull())
        inconsistent.append(unknown_date != F.col(f"return_{name}_pct").isNull())
        misdated.append(F.col(f"return_{name}_date") < F.add_months("selected_date", months))
    names = list(HORIZONS)
    misdated += [
        F.col(f"return_{b}_date") < F.col(f"return_{a}_date") for a, b in zip(names, names[1:])
    ]
    return check_table(
        outcomes,
        {
            "missing_core_price_outcome": any_of([F.col(c).isNull() for c in core]),
            "bad_date_rows": any_of([F.col(c) < F.col("selected_date") for c in dates]),
            "bad_price_rows": F.col("high_price") < F.col("low_price"),
            "inconsistent_fixed_horizon_rows": any_of(inconsistent),
            "bad_fixed_horizon_date_rows": any_of(misdated),
        },
    )


def confirmation_timing_checks(outcomes: DataFrame) -> DataFrame:
    """Order of signal, F, G, H and entry dates per screen."""
    signal, f = F.col("signal_date"), F.col("f_confirmation_date")
    g, h = F.col("g_confirmation_date"), F.col("h_confirmation_date")
    entry, screen = F.col("selected_date"), F.col("screen_type")
    return check_table(
        outcomes,
        {
            "bad_signal_order": signal.isNull() | f.isNull() | (f <= signal) | (entry < f),
            "bad_a_f_timing": (screen == "A_F")
            & ((entry != f) | g.isNotNull() | h.isNotNull()),
            "bad_a_h_timing": (screen == "A_H")
            & (g.isNull() | h.isNull() | (g < f) | (h <= g) | (entry != h)),
        },
    )


def grid_checks(params: DataFrame, expected: int) -> DataFrame:
    """Size of the grid and uniqueness of its parameter key."""
    size = params.agg((F.count(F.lit(1)) - expected).alias("off"))
    missing = check_table(size, {"unexpected_grid_size": F.col("off") != 0})
    return missing.unionByName(duplicate_check(params, PARAMETER_KEY, "duplicate_parameter_keys"))


def export_checks(perf: DataFrame, expected_sets: int) -> DataFrame:
    """Both screens complete, and some 6-month outcome."""
    present = perf.agg(
        F.count_if(F.col("screen_type") == "A_F").alias("a_f"),
        F.count_if(F.col("screen_type") == "A_H").alias("a_h"),
        F.count_if(F.col("sample_size_6m") > 0).alias("with_6m"),
    )
    return check_table(
        present,
        {
            "incomplete_a_f": F.col("a_f") != expected_sets,
            "incomplete_a_h": F.col("a_h") != expected_sets,
            "no_completed_6m": F.col("with_6m") == 0,
        },
    )


def screen_summary(outcomes: DataFrame) -> DataFrame:
    """Rows, sets, securities and date ranges per screen."""
    return outcomes.groupBy("screen_type").agg(
        F.count(F.lit(1)).alias("outcome_rows"),
        F.count_distinct("parameter_set_id").alias("parameter_sets_with_results"),
        F.count_distinct(*SECURITY).alias("unique_securities"),
        F.min("signal_date").alias("earliest_signal_date"),
        F.max("signal_date").alias("latest_signal_date"),
        F.min("selected_date").alias("earliest_selected_date"),
        F.max("selected_date").alias("latest_selected_date"),
    )


def completed_horizons(outcomes: DataFrame) -> DataFrame:
    """Selections and completed horizons per screen."""
    return outcomes.groupBy("screen_type").agg(
        F.count(F.lit(1)).alias("selections"),
        *[F.count(f"return_{h}_pct").alias(f"completed_{h}") for h in HORIZONS],
    )


def _values_without_date(date: str, values: Sequence[str]) -> Column:
    return F.col(date).isNull() & any_of([F.col(v).isNotNull() for v in values])
