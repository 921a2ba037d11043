"""Queries of the backtest and its reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import asof, backtest, growth, performance, quality
from .layers import END, GRID, QUARTERLY_ORDER, START, _buckets, build_bt_daily, layer, rows_of
from .registry import query

# --- features -------------------------------------------------------------------------

BT_DAILY_COLUMNS = (
    "snapshot_date gvkey iid ticker company_name close_price adjusted_close_price volume ma20:float ma50:float ma100:float "
    "volume_ma30 volume_ratio future_daily_confirmation_date future_daily_close_price "
    "future_daily_adjusted_close_price future_daily_ma20:float future_daily_ma50:float future_daily_ma100:float"
)
BT_WEEKLY_COLUMNS = (
    "week_start_date week_end_date gvkey iid weekly_open_price weekly_high_price weekly_low_price weekly_close_price "
    "weekly_volume weekly_ma5:float weekly_ma10:float weekly_ma30:float future_weekly_confirmation_date future_weekly_close_price "
    "future_weekly_ma5:float future_weekly_ma10:float future_weekly_ma30:float"
)

query("c14_backtest_daily_features", BT_DAILY_COLUMNS, "bt_daily")(build_bt_daily)
query(
    "w08_next_row_daily",
    "snapshot_date gvkey iid future_daily_confirmation_date future_daily_close_price future_daily_ma100:float",
    "bt_daily",
)(build_bt_daily)
query("p07_warmup_dropped_after_windows", "snapshot_date gvkey iid ma100:float", "bt_daily")(build_bt_daily)


@query("c15_backtest_weekly_features", BT_WEEKLY_COLUMNS, "bt_weekly")
def weekly_features(spark, sf):
    return backtest.weekly_features(build_bt_daily(spark, sf), laid_out=True)


@query("w09_next_row_weekly", "gvkey iid week_end_date future_weekly_confirmation_date future_weekly_close_price", "bt_weekly")
def _(spark, sf):
    return backtest.weekly_features(layer(spark, sf, "bt_daily"), laid_out=True)


@query("j16_traded_on_official_week_end", "gvkey iid week_start_date week_end_date", "bt_bars")
def _(spark, sf):
    return backtest.weekly_features(rows_of(spark, sf, "bt_daily"), laid_out=True)


# --- signals --------------------------------------------------------------------------


@query(
    "w13_surge_days_3m",
    "snapshot_date gvkey iid surges",
    "SELECT snapshot_date, gvkey, iid, count(*) FILTER (WHERE volume_ratio >= 1.5) OVER (PARTITION BY gvkey, iid "
    "ORDER BY snapshot_date RANGE BETWEEN INTERVAL 3 MONTH PRECEDING AND CURRENT ROW) AS surges FROM bt_daily",
)
def _(spark, sf):
    from ..operators.rolling import surge_days

    surges = surge_days("volume_ratio", 1.5, "snapshot_date")
    return layer(spark, sf, "bt_daily").withColumn("surges", surges)


_PIT = """
SELECT d.gvkey, d.iid, d.snapshot_date, x.valid AS valid_count, x.passed AS pass_count
FROM (SELECT gvkey, iid, snapshot_date FROM bt_daily) d,
LATERAL (SELECT count(*) AS valid, count(*) FILTER (WHERE rev >= -0.1 AND inc >= -0.1) AS passed FROM (
  SELECT {p}_revenue_growth_yoy AS rev, {p}_operating_income_growth_yoy AS inc, row_number() OVER (ORDER BY {o}) AS k
  FROM {p} h WHERE h.gvkey = d.gvkey AND h.datadate <= d.snapshot_date AND has_valid_{p}_growth_pair) WHERE k <= {n}) x
WHERE x.valid = {n} AND x.passed = {n}"""


def _pit(spark, sf, period: str, n: int, order):
    signals = layer(spark, sf, "bt_daily")
    intervals = backtest.point_in_time_passes(
        growth.growth_serving(layer(spark, sf, period), period),
        f"{period}_revenue_growth",
        f"{period}_operating_income_growth",
        [(n, -10)],
        "ids",
        order,
    )
    return backtest.in_force(signals, intervals.filter(F.size("ids") > 0), "snapshot_date")


@query(
    "j09_pit_last_n_annual",
    "gvkey iid snapshot_date",
    _PIT.format(p="annual", o="datadate DESC, fyear DESC", n=2),
)
def _(spark, sf):
    return _pit(spark, sf, "annual", 2, ("datadate", "fyear"))


@query(
    "j10_pit_last_n_quarterly",
    "gvkey iid snapshot_date",
    _PIT.format(p="quarterly", o="datadate DESC, fyearq DESC, fqtr DESC", n=3),
)
def _(spark, sf):
    return _pit(spark, sf, "quarterly", 3, QUARTERLY_ORDER)


@query(
    "j11_asof_forward",
    "gvkey iid snapshot_date f_date:date week_end_date weekly_close_price",
    "SELECT d.gvkey, d.iid, d.snapshot_date, d.future_daily_confirmation_date AS f_date, w.week_end_date, w.weekly_close_price "
    "FROM bt_daily d ASOF JOIN bt_weekly w ON d.gvkey = w.gvkey AND d.iid = w.iid AND d.future_daily_confirmation_date <= w.week_end_date",
)
def asof_forward(spark, sf):
    """First completed week that ends on or after the confirmation date of every daily row."""
    left = layer(spark, sf, "bt_daily").select(
        "gvkey", "iid", "snapshot_date", F.col("future_daily_confirmation_date").alias("f_date")
    )
    right = layer(spark, sf, "bt_weekly").select("gvkey", "iid", "week_end_date", "weekly_close_price")
    return asof.asof_join(left, right, ["gvkey", "iid"], "f_date", "week_end_date")


SELECTION_COLUMNS = (
    "parameter_set_id screen_type signal_date f_confirmation_date g_confirmation_date h_confirmation_date selected_date "
    "gvkey iid ticker company_name selected_price selected_adjusted_price flag_a flag_b flag_c flag_d flag_e flag_f "
    "flag_g flag_h"
)


@query("c17_select_signals", SELECTION_COLUMNS, "selections")
def select_signals(spark, sf):
    """First A_F and A_H selections of all 192 parameter sets."""
    return backtest.select_signals(
        layer(spark, sf, "bt_daily"),
        layer(spark, sf, "bt_weekly"),
        growth.growth_serving(layer(spark, sf, "annual"), "annual"),
        growth.growth_serving(layer(spark, sf, "quarterly"), "quarterly"),
        GRID,
        ("datadate", "fyear"),
        QUARTERLY_ORDER,
    )


query(
    "d06_first_signal_per_security",
    "parameter_set_id screen_type gvkey iid signal_date",
    "selections",
)(select_signals)
query(
    "set_union_of_screens",
    "screen_type selection_count",
    "SELECT screen_type, count(*) AS selection_count FROM selections GROUP BY screen_type",
)(lambda spark, sf: select_signals(spark, sf).groupBy("screen_type").agg(F.count("*").alias("selection_count")))


@query(
    "p19_technical_candidates",
    "gvkey iid snapshot_date set_count",
    "SELECT gvkey, iid, snapshot_date, count(*) AS set_count FROM technical GROUP BY ALL",
)
def _(spark, sf):
    tests = list(dict.fromkeys(p.technical for p in GRID))
    rows = backtest.technical_candidates(layer(spark, sf, "bt_daily"), tests)
    return rows.withColumn("set_count", F.size("technical_ids").cast("long"))


# --- outcomes -------------------------------------------------------------------------

PATH_COLUMNS = (
    "gvkey iid selected_date latest_price_date latest_price latest_adjusted_price high_price high_price_date low_price "
    "low_price_date trading_days_after_selection:int return_6m_date price_6m return_1y_date price_1y return_2y_date price_2y"
)
OUTCOME_COLUMNS = (
    "parameter_set_id screen_type signal_date f_confirmation_date selected_date gvkey iid selected_price latest_price_date "
    "latest_price latest_adjusted_price high_price high_price_date low_price low_price_date return_pct "
    "max_return_pct max_drawdown_pct return_6m_date price_6m return_6m_pct return_1y_date price_1y return_1y_pct "
    "return_2y_date price_2y return_2y_pct trading_days_after_selection:int"
)


@query("c18_price_outcomes", OUTCOME_COLUMNS, "outcomes")
def price_outcomes(spark, sf):
    return backtest.price_outcomes(layer(spark, sf, "selections"), layer(spark, sf, "bt_daily"), buckets=_buckets(spark, sf))


def _paths(spark, sf):
    return backtest.price_paths(layer(spark, sf, "selections"), layer(spark, sf, "bt_daily"), _buckets(spark, sf))


query("j12_w14_forward_paths", PATH_COLUMNS, "paths")(_paths)
query("j14_high_low_dates", "gvkey iid selected_date high_price_date low_price_date", "paths")(_paths)
query("a07_horizon_prices", "gvkey iid selected_date return_6m_date price_6m price_2y", "paths")(_paths)

_EVERY_ROW = """
SELECT d.gvkey, d.iid, d.snapshot_date AS selected_date, x.* FROM bt_daily d, LATERAL (
SELECT max(p.snapshot_date) AS latest_price_date, max(p.adjusted_close_price) AS high_price, min(p.adjusted_close_price) AS low_price,
  CAST(count(*) AS INTEGER) AS trading_days_after_selection,
  min(p.snapshot_date) FILTER (WHERE p.snapshot_date >= d.snapshot_date + INTERVAL 1 YEAR) AS return_1y_date
FROM bt_daily p WHERE p.gvkey = d.gvkey AND p.iid = d.iid AND p.snapshot_date >= d.snapshot_date) x"""


@query(
    "w14_forward_path_of_every_row",
    "gvkey iid selected_date latest_price_date high_price low_price trading_days_after_selection:int return_1y_date",
    _EVERY_ROW,
)
def _(spark, sf):
    daily = layer(spark, sf, "bt_daily")
    entries = daily.select("gvkey", "iid", F.col("snapshot_date").alias("selected_date"))
    return backtest.price_paths(entries, daily, _buckets(spark, sf))


@query(
    "p25_percent_return",
    "parameter_set_id screen_type gvkey iid return_pct return_6m_pct",
    "outcomes",
)
def _(spark, sf):
    return layer(spark, sf, "outcomes")


@query(
    "p30_price_coalesce",
    "snapshot_date gvkey iid price",
    "SELECT *, coalesce(adjusted_close_price, close_price) AS price FROM bt_daily",
)
def _(spark, sf):
    return layer(spark, sf, "bt_daily").withColumn("price", F.coalesce("adjusted_close_price", "close_price"))


@query(
    "a08_a09_trading_day_counts",
    "screen_type trading_days_after_selection:int row_count",
    "SELECT screen_type, trading_days_after_selection, count(*) AS row_count FROM outcomes GROUP BY ALL",
)
def _(spark, sf):
    return layer(spark, sf, "outcomes").groupBy("screen_type", "trading_days_after_selection").agg(
        F.count("*").alias("row_count")
    )


RUN_DATES = ("latest_price_date", "high_price_date", "low_price_date", "return_6m_date", "return_1y_date", "return_2y_date")
RUN_VALUES = (
    *("selected_price", "latest_price", "latest_adjusted_price", "high_price", "low_price", "price_6m", "price_1y", "price_2y"),
    *("return_pct", "max_return_pct", "max_drawdown_pct", "return_6m_pct", "return_1y_pct", "return_2y_pct"),
)


@query(
    "c19_run_grid",
    "run_name status parameter_set_count:int logged_outcomes:long parameter_set_id:long screen_type outcome_count trading_days:long "
    + " ".join(f"n_{c}:long last_{c}" for c in RUN_DATES)
    + " "
    + " ".join(f"n_{c}:long sum_{c}:float" for c in RUN_VALUES),
    f"SELECT 'grid' AS run_name, 'succeeded' AS status, {len(GRID)} AS parameter_set_count, "
    "(SELECT count(*) FROM outcomes) AS logged_outcomes, parameter_set_id, screen_type, count(*) AS outcome_count, "
    "sum(trading_days_after_selection) AS trading_days, "
    + ", ".join(f"count({c}) AS n_{c}, max({c}) AS last_{c}" for c in RUN_DATES)
    + ", "
    + ", ".join(f"count({c}) AS n_{c}, sum({c}) AS sum_{c}" for c in RUN_VALUES)
    + " FROM outcomes GROUP BY parameter_set_id, screen_type",
)
def run_grid(spark, sf):
    """The whole backtest from raw rows to stored outcomes, logged, and read back from the store."""
    from ..sources import sinks
    from ..sources.layout import store_by_key
    from ..sources.workspace import materialize, workspace
    from . import tables
    from .layers import build_annual, build_quarterly

    folder = workspace(spark)
    store, log = f"{folder}/outcomes", f"{folder}/runs"

    def work() -> int:
        features = backtest.daily_features(tables.raw_daily(spark, sf), START, END, tiebreak=tables.TIEBREAK)
        daily = store_by_key(features, "daily", sort_by=["snapshot_date"], folder=folder)
        weekly = store_by_key(backtest.weekly_features(daily), "weekly", sort_by=["week_end_date"], folder=folder)
        selections = backtest.select_signals(
            daily,
            weekly,
            growth.growth_serving(build_annual(spark, sf), "annual"),
            growth.growth_serving(build_quarterly(spark, sf), "quarterly"),
            GRID,
            ("datadate", "fyear"),
            QUARTERLY_ORDER,
        )
        selections = materialize(selections, "selections", folder)
        outcomes = backtest.price_outcomes(selections, daily, folder)
        sinks.write_sets(outcomes, store, [p.parameter_set_id for p in GRID])
        return spark.read.parquet(store).count()

    backtest.recorded_run(spark, log, "grid", START, END, len(GRID), work)
    run = backtest.run_log(spark.read.parquet(log)).withColumn("logged_outcomes", F.col("outcome_count"))
    totals = spark.read.parquet(store).groupBy("parameter_set_id", "screen_type").agg(
        F.count("*").alias("outcome_count"),
        F.sum("trading_days_after_selection").alias("trading_days"),
        *[x for c in RUN_DATES for x in (F.count(c).alias(f"n_{c}"), F.max(c).alias(f"last_{c}"))],
        *[x for c in RUN_VALUES for x in (F.count(c).alias(f"n_{c}"), F.sum(c).alias(f"sum_{c}"))],
    )
    # The log of this run is one row.
    return totals.join(F.broadcast(run.select("run_name", "status", "parameter_set_count", "logged_outcomes")))


# --- reports --------------------------------------------------------------------------

PERF_COLUMNS = (
    "parameter_set_id parameter_set_name annual_growth_pct quarterly_growth_pct annual_years:int quarter_count:int "
    "volume_ratio_threshold volume_surge_min_days:int screen_type sample_size sample_size_6m avg_return_6m_pct "
    "median_return_6m_pct win_rate_6m_pct sample_size_1y avg_return_1y_pct median_return_1y_pct win_rate_1y_pct "
    "sample_size_2y avg_return_2y_pct median_return_2y_pct win_rate_2y_pct earliest_signal_date latest_signal_date "
    "earliest_entry_date latest_entry_date"
)
MINIMUMS = {"A_F": 30, "A_H": 4}
_ELIGIBLE = (
    "sample_size_{h} >= CASE screen_type WHEN 'A_F' THEN 30 ELSE 4 END AND avg_return_{h}_pct IS NOT NULL"
)


def parameters(spark):
    return backtest.parameter_frame(spark, GRID)


@query("c20_performance_comparison", PERF_COLUMNS, "perf")
def performance_comparison(spark, sf):
    return performance.performance_comparison(parameters(spark), layer(spark, sf, "outcomes"))


query(
    "a12_j22_horizon_statistics",
    "parameter_set_id screen_type sample_size_6m avg_return_6m_pct median_return_6m_pct win_rate_6m_pct",
    "perf",
)(performance_comparison)


@query(
    "a13_total_return_statistics",
    "parameter_set_id parameter_set_name screen_type sample_size avg_return_pct median_return_pct win_rate_pct avg_drawdown_pct avg_max_return_pct",
    "SELECT p.parameter_set_id, p.parameter_set_name, o.screen_type, count(*) AS sample_size, round(avg(return_pct), 2) AS avg_return_pct, "
    "round(quantile_cont(return_pct, 0.5), 2) AS median_return_pct, "
    "round(100.0 * count(*) FILTER (WHERE return_pct > 0) / count(*), 2) AS win_rate_pct, "
    "round(avg(max_drawdown_pct), 2) AS avg_drawdown_pct, round(avg(max_return_pct), 2) AS avg_max_return_pct "
    "FROM grid p JOIN outcomes o USING (parameter_set_id) GROUP BY ALL",
)
def _(spark, sf):
    return performance.total_return_summary(parameters(spark), layer(spark, sf, "outcomes"))


@query(
    "c21_w15_horizon_ranking",
    "parameter_set_id screen_type avg_return_1y_pct sample_size_1y rank_1y:int",
    "SELECT *, row_number() OVER (PARTITION BY screen_type ORDER BY avg_return_1y_pct DESC, sample_size_1y DESC, parameter_set_id) AS rank_1y "
    f"FROM perf WHERE {_ELIGIBLE.format(h='1y')}",
)
def _(spark, sf):
    return performance.horizon_ranking(performance_comparison(spark, sf), "1y", MINIMUMS)


def _rank(h: str) -> str:
    return (
        f"row_number() OVER (PARTITION BY screen_type ORDER BY avg_return_{h}_pct DESC, sample_size_{h} DESC, "
        f"parameter_set_id) AS rank_{h}"
    )


_COMBINED = f"""
SELECT *, (rank_6m + rank_1y + rank_2y) / 3 AS combined_rank_score FROM (
SELECT *, {_rank("6m")}, {_rank("1y")}, {_rank("2y")} FROM perf
WHERE {" AND ".join(_ELIGIBLE.format(h=h) for h in ("6m", "1y", "2y"))})"""


@query(
    "c22_combined_ranking",
    "parameter_set_id screen_type rank_6m:int rank_1y:int rank_2y:int combined_rank_score:float",
    _COMBINED,
)
def _(spark, sf):
    return performance.combined_ranking(performance_comparison(spark, sf), MINIMUMS)


@query(
    "c26_combined_leaders",
    "screen_type leader_rank:int parameter_set_id combined_rank_score:float",
    f"SELECT *, row_number() OVER (PARTITION BY screen_type ORDER BY combined_rank_score, parameter_set_id) AS leader_rank "
    f"FROM ({_COMBINED}) QUALIFY leader_rank <= 3",
)
def _(spark, sf):
    return performance.combined_leaders(performance_comparison(spark, sf), MINIMUMS, 3)


@query(
    "c23_screen_overview",
    "screen_type set_count selections:long completed_6m:long completed_1y:long completed_2y:long minimum_sample:int combined_eligible",
    "SELECT screen_type, count(*) AS set_count, sum(sample_size) AS selections, sum(sample_size_6m) AS completed_6m, "
    "sum(sample_size_1y) AS completed_1y, sum(sample_size_2y) AS completed_2y, "
    "CASE screen_type WHEN 'A_F' THEN 30 ELSE 4 END AS minimum_sample, count(*) FILTER (WHERE "
    + " AND ".join(_ELIGIBLE.format(h=h) for h in ("6m", "1y", "2y"))
    + ") AS combined_eligible FROM perf GROUP BY screen_type",
)
def _(spark, sf):
    return performance.screen_overview(performance_comparison(spark, sf), MINIMUMS)


COUNT_COLUMNS = (
    "parameter_set_id annual_growth_pct quarterly_growth_pct annual_years:int quarter_count:int volume_ratio_threshold "
    "volume_surge_min_days:int daily_ma_tolerance_pct weekly_ma_tolerance_pct screen_type selected_stock_count"
)


@query("q13_selection_counts", COUNT_COLUMNS, "set_counts")
def selection_counts(spark, sf):
    return performance.selection_counts(parameters(spark), layer(spark, sf, "outcomes"))


_FACTORS = ("annual_growth_pct", "quarterly_growth_pct", "annual_years", "quarter_count", "volume_ratio_threshold", "volume_surge_min_days")
_YIELD = " UNION ALL ".join(
    f"SELECT '{f}' AS factor, CAST({f} AS DOUBLE) AS factor_value, "
    "coalesce(avg(selected_stock_count) FILTER (WHERE screen_type = 'A_F'), 0) AS mean_yield_a_f, "
    "coalesce(avg(selected_stock_count) FILTER (WHERE screen_type = 'A_H'), 0) AS mean_yield_a_h "
    f"FROM set_counts WHERE screen_type IS NOT NULL GROUP BY {f}"
    for f in _FACTORS
)


@query("a23_mean_yield_by_factor", "factor factor_value mean_yield_a_f:float mean_yield_a_h:float", _YIELD)
def _(spark, sf):
    return performance.mean_yield_by_factor(selection_counts(spark, sf))


@query(
    "c24_parameter_sensitivity",
    "factor low_value high_value low_yield_a_f:float low_yield_a_h:float high_yield_a_f:float high_yield_a_h:float",
    "SELECT factor, min(factor_value) AS low_value, max(factor_value) AS high_value, arg_min(mean_yield_a_f, factor_value) AS low_yield_a_f, "
    "arg_min(mean_yield_a_h, factor_value) AS low_yield_a_h, arg_max(mean_yield_a_f, factor_value) AS high_yield_a_f, "
    f"arg_max(mean_yield_a_h, factor_value) AS high_yield_a_h FROM ({_YIELD}) GROUP BY factor",
)
def _(spark, sf):
    return performance.parameter_sensitivity(selection_counts(spark, sf))


_COVERAGE = """
SELECT *, selected_a_f + selected_a_h AS total, selected_a_h / CASE WHEN selected_a_f = 0 THEN 1 ELSE selected_a_f END AS a_h_share FROM (
SELECT parameter_set_id, CAST(coalesce(sum(selected_stock_count) FILTER (WHERE screen_type = 'A_F'), 0) AS BIGINT) AS selected_a_f,
  CAST(coalesce(sum(selected_stock_count) FILTER (WHERE screen_type = 'A_H'), 0) AS BIGINT) AS selected_a_h
FROM set_counts WHERE screen_type IS NOT NULL GROUP BY parameter_set_id)"""


def _coverage(spark, sf):
    return performance.coverage_ranking(selection_counts(spark, sf))


query(
    "c25_a24_coverage_ranking",
    "parameter_set_id selected_a_f selected_a_h total a_h_share:float",
    _COVERAGE,
)(_coverage)


@query(
    "o06_top_coverage",
    "parameter_set_id total selected_a_h",
    f"SELECT * FROM ({_COVERAGE}) ORDER BY total DESC, selected_a_h DESC, parameter_set_id LIMIT 10",
)
def _(spark, sf):
    return performance.top_coverage(_coverage(spark, sf))


@query(
    "o06_bottom_coverage",
    "parameter_set_id total selected_a_h",
    f"SELECT * FROM ({_COVERAGE}) ORDER BY total, selected_a_h, selected_a_f, parameter_set_id LIMIT 10",
)
def _(spark, sf):
    return performance.bottom_coverage(_coverage(spark, sf))


# --- result validation ----------------------------------------------------------------


_INTEGRITY = (
    "SELECT 'missing_core_price_outcome' AS check_name, count(*) FILTER (WHERE selected_price IS NULL OR latest_price IS NULL OR high_price IS NULL "
    "OR low_price IS NULL OR high_price_date IS NULL OR low_price_date IS NULL) AS failures FROM outcomes UNION ALL "
    "SELECT 'bad_date_rows', count(*) FILTER (WHERE latest_price_date < selected_date OR high_price_date < selected_date OR low_price_date < selected_date) FROM outcomes UNION ALL "
    "SELECT 'bad_price_rows', count(*) FILTER (WHERE high_price < low_price) FROM outcomes UNION ALL "
    "SELECT 'inconsistent_fixed_horizon_rows', count(*) FILTER (WHERE (return_6m_date IS NULL) <> (price_6m IS NULL) OR (return_1y_date IS NULL) <> (price_1y IS NULL) "
    "OR (return_2y_date IS NULL) <> (return_2y_pct IS NULL)) FROM outcomes UNION ALL "
    "SELECT 'bad_fixed_horizon_date_rows', count(*) FILTER (WHERE return_6m_date < selected_date + INTERVAL 6 MONTH OR return_1y_date < return_6m_date "
    "OR return_2y_date < return_1y_date) FROM outcomes"
)


@query("q08_outcome_integrity", "check_name failures", _INTEGRITY)
def _(spark, sf):
    return quality.outcome_checks(layer(spark, sf, "outcomes"))


# Outcomes of which the sets with each remainder of 7 break another rule; the rest is as stored.
_KIND = "parameter_set_id % 7"
_BROKEN = {
    "selected_price": (1, "NULL"),
    "latest_price_date": (2, "selected_date - 1"),
    "high_price": (3, "low_price - 1"),
    "return_6m_date": (4, "NULL"),
    "return_1y_date": (5, "return_6m_date - 1"),
}
_MISTIMED = {
    "f_confirmation_date": (1, "signal_date"),
    "g_confirmation_date": (2, "CASE WHEN screen_type = 'A_F' THEN f_confirmation_date ELSE NULL END"),
    "h_confirmation_date": (3, "CASE WHEN screen_type = 'A_H' THEN g_confirmation_date END"),
}


def _broken_sql(changes: dict[str, tuple[int, str]]) -> str:
    columns = ", ".join(f"CASE WHEN {_KIND} = {k} THEN {x} ELSE {c} END AS {c}" for c, (k, x) in changes.items())
    return f"(SELECT * REPLACE ({columns}) FROM outcomes)"


def _broken(rows, changes: dict[str, tuple[int, str]]):
    kept = {c: F.expr(f"CASE WHEN {_KIND} = {k} THEN {x} ELSE {c} END") for c, (k, x) in changes.items()}
    return rows.withColumns(kept)


@query("q08_broken_outcomes", "check_name failures", _INTEGRITY.replace("FROM outcomes", f"FROM {_broken_sql(_BROKEN)}"))
def _(spark, sf):
    """The same checks on outcomes that break each rule."""
    return quality.outcome_checks(_broken(layer(spark, sf, "outcomes"), _BROKEN))


_TIMING = (
    "SELECT 'bad_signal_order' AS check_name, count(*) FILTER (WHERE f_confirmation_date <= signal_date OR selected_date < f_confirmation_date) AS failures FROM outcomes "
    "UNION ALL SELECT 'bad_a_f_timing', count(*) FILTER (WHERE screen_type = 'A_F' AND (selected_date <> f_confirmation_date OR g_confirmation_date IS NOT NULL "
    "OR h_confirmation_date IS NOT NULL)) FROM outcomes UNION ALL SELECT 'bad_a_h_timing', count(*) FILTER (WHERE screen_type = 'A_H' AND (g_confirmation_date IS NULL "
    "OR h_confirmation_date IS NULL OR g_confirmation_date < f_confirmation_date OR h_confirmation_date <= g_confirmation_date OR selected_date <> h_confirmation_date)) FROM outcomes"
)


@query("q09_broken_timing", "check_name failures", _TIMING.replace("FROM outcomes", f"FROM {_broken_sql(_MISTIMED)}"))
def _(spark, sf):
    """The same checks on outcomes whose dates are out of order."""
    return quality.confirmation_timing_checks(_broken(layer(spark, sf, "outcomes"), _MISTIMED))


@query("q09_confirmation_timing", "check_name failures", _TIMING)
def _(spark, sf):
    return quality.confirmation_timing_checks(layer(spark, sf, "outcomes"))


@query(
    "q10_export_completeness",
    "check_name failures",
    "SELECT 'incomplete_a_f' AS check_name, CAST(count(*) FILTER (WHERE screen_type = 'A_F') <> 192 AS BIGINT) AS failures FROM perf UNION ALL "
    "SELECT 'incomplete_a_h', CAST(count(*) FILTER (WHERE screen_type = 'A_H') <> 192 AS BIGINT) FROM perf UNION ALL "
    "SELECT 'no_completed_6m', CAST(count(*) FILTER (WHERE sample_size_6m > 0) = 0 AS BIGINT) FROM perf",
)
def _(spark, sf):
    return quality.export_checks(performance_comparison(spark, sf), len(GRID))


@query(
    "q13_a10_a14_screen_summary",
    "screen_type outcome_rows parameter_sets_with_results unique_securities earliest_signal_date latest_signal_date earliest_selected_date latest_selected_date",
    "SELECT screen_type, count(*) AS outcome_rows, count(DISTINCT parameter_set_id) AS parameter_sets_with_results, "
    "count(DISTINCT gvkey || '-' || iid) AS unique_securities, min(signal_date) AS earliest_signal_date, max(signal_date) AS latest_signal_date, "
    "min(selected_date) AS earliest_selected_date, max(selected_date) AS latest_selected_date FROM outcomes GROUP BY screen_type",
)
def _(spark, sf):
    return quality.screen_summary(layer(spark, sf, "outcomes"))


@query(
    "q13_completed_horizons",
    "screen_type selections completed_6m completed_1y completed_2y",
    "SELECT screen_type, count(*) AS selections, count(return_6m_pct) AS completed_6m, count(return_1y_pct) AS completed_1y, "
    "count(return_2y_pct) AS completed_2y FROM outcomes GROUP BY screen_type",
)
def _(spark, sf):
    return quality.completed_horizons(layer(spark, sf, "outcomes"))


@query(
    "a20_duplicate_outcomes",
    "parameter_set_id screen_type selected_date row_count",
    "SELECT parameter_set_id, screen_type, selected_date, count(*) AS row_count FROM outcomes GROUP BY ALL HAVING count(*) > 1",
)
def _(spark, sf):
    from ..operators.dedup import duplicate_keys

    keys = ["parameter_set_id", "screen_type", "selected_date"]
    return duplicate_keys(layer(spark, sf, "outcomes"), keys)
