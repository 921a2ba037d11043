"""Physical plans keep the properties the operators promise at scale."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tickerloom.operators import backtest, daily, rolling
from tickerloom.plans import tables
from tickerloom.sources import lake, sinks
from tickerloom.sources.workspace import workspace

QUERIES = queries()
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "c01_annual_growth",
        "c02_quarterly_growth",
        "c03_daily_metrics",
        "c04_weekly_metrics",
        "c06_screen_latest",
        "c07_universe_filter_kept",
        "c08_screen_dynamic_strict",
        "c09_screen_fundamentals",
        "c10_security_master",
        "c14_backtest_daily_features",
        "c15_backtest_weekly_features",
        "c17_select_signals",
        "c18_price_outcomes",
        "c20_performance_comparison",
        "j11_asof_forward",
        "j17_missing_future_links",
        "w14_forward_path_of_every_row",
    ],
)
def test_no_pairwise_join_and_no_python(spark, sf_dir, no_automatic_broadcast, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert not [node for node in FORBIDDEN if node in plan], plan


def test_daily_windows_share_one_exchange(spark, sf_dir):
    rows = daily.add_daily_ratios(daily.add_daily_indicators(daily.clean_daily(tables.prices(spark, sf_dir), tables.TIEBREAK)))
    plan = plan_of(rolling.add_previous(rows, [*daily.MEANS, *daily.RATIOS], "date"))
    # One exchange to deduplicate, one that serves all eleven window columns.
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2, plan
    assert len(re.findall(r"Sort \[gvkey", plan)) == 1, plan


def test_weekly_bars_and_averages_share_one_layout(spark, sf_dir):
    daily = tables.prices(spark, sf_dir).withColumns({c: F.lit("x") for c in ("company_name",)})
    features = backtest.daily_features(daily, "1996-01-01", "2001-12-31", tiebreak=tables.TIEBREAK)
    plan = plan_of(backtest.weekly_features(features))
    by_security = re.findall(r"Exchange hashpartitioning\(gvkey#\d+, iid#\d+, \d+\)", plan)
    assert len(by_security) == 1, plan


def test_scans_read_only_the_needed_columns(spark, sf_dir):
    plan = QUERIES["t01_monday"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in plan, plan


def test_date_filters_prune_partitions_and_keys_reach_the_scan(spark, sf_dir):
    path = f"{workspace(spark)}/daily"
    rows = tables.prices(spark, sf_dir).filter("date >= DATE'2001-10-01'")
    sinks.write_daily(rows, path)
    stored = lake.read_parquet(spark, path, merge=False)
    plan = plan_of(stored.filter("date >= DATE'2001-10-20' AND gvkey = '3'").select("volume"))
    assert re.search(r"PartitionFilters: \[[^\]]*date", plan), plan
    assert "EqualTo(gvkey,3)" in plan, plan
    window = plan_of(lake.window_for_lookback(stored))
    assert re.search(r"PartitionFilters: \[[^\]]*date", window), window


def test_grid_size_does_not_multiply_the_daily_scan(spark, sf_dir):
    plan = plan_of(QUERIES["c17_select_signals"](spark, sf_dir))
    scans = len(re.findall(r"FileScan parquet", plan))
    assert scans <= 6, plan
