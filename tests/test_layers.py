"""Stored layers: one narrow exchange by security, bounded buckets, nothing stored that a row gives by itself."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tickerloom import SECURITY
from tickerloom.operators import backtest, daily, quality, refresh, weekly
from tickerloom.plans import evaluation, layers, storage, tables
from tickerloom.sources import layout, sinks

from .test_plans import plan_of

QUERIES = queries()


def same(one, other):
    other = other.select(*one.columns)
    return one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_daily_and_weekly_rows_share_one_exchange_of_line_items(spark, sf_dir, no_automatic_broadcast):
    lines = plan_of(layers.build_lines(spark, sf_dir))
    assert "Exchange" not in lines and "Sort [" not in lines, lines  # the only exchange is that of the layout
    for build in (layers.build_daily, layers.build_weekly, layers.build_bt_daily, layers.build_bt_weekly):
        plan = plan_of(build(spark, sf_dir))
        assert "hashpartitioning(gvkey" not in plan, plan


def test_buckets_do_not_grow_with_the_table(spark):
    least = layout.bucket_count(spark)
    assert layout.bucket_count(spark, 1000) == least
    for rows in (10**8, 10**9):
        assert rows / layout.bucket_count(spark, rows) <= layout.ROWS_PER_BUCKET


def test_layers_that_meet_have_one_number_of_buckets(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(layout, "ROWS_PER_BUCKET", 300)
    rows = tables.table(spark, sf_dir, "lineitem").count()
    assert layers._buckets(spark, sf_dir) == -(-rows // 300) > layout.bucket_count(spark)


def test_stored_daily_and_weekly_rows_give_all_columns(spark, sf_dir):
    raw = tables.raw_daily(spark, sf_dir)
    whole = daily.daily_history(raw, tables.TIEBREAK)
    assert set(layers.layer(spark, sf_dir, "daily").columns) == set(whole.columns)
    assert same(layers.layer(spark, sf_dir, "daily"), whole)
    weeks = weekly.weekly_history(raw, tiebreak=tables.TIEBREAK)
    assert set(layers.layer(spark, sf_dir, "weekly").columns) == set(weeks.columns)
    assert same(layers.layer(spark, sf_dir, "weekly"), weeks)
    stored = layers._stored(spark, sf_dir, "daily")[0].columns
    assert not [c for c in stored if "ratio" in c or c.startswith("flag_")], stored


@pytest.mark.parametrize("key", ["7", None])
def test_copies_of_a_hot_security_go_before_the_layout(spark, sf_dir, key):
    few = tables.line_rows(spark, sf_dir).filter("gvkey < '2'")
    some = few.filter("gvkey = '1' AND iid = 'F'").withColumns({"gvkey": F.lit(key).cast("string"), "iid": F.lit("F")})
    copies = some.crossJoin(spark.range(40)).withColumn("l_quantity", F.when(F.col("id") > 0, F.col("l_quantity") + F.col("id") % 7)).drop("id")
    rows = few.unionByName(copies)
    most = few.groupBy(*SECURITY).count().agg(F.max("count")).first()[0]
    assert copies.count() > most
    kept = layers.without_hot_copies(rows, most)
    hot = kept.filter(F.col("gvkey").eqNullSafe(F.lit(key)))
    assert 0 < hot.groupBy("date").count().agg(F.max("count")).first()[0] <= 2
    assert kept.count() - hot.count() == few.count()
    for keep_raw in (False, True):
        want = daily.clean_daily(tables.prices_of(rows), tables.TIEBREAK, keep_raw=keep_raw)
        assert same(daily.clean_daily(tables.prices_of(kept), tables.TIEBREAK, keep_raw=keep_raw), want)
    unasked = daily.clean_daily(tables.prices_of(rows), tables.TIEBREAK, need_volume=False)
    assert same(daily.clean_daily(tables.prices_of(kept), tables.TIEBREAK, need_volume=False), unasked)


def test_forward_paths_leave_daily_rows_in_their_layout(spark, sf_dir, no_automatic_broadcast):
    selections, days = (layers.layer(spark, sf_dir, n) for n in ("selections", "bt_daily"))
    rows = backtest.price_paths(selections, days, layers._buckets(spark, sf_dir))
    plan = plan_of(rows)
    assert not re.search(r"Exchange hashpartitioning\(gvkey#\d+, iid#\d+, \d+\), ENSURE", plan), plan
    want = backtest.price_paths(selections, days)
    assert want.count() > 0 and same(rows, want)


def test_selections_are_reduced_in_the_layout_of_the_match(spark, sf_dir, no_automatic_broadcast):
    plan = plan_of(evaluation.select_signals(spark, sf_dir))
    assert not re.search(r"Exchange hashpartitioning\(gvkey#\d+, iid#\d+, screen_type", plan), plan


class Stop(Exception):
    pass


@pytest.mark.parametrize("run, write, name", [("rebuild_changed", "write_daily", "daily"), ("rebuild_changed_weeks", "write_weekly", "weekly")])
def test_rebuilds_store_no_column_that_follows_from_others(spark, sf_dir, monkeypatch, run, write, name):
    """One narrow exchange by date, straight from the windows: the layer is not written first."""
    seen = []

    def stop(df, path):
        seen.append(df)
        raise Stop

    monkeypatch.setattr(sinks, write, stop)
    monkeypatch.setattr(layers, "_written", {k: v for k, v in layers._written.items() if k[2] in ("lines", "names")})
    with pytest.raises(Stop):
        getattr(storage, run)(spark, sf_dir)
    assert not [c for c in seen[0].columns if "ratio" in c or c.startswith("flag_")], seen[0].columns
    assert name not in {k[2] for k in layers._written}
    assert "hashpartitioning(gvkey" not in plan_of(seen[0])


@pytest.mark.parametrize("run", ["rebuild_changed", "rebuild_changed_weeks"])
def test_refreshes_compute_the_changed_rows_once(spark, sf_dir, monkeypatch, run):
    """The ranges come from the recomputed rows as stored; what changed is stored before the raw rows meet it."""
    seen = {}

    def materialize(df, name, folder):
        seen[name] = plan_of(df)
        if name == "ranges":
            raise Stop
        return keep(df, name, folder)

    keep = refresh.materialize
    monkeypatch.setattr(refresh, "materialize", materialize)
    with pytest.raises(Stop):
        getattr(storage, run)(spark, sf_dir)
    assert "Window" in seen["recomputed"] and "Window" not in seen["ranges"], seen["ranges"]
    if run == "rebuild_changed_weeks":
        assert "changes" in seen and "Union" not in seen["recomputed"], seen["recomputed"]


@pytest.mark.parametrize(
    "name", ["p22_parameter_literals", "q04_future_field_checks", "c10_security_master", "j16_traded_on_official_week_end", "q05_load_checks"]
)
def test_queries_of_few_columns_write_no_wide_layer(spark, sf_dir, monkeypatch, name):
    wide = ("daily", "weekly", "bt_daily", "bt_weekly")
    known = {k: v for k, v in layers._written.items() if k[2] not in wide}
    monkeypatch.setattr(layers, "_written", known)
    rows = QUERIES[name](spark, sf_dir)
    assert not {k[2] for k in known} & set(wide), known.keys()
    alone = sorted(map(str, rows.collect()))
    for w in wide:
        layers.layer(spark, sf_dir, w)
    assert alone and alone == sorted(map(str, QUERIES[name](spark, sf_dir).collect()))


def test_columns_that_are_not_shown_compute_no_average(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(layers, "_written", {k: v for k, v in layers._written.items() if k[2] in ("lines", "names")})
    for name in ("c10_security_master", "j16_traded_on_official_week_end"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert "avg(" not in plan and "lead(" not in plan, plan


def test_outcomes_write_no_backtest_rows(spark, sf_dir, monkeypatch):
    """Checks of outcomes (q08, q09) need selections and outcomes alone."""
    want = [layers.layer(spark, sf_dir, n) for n in ("selections", "outcomes")]
    known = {k: v for k, v in layers._written.items() if k[2] in ("lines", "names", "filings", "annual", "quarterly")}
    monkeypatch.setattr(layers, "_written", known)
    outcomes = layers.layer(spark, sf_dir, "outcomes")
    assert not {k[2] for k in known} & {"bt_daily", "bt_weekly"}, known.keys()
    assert outcomes.count() > 0 and same(outcomes, want[1])
    assert same(layers.layer(spark, sf_dir, "selections"), want[0])


def test_missing_links_are_found_in_one_pass(spark, sf_dir, no_automatic_broadcast):
    weeks = layers.layer(spark, sf_dir, "weekly").select(*SECURITY, "week_end_date")
    linked = weeks.withColumn("link", F.when(F.col("gvkey") > "2", F.date_add("week_end_date", 7)))
    got = quality.missing_future_links(linked, "week_end_date", "link")
    plan = plan_of(got)
    assert "Exchange" not in plan and "Join" not in plan, plan
    targets = weeks.withColumnRenamed("week_end_date", "link")
    want = linked.filter("link IS NOT NULL").join(targets, [*SECURITY, "link"], "left_anti")
    assert want.count() > 0 and same(got, want)


def test_missing_links_of_unknown_keys_and_copies(spark):
    rows = [("1", "F", 1, 2, "a"), ("1", "F", 2, 3, "b"), ("1", "F", 2, 9, "c"), ("1", "F", None, 2, "d"), ("1", "F", 4, None, "e")]
    rows += [("1", "F", 5, 5, "f"), ("2", "F", 1, 2, "g"), (None, "F", 2, 2, "h"), ("2", None, 2, 2, "i")]
    df = spark.createDataFrame([(a, b, c, d, e) for a, b, c, d, e in rows], "gvkey string, iid string, week_end_date int, link int, id string")
    got = quality.missing_future_links(df, "week_end_date", "link")
    assert got.columns == df.columns
    assert sorted(r["id"] for r in got.collect()) == ["b", "c", "g", "h", "i"]
