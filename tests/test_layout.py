"""Layouts by key and by bucket, windows from folder names, and rebuilds of what changed."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickerloom import SECURITY
from tickerloom.operators import backtest, daily, refresh, serving, weekly
from tickerloom.plans import layers, storage, tables
from tickerloom.sources import ingest, lake, layout, partitions, sinks

from .test_plans import plan_of

D = dt.date
RAW = (
    "date date, gvkey string, iid string, ticker string, currency string, close_price_raw double, adjusted_close_price double, "
    "adjustment_factor double, volume double"
)


def raw_rows(seed, days, securities):
    r = random.Random(seed)
    rows = []
    for s in range(securities):
        day = D(2020, 1, 1) + dt.timedelta(r.randrange(5))
        for _ in range(days):
            day += dt.timedelta(r.choice([1, 1, 1, 3]))
            close = round(10 + r.random() * 5, 2)
            rows.append((day, str(s), "01", f"T{s}", "USD", close, None, 1.0, float(r.randrange(1, 500))))
            if r.random() < 0.05:
                rows.append((day, str(s), "01", f"T{s}", "USD", close + 1, None, 1.0, float(r.randrange(1, 500))))
    return rows


@pytest.fixture(scope="module")
def laid_out(spark):
    df = spark.createDataFrame(raw_rows(1, 140, 9), RAW).withColumn("company_name", F.lit("N"))
    return layout.store_by_key(df, "raw", sort_by=["date"])


def nodes(df, name):
    return plan_of(df).count(name)


def test_features_on_the_layout_plan_no_exchange_and_one_sort(laid_out, no_automatic_broadcast):
    features = backtest.daily_features(laid_out, D(2020, 3, 1), D(2021, 12, 31), tiebreak=("volume",), laid_out=True)
    assert (nodes(features, "Exchange"), nodes(features, "Sort [")) == (0, 1), plan_of(features)
    history = daily.daily_history(laid_out, ("volume",), laid_out=True)
    assert (nodes(history, "Exchange"), nodes(history, "Sort [")) == (0, 1), plan_of(history)
    other = daily.daily_history(laid_out, ("volume",))
    assert nodes(other, "Sort [") > 1  # sorted by hash first
    assert sorted(map(tuple, history.collect()), key=str) == sorted(map(tuple, other.select(history.columns).collect()), key=str)


def test_weekly_bars_paths_and_matches_on_the_layout_shuffle_nothing(spark, sf_dir, no_automatic_broadcast):
    stored = layers.layer(spark, sf_dir, "bt_daily")
    by_security = r"hashpartitioning(gvkey"
    assert by_security not in plan_of(backtest.weekly_features(stored))
    assert by_security not in plan_of(serving.security_master(layers.layer(spark, sf_dir, "daily")).drop("is_active"))
    entries = stored.select(*SECURITY, F.col("snapshot_date").alias("selected_date"))
    # Entries and prices are stacked; the stack is shuffled once.
    assert plan_of(backtest.price_paths(entries, stored)).count(by_security) <= 1


def test_grid_is_selected_in_one_layout(spark, sf_dir, no_automatic_broadcast):
    from __spark_entry__ import queries

    plan = plan_of(queries()["c17_select_signals"](spark, sf_dir))
    assert plan.count("FileScan parquet") <= 6, plan


def test_fundamentals_come_from_one_pass_over_line_items(spark, sf_dir):
    from __spark_entry__ import queries

    plan = plan_of(tables.quarter_sums(spark, sf_dir))
    assert plan.count("l_extendedprice") and plan.count("lineitem.parquet") == 1
    for name in ("c01_annual_growth", "c02_quarterly_growth", "c09_screen_fundamentals"):
        plan = plan_of(queries()[name](spark, sf_dir))
        assert "lineitem.parquet" not in plan and "filings" in plan


def test_a_layout_has_one_sorted_file_per_bucket(spark):
    df = spark.range(1000).selectExpr("CAST(id % 37 AS STRING) AS gvkey", "'01' AS iid", "-id AS t")
    stored = layout.store_by_key(df, "t", sort_by=["t"], buckets=5, table="some_layout")
    per_file = stored.select("*", F.col("_metadata.file_path").alias("file")).groupBy("gvkey").agg(F.count_distinct("file").alias("n"))
    assert per_file.filter("n > 1").count() == 0
    assert stored.select("_metadata.file_path").distinct().count() <= 5
    assert stored.count() == 1000 and stored.groupBy(*SECURITY).count().count() == 37
    layout.drop_layout(spark, "some_layout")
    assert not spark.catalog.tableExists("some_layout")


# --- the lattice of parameter sets ----------------------------------------------------


def test_strictest_values_stand_for_the_weaker_ones(spark):
    axis = backtest.Axis([(2, -30.0), (1, -10.0), (1, -30.0), (2, -10.0), (1, -30.0)], backtest._periods_imply)
    assert axis.values == [(2, -30.0), (1, -10.0), (1, -30.0), (2, -10.0)]
    assert [sorted(i) for i in axis.implied] == [[0, 2], [1, 2], [2], [0, 1, 2, 3]] and axis.top == [3]
    rows = spark.createDataFrame([([0, 1, 2],), ([2],), ([],), ([0, 1, 2, 3],)], "ids array<int>")
    assert [r[0] for r in rows.select(axis.strictest("ids")).collect()] == [[0, 1], [2], [], [3]]


def test_lattice_minimum_equals_every_point_by_itself(spark):
    r = random.Random(4)
    periods = backtest.Axis([(a, b) for a in (1, 2, 3) for b in (5.0, 10.0)], backtest._periods_imply)
    bands = backtest.Axis([3.0, 1.0, 2.0], lambda a, b: a <= b)
    single = backtest.Axis(["x"], lambda a, b: True)
    points = [(f"k{r.randrange(6)}", D(2020, 1, 1) + dt.timedelta(i), r.randrange(6), r.randrange(3), 0, i) for i in range(60)]
    df = spark.createDataFrame(points, "k string, d date, p int, b int, s int, carried int")
    got = backtest.lattice_first(df, {"p": periods, "b": bands, "s": single}, ["k"], "d")
    want = set()
    for k in {x[0] for x in points}:
        for p in range(6):
            for b in range(3):
                implying = [x for x in points if x[0] == k and p in periods.implied[x[2]] and b in bands.implied[x[3]]]
                if implying:
                    first = min(implying, key=lambda x: x[1])
                    want.add((k, first[1], p, b, 0, first[5]))
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)


def test_technical_order():
    weak, strong = (D(2020, 1, 1), None, 2.0, 1, 5.0), (D(2020, 2, 1), D(2021, 1, 1), 3.0, 2, 1.0)
    assert backtest._technical_implies(strong, weak) and not backtest._technical_implies(weak, strong)
    assert not backtest._technical_implies((D(2020, 1, 1), None, 3.0, 1, 1.0), (D(2020, 1, 1), D(2021, 1, 1), 2.0, 1, 1.0))


# --- rebuilds of what changed ---------------------------------------------------------


def change(rows, r, kind):
    """Two dates of the rows, downloaded anew."""
    days = sorted({x[0] for x in rows})
    two = {days[r.randrange(len(days))], days[-1] if kind == "last" else days[r.randrange(len(days))]}
    out = []
    for x in rows:
        if x[0] in two and int(x[1]) % 3 == 0:
            if kind == "removed":
                continue
            x = (*x[:5], x[5] * 2, None, 1.0, x[8] + 7)
        out.append(x)
    if kind == "added":
        day = min(two)
        out.append((day, "77", "01", "T77", "USD", 5.0, None, 1.0, 9.0))
        out.append((D(2019, 12, 30), "1", "01", "T1", "USD", 5.0, None, 1.0, 9.0))
        two.add(D(2019, 12, 30))
    return out, two


@pytest.mark.parametrize("kind", ["changed", "removed", "added", "nothing"])
def test_refreshed_store_equals_a_full_rebuild(spark, tmp_path, kind):
    r = random.Random(len(kind))
    rows = raw_rows(2, 150, 6)
    new, two = (rows, {rows[3][0]}) if kind == "nothing" else change(rows, r, kind)
    before, after = spark.createDataFrame(rows, RAW), spark.createDataFrame(new, RAW)
    path = str(tmp_path / "daily")
    sinks.write_daily(daily.daily_history(before, ("volume", "close_price_raw")), path)
    files = {p for p in Path(path).rglob("*.parquet")}
    dates = F.col("date").isin(list(two))
    changed = refresh.changed_keys(before.filter(dates), after.filter(dates))
    n = refresh.refresh_daily_store(spark, path, after, changed, ("volume", "close_price_raw"))
    want = daily.daily_history(after, ("volume", "close_price_raw"))
    columns = want.columns
    got = spark.read.parquet(path).select(*columns)
    key = lambda x: tuple(map(str, x))
    for a, b in zip(sorted(map(tuple, got.collect()), key=key), sorted(map(tuple, want.collect()), key=key), strict=True):
        assert a == pytest.approx(b), (a, b)
    kept = {p for p in Path(path).rglob("*.parquet")} & files
    if kind == "nothing":
        assert n == 0 and kept == files
    else:
        assert n > 0 and changed.count() < 8


@pytest.mark.parametrize("kind", ["changed", "added", "week"])
def test_refreshed_weeks_equal_a_full_rebuild(spark, tmp_path, kind):
    """``week``: the market loses the last session of a week, so that all securities lose its bar."""
    order = ("volume", "close_price_raw")
    r = random.Random(3)
    days = [d for d in (D(2020, 1, 6) + dt.timedelta(i) for i in range(330)) if d.weekday() < 5]
    rows = [
        (d, str(s), "01", f"T{s}", "USD", round(10 + 5 * r.random(), 2), None, 1.0, float(r.randrange(1, 500)))
        for s in range(4)
        for d in days
        if s == 0 or r.random() < 0.6
    ]
    if kind == "week":
        fridays = sorted({x[0] for x in rows if x[0].weekday() == 4})
        new, two = [x for x in rows if x[0] != fridays[20]], {fridays[20]}
    else:
        new, two = change(rows, r, kind)
    before, after = (spark.createDataFrame(r, RAW).withColumn("company_name", F.lit("N")) for r in (rows, new))
    path = str(tmp_path / "weekly")
    sinks.write_weekly(weekly.weekly_history(before, tiebreak=order), path)
    dates = F.col("date").isin(list(two))
    changed = refresh.changed_keys(before.filter(dates), after.filter(dates))
    refresh.refresh_weekly_store(spark, path, before, after, changed, tiebreak=order)
    want = weekly.weekly_history(after, tiebreak=order)
    got = spark.read.parquet(path).select(*want.columns)
    key = lambda x: tuple(map(str, x[:8]))
    a, b = (sorted(map(tuple, df.select("week_start_date", *SECURITY, *[c for c in want.columns if c not in ("week_start_date", *SECURITY)]).collect()), key=key) for df in (got, want))
    assert len(a) == len(b) > 100
    for x, y in zip(a, b, strict=True):
        assert x == pytest.approx(y), (x, y)


def test_changed_keys_see_copies_and_nulls(spark):
    schema = "date date, gvkey string, iid string, v double"
    a, b = D(2024, 1, 2), D(2024, 1, 3)
    old = spark.createDataFrame([(a, "1", "1", None), (b, "1", "1", 2.0), (a, "2", "1", 3.0), (a, "2", "1", 3.0), (a, "3", "1", 1.0)], schema)
    new = spark.createDataFrame([(b, "1", "1", 2.0), (a, "1", "1", None), (a, "2", "1", 3.0), (b, "3", "1", 1.0)], schema)
    got = {r["gvkey"]: (r["first_changed"], r["last_changed"]) for r in refresh.changed_keys(old, new).collect()}
    assert got == {"2": (a, a), "3": (a, b)}


# --- buckets --------------------------------------------------------------------------


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(200).selectExpr("id AS k", "'old' AS v", "'first' AS created_at", "id AS other")
    sinks.write_buckets(rows, path, ["k"], 16)
    before = {p.parent.name: p.name for p in Path(path).rglob("*.parquet")}
    updates = spark.createDataFrame([(3, "new", "second"), (1000, "new", "second")], "k long, v string, created_at string")
    assert sinks.upsert_buckets(spark, path, updates, ["k"]) <= 2
    after = {p.parent.name: p.name for p in Path(path).rglob("*.parquet")}
    assert sum(before[b] != after[b] for b in before) <= 2
    got = {r["k"]: (r["v"], r["created_at"], r["other"]) for r in spark.read.parquet(path).collect()}
    want = {k: ("old", "first", k) for k in range(200)} | {3: ("new", "first", 3), 1000: ("new", "second", None)}
    assert got == want


def test_refused_upserts_change_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_buckets(spark.createDataFrame([(1, "a", True)], "k long, v string, active boolean"), path, ["k"], 4)
    update = lambda rows, schema: sinks.upsert_buckets(spark, path, spark.createDataFrame(rows, schema), ["k"])
    for rows, schema, why in [
        ([], "k long, v string", "no updates"),
        ([("x",)], "v string", "lack"),
        ([(1, 2)], "k long, w int", "unknown"),
        ([(1, "b"), (1, "c")], "k long, v string", "twice"),
        ([(None, "b")], "k long, v string", "lack a key"),
    ]:
        with pytest.raises(partitions.ReplaceError, match=why):
            update(rows, schema)
    assert [tuple(r) for r in spark.read.parquet(path).select("k", "v", "active").collect()] == [(1, "a", True)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    new = spark.createDataFrame([(2, "b", True)], "k long, v string, active boolean")
    sinks.upsert_buckets(spark, path, new, ["k"], deactivate="active")
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "active").collect()) == [(1, False), (2, True)]


# --- windows from folder names --------------------------------------------------------


def test_windows_of_a_dated_table_are_partition_filters(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [D(2023, 6, 1) + dt.timedelta(7 * i) for i in range(60)]
    rows = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "date date, v int")
    sinks.write_daily(rows, path)
    table = lake.DatedTable(spark, path)
    assert table.dates == days and table.latest == days[-1]
    pairs = [
        (table.target_window(3, 40), lake.window_for_targets(rows, 3, 40)),
        (table.week_window(100), lake.window_for_weeks(rows, 100)),
        (table.lookback_window(3), lake.window_for_lookback(rows, 3)),
        (table.backtest_window(days[20], days[30], 50), lake.window_for_backtest(rows, str(days[20]), str(days[30]), 50)),
    ]
    for got, want in pairs:
        plan = plan_of(got)
        assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(date" in plan and "subquery" not in plan.lower(), plan
        assert sorted(map(tuple, got.select("date", "v").collect())) == sorted(map(tuple, want.collect()))
        assert 0 < got.count() < 60


def test_windows_of_an_empty_dated_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_daily(spark.createDataFrame([(None, 1)], "date date, v int"), path)
    table = lake.DatedTable(spark, path)
    assert table.latest is None
    for df in (table.target_window(), table.week_window(), table.lookback_window()):
        assert df.count() == 0


# --- names in force -------------------------------------------------------------------


def test_names_in_force_may_overlap_and_stay_open(spark, no_automatic_broadcast):
    r = random.Random(8)
    start = D(2020, 1, 1)
    day = lambda i: start + dt.timedelta(i)
    names = [(k, day(b), None if r.random() < 0.3 else day(b + r.randrange(-2, 30)), f"n{i}") for i in range(40) for k, b in [(r.randrange(4), r.randrange(60))]]
    names += [(1, None, day(9), "no start"), (1, day(5), day(5), "one day")]
    prices = [(k, day(r.randrange(100)), i) for i in range(150) for k in [r.randrange(5)]] + [(1, None, 1), (None, day(3), 2), (1, day(5), 3), (1, day(5), 3)]
    got = ingest.with_names_in_force(
        spark.createDataFrame(prices, "permno int, date date, v int"),
        spark.createDataFrame(names, "permno int, namedt date, nameenddt date, ticker string"),
    )
    want = [(p, d, v, n) for p, d, v in prices for k, b, e, n in names if p == k and d and b and b <= d and (e is None or d <= e)]
    assert sorted((x["permno"], x["date"], x["v"], x["ticker"]) for x in got.collect()) == sorted(want)
    plan = plan_of(got)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_master_of_repeated_last_rows(spark):
    schema = "date date, gvkey string, iid string, ticker string, company_name string, exchange_code int, security_status string, issue_type_code string"
    a, b = D(2024, 1, 2), D(2024, 1, 3)
    rows = [(a, "1", "1", "A", "x", 1, "A", "0"), (b, "1", "1", "B", "x", 1, "A", "0"), (b, "1", "1", "C", "x", 1, "A", "0"), (a, "2", "1", None, None, None, None, None)]
    got = {r["gvkey"]: r for r in serving.security_master(spark.createDataFrame(rows, schema)).collect()}
    assert len(got) == 2 and got["1"]["ticker"] == "C" and got["1"]["is_active"] and not got["2"]["is_active"]
    assert (got["1"]["first_seen_date"], got["1"]["last_seen_date"]) == (a, b)


def test_weekly_features_take_the_layout(laid_out):
    features = backtest.daily_features(laid_out, D(2020, 3, 1), D(2021, 12, 31), tiebreak=("volume",), laid_out=True)
    assert "hashpartitioning(gvkey" not in plan_of(backtest.weekly_features(features))
    assert weekly.MEANS and storage.rebuild_changed
