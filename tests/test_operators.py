"""Operators against brute force and hand-computed values."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tickerloom.functions.flags import cluster_flag, strict_cluster_flag
from tickerloom.functions.prices import adjusted_close, cluster_ratio, percent_return, yoy_growth
from tickerloom.operators import asof, calendar, daily, dedup, growth, performance, quality, serving, universe, weekly

D = dt.date
DAY = dt.timedelta(days=1)


@pytest.mark.parametrize("direction", ["forward", "backward"])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_asof_join_equals_brute_force(spark, direction, how):
    rng = random.Random(7)
    start = D(2020, 1, 1)
    lefts = [(rng.randrange(4), i, start + DAY * rng.randrange(40)) for i in range(200)]
    lefts.append((1, 999, None))
    rights = sorted({(rng.randrange(4), start + DAY * rng.randrange(40)) for _ in range(40)})
    left = spark.createDataFrame(lefts, "k int, n int, t date")
    right = spark.createDataFrame([(k, t, f"{k}/{t}") for k, t in rights], "k int, u date, label string")
    got = {r["n"]: r["u"] for r in asof.asof_join(left, right, ["k"], "t", "u", direction, how).collect()}
    want = {}
    for k, n, t in lefts:
        if direction == "forward":
            hits = [u for kk, u in rights if kk == k and t is not None and u >= t]
            match = min(hits, default=None)
        else:
            hits = [u for kk, u in rights if kk == k and t is not None and u <= t]
            match = max(hits, default=None)
        if match is not None or how == "left":
            want[n] = match
    assert got == want


@pytest.mark.parametrize("size", [1, 2, 3, 64, 501, 1000])
def test_exact_medians_equal_sorted_ones(spark, size):
    rng = random.Random(size)
    rows = []
    for group in ("hot", "cold"):
        # A third of the values of the hot group are the same one.
        values = [0.5 if group == "hot" and rng.random() < 0.34 else rng.gauss(0, 50) for _ in range(size)]
        rows += [(group, v, None if i % 5 == 0 and size > 2 else v * 2) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = {r["g"]: (r["mx"], r["my"]) for r in performance.exact_medians(df, ["g"], {"mx": "x", "my": "y"}).collect()}
    for group in ("hot", "cold"):
        xs = [x for g, x, _ in rows if g == group]
        ys = [y for g, _, y in rows if g == group and y is not None]
        assert got[group] == pytest.approx((statistics.median(xs), statistics.median(ys)))


def test_keep_first_limits_copies_before_the_exchange(spark):
    rows = spark.range(0, 3000, 1, 4).select(
        F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    kept = dedup.keep_first(rows, ["k"], [F.desc("v")])
    result = {r["k"]: r["v"] for r in kept.collect()}
    assert result[0] == 999 and len(result) == 2001
    plan = kept._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning", 1)[1]
    assert "row_number(), 1, Partial" in below, plan


def test_price_expressions(spark):
    rows = [
        (1, 9.0, 10.0, 2.0),
        (2, None, 10.0, 2.0),
        (3, None, 10.0, 0.0),
        (4, None, 10.0, None),
        (5, None, None, 2.0),
    ]
    df = spark.createDataFrame(rows, "n int, given double, raw double, factor double")
    out = df.select("n", adjusted_close("given", "raw", "factor").alias("a"), adjusted_close("given", "raw", "factor", True).alias("b"))
    assert [(r["a"], r["b"]) for r in out.orderBy("n").collect()] == [
        (9.0, 9.0),
        (5.0, 5.0),
        (None, 10.0),
        (None, 10.0),
        (None, None),
    ]
    df = spark.createDataFrame([(1, 2.0, 1.0), (2, 2.0, 0.0), (3, 2.0, -1.0), (4, None, 1.0), (5, 2.0, None)], "n int, c double, p double")
    out = df.select("n", yoy_growth("c", "p").alias("g"), percent_return("c", "p").alias("r")).orderBy("n").collect()
    assert [r["g"] for r in out] == [1.0, None, None, None, None]
    assert [r["r"] for r in out] == [100.0, None, -300.0, None, None]


def test_three_valued_and_strict_tolerance(spark):
    rows = [
        (1, 100.0, 100.0, 100.0, 1),
        (2, 100.0, 100.0, 103.0, 1),
        (3, 100.0, 0.0, 100.0, 1),
        (4, None, 100.0, 100.0, 1),
        (5, 100.0, 100.0, 100.0, None),
    ]
    df = spark.createDataFrame(rows, "n int, a double, b double, c double, r int")
    out = df.select(
        cluster_flag("a", "b", "c", 0.98, 1.02, ["r"]).alias("x"),
        strict_cluster_flag("a", "b", "c", 0.98, 1.02, ["r"]).alias("y"),
        cluster_ratio("a", "b", "c").alias("ratio"),
        "n",
    )
    got = out.orderBy("n").collect()
    assert [r["x"] for r in got] == [True, False, False, None, None]
    assert [r["y"] for r in got] == [True, False, False, False, False]
    assert got[1]["ratio"] == pytest.approx(3 / 101) and got[3]["ratio"] is None


def test_trading_week_ends(spark):
    weeks = {r[0]: r[1] for r in calendar.trading_weeks(spark).collect()}
    assert weeks[D(2026, 6, 1)] == D(2026, 6, 5)
    assert weeks[D(2026, 6, 29)] == D(2026, 7, 2)
    assert weeks[D(2024, 3, 25)] == D(2024, 3, 28)  # Good Friday
    assert weeks[D(2001, 9, 10)] == D(2001, 9, 10)
    days = spark.createDataFrame([(D(2026, 6, 4),), (D(2026, 6, 5),), (D(2026, 7, 3),), (D(2026, 7, 2),)], "d date")
    marked = {r["d"]: r["is_official_week_end"] for r in calendar.mark_official_week_ends(days, "d").collect()}
    assert marked == {D(2026, 6, 4): False, D(2026, 6, 5): True, D(2026, 7, 3): False, D(2026, 7, 2): True}


def test_holidays_of_known_years(spark):
    # Published closures of 2021 (no observed New Year's Day 2022) and 2022 (first Juneteenth).
    closed = [
        "2021-01-01", "2021-01-18", "2021-02-15", "2021-04-02", "2021-05-31", "2021-07-05", "2021-09-06", "2021-11-25",
        "2021-12-24", "2022-01-17", "2022-02-21", "2022-04-15", "2022-05-30", "2022-06-20", "2022-07-04", "2022-09-05",
        "2022-11-24", "2022-12-26",
    ]
    span = spark.createDataFrame([(D(2021, 1, 1), D(2022, 12, 31))], "a date, b date")
    sessions = {r[0] for r in calendar.sessions_between(span, "a", "b").collect()}
    weekdays = {D(2021, 1, 1) + DAY * i for i in range(730) if (D(2021, 1, 1) + DAY * i).weekday() < 5}
    assert sorted(str(d) for d in weekdays - sessions) == closed


def test_universe_rules_on_the_sample(spark):
    excluded = {
        "BEAG": "BOLD EAGLE ACQUTN CORP -REDH",
        "TESTW": "EXAMPLE WARRANTS",
        "TSTR": "EXAMPLE RIGHTS",
        "TSTU": "EXAMPLE UNITS",
        "SPAC": "BLANK CHECK ACQUISITION CORP",
    }
    kept = {
        "NVDA": "NVIDIA CORP",
        "AMZN": "AMAZON COM INC",
        "META": "META PLATFORMS INC",
        "ADBE": "ADOBE INC",
        "ISRG": "INTUITIVE SURGICAL INC",
        "MEDP": "MEDPACE HOLDINGS INC",
    }
    more = {"U1": "foo unıts", "U2": "éunits", "U3": "Smith Acq. Co", "U4": "acquired"}
    rows = [(t, n, "01") for t, n in {**excluded, **kept, **more}.items()] + [(None, "REDEEMABLE", None)]
    df = universe.annotate_universe(spark.createDataFrame(rows, "ticker string, company_name string, iid string"))
    got = {r["ticker"]: r["exclusion_reason"] for r in df.collect()}
    assert all(got[t] for t in excluded) and not any(got[t] for t in kept)
    assert got["BEAG"] == "redeemable marker; SPAC/acquisition company"
    assert got["U1"] == "unit security" and got["U2"] == "" and got["U4"] == ""
    assert got["U3"] == "SPAC/acquisition company" and got[None] == "redeemable security"


def test_annual_growth_uses_the_previous_available_year(spark):
    rows = [
        ("1", D(2019, 12, 31), 2019, 100.0, None, 10.0),
        ("1", D(2019, 6, 30), 2019, 1.0, None, 1.0),
        ("1", D(2021, 12, 31), 2021, None, 150.0, -5.0),
        ("1", D(2022, 12, 31), 2022, 300.0, None, 5.0),
        (None, D(2022, 12, 31), 2022, 300.0, None, 5.0),
    ]
    raw = spark.createDataFrame(rows, "gvkey string, datadate date, fyear int, sale double, revt double, oiadp double")
    raw = raw.withColumns({c: F.lit("x") for c in ("ticker", "company_name", "currency")}).withColumn("exchange_code", F.lit(14))
    got = growth.annual_growth(raw).orderBy("fyear").collect()
    assert [r["annual_revenue_growth_yoy"] for r in got] == [None, 0.5, 1.0]
    assert [r["annual_operating_income_growth_yoy"] for r in got] == [None, -1.5, None]
    assert [r["annual_rank_desc"] for r in got] == [3, 2, 1]


def test_quarterly_growth_needs_the_same_quarter_one_year_before(spark):
    rows = [("1", D(y, q * 3, 1), y, q, float(v)) for y, q, v in [(2019, 1, 10), (2020, 1, 20), (2022, 1, 80), (2020, 2, 5)]]
    raw = spark.createDataFrame(rows, "gvkey string, datadate date, fyearq int, fqtr int, saleq double")
    raw = raw.withColumns({"revtq": F.lit(None).cast("double"), "oiadpq": F.lit(1.0), "exchange_code": F.lit(14)})
    raw = raw.withColumns({c: F.lit("x") for c in ("ticker", "company_name", "currency")})
    got = {(r["fyearq"], r["fqtr"]): r["quarterly_revenue_growth_yoy"] for r in growth.quarterly_growth(raw).collect()}
    assert got == {(2019, 1): None, (2020, 1): 1.0, (2022, 1): None, (2020, 2): None}


def test_three_growth_semantics_differ_on_a_null_row(spark):
    history = spark.createDataFrame(
        [("1", 2022, D(2022, 1, 1), 0.5, 0.5, 1), ("1", 2021, D(2021, 1, 1), None, 0.5, 2), ("1", 2020, D(2020, 1, 1), 0.5, 0.5, 3)],
        "gvkey string, fyear int, datadate date, annual_revenue_growth_yoy double, annual_operating_income_growth_yoy double, annual_rank_desc int",
    )
    from tickerloom.operators import backtest

    first = growth.recent_growth_flag(history, "annual", 2, 0.1, "flag_a").first()
    assert first["flag_a"] is False and first["annual_revenue_growth_obs"] == 1
    renamed = history.withColumnsRenamed({f"annual_{m}_growth_yoy": f"annual_{m}_growth" for m in ("revenue", "operating_income")})
    assert growth.recent_pass_count(renamed, "annual", 2, 0.1).first()["annual_pass_count"] == 1
    intervals = backtest.point_in_time_passes(renamed, "annual_revenue_growth", "annual_operating_income_growth", [(2, 10)], "ids")
    assert intervals.orderBy(F.desc("valid_from")).first()["ids"] == [0]


def price_rows(spark, days, price=lambda i: 100.0 + i, volume=lambda i: 10.0):
    rows = [
        ("1", "01", d, price(i), None, None, volume(i), "T", "Name", "USD", 1.0, 1.0)
        for i, d in enumerate(days)
    ]
    return spark.createDataFrame(
        rows,
        "gvkey string, iid string, date date, adjusted_close_price double, close_price_raw double, adjustment_factor double, "
        "volume double, ticker string, company_name string, currency string, shares_outstanding double, high_price_raw double",
    )


def test_daily_metrics_warm_up_is_enough_for_the_targets(spark):
    days = [D(2026, 1, 1) + DAY * i for i in range(300)]
    raw = price_rows(spark, days, price=lambda i: 100.0 + (i * 37) % 11, volume=lambda i: 5.0 + i % 7)
    full = daily.daily_history(raw).filter(F.col("date") > days[-6]).orderBy("date")
    window = daily.daily_metrics(raw).orderBy("date")
    assert window.count() == 5
    for a, b in zip(full.collect(), window.collect()):
        assert a.asDict() == pytest.approx(b.asDict())
    last = window.collect()[-1]
    prices = [100.0 + (i * 37) % 11 for i in range(300)]
    assert last["ma100"] == pytest.approx(sum(prices[-100:]) / 100)
    assert last["volume_ma30"] == pytest.approx(sum(5.0 + i % 7 for i in range(269, 299)) / 30)


def test_weekly_metrics_skip_incomplete_weeks_and_exclude_the_current_one(spark):
    days = [D(2026, 6, 1) + DAY * i for i in range(38)]  # to Wednesday 2026-07-08
    days = [d for d in days if d.weekday() < 5 and d != D(2026, 7, 3) and d != D(2026, 6, 19)]
    got = weekly.weekly_metrics(price_rows(spark, days)).orderBy("week_end_date").collect()
    assert [r["week_end_date"] for r in got] == [D(2026, 6, 5), D(2026, 6, 12), D(2026, 6, 18), D(2026, 6, 26), D(2026, 7, 2)]
    closes = [r["weekly_close_price"] for r in got]
    assert [r["wma5"] for r in got][:3] == [None, closes[0], (closes[0] + closes[1]) / 2]


def test_weekly_bar_skips_null_values(spark):
    rows = price_rows(spark, [D(2026, 6, 1), D(2026, 6, 5)])
    raw = rows.withColumn("close_price_raw", F.when(F.col("date") == D(2026, 6, 1), 7.0))
    weeks = calendar.completed_weeks(raw)
    bar = weekly.weekly_bars(raw, weeks).first()
    assert bar["weekly_close_price_raw"] == 7.0 and bar["weekly_close_price"] == 101.0


def test_confirmation_needs_a_later_row(spark):
    df = spark.createDataFrame(
        [("1", "01", D(2026, 1, 1), 1.0), ("1", "01", D(2026, 1, 1), 2.0), ("1", "01", D(2026, 1, 2), 3.0)],
        "gvkey string, iid string, d date, x double",
    )
    got = serving.add_confirmation(df, "d", {"next_d": "d", "next_x": "x"}).collect()
    confirmed = [r for r in got if r["next_d"] is not None]
    assert len(confirmed) == 1 and confirmed[0]["next_d"] == D(2026, 1, 2) and confirmed[0]["next_x"] == 3.0


def test_checks_count_and_raise(spark):
    df = spark.createDataFrame([(1, None), (2, 3), (2, 3)], "a int, b int")
    table = quality.check_table(df, {"b_missing": F.col("b").isNull(), "a_negative": F.col("a") < 0})
    assert {r[0]: r[1] for r in table.collect()} == {"b_missing": 1, "a_negative": 0}
    with pytest.raises(quality.QualityError, match="b_missing=1"):
        quality.require(table)
    assert quality.duplicate_check(df, ["a"], "dup").first()["failures"] == 1
    with pytest.raises(quality.QualityError, match="zz"):
        quality.require_columns(df, ["a", "zz"], "t")
    with pytest.raises(quality.QualityError):
        quality.require_rows(df.filter("a > 5"), "t")


def test_grid_checks(spark):
    from tickerloom.operators.backtest import GridAxes, parameter_frame

    frame = parameter_frame(spark, GridAxes().sets(D(2022, 1, 1)))
    assert {r[0]: r[1] for r in quality.grid_checks(frame, 192).collect()} == {
        "unexpected_grid_size": 0,
        "duplicate_parameter_keys": 0,
    }
    doubled = quality.grid_checks(frame.unionAll(frame), 192)
    assert {r[0]: r[1] for r in doubled.collect()} == {"unexpected_grid_size": 1, "duplicate_parameter_keys": 192}
