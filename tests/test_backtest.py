"""Hand-computed backtest cases: causal dates, fixed horizons, confirmation order."""

import datetime as dt

import pytest

from tickerloom.operators import backtest

D = dt.date
DAILY = (
    "snapshot_date date, gvkey string, iid string, ticker string, company_name string, close_price double, "
    "adjusted_close_price double, volume_ratio double, ma20 double, ma50 double, ma100 double, "
    "future_daily_confirmation_date date, future_daily_close_price double, future_daily_adjusted_close_price double, "
    "future_daily_ma20 double, future_daily_ma50 double, future_daily_ma100 double"
)
WEEKLY = (
    "week_end_date date, gvkey string, iid string, weekly_close_price double, weekly_ma5 double, weekly_ma10 double, "
    "weekly_ma30 double, future_weekly_confirmation_date date, future_weekly_close_price double, future_weekly_ma5 double, "
    "future_weekly_ma10 double, future_weekly_ma30 double"
)
ANNUAL = "gvkey string, datadate date, annual_revenue_growth double, annual_operating_income_growth double"
QUARTERLY = "gvkey string, datadate date, quarterly_revenue_growth double, quarterly_operating_income_growth double"


def daily_row(day, close, ratio, next_day=None, next_close=None, ma=100.0):
    future_ma = None if next_day is None else 100.0
    return (
        day, "1", "01", "TEST", "Test Company", close, close, ratio, ma, ma, ma,
        next_day, next_close, next_close, future_ma, future_ma, future_ma,
    )


def weekly_row(day, close, next_day=None, next_close=None):
    ma = None if next_day is None else 100.0
    return (day, "1", "01", close, 100.0, 100.0, 100.0, next_day, next_close, ma, ma, ma)


def fundamentals(spark):
    annual = [("1", D(2025, 12, 31), 0.1, 0.1), ("1", D(2024, 12, 31), 0.1, 0.1)]
    quarterly = [("1", D(2026, 3, 31), 0.1, 0.1), ("1", D(2025, 12, 31), 0.1, 0.1)]
    return spark.createDataFrame(annual, ANNUAL), spark.createDataFrame(quarterly, QUARTERLY)


def one_set(number, start, end, **changes):
    values = dict(
        annual_growth_pct=2.0,
        quarterly_growth_pct=2.0,
        annual_years=2,
        quarter_count=2,
        volume_ratio_threshold=2.0,
        volume_surge_min_days=1,
        daily_ma_tolerance_pct=1.0,
        weekly_ma_tolerance_pct=2.0,
    )
    return backtest.ParameterSet(number, "case", start, end, **{**values, **changes})


@pytest.fixture(scope="module")
def causal(spark):
    daily = spark.createDataFrame(
        [
            daily_row(D(2026, 5, 26), 100.0, 3.0, D(2026, 5, 27), 105.0),
            daily_row(D(2026, 5, 27), 105.0, 1.0, D(2026, 5, 28), 106.0),
            daily_row(D(2026, 6, 5), 120.0, 1.0, D(2026, 6, 8), 121.0),
            daily_row(D(2026, 6, 8), 121.0, 1.0),
        ],
        DAILY,
    )
    weekly = spark.createDataFrame([weekly_row(D(2026, 5, 29), 108.0, D(2026, 6, 5), 120.0)], WEEKLY)
    return daily, weekly


def test_entry_dates_and_prices_are_causal(spark, causal):
    daily, weekly = causal
    grid = [one_set(2, D(2026, 5, 26), D(2026, 6, 8))]
    selections = backtest.select_signals(daily, weekly, *fundamentals(spark), grid)
    outcomes = {r["screen_type"]: r for r in backtest.price_outcomes(selections, daily).collect()}
    assert set(outcomes) == {"A_F", "A_H"}
    f, h = outcomes["A_F"], outcomes["A_H"]
    assert f["parameter_set_id"] == h["parameter_set_id"] == 2
    assert (f["signal_date"], f["f_confirmation_date"]) == (D(2026, 5, 26), D(2026, 5, 27))
    assert (f["g_confirmation_date"], f["h_confirmation_date"]) == (None, None)
    assert (f["selected_date"], f["selected_price"]) == (D(2026, 5, 27), 105.0)
    assert (f["flag_f"], f["flag_g"], f["flag_h"]) == (True, None, None)
    assert f["return_pct"] == pytest.approx((121 / 105 - 1) * 100)
    assert f["max_drawdown_pct"] == 0
    assert (h["signal_date"], h["f_confirmation_date"]) == (D(2026, 5, 26), D(2026, 5, 27))
    assert (h["g_confirmation_date"], h["h_confirmation_date"]) == (D(2026, 5, 29), D(2026, 6, 5))
    assert (h["selected_date"], h["selected_price"]) == (D(2026, 6, 5), 120.0)
    assert h["return_pct"] == pytest.approx((121 / 120 - 1) * 100)
    for row in (f, h):
        assert [row[f"return_{x}_pct"] for x in ("6m", "1y", "2y")] == [None, None, None]


def test_fixed_horizons_take_the_first_price_on_or_after(spark):
    path = [
        (D(2024, 1, 2), 100.0),
        (D(2024, 7, 1), 105.0),
        (D(2024, 7, 2), 110.0),
        (D(2025, 1, 2), 120.0),
        (D(2026, 1, 2), 150.0),
    ]
    daily = spark.createDataFrame(
        [(d, "1", "01", p, p) for d, p in path],
        "snapshot_date date, gvkey string, iid string, close_price double, adjusted_close_price double",
    )
    selections = spark.createDataFrame(
        [(1, "A_F", D(2024, 1, 2), "1", "01", 100.0)],
        "parameter_set_id long, screen_type string, selected_date date, gvkey string, iid string, selected_price double",
    )
    row = backtest.price_outcomes(selections, daily).first()
    dates = [row[f"return_{h}_date"] for h in ("6m", "1y", "2y")]
    assert dates == [D(2024, 7, 2), D(2025, 1, 2), D(2026, 1, 2)]
    returns = [row[f"return_{h}_pct"] for h in ("6m", "1y", "2y")]
    assert returns == pytest.approx([10, 20, 50])
    assert row["trading_days_after_selection"] == 5


def test_weekly_confirmation_cannot_precede_the_daily_one(spark):
    daily = spark.createDataFrame(
        [daily_row(D(2026, 5, 29), 100.0, 3.0, D(2026, 6, 1), 101.0)], DAILY
    )
    weekly = spark.createDataFrame(
        [
            weekly_row(D(2026, 5, 29), 100.0, D(2026, 6, 5), 110.0),
            weekly_row(D(2026, 6, 5), 110.0, D(2026, 6, 12), 120.0),
        ],
        WEEKLY,
    )
    grid = [one_set(1, D(2026, 5, 29), D(2026, 6, 12))]
    rows = backtest.select_signals(daily, weekly, *fundamentals(spark), grid).collect()
    a_h = [r for r in rows if r["screen_type"] == "A_H"]
    assert len(a_h) == 1
    dates = [a_h[0][f"{x}_confirmation_date"] for x in "fgh"]
    assert dates == [D(2026, 6, 1), D(2026, 6, 5), D(2026, 6, 12)]


def test_a_failing_first_week_leaves_the_security_to_a_later_signal(spark):
    """The week is matched first and tested after: the early signal is dropped, the later one wins."""
    daily = spark.createDataFrame(
        [
            daily_row(D(2026, 5, 26), 100.0, 3.0, D(2026, 5, 27), 101.0),
            daily_row(D(2026, 6, 2), 100.0, 3.0, D(2026, 6, 3), 101.0),
        ],
        DAILY,
    )
    bad = weekly_row(D(2026, 5, 29), 100.0, D(2026, 6, 5), 110.0)
    bad = (*bad[:4], 150.0, *bad[5:])
    weekly = spark.createDataFrame(
        [bad, weekly_row(D(2026, 6, 5), 110.0, D(2026, 6, 12), 120.0)], WEEKLY
    )
    grid = [one_set(1, D(2026, 5, 26), None)]
    rows = backtest.select_signals(daily, weekly, *fundamentals(spark), grid).collect()
    signals = {r["screen_type"]: r["signal_date"] for r in rows}
    assert signals == {"A_F": D(2026, 5, 26), "A_H": D(2026, 6, 2)}


def test_sets_differ_only_where_their_axes_do(spark, causal):
    daily, weekly = causal
    end = D(2026, 6, 8)
    grid = [
        one_set(1, D(2026, 5, 26), end),
        one_set(2, D(2026, 5, 26), end, volume_ratio_threshold=4.0),
        one_set(3, D(2026, 5, 26), end, volume_surge_min_days=2),
        one_set(4, D(2026, 5, 26), end, annual_years=3),
        one_set(5, D(2026, 5, 26), end, quarterly_growth_pct=11.0),
        one_set(6, D(2026, 5, 27), end),
        one_set(7, D(2026, 5, 26), end, weekly_ma_tolerance_pct=3.0),
    ]
    rows = backtest.select_signals(daily, weekly, *fundamentals(spark), grid).collect()
    got = sorted((r["parameter_set_id"], r["screen_type"]) for r in rows)
    assert got == [(1, "A_F"), (1, "A_H"), (7, "A_F"), (7, "A_H")]


def test_point_in_time_skips_null_growth_and_future_filings(spark):
    history = spark.createDataFrame(
        [
            ("1", D(2020, 1, 1), 0.5, 0.5),
            ("1", D(2021, 1, 1), None, 0.5),
            ("1", D(2022, 1, 1), 0.5, 0.5),
            ("1", D(2023, 1, 1), 0.0, 0.5),
        ],
        ANNUAL,
    )
    intervals = backtest.point_in_time_passes(
        history, "annual_revenue_growth", "annual_operating_income_growth", [(2, 10)], "ids"
    )
    days = [D(2019, 6, 1), D(2020, 6, 1), D(2021, 6, 1), D(2022, 1, 1), D(2022, 6, 1), D(2023, 1, 1)]
    signals = spark.createDataFrame([("1", d) for d in days], "gvkey string, d date")
    rows = backtest.in_force(signals, intervals, "d").collect()
    assert {r["d"]: r["ids"] for r in rows} == {
        D(2020, 6, 1): [],
        D(2021, 6, 1): [],
        D(2022, 1, 1): [0],
        D(2022, 6, 1): [0],
        D(2023, 1, 1): [],
    }


def test_default_grid_has_192_named_sets():
    grid = backtest.GridAxes().sets(D(2022, 1, 1))
    assert len(grid) == 192
    assert [p.parameter_set_id for p in grid] == list(range(1, 193))
    assert grid[0].parameter_set_name == "ag2_qg2_ay2_qc2_vr2_vd2"
    assert len({p.parameter_set_name for p in grid}) == 192


def test_zero_entry_price_has_no_return(spark):
    daily = spark.createDataFrame(
        [(D(2024, 1, 2), "1", "01", 0.0, None), (D(2024, 1, 3), "1", "01", 5.0, None)],
        "snapshot_date date, gvkey string, iid string, close_price double, adjusted_close_price double",
    )
    selections = spark.createDataFrame(
        [(1, "A_F", D(2024, 1, 2), "1", "01", 0.0)],
        "parameter_set_id long, screen_type string, selected_date date, gvkey string, iid string, selected_price double",
    )
    row = backtest.price_outcomes(selections, daily).first()
    assert row["return_pct"] is None
    assert (row["high_price"], row["high_price_date"]) == (5.0, D(2024, 1, 3))
    assert row["latest_adjusted_price"] is None
