"""Stored updates, the run log, and windows that must not drop anything."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickerloom.operators import backtest, calendar, quality, screens, weekly
from tickerloom.sources import ingest, lake, partitions, sinks

D = dt.date


def test_failed_second_rename_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_parquet(spark.range(3), path)
    moves = []

    def rename(a, b):
        moves.append((a, b))
        if len(moves) == 2:
            return False
        import os

        os.rename(a, b)
        return True

    with pytest.raises(sinks.SwapError):
        sinks.replace_table(spark.range(5), path, rename)
    assert spark.read.parquet(path).count() == 3
    sinks.replace_table(spark.read.parquet(path).unionAll(spark.range(2)), path)
    assert spark.read.parquet(path).count() == 5


def test_failed_first_rename_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_parquet(spark.range(3), path)
    with pytest.raises(sinks.SwapError):
        sinks.replace_table(spark.range(5), path, lambda a, b: False)
    assert spark.read.parquet(path).count() == 3


def test_date_window_is_replaced_in_the_store(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(D(2024, 1, d), d) for d in range(1, 8)]
    old = spark.createDataFrame(rows, "date date, v int")
    sinks.write_daily(old, path)
    new = spark.createDataFrame([(D(2024, 1, 3), 30), (D(2024, 1, 5), 50)], "date date, v int")
    sinks.store_date_window(new, path, "2024-01-03", "2024-01-05")
    got = sorted((r["date"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [(D(2024, 1, d), {3: 30, 5: 50}.get(d, d)) for d in (1, 2, 3, 5, 6, 7)]
    with pytest.raises(partitions.ReplaceError, match="outside"):
        sinks.store_date_window(old, path, "2024-01-03", "2024-01-05")
    assert sorted((r["date"], r["v"]) for r in spark.read.parquet(path).collect()) == got


class Moves:
    """Renames that fail, or crash, at one move."""

    def __init__(self, spark, path, fail_at, crash=False):
        self.folder, self.fail_at, self.crash, self.n = partitions.Folder(spark, path), fail_at, crash, 0

    def __call__(self, source, target):
        self.n += 1
        if self.n == self.fail_at:
            if self.crash:
                raise KeyboardInterrupt
            return False
        return self.folder.rename(source, target)


def siblings(path):
    return sorted(p.name for p in Path(path).parent.iterdir())


@pytest.mark.parametrize("crash", [False, True])
@pytest.mark.parametrize("fail_at", [1, 3, 4, 5])
def test_a_window_that_fails_between_moves_is_the_old_one(spark, tmp_path, fail_at, crash):
    """Three folders are set aside and two moved in; the table is whole wherever that ends."""
    path = str(tmp_path / "t")
    rows = [(D(2024, 1, d), d) for d in range(1, 8)]
    sinks.write_daily(spark.createDataFrame(rows, "date date, v int"), path)
    new = spark.createDataFrame([(D(2024, 1, 3), 30), (D(2024, 1, 5), 50)], "date date, v int")
    args = (new, path, "2024-01-03", "2024-01-05")
    with pytest.raises(KeyboardInterrupt if crash else partitions.ReplaceError):
        sinks.store_date_window(*args, rename=Moves(spark, path, fail_at, crash))
    if crash:  # nothing was put back yet
        assert partitions.recover(spark, path) == 1
    assert sorted((r["date"], r["v"]) for r in spark.read.parquet(path).collect()) == rows
    assert siblings(path) == ["t"]
    assert partitions.recover(spark, path) == 0
    assert sinks.store_date_window(*args) == 2
    got = sorted((r["date"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [(D(2024, 1, d), {3: 30, 5: 50}.get(d, d)) for d in (1, 2, 3, 5, 6, 7)]
    assert siblings(path) == ["t"]


def test_a_window_with_a_repeated_or_missing_key_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_daily(spark.createDataFrame([(D(2024, 1, 3), "a")], "date date, k string"), path)
    for bad in ([(D(2024, 1, 3), "b"), (D(2024, 1, 3), "b")], [(D(2024, 1, 3), None)]):
        new = spark.createDataFrame(bad, "date date, k string")
        with pytest.raises(partitions.ReplaceError, match="keys of k, date"):
            sinks.store_date_window(new, path, "2024-01-03", "2024-01-03", keys=["k"])
    assert [r["k"] for r in spark.read.parquet(path).collect()] == ["a"] and siblings(path) == ["t"]
    sinks.store_date_window(new.limit(0), path, "2024-01-03", "2024-01-03")
    assert partitions.Folder(spark, path).partitions(["year", "month", "date"]) == {}


def test_a_rerun_set_without_rows_loses_its_old_ones(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "parameter_set_id long, screen_type string, gvkey string, iid string"
    rows = spark.createDataFrame([(i, "A_F", g, "01") for i in range(1, 5) for g in "ab"], schema)
    sinks.write_sets(rows, path)
    rerun = rows.filter("parameter_set_id = 2 AND gvkey = 'a'")
    with pytest.raises(partitions.ReplaceError):
        sinks.write_sets(rerun, path, [2, 3], rename=Moves(spark, path, 3))
    assert spark.read.parquet(path).count() == 8
    with pytest.raises(partitions.ReplaceError, match="outside"):
        sinks.write_sets(rerun, path, [3])
    sinks.write_sets(rerun, path, [2, 3])
    got = sorted((r["parameter_set_id"], r["gvkey"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, "a"), (1, "b"), (2, "a"), (4, "a"), (4, "b")]
    sinks.write_sets(rerun.limit(0), path, [1])
    assert sorted({r["parameter_set_id"] for r in spark.read.parquet(path).collect()}) == [2, 4]


def test_the_latest_date_comes_from_folder_names(spark, tmp_path):
    path = str(tmp_path / "t")
    columns = ["year", "month", "date"]
    assert partitions.latest_partition(spark, path, columns) is None
    rows = [(D(2023, 12, 30), 1), (D(2024, 1, 2), 2), (None, 3)]
    sinks.write_daily(spark.createDataFrame(rows, "date date, v int"), path)
    assert partitions.latest_partition(spark, path, columns) == "2024-01-02"


def test_runs_are_logged(spark, tmp_path):
    log = str(tmp_path / "runs")
    args = (spark, log, "r", D(2020, 1, 1), D(2021, 1, 1), 3)
    done = backtest.recorded_run(*args, lambda: 17)

    def fail():
        raise ValueError("no prices")

    with pytest.raises(ValueError):
        backtest.recorded_run(*args, fail)
    sinks.append_event(spark, log, backtest.run_event(spark, "open", "r", D(2020, 1, 1), D(2021, 1, 1), 3, "running"))
    got = {r["run_id"]: r for r in backtest.run_log(spark.read.parquet(log)).collect()}
    assert (got[done]["status"], got[done]["outcome_count"], got[done]["error"]) == ("succeeded", 17, None)
    assert got[done]["finished_at"] is not None
    assert got["open"]["status"] == "running" and got["open"]["finished_at"] is None
    failed = [r for r in got.values() if r["status"] == "failed"]
    assert len(failed) == 1 and failed[0]["error"] == "ValueError: no prices"


def test_weeks_without_session_rules_are_an_error(spark):
    rows = spark.createDataFrame([(D(1960, 3, 2),), (D(2001, 3, 2),)], "date date")
    with pytest.raises(Exception, match="no session rules"):
        calendar.completed_weeks(rows).collect()
    with pytest.raises(Exception, match="no session rules"):
        calendar.mark_official_week_ends(rows, "date").collect()
    own = calendar.week_ends(rows, "date")
    assert calendar.completed_weeks(rows, own).count() == 2


def test_repeated_calendar_rows_do_not_double_bars(spark):
    rows = spark.createDataFrame([(D(2001, 3, 2),)], "date date")
    own = calendar.week_ends(rows, "date")
    assert calendar.completed_weeks(rows, own.unionAll(own)).count() == 1


def test_all_failing_checks_are_named(spark):
    checks = spark.createDataFrame([(f"check{i}", 1) for i in range(45)], "check_name string, failures long")
    with pytest.raises(quality.QualityError) as error:
        quality.require(checks)
    assert all(f"check{i}=1" in str(error.value) for i in range(45))


def test_old_start_week_reads_back_far_enough(spark):
    days = [D(2018, 1, 1) + dt.timedelta(d) for d in range(1500)]
    rows = [("1", "01", "T", "N", "USD", d, 10.0 + i % 7, 10.0 + i % 7, 1.0, 100) for i, d in enumerate(days) if d.weekday() < 5]
    raw = spark.createDataFrame(
        rows,
        "gvkey string, iid string, ticker string, company_name string, currency string, date date, close_price_raw double, "
        "adjusted_close_price double, adjustment_factor double, volume long",
    )
    got = weekly.weekly_metrics(raw, start_week="2019-07-01", tiebreak=("volume",))
    first = got.orderBy("week_start_date").first()
    assert first["week_start_date"] == D(2019, 7, 1) and first["wma30"] is not None


def test_report_numbers_every_row(spark, sf_dir):
    from tickerloom.plans.screening import screen

    rows = screen(spark, sf_dir)
    ranks = sorted(r["report_rank"] for r in screens.numbered_screen(rows).collect())
    assert ranks == list(range(1, rows.count() + 1))


def test_year_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(900).select(F.date_add(F.lit(D(2018, 1, 1)), F.col("id").cast("int")).alias("date")).write.parquet(path)
    rows = spark.read.parquet(path)
    for df in (lake.read_dual_layout(rows, rows, 2018), rows.filter(ingest._within_year("date", 2019))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(date" in plan and "LessThan(date" in plan
    assert lake.read_dual_layout(rows, rows, 2018).count() == 900
    assert rows.filter(ingest._within_year("date", 2019)).count() == 365
