"""Sources and sinks on small fixtures."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickerloom.operators.backtest import PARAMETER_KEY, GridAxes, parameter_frame
from tickerloom.operators.screens import parameter_tag
from tickerloom.sources import ingest, lake, sinks
from tickerloom.sources.workspace import materialize, workspace

D = dt.date


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_upsert_updates_inserts_and_preserves(spark):
    target = spark.createDataFrame([(1, "a", "c1"), (2, "b", "c1")], "k int, v string, created_at string")
    updates = spark.createDataFrame([(2, None, "c2"), (3, "d", "c2")], "k int, v string, created_at string")
    assert rows_of(sinks.upsert(target, updates, ["k"]), "k") == [(1, "a", "c1"), (2, None, "c1"), (3, "d", "c2")]


def test_upsert_keeps_columns_the_updates_lack(spark):
    target = spark.createDataFrame([(1, "a", 7)], "k int, v string, w int")
    updates = spark.createDataFrame([(1, "z"), (2, "y")], "k int, v string")
    assert rows_of(sinks.upsert(target, updates, ["k"]), "k") == [(1, "z", 7), (2, "y", None)]


def test_replace_table_may_read_the_table_it_replaces(spark):
    path = f"{workspace(spark)}/t"
    sinks.write_parquet(spark.range(3), path)
    stored = spark.read.parquet(path)
    sinks.replace_table(stored.select((F.col("id") + 10).alias("id")), path)
    assert rows_of(spark.read.parquet(path), "id") == [(10,), (11,), (12,)]
    siblings = [p.name for p in Path(path.removeprefix("file:")).parent.iterdir()]
    assert siblings == ["t"]


def test_parameter_upsert_keeps_known_ids_and_continues_numbering(spark):
    axes = GridAxes((2,), (2,), (2,), (2,), (2, 3), (2,))
    target = parameter_frame(spark, axes.sets(D(2022, 1, 1)))
    wider = parameter_frame(spark, GridAxes((2,), (2,), (2,), (2,), (4, 3, 2), (2,)).sets(D(2023, 1, 1)))
    got = sinks.upsert_parameters(target, wider, PARAMETER_KEY)
    ids = {r["volume_ratio_threshold"]: (r["parameter_set_id"], r["start_date"]) for r in got.collect()}
    assert ids == {2.0: (1, D(2023, 1, 1)), 3.0: (2, D(2023, 1, 1)), 4.0: (3, D(2023, 1, 1))}


def test_replace_date_window_with_nothing_new_keeps_the_target(spark):
    target = spark.createDataFrame([(D(2026, 1, 1), 1)], "d date, v int")
    assert rows_of(sinks.replace_date_window(target, target.limit(0), "d"), "d") == [(D(2026, 1, 1), 1)]


def test_partitions_are_replaced_one_by_one(spark):
    path = f"{workspace(spark)}/daily"
    first = spark.createDataFrame([(D(2026, 1, 30), 1), (D(2026, 2, 2), 2)], "date date, v int")
    sinks.write_daily(first, path)
    sinks.write_daily(spark.createDataFrame([(D(2026, 2, 2), 9)], "date date, v int"), path)
    assert rows_of(spark.read.parquet(path).select("date", "v"), "date") == [(D(2026, 1, 30), 1), (D(2026, 2, 2), 9)]
    assert (Path(path.removeprefix("file:")) / "year=2026" / "month=02" / "date=2026-02-02").is_dir()


def test_dual_layout_counts_an_overlap_once(spark):
    yearly = spark.createDataFrame([(D(2025, 12, 31), 1), (D(2026, 1, 2), 99)], "date date, v int")
    dated = spark.createDataFrame([(D(2026, 1, 2), 2, "x"), (D(2025, 12, 31), 98, "x")], "date date, v int, extra string")
    assert rows_of(lake.read_dual_layout(yearly, dated, 2025), "date") == [(D(2025, 12, 31), 1, None), (D(2026, 1, 2), 2, "x")]


def test_merge_by_name_and_provenance(spark):
    folder = workspace(spark)
    sinks.write_parquet(spark.createDataFrame([(1, 2)], "a int, b int"), f"{folder}/p1")
    sinks.write_parquet(spark.createDataFrame([(3, 4)], "c int, a int"), f"{folder}/p2")
    df = lake.read_parquet(spark, f"{folder}/p1", f"{folder}/p2", provenance=True)
    assert rows_of(df.select("a", "b", "c"), F.coalesce("a", F.lit(9))) == [(1, 2, None), (4, None, 3)]
    assert all(p[0].endswith(".parquet") for p in df.select("source_path").collect())


def test_screen_outputs(spark):
    rows = spark.createDataFrame([("A", False, ""), ("B", True, "unit security")], "ticker string, is_excluded_universe boolean, exclusion_reason string")
    summary = spark.createDataFrame([("rows", 2, 1)], "measure string, before_filter int, after_filter int")
    folder = f"{workspace(spark)}/{parameter_tag(10, 3, 4, 2.5, 3)}"
    sinks.write_screen(rows, summary, folder, unfiltered_audit=True)
    assert folder.endswith("n10_annual3_quarter4_q2.5_m3")
    assert spark.read.parquet(f"{folder}/screening_results.parquet").count() == 1
    assert spark.read.option("header", True).csv(f"{folder}/excluded_universe/excluded_universe.csv").first()["ticker"] == "B"
    assert spark.read.parquet(f"{folder}/unfiltered/screening_results_unfiltered.parquet").count() == 2


def test_export_writes_iso_dates_and_nulls(spark):
    folder = workspace(spark)
    sinks.export_table(spark.createDataFrame([(1, D(2026, 1, 2), None)], "n int, d date, x double"), folder, "t")
    lines = [x for p in Path(f"{folder}/t.json".removeprefix("file:")).glob("part-*") for x in p.read_text().splitlines()]
    assert json.loads(lines[0]) == {"n": 1, "d": "2026-01-02", "x": None}


def test_freshness_flags_a_stale_layer(spark):
    a = spark.createDataFrame([(D(2026, 1, 2), "1"), (D(2026, 1, 2), "2"), (D(2026, 1, 1), "3")], "date date, gvkey string")
    b = a.filter("gvkey = '3'")
    got = {r["layer"]: r for r in lake.freshness({"vendor": a, "raw": b}).collect()}
    assert (got["vendor"]["row_count"], got["vendor"]["up_to_date"]) == (2, True)
    assert (got["raw"]["latest_date"], got["raw"]["up_to_date"]) == (D(2026, 1, 1), False)


def test_ingest_year_is_bounded_at_today(spark):
    base = {c: None for c in ingest.DAILY_COLUMNS}
    rows = [
        {**base, "datadate": d, "gvkey": "1", "iid": "01", "exchg": 14, "secstat": "A", "tpci": "0", "prccd": 8.0, "cshtrd": 5.0, "ajexdi": f}
        for d, f in [(D(2026, 1, 5), 2.0), (D(2026, 3, 5), None), (D(2026, 9, 5), 1.0)]
    ]
    types = {"datadate": "date", "exchg": "int", "prccd": "double", "cshtrd": "double", "ajexdi": "double"}
    schema = ", ".join(f"{c} {types.get(c, 'string')}" for c in ingest.DAILY_COLUMNS)
    secd = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    got = ingest.ingest_year(secd, 2026, today=D(2026, 6, 1)).orderBy("date").collect()
    assert [(r["date"], r["adjusted_close_price"]) for r in got] == [(D(2026, 1, 5), 4.0), (D(2026, 3, 5), 8.0)]
    assert ingest.ingest_year(secd, 2026, today=D(2027, 1, 1)).count() == 3


def test_workspace_follows_the_session_setting(spark):
    assert workspace(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    back = materialize(spark.range(5), "five")
    assert back.count() == 5 and "Range" not in back._jdf.queryExecution().toString()


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master = "yarn"

    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace(Session())


def test_all_screen_outputs_come_from_one_run_of_the_screen(spark, sf_dir, monkeypatch):
    from __spark_entry__ import queries

    write, plans = sinks.write_screen, []

    def seen(annotated, summary, *args, **kwargs):
        plans.extend(df._jdf.queryExecution().executedPlan().toString() for df in (annotated, summary))
        write(annotated, summary, *args, **kwargs)

    monkeypatch.setattr(sinks, "write_screen", seen)
    counts = {r["output"]: r["row_count"] for r in queries()["s20_screen_outputs"](spark, sf_dir).collect()}
    assert counts["unfiltered"] == counts["parquet"] + counts["excluded"] > 0
    assert plans and not [p for p in plans if "Join" in p], plans
