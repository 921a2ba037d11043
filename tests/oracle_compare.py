"""Compare Spark queries with their SQL counterparts: columns, types, rows and values."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def kind(value) -> str:
    return type(value).__name__


def compare(spark, con, sf_dir: str, name: str, run, sql: str | None) -> tuple[str, float, float, int]:
    """Result text ("ok" when equal), Spark and SQL seconds, rows."""
    started = time.time()
    df = run(spark, sf_dir)
    ours = [tuple(r) for r in df.collect()]
    spark_seconds = time.time() - started
    columns = df.columns
    if sql is None:
        return "rows only", spark_seconds, 0.0, len(ours)
    started = time.time()
    cursor = con.execute(sql)
    theirs_columns = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    sql_seconds = time.time() - started
    result = _difference(columns, ours, theirs_columns, theirs)
    return result, spark_seconds, sql_seconds, len(ours)


def _difference(columns, ours, theirs_columns, theirs) -> str:
    if sorted(columns) != sorted(theirs_columns):
        return f"columns differ: {sorted(set(columns) ^ set(theirs_columns))}"
    pick = [theirs_columns.index(c) for c in columns]
    theirs = [tuple(r[i] for i in pick) for r in theirs]
    if len(ours) != len(theirs):
        return f"row counts differ: {len(ours)} / {len(theirs)}"
    order = lambda r: tuple((v is not None, str(v)) for v in r)
    ours, theirs = sorted(ours, key=order), sorted(theirs, key=order)
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if bad:
        a, b = bad[0]
        cells = [(c, x, y) for c, x, y in zip(columns, a, b) if x != y]
        return f"{len(bad)} of {len(ours)} rows differ, first: {cells}"
    for i, c in enumerate(columns):
        kinds = {kind(r[i]) for r in ours if r[i] is not None} | {kind(r[i]) for r in theirs if r[i] is not None}
        if len(kinds) > 1:
            return f"types of {c} differ: {kinds}"
    return "ok" if ours else "ok (empty)"
