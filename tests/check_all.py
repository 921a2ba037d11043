"""Run registered queries against their oracles: ``python tests/check_all.py SF_DIR [NAME_PART ...]``."""

from __future__ import annotations

import sys
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tests.oracle_compare import compare, duck  # noqa: E402


def main() -> int:
    sf_dir, parts = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, oracles, failed = duck(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if parts and not any(p in name for p in parts):
            continue
        try:
            result, ours, theirs, rows = compare(spark, con, sf_dir, name, run, oracles.get(name))
        except Exception as error:  # report and go on
            lines = [x for x in str(error).splitlines() if x.strip()]
            result, ours, theirs, rows = f"ERROR {type(error).__name__}: {' '.join(lines[:4])[:600]}", 0, 0, 0
            if "-v" in sys.argv:
                traceback.print_exc()
        failed += not result.startswith(("ok", "rows only"))
        print(f"{name:42s} {rows:8d} rows  spark {ours:6.2f}s  sql {theirs:6.2f}s  {result}", flush=True)
    print(f"failed: {failed}")
    return failed


if __name__ == "__main__":
    sys.exit(main() > 0)
