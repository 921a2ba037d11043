"""Queries of the source and sink layer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import SECURITY
from ..operators import quality, refresh, screens, universe
from ..sources import ingest, lake, sinks
from ..sources.workspace import materialize, workspace
from . import tables as t
from .layers import DAILY_AVERAGES, layer, layer_path, rows_of, unstored, view_daily, view_weekly, with_daily_ratios
from .oracle import BT_END, BT_START, RAW_ORDER, daily_sql, weekly_bars_sql, weekly_sql
from .registry import query
from .screening import KNOBS, _ANNOTATED, _SUMMARY, master, screen

# --- reads ----------------------------------------------------------------------------


@query(
    "s01_read_union_by_name",
    "l_orderkey o_orderkey l_linenumber:int o_totalprice",
    "SELECT * FROM (SELECT * FROM lineitem UNION ALL BY NAME SELECT * FROM orders)",
)
def _(spark, sf):
    return lake.read_parquet(spark, f"{sf}/lineitem.parquet", f"{sf}/orders.parquet")


@query("s02_read_table", "s_suppkey s_name s_nationkey:int s_acctbal", "supplier")
def _(spark, sf):
    return lake.read_parquet(spark, f"{sf}/supplier.parquet", merge=False)


@query(
    "s08_row_provenance",
    "file_name row_count",
    "SELECT 'lineitem.parquet' AS file_name, count(*) AS row_count FROM lineitem",
)
def _(spark, sf):
    rows = lake.read_parquet(spark, f"{sf}/lineitem.parquet", provenance=True)
    name = F.element_at(F.split("source_path", "/"), -1)
    return rows.groupBy(name.alias("file_name")).agg(F.count("*").alias("row_count"))


_RAW_COLUMNS = "date gvkey iid ticker volume close_price_raw adjusted_close_price"


def _window_sql(condition: str) -> str:
    return f"SELECT * FROM raw WHERE {condition}"


def _dated(spark, sf):
    """The raw rows in date partitions; bounds of windows come from the names of their folders."""
    return lake.DatedTable(spark, layer_path(spark, sf, "raw_dated"))


@query(
    "s04_target_window",
    _RAW_COLUMNS,
    _window_sql(
        "date BETWEEN (SELECT min(date) - 250 FROM target_dates) AND (SELECT max(date) FROM target_dates)"
    ),
)
def _(spark, sf):
    return _dated(spark, sf).target_window()


@query("s05_weekly_window", _RAW_COLUMNS, _window_sql("date >= (SELECT max(date) FROM raw) - 500"))
def _(spark, sf):
    return _dated(spark, sf).week_window()


@query(
    "s06_backtest_window",
    _RAW_COLUMNS,
    _window_sql(f"date BETWEEN DATE '{BT_START}' - 420 AND DATE '{BT_END}'"),
)
def _(spark, sf):
    return _dated(spark, sf).backtest_window(dt.date.fromisoformat(BT_START), dt.date.fromisoformat(BT_END))


@query("s07_lookback_window", _RAW_COLUMNS, _window_sql("date >= (SELECT max(date) FROM raw) - INTERVAL 3 MONTH"))
def _(spark, sf):
    return _dated(spark, sf).lookback_window(3)


@query(
    "s03_dual_layout",
    "year_value:int row_count total_volume",
    "SELECT year(date) AS year_value, count(*) AS row_count, sum(volume) AS total_volume FROM raw GROUP BY ALL",
)
def _(spark, sf):
    """Yearly files up to 1998 and date partitions from 1998 on; the overlap must not count twice."""
    raw = t.prices(spark, sf)
    folder = workspace(spark)
    old = raw.filter(F.year("date") <= 1998).withColumn("file_year", F.year("date"))
    sinks.write_partitions(old, f"{folder}/yearly", ["file_year"])
    sinks.write_daily(raw.filter(F.year("date") >= 1998), f"{folder}/dated")
    yearly = lake.read_parquet(spark, f"{folder}/yearly", schema=old.schema).drop("file_year")
    dated = lake.read_parquet(spark, f"{folder}/dated", merge=False).drop("year", "month")
    both = lake.read_dual_layout(yearly, dated, 1998)
    return both.groupBy(F.year("date").alias("year_value")).agg(
        F.count("*").alias("row_count"), F.sum("volume").alias("total_volume")
    )


# --- ingest ---------------------------------------------------------------------------

INGEST_COLUMNS = (
    "date gvkey iid ticker company_name exchange_code:int security_status issue_type_code close_price_raw volume "
    "adjustment_factor adjusted_close_price data_source"
)


@query(
    "s09_latest_trading_dates",
    "datadate",
    "SELECT DISTINCT date AS datadate FROM ingested ORDER BY datadate DESC LIMIT 10",
)
def _(spark, sf):
    return ingest.latest_trading_dates(t.vendor_daily(spark, sf), 10)


@query(
    "s09_ingest_latest_dates",
    INGEST_COLUMNS,
    "SELECT * FROM ingested WHERE date IN (SELECT DISTINCT date FROM ingested ORDER BY date DESC LIMIT 10)",
)
def _(spark, sf):
    return ingest.ingest_latest(t.vendor_daily(spark, sf), 10)


@query("s10_ingest_date", INGEST_COLUMNS, "SELECT * FROM ingested WHERE date = DATE '1998-06-03'")
def _(spark, sf):
    return ingest.ingest_date(t.vendor_daily(spark, sf), dt.date(1998, 6, 3))


@query("s11_ingest_year", INGEST_COLUMNS, "SELECT * FROM ingested WHERE year(date) = 1999")
def _(spark, sf):
    return ingest.ingest_year(t.vendor_daily(spark, sf), 1999)


@query("s12_normalised_daily", INGEST_COLUMNS, "ingested")
def _(spark, sf):
    return ingest.normalise_daily(ingest.daily_rows(t.vendor_daily(spark, sf)))


@query(
    "s13_j15_ingest_annual",
    "gvkey datadate fyear:int ticker company_name currency sale revt oiadp",
    "SELECT * FROM raw_annual WHERE fyear >= 1997 AND indfmt = 'INDL' AND consol = 'C' AND popsrc = 'D' AND datafmt = 'STD' "
    "AND gvkey IN (SELECT gvkey FROM active)",
)
def _(spark, sf):
    return ingest.ingest_annual(t.vendor_annual(spark, sf), t.vendor_daily(spark, sf), 1997)


@query(
    "s14_ingest_quarterly",
    "gvkey datadate fyearq:int fqtr:int ticker company_name currency saleq revtq oiadpq",
    "SELECT * FROM raw_quarterly WHERE datadate >= DATE '1998-01-01' AND indfmt = 'INDL' AND consol = 'C' AND popsrc = 'D' "
    "AND datafmt = 'STD' AND gvkey IN (SELECT gvkey FROM active)",
)
def _(spark, sf):
    return ingest.ingest_quarterly(t.vendor_quarterly(spark, sf), t.vendor_daily(spark, sf), "1998-01-01")


# Archived source: names change every year, a third of the securities have a further name without
# an end beside them, and a name record can fail the listing filters.
_NAMES = """
SELECT l_suppkey AS permno, make_date(CAST(y AS INTEGER), 1, 1) AS namedt, make_date(CAST(y AS INTEGER), 12, 31) AS nameenddt,
  'N' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(y AS VARCHAR) AS ticker, CASE WHEN lowest_tax = 0 THEN 3 ELSE 1 END AS exchcd,
  CASE WHEN lowest_discount = 0 THEN 10 ELSE 12 END AS shrcd
FROM (SELECT l_suppkey, year(l_shipdate) AS y, min(l_tax) AS lowest_tax, min(l_discount) AS lowest_discount FROM lineitem GROUP BY ALL)
UNION ALL SELECT DISTINCT l_suppkey, DATE '1996-06-15', NULL, 'X' || CAST(l_suppkey AS VARCHAR), 3, 10 FROM lineitem WHERE l_suppkey % 3 = 0"""


def _archive(spark, sf):
    line = t.table(spark, sf, "lineitem")
    prices = line.select(
        F.col("l_suppkey").alias("permno"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("prc"),
        F.col("l_quantity").alias("vol"),
    )
    stats = line.groupBy("l_suppkey", F.year("l_shipdate").alias("y")).agg(
        F.min("l_tax").alias("lowest_tax"), F.min("l_discount").alias("lowest_discount")
    )
    names = stats.select(
        F.col("l_suppkey").alias("permno"),
        F.make_date("y", F.lit(1), F.lit(1)).alias("namedt"),
        F.make_date("y", F.lit(12), F.lit(31)).alias("nameenddt"),
        F.concat(F.lit("N"), F.col("l_suppkey"), F.lit("-"), F.col("y")).alias("ticker"),
        F.when(F.col("lowest_tax") == 0, 3).otherwise(1).alias("exchcd"),
        F.when(F.col("lowest_discount") == 0, 10).otherwise(12).alias("shrcd"),
    )
    other = line.filter(F.col("l_suppkey") % 3 == 0).select(
        F.col("l_suppkey").alias("permno"),
        F.lit("1996-06-15").cast("date").alias("namedt"),
        F.lit(None).cast("date").alias("nameenddt"),
        F.concat(F.lit("X"), F.col("l_suppkey")).alias("ticker"),
        F.lit(3).alias("exchcd"),
        F.lit(10).alias("shrcd"),
    )
    return prices, names.unionByName(other.distinct())


@query(
    "s15_ingest_archive",
    "permno date prc vol ticker exchcd:int shrcd:int",
    f"SELECT l_suppkey AS permno, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS prc, l_quantity AS vol, n.ticker, n.exchcd, n.shrcd "
    f"FROM lineitem JOIN ({_NAMES}) n ON l_suppkey = n.permno AND CAST(l_shipdate AS DATE) BETWEEN namedt AND coalesce(nameenddt, DATE '9999-12-31') "
    "WHERE year(l_shipdate) = 1997 AND exchcd = 3 AND shrcd IN (10, 11)",
)
def _(spark, sf):
    return ingest.ingest_archive(*_archive(spark, sf), 1997)


@query(
    "j13_names_in_force",
    "permno date ticker row_count",
    f"SELECT l_suppkey AS permno, CAST(l_shipdate AS DATE) AS date, n.ticker, count(*) AS row_count FROM lineitem JOIN ({_NAMES}) n "
    "ON l_suppkey = n.permno AND CAST(l_shipdate AS DATE) BETWEEN namedt AND coalesce(nameenddt, DATE '9999-12-31') GROUP BY ALL",
)
def _(spark, sf):
    rows = ingest.with_names_in_force(*_archive(spark, sf))
    return rows.groupBy("permno", "date", "ticker").agg(F.count("*").alias("row_count"))


@query(
    "s16_ingest_archive_v2",
    "permno date prc vol",
    "SELECT l_suppkey AS permno, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS prc, l_quantity AS vol FROM lineitem "
    "WHERE year(l_shipdate) = 1998 AND l_linestatus = 'O' AND l_returnflag = 'A' AND l_tax > 0 AND l_discount > 0",
)
def _(spark, sf):
    line = t.table(spark, sf, "lineitem")
    prices = line.select(
        F.col("l_suppkey").alias("permno"),
        F.col("l_shipdate").cast("date").alias("dlycaldt"),
        F.col("l_extendedprice").alias("dlyprc"),
        F.col("l_quantity").alias("dlyvol"),
        F.when(F.col("l_linestatus") == "O", "Q").otherwise("N").alias("primaryexch"),
        F.when(F.col("l_returnflag") == "A", "NS").otherwise("SB").alias("sharetype"),
        F.when(F.col("l_tax") > 0, "EQTY").otherwise("FUND").alias("securitytype"),
        F.when(F.col("l_discount") > 0, "COM").otherwise("ETF").alias("securitysubtype"),
    )
    return ingest.ingest_archive_v2(prices, 1998)


# --- writes ---------------------------------------------------------------------------


@query(
    "s17_write_daily_partitions",
    "year:int month:int date row_count",
    "SELECT year(date) AS year, month(date) AS month, date, count(*) AS row_count FROM daily GROUP BY ALL",
)
def _(spark, sf):
    path = f"{workspace(spark)}/daily"
    sinks.write_daily(layer(spark, sf, "daily"), path)
    rows = lake.read_parquet(spark, path, merge=False)
    return rows.groupBy("year", "month", "date").agg(F.count("*").alias("row_count"))


@query(
    "s18_replace_week_partitions",
    "week_start_date row_count revised:long",
    "SELECT week_start_date, count(*) AS row_count, count(*) FILTER (WHERE week_start_date IN (SELECT DISTINCT week_start_date "
    "FROM weekly ORDER BY 1 DESC LIMIT 8)) AS revised FROM weekly GROUP BY ALL",
)
def _(spark, sf):
    """All weeks, then the latest eight again: only those partitions are replaced."""
    from ..operators.weekly import latest_weeks

    path = f"{workspace(spark)}/weekly"
    rows = layer(spark, sf, "weekly").withColumn("revision", F.lit(0))
    sinks.write_weekly(rows, path)
    latest = rows.join(F.broadcast(latest_weeks(rows, 8)), "week_start_date", "left_semi")
    sinks.write_weekly(latest.withColumn("revision", F.lit(1)), path)
    stored = lake.read_parquet(spark, path, merge=False)
    return stored.groupBy("week_start_date").agg(
        F.count("*").alias("row_count"), F.sum("revision").alias("revised")
    )


@query(
    "s19_split_yearly_file",
    "date row_count",
    "SELECT date, count(*) AS row_count FROM raw WHERE year(date) = 2000 GROUP BY ALL",
)
def _(spark, sf):
    folder = workspace(spark)
    sinks.write_parquet(t.prices(spark, sf).filter(F.year("date") == 2000), f"{folder}/year_2000")
    sinks.split_yearly_file(spark, f"{folder}/year_2000", f"{folder}/dated")
    rows = lake.read_parquet(spark, f"{folder}/dated", merge=False)
    return rows.groupBy("date").agg(F.count("*").alias("row_count"))


_OUTPUTS = ("parquet", "csv", "excluded", "excluded_csv", "unfiltered", "unfiltered_csv")


@query(
    "s20_screen_outputs",
    "output row_count excluded_rows:long volume:float",
    " UNION ALL ".join(
        f"SELECT '{o}' AS output, count(*) AS row_count, count(*) FILTER (WHERE excluded) AS excluded_rows, sum(volume) AS volume FROM {_ANNOTATED}"
        + (" WHERE excluded" if o.startswith("excluded") else "" if o.startswith("unfiltered") else " WHERE NOT excluded")
        for o in _OUTPUTS
    )
    + f" UNION ALL SELECT 'summary', sum(before_filter)::BIGINT, sum(before_filter - after_filter)::BIGINT, NULL FROM ({_SUMMARY})",
)
def _(spark, sf):
    """All outputs of the screen, the unfiltered audit included, read back."""
    tag = screens.parameter_tag(**KNOBS)
    folder = f"{workspace(spark)}/{tag}"
    # All outputs and the summary come from one run of the screen.
    rows = materialize(universe.annotate_universe(screen(spark, sf)), "screen", folder)
    sinks.write_screen(rows, universe.universe_summary(rows), folder, unfiltered_audit=True)
    paths = ("screening_results", "excluded_universe/excluded_universe", "unfiltered/screening_results_unfiltered")
    tables = [f for p in paths for f in (spark.read.parquet(f"{folder}/{p}.parquet"), spark.read.option("header", True).csv(f"{folder}/{p}.csv"))]
    excluded = F.count_if(F.col("is_excluded_universe").cast("boolean"))
    out = spark.read.json(f"{folder}/screening_summary.json").select(
        F.lit("summary").alias("output"),
        F.sum("before_filter").alias("row_count"),
        F.sum(F.col("before_filter") - F.col("after_filter")).alias("excluded_rows"),
        F.lit(None).cast("double").alias("volume"),
    )
    for name, df in zip(_OUTPUTS, tables, strict=True):
        counts = df.agg(F.count(F.lit(1)).alias("row_count"), excluded.alias("excluded_rows"), F.sum(F.col("volume").cast("double")).alias("volume"))
        out = out.unionByName(counts.withColumn("output", F.lit(name)))
    return out


@query(
    "o04_stored_order",
    "week_start_date gvkey iid place:int",
    "SELECT week_start_date, gvkey, iid, row_number() OVER (PARTITION BY week_start_date ORDER BY gvkey, iid) AS place FROM weekly",
)
def _(spark, sf):
    """The place of each row in its week's stored file: rows are written in the order of their keys."""
    path = f"{workspace(spark)}/weekly"
    sinks.write_weekly(layer(spark, sf, "weekly"), path)
    stored = lake.read_parquet(spark, path, merge=False)
    return stored.withColumn("place", F.col("_metadata.row_index") + 1)


_LOADS = {
    "daily": ("date", "gvkey", "iid", "adjusted_close_price", "cusip"),
    "weekly": ("week_start_date", "week_end_date", "gvkey", "iid"),
    "future": ("date", "cusip", "cik"),
}


@query(
    "q05_load_checks",
    "check_name failures",
    "SELECT 'daily_missing_columns' AS check_name, 1 AS failures UNION ALL SELECT 'daily_empty', (SELECT count(*) = 0 FROM daily)::BIGINT "
    "UNION ALL SELECT 'weekly_missing_columns', 0 UNION ALL SELECT 'weekly_empty', (SELECT count(*) = 0 FROM weekly)::BIGINT "
    "UNION ALL SELECT 'future_missing_columns', 2 UNION ALL SELECT 'future_empty', (SELECT count(*) = 0 FROM daily WHERE date > DATE '2005-01-01')::BIGINT",
)
def _(spark, sf):
    """Loads that are complete, lack columns, and have no rows."""
    daily = rows_of(spark, sf, "daily")
    loads = {"daily": daily, "weekly": rows_of(spark, sf, "weekly"), "future": daily.filter("date > DATE'2005-01-01'")}
    return quality.load_checks(loads, _LOADS)


@query("s21_zstd_round_trip", "gvkey fyear:int annual_rank_desc:int", "annual")
def _(spark, sf):
    path = f"{workspace(spark)}/annual"
    sinks.write_parquet(layer(spark, sf, "annual"), path)
    return lake.read_parquet(spark, path, merge=False)


@query(
    "s22_upsert_by_key",
    "gvkey iid last_seen_date source created_at",
    "SELECT gvkey, iid, last_seen_date, CASE WHEN CAST(gvkey AS BIGINT) % 2 = 0 THEN 'new' ELSE 'old' END AS source, "
    "CASE WHEN CAST(gvkey AS BIGINT) % 4 = 0 THEN 'second load' ELSE 'first load' END AS created_at FROM master",
)
def _(spark, sf):
    """Matched keys take the new values but keep ``created_at``; unmatched ones are inserted."""
    rows = master(spark, sf).select("gvkey", "iid", "last_seen_date")
    number = F.col("gvkey").cast("long")
    target = rows.filter(number % 4 != 0).withColumns({"source": F.lit("old"), "created_at": F.lit("first load")})
    updates = rows.filter(number % 2 == 0).withColumns({"source": F.lit("new"), "created_at": F.lit("second load")})
    path = f"{workspace(spark)}/master"
    sinks.write_buckets(target, path, ["gvkey", "iid"], 16)
    sinks.upsert_buckets(spark, path, updates, ["gvkey", "iid"])
    return lake.read_parquet(spark, path, merge=False)


@query(
    "s23_replace_date_window",
    "date row_count replaced:long volume volume_ratio:float",
    "SELECT date, count(*) AS row_count, CASE WHEN date BETWEEN DATE '1999-01-01' AND DATE '1999-03-31' THEN count(*) ELSE 0 END AS replaced, "
    "sum(volume) AS volume, avg(volume_ratio) AS volume_ratio FROM daily WHERE date <> DATE '1999-02-03' GROUP BY date",
)
def _(spark, sf):
    """All dates of the stored daily layer after one quarter was loaded anew; the load lacks a day."""
    first, last = "1999-01-01", "1999-03-31"
    path = f"{workspace(spark)}/daily"
    rows = layer(spark, sf, "daily").select("date", "gvkey", "iid", "volume", "volume_ratio")
    sinks.write_daily(rows.withColumn("load", F.lit(0)), path)
    odd = F.col("date") != F.lit("1999-02-03").cast("date")
    new = rows.filter(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")) & odd)
    sinks.store_date_window(new.withColumn("load", F.lit(1)), path, first, last, keys=["gvkey", "iid"])
    return lake.read_parquet(spark, path, merge=False).groupBy("date").agg(
        F.count("*").alias("row_count"),
        F.sum("load").alias("replaced"),
        F.sum("volume").alias("volume"),
        F.avg("volume_ratio").alias("volume_ratio"),
    )


_FIRST_CHANGE, _SECOND_CHANGE = "1998-06-03", "1999-02-03"
_REVISED = f"""
SELECT * REPLACE (CASE WHEN adjusted_close_price IS NOT NULL THEN adjusted_close_price
                       WHEN adjustment_factor <> 0 THEN close_price_raw / adjustment_factor END AS adjusted_close_price)
FROM (SELECT * REPLACE (CASE WHEN date = DATE '{_FIRST_CHANGE}' THEN 2 * close_price_raw ELSE close_price_raw END AS close_price_raw,
                        CASE WHEN date = DATE '{_FIRST_CHANGE}' THEN volume + 1 ELSE volume END AS volume)
      FROM raw WHERE date <> DATE '{_SECOND_CHANGE}' OR CAST(gvkey AS BIGINT) % 2 = 1)"""
_REVISED_ONCE = f"""
(SELECT * FROM ({_REVISED}) WHERE adjusted_close_price IS NOT NULL AND volume IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY gvkey, iid, date ORDER BY {RAW_ORDER}) = 1) AS revised"""

#: What the metric stores hold of a row shown by the rebuilds: ratios and flags follow from it on reading.
DAILY_STORE = ("date", *SECURITY, "ticker", "company_name", "adjusted_close_price", "volume", *DAILY_AVERAGES)
WEEKLY_STORE = (
    *("week_start_date", "week_end_date", *SECURITY, "ticker", "company_name", "security_week_last_trade_date"),
    *[f"weekly_{c}" for c in ("open_price", "high_price", "low_price", "close_price", "volume")],
    *("wma5", "wma10", "wma30", "prev_wma5", "prev_wma10", "prev_wma30"),
)

_REVISED_PRICED = f"""
(SELECT * FROM ({_REVISED}) WHERE adjusted_close_price IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY gvkey, iid, date ORDER BY {RAW_ORDER}) = 1)"""


@query(
    "s09_c03_rebuild_changed",
    "date gvkey iid ticker company_name adjusted_close_price volume volume_ma30 volume_ratio ma20:float ma50:float ma100:float "
    "daily_ma_cluster_ratio:float prev_ma20:float prev_ma100:float prev_ma50_ma100_ratio:float flag_e flag_f",
    daily_sql(_REVISED_ONCE),
)
def rebuild_changed(spark, sf):
    """All dates of the stored daily metrics after rows of two dates were downloaded anew.

    Prices and volumes of the first date changed, half of the second date's rows are gone.  Only
    rows that depend on them are computed again; the SQL rebuilds everything.
    """
    raw, revised, changed = _revision(spark, sf)
    path = f"{workspace(spark)}/daily"
    sinks.write_daily(view_daily(unstored(spark, sf, "daily")).select(*DAILY_STORE), path)
    refresh.refresh_daily_store(spark, path, t.with_names(spark, sf, revised), changed, t.TIEBREAK)
    return with_daily_ratios(lake.read_parquet(spark, path, merge=False))


@query(
    "s09_c04_rebuild_changed",
    "gvkey iid ticker company_name week_start_date week_end_date security_week_last_trade_date weekly_open_price weekly_high_price "
    "weekly_low_price weekly_close_price weekly_volume wma5:float wma10:float wma30:float weekly_ma_cluster_ratio:float "
    "prev_wma10:float prev_wma5_wma30_ratio:float flag_g flag_h",
    weekly_sql(f"({weekly_bars_sql(_REVISED_PRICED)})"),
)
def rebuild_changed_weeks(spark, sf):
    """All weeks of the stored weekly metrics after the same change."""
    raw, revised, changed = _revision(spark, sf)
    path = f"{workspace(spark)}/weekly"
    sinks.write_weekly(unstored(spark, sf, "weekly").select(*WEEKLY_STORE), path)
    old, new = (t.with_names(spark, sf, rows) for rows in (raw, revised))
    refresh.refresh_weekly_store(spark, path, old, new, changed, tiebreak=t.TIEBREAK)
    return view_weekly(lake.read_parquet(spark, path, merge=False))


def _revision(spark, sf):
    """Raw rows before and after the change, and the securities and dates that it concerns."""
    raw = t.prices(spark, sf)
    first = F.col("date") == F.lit(_FIRST_CHANGE).cast("date")
    second = F.col("date") == F.lit(_SECOND_CHANGE).cast("date")
    revised = raw.withColumns(
        {
            "close_price_raw": F.when(first, 2 * F.col("close_price_raw")).otherwise(F.col("close_price_raw")),
            "volume": F.when(first, F.col("volume") + 1).otherwise(F.col("volume")),
        }
    ).filter(~second | (F.col("gvkey").cast("long") % 2 == 1))
    return raw, revised, refresh.changed_keys(raw.filter(first | second), revised.filter(first | second))


@query(
    "s24_deactivate_then_upsert",
    "gvkey iid is_active",
    "SELECT gvkey, iid, last_seen_date >= DATE '2001-10-15' AND is_active AS is_active FROM master",
)
def _(spark, sf):
    rows = master(spark, sf).select("gvkey", "iid", "last_seen_date", "is_active")
    target = rows.withColumn("is_active", F.lit(True))
    updates = rows.filter("last_seen_date >= DATE '2001-10-15'")
    path = f"{workspace(spark)}/master"
    sinks.write_buckets(target, path, ["gvkey", "iid"], 16)
    sinks.upsert_buckets(spark, path, updates, ["gvkey", "iid"], deactivate="is_active")
    return lake.read_parquet(spark, path, merge=False)


@query(
    "s25_replace_sets",
    "parameter_set_id row_count rerun:long",
    "SELECT parameter_set_id, count(*) AS row_count, CASE WHEN parameter_set_id BETWEEN 40 AND 60 THEN count(*) ELSE 0 END AS rerun "
    "FROM outcomes WHERE parameter_set_id NOT BETWEEN 61 AND 70 GROUP BY parameter_set_id",
)
def _(spark, sf):
    """Sets 40 to 70 are replaced; the new run of 61 to 70 is empty, so those rows vanish."""
    columns = ["parameter_set_id", "screen_type", "gvkey", "iid"]
    rows = layer(spark, sf, "outcomes").select(*columns).withColumn("run", F.lit(0))
    new = rows.filter("parameter_set_id BETWEEN 40 AND 60").withColumn("run", F.lit(1))
    path = f"{workspace(spark)}/outcomes"
    sinks.write_sets(rows, path)
    sinks.write_sets(new, path, range(40, 71))
    merged = lake.read_parquet(spark, path, merge=False)
    return merged.groupBy("parameter_set_id").agg(
        F.count("*").alias("row_count"), F.sum("run").alias("rerun")
    )


_KNOWN = "SELECT * FROM grid WHERE parameter_set_id IN (SELECT parameter_set_id FROM outcomes WHERE screen_type = 'A_H')"


@query(
    "s25_upsert_parameters",
    "parameter_set_id:long parameter_set_name",
    f"SELECT parameter_set_id, parameter_set_name FROM ({_KNOWN}) UNION ALL SELECT (SELECT coalesce(max(parameter_set_id), 0) FROM ({_KNOWN})) "
    "+ row_number() OVER (ORDER BY annual_growth_pct, quarterly_growth_pct, annual_years, quarter_count, volume_ratio_threshold, "
    f"volume_surge_min_days), parameter_set_name FROM grid WHERE parameter_set_id NOT IN (SELECT parameter_set_id FROM ({_KNOWN}))",
)
def _(spark, sf):
    """The sets with confirmed outcomes are known and keep their ids; the rest of the grid is added."""
    from ..operators.backtest import PARAMETER_KEY
    from .evaluation import parameters

    grid = parameters(spark)
    confirmed = layer(spark, sf, "outcomes").filter("screen_type = 'A_H'").select("parameter_set_id").distinct()
    return sinks.upsert_parameters(grid.join(confirmed, "parameter_set_id", "left_semi"), grid, PARAMETER_KEY)


@query(
    "s26_layer_freshness",
    "layer latest_date row_count unique_gvkeys up_to_date",
    "SELECT *, latest_date = max(latest_date) FILTER (WHERE layer = 'vendor') OVER () AS up_to_date FROM ("
    + " UNION ALL ".join(
        f"SELECT '{n}' AS layer, max(date) AS latest_date, count(*) FILTER (WHERE date = m) AS row_count, "
        f"count(DISTINCT gvkey) FILTER (WHERE date = m) AS unique_gvkeys FROM (SELECT *, max(date) OVER () AS m FROM {s})"
        for n, s in (("vendor", "ingested"), ("raw", "raw"), ("daily", "daily"))
    )
    + ")",
)
def _(spark, sf):
    vendor = ingest.daily_rows(t.vendor_daily(spark, sf))
    layers = {"vendor": vendor, "raw": t.prices(spark, sf), "daily": layer(spark, sf, "daily")}
    return lake.freshness(layers, reference="vendor")


@query(
    "s27_f08_export_round_trip",
    "parameter_set_id screen_type earliest_signal_date:date sample_size:long json_rows:long",
    "SELECT parameter_set_id, screen_type, earliest_signal_date, sample_size, (SELECT count(*) FROM perf) AS json_rows FROM perf",
)
def _(spark, sf):
    """CSV export read back, with the row count of the JSON export."""
    from .evaluation import performance_comparison

    folder = workspace(spark)
    sinks.export_table(performance_comparison(spark, sf), folder, "performance")
    as_json = spark.read.json(f"{folder}/performance.json").agg(F.count(F.lit(1))).scalar()
    rows = spark.read.option("header", True).csv(f"{folder}/performance.csv")
    typed = rows.withColumn("parameter_set_id", F.col("parameter_set_id").cast("long"))
    return typed.withColumn("json_rows", as_json)
