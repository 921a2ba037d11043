"""Queries of the feature layer: sources, windows, calendar, growth."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import months_before, week_start
from ..functions.flags import cluster_flag, strict_cluster_flag
from ..functions.prices import adjusted_close, cluster_ratio, safe_ratio
from ..operators import calendar, daily, dedup, growth, rolling, screens, weekly
from . import tables as t
from .layers import layer, prices
from .registry import query

KEY = "date gvkey iid"


# --- prices and deduplication ---------------------------------------------------------


@query(
    "p01_typed_keys",
    "date gvkey iid row_count",
    "SELECT date, gvkey, iid, count(*) AS row_count FROM raw GROUP BY ALL",
)
def _(spark, sf):
    return t.prices(spark, sf).groupBy("date", "gvkey", "iid").agg(F.count("*").alias("row_count"))


_ADJUSTED = (
    "date gvkey iid volume price",
    "SELECT *, {} AS price FROM raw",
)


@query(
    "p02_adjusted_close",
    _ADJUSTED[0],
    _ADJUSTED[1].format(
        "CASE WHEN adjusted_close_price IS NOT NULL THEN adjusted_close_price "
        "WHEN adjustment_factor IS NOT NULL AND adjustment_factor <> 0 THEN close_price_raw / adjustment_factor END"
    ),
)
def _(spark, sf):
    price = adjusted_close("adjusted_close_price", "close_price_raw", "adjustment_factor")
    return t.prices(spark, sf).withColumn("price", price)


@query(
    "p03_adjusted_close_backtest",
    _ADJUSTED[0],
    _ADJUSTED[1].format(
        "CASE WHEN adjusted_close_price IS NOT NULL THEN adjusted_close_price "
        "WHEN adjustment_factor <> 0 THEN close_price_raw / adjustment_factor ELSE close_price_raw END"
    ),
)
def _(spark, sf):
    price = adjusted_close("adjusted_close_price", "close_price_raw", "adjustment_factor", True)
    return t.prices(spark, sf).withColumn("price", price)


@query(
    "p04_first_known_revenue",
    "gvkey fyear datadate annual_revenue annual_operating_income",
    "SELECT gvkey, fyear, datadate, coalesce(sale, revt) AS annual_revenue, oiadp AS annual_operating_income "
    "FROM raw_annual WHERE gvkey IS NOT NULL AND fyear IS NOT NULL",
)
def _(spark, sf):
    return growth.annual_base(t.raw_annual(spark, sf))


@query(
    "p05_row_filters",
    "date gvkey iid volume close_price_raw",
    "SELECT * FROM adjusted WHERE adjusted_close_price IS NOT NULL AND volume IS NOT NULL "
    "AND date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'",
)
def _(spark, sf):
    price = adjusted_close("adjusted_close_price", "close_price_raw", "adjustment_factor")
    kept = price.isNotNull() & F.col("volume").isNotNull()
    return t.prices(spark, sf).filter(
        kept & F.col("date").between(F.lit("1997-01-01").cast("date"), F.lit("1999-12-31").cast("date"))
    )


@query("d01_daily_once", "date gvkey iid volume adjusted_close_price", "deduped")
def _(spark, sf):
    return daily.clean_daily(t.prices(spark, sf), t.TIEBREAK)


@query("d02_annual_once", "gvkey fyear datadate annual_revenue annual_operating_income", "annual_once")
def _(spark, sf):
    rows = growth.annual_base(t.raw_annual(spark, sf))
    order = ["datadate", "annual_revenue", "annual_operating_income"]
    return dedup.latest_per_key(rows, ["gvkey", "fyear"], order)


@query(
    "d03_quarterly_once",
    "gvkey fyearq fqtr datadate quarterly_revenue quarterly_operating_income",
    "quarterly_once",
)
def _(spark, sf):
    rows = growth.quarterly_base(t.raw_quarterly(spark, sf))
    order = ["datadate", "quarterly_revenue", "quarterly_operating_income"]
    return dedup.latest_per_key(rows, ["gvkey", "fyearq", "fqtr"], order)


@query(
    "d04_last_row_per_security",
    "gvkey iid date close_price_raw volume",
    "SELECT * FROM deduped QUALIFY row_number() OVER (PARTITION BY gvkey, iid ORDER BY date DESC) = 1",
)
def _(spark, sf):
    rows = daily.clean_daily(t.prices(spark, sf), t.TIEBREAK)
    return dedup.latest_per_key(rows, ["gvkey", "iid"], ["date"])


@query("d05_distinct_keys", "gvkey iid", "SELECT DISTINCT gvkey, iid FROM raw")
def _(spark, sf):
    return t.prices(spark, sf).select("gvkey", "iid").dropDuplicates(["gvkey", "iid"])


@query(
    "d07_duplicate_keys",
    "gvkey iid date row_count",
    "SELECT gvkey, iid, date, count(*) AS row_count FROM raw GROUP BY ALL HAVING count(*) > 1",
)
def _(spark, sf):
    return dedup.duplicate_keys(t.prices(spark, sf), ["gvkey", "iid", "date"])


# --- daily windows --------------------------------------------------------------------


def _daily_rows(spark, sf):
    return prices(spark, sf)


def _indicators(spark, sf):
    return daily.add_daily_indicators(_daily_rows(spark, sf))


@query("w01_moving_averages", f"{KEY} ma20:float ma50:float ma100:float", "daily")
def _(spark, sf):
    return rolling.add_trailing_means(_daily_rows(spark, sf), "adjusted_close_price", daily.MEANS, "date")


@query("w02_volume_mean_excluding_today", f"{KEY} volume_ma30", "daily")
def _(spark, sf):
    mean = rolling.trailing_mean("volume", 30, "date", with_current=False)
    return _daily_rows(spark, sf).withColumn("volume_ma30", mean)


@query("p10_volume_ratio", f"{KEY} volume_ratio ma20_ma50_ratio:float ma20_ma100_ratio:float ma50_ma100_ratio:float", "daily")
def _(spark, sf):
    return daily.add_daily_ratios(_indicators(spark, sf))


@query("p11_cluster_ratio", f"{KEY} daily_ma_cluster_ratio:float", "daily")
def _(spark, sf):
    return _indicators(spark, sf).withColumn("daily_ma_cluster_ratio", cluster_ratio("ma20", "ma50", "ma100"))


@query(
    "w05_previous_averages",
    f"{KEY} prev_ma20:float prev_ma50:float prev_ma100:float prev_ma20_ma50_ratio:float prev_ma20_ma100_ratio:float prev_ma50_ma100_ratio:float",
    "daily",
)
def _(spark, sf):
    rows = daily.add_daily_ratios(_indicators(spark, sf))
    return rolling.add_previous(rows, [*daily.MEANS, *daily.RATIOS], "date")


@query("p12_flag_e", f"{KEY} flag_e", "daily")
def _(spark, sf):
    return daily.add_daily_ratios(_indicators(spark, sf)).withColumn("flag_e", daily.flag_e())


@query("p13_flag_f", f"{KEY} flag_f", "daily")
def _(spark, sf):
    return daily.daily_history(t.prices(spark, sf), t.TIEBREAK)


_LEGACY_DAILY = """
SELECT *, CASE WHEN prev_e AND prev_ma20 <= prev_ma50 AND ma20 > ma50 THEN TRUE ELSE FALSE END AS legacy_f
FROM (SELECT *, lag(legacy_e) OVER (PARTITION BY gvkey, iid ORDER BY date) AS prev_e
FROM (SELECT *, CASE WHEN daily_ma_cluster_ratio <= 0.01 THEN TRUE ELSE FALSE END AS legacy_e FROM daily))"""


@query("p16_legacy_daily_flags", f"{KEY} legacy_e legacy_f", _LEGACY_DAILY)
def _(spark, sf):
    rows = daily.add_daily_ratios(_indicators(spark, sf))
    flags = daily.legacy_daily_flags(rows)
    return flags.withColumnsRenamed({"flag_e": "legacy_e", "flag_f": "legacy_f"})


DAILY_COLUMNS = (
    "date gvkey iid ticker company_name currency close_price_raw open_price_raw high_price_raw low_price_raw "
    "adjusted_close_price volume volume_ma30 volume_ratio shares_outstanding adjustment_factor "
    "total_return_factor exchange_code:int security_status issue_type_code ma20:float ma50:float ma100:float ma20_ma50_ratio:float "
    "ma20_ma100_ratio:float ma50_ma100_ratio:float daily_ma_cluster_ratio:float prev_ma20:float prev_ma50:float prev_ma100:float "
    "prev_ma20_ma50_ratio:float prev_ma20_ma100_ratio:float prev_ma50_ma100_ratio:float flag_e flag_f"
)


@query("c03_daily_metrics", DAILY_COLUMNS, "target_daily")
def daily_metrics(spark, sf):
    """Latest five dates from a 250-day warm-up window."""
    return t.with_names(spark, sf, daily.daily_metrics(t.prices(spark, sf), tiebreak=t.TIEBREAK))


@query("c03_daily_metrics_full_history", DAILY_COLUMNS, "daily")
def _(spark, sf):
    """Every date, from rows stored by security: no exchange."""
    return daily.daily_history(prices(spark, sf), t.TIEBREAK, laid_out=True)


@query("p06_target_dates_after_windows", "date gvkey iid ma100:float", "target_daily")
def _(spark, sf):
    rows = daily.daily_metrics(t.prices(spark, sf), tiebreak=t.TIEBREAK)
    dates = daily.latest_dates(t.prices(spark, sf), 5)
    return rows.join(F.broadcast(dates), "date", "left_semi")


_TRISTATE = """
SELECT *, CASE WHEN ma20 IS NULL OR ma50 IS NULL OR ma100 IS NULL THEN NULL WHEN ma50 = 0 OR ma100 = 0 THEN FALSE
  ELSE ma20 / ma50 BETWEEN 0.95 AND 1.05 AND ma50 / ma100 BETWEEN 0.95 AND 1.05 AND ma20 / ma100 BETWEEN 0.95 AND 1.05 END AS now,
  CASE WHEN nxt IS NULL OR n20 IS NULL OR n50 IS NULL OR n100 IS NULL THEN NULL WHEN n50 = 0 OR n100 = 0 THEN FALSE
  ELSE n20 / n50 BETWEEN 0.95 AND 1.05 AND n50 / n100 BETWEEN 0.95 AND 1.05 AND n20 / n100 BETWEEN 0.95 AND 1.05 END AS later
FROM (SELECT *, lead(date) OVER w AS nxt, lead(ma20) OVER w AS n20, lead(ma50) OVER w AS n50, lead(ma100) OVER w AS n100
      FROM daily WINDOW w AS (PARTITION BY gvkey, iid ORDER BY date))"""


def _with_next(spark, sf):
    nxt = {"nxt": "date", "n20": "ma20", "n50": "ma50", "n100": "ma100"}
    return rolling.add_next(_indicators(spark, sf), nxt, "date")


@query("p18_three_valued_tolerance", f"{KEY} now later", _TRISTATE)
def _(spark, sf):
    return _with_next(spark, sf).withColumns(
        {
            "now": cluster_flag("ma20", "ma50", "ma100", 0.95, 1.05),
            "later": cluster_flag("n20", "n50", "n100", 0.95, 1.05, required=["nxt"]),
        }
    )


@query(
    "p19_strict_tolerance",
    f"{KEY} now later",
    f"SELECT date, gvkey, iid, coalesce(now, FALSE) AS now, coalesce(later, FALSE) AS later FROM ({_TRISTATE})",
)
def _(spark, sf):
    return _with_next(spark, sf).withColumns(
        {
            "now": strict_cluster_flag("ma20", "ma50", "ma100", 0.95, 1.05),
            "later": strict_cluster_flag("n20", "n50", "n100", 0.95, 1.05, required=["nxt"]),
        }
    )


@query(
    "p27_month_arithmetic",
    "date months_before:date months_after:date year_after:date row_count",
    "SELECT date, date - INTERVAL 3 MONTH AS months_before, date + INTERVAL 6 MONTH AS months_after, "
    "date + INTERVAL 1 YEAR AS year_after, count(*) AS row_count FROM raw GROUP BY ALL",
)
def _(spark, sf):
    rows = t.prices(spark, sf).groupBy("date").agg(F.count("*").alias("row_count"))
    return rows.withColumns(
        {
            "months_before": months_before("date", 3),
            "months_after": F.add_months("date", 6),
            "year_after": F.add_months("date", 12),
        }
    )


@query(
    "p28_week_start",
    "week_start_date:date row_count",
    "SELECT date_trunc('week', date) AS week_start_date, count(*) AS row_count FROM raw GROUP BY ALL",
)
def _(spark, sf):
    rows = t.prices(spark, sf).groupBy(week_start("date").alias("week_start_date"))
    return rows.agg(F.count("*").alias("row_count"))


@query(
    "f06_partition_values",
    "date year_value month_value date_value row_count",
    "SELECT date, strftime(date, '%Y') AS year_value, strftime(date, '%m') AS month_value, "
    "strftime(date, '%Y-%m-%d') AS date_value, count(*) AS row_count FROM raw GROUP BY ALL",
)
def _(spark, sf):
    rows = t.prices(spark, sf).groupBy("date").agg(F.count("*").alias("row_count"))
    formats = {"year_value": "yyyy", "month_value": "MM", "date_value": "yyyy-MM-dd"}
    return rows.withColumns({n: F.date_format("date", f) for n, f in formats.items()})


@query(
    "c05_recent_volume",
    "date gvkey iid volume_ratio latest_date window_start_date:date",
    "SELECT * FROM (SELECT *, (SELECT max(date) FROM daily) AS latest_date, "
    "(SELECT max(date) FROM daily) - INTERVAL 3 MONTH AS window_start_date FROM daily) "
    "WHERE date >= window_start_date AND date <= latest_date AND volume_ratio IS NOT NULL",
)
def _(spark, sf):
    return daily.recent_volume(layer(spark, sf, "daily"))


# --- calendar and weekly --------------------------------------------------------------


@query("t01_monday", "date monday:date", "SELECT DISTINCT date, date_trunc('week', date) AS monday FROM raw")
def _(spark, sf):
    return t.prices(spark, sf).select("date").distinct().withColumn("monday", week_start("date"))


@query(
    "t02_official_week_ends",
    "week_start_date:date official_week_end_date:date",
    "SELECT k.* FROM calendar k SEMI JOIN (SELECT CAST(date_trunc('week', date) AS DATE) AS week_start_date FROM raw) r "
    "USING (week_start_date)",
)
def _(spark, sf):
    weeks = t.prices(spark, sf).select(week_start("date").alias("week_start_date")).distinct()
    return calendar.with_official_week_end(weeks, how="inner")


@query(
    "t03_is_official_week_end",
    "date is_official_week_end",
    "SELECT DISTINCT date, date IN (SELECT official_week_end_date FROM calendar) AS is_official_week_end FROM raw",
)
def _(spark, sf):
    return calendar.mark_official_week_ends(t.prices(spark, sf).select("date").distinct(), "date")


@query(
    "t04_completed_weeks",
    "week_start_date:date week_end_date:date",
    "SELECT DISTINCT week_start_date, week_end_date FROM weekly_bars",
)
def _(spark, sf):
    rows = t.prices(spark, sf)
    price = adjusted_close("adjusted_close_price", "close_price_raw", "adjustment_factor")
    return calendar.completed_weeks(rows.filter(price.isNotNull()))


@query(
    "t05_sessions",
    "session_date",
    "SELECT day AS session_date FROM sessions WHERE day BETWEEN (SELECT min(date) FROM raw) AND (SELECT max(date) FROM raw)",
)
def _(spark, sf):
    bounds = t.prices(spark, sf).agg(F.min("date").alias("first"), F.max("date").alias("last"))
    return calendar.sessions_between(bounds, "first", "last")


@query(
    "a11_market_week_end",
    "week_start_date:date market_week_end_date:date",
    "SELECT date_trunc('week', date) AS week_start_date, max(date) AS market_week_end_date FROM raw GROUP BY ALL",
)
def _(spark, sf):
    return calendar.market_week_ends(t.prices(spark, sf))


BAR_COLUMNS = (
    "gvkey iid ticker company_name currency week_start_date week_end_date security_week_last_trade_date "
    "weekly_open_price weekly_high_price weekly_low_price weekly_close_price weekly_close_price_raw weekly_volume"
)


def _bars(spark, sf):
    raw = t.raw_daily(spark, sf)
    rows = daily.clean_daily(raw, t.TIEBREAK, need_volume=False)
    return weekly.weekly_bars(rows, calendar.completed_weeks(daily.priced_rows(raw, need_volume=False)))


@query("a05_a06_weekly_bars", BAR_COLUMNS, "weekly_bars")
def _(spark, sf):
    return _bars(spark, sf)


@query("j03_j04_rows_of_completed_weeks", "gvkey iid week_start_date week_end_date", "weekly_bars")
def _(spark, sf):
    return _bars(spark, sf)


@query("w03_weekly_averages", "gvkey iid week_end_date wma5:float wma10:float wma30:float", "weekly")
def _(spark, sf):
    return weekly.add_weekly_averages(_bars(spark, sf))


_LEGACY_WEEKLY = """
SELECT *, CASE WHEN prev_g AND prev10 <= prev30 AND wma10 > wma30 THEN TRUE ELSE FALSE END AS legacy_h FROM (
SELECT *, lag(wma10) OVER w AS prev10, lag(wma30) OVER w AS prev30, lag(legacy_g) OVER w AS prev_g FROM (
SELECT *, CASE WHEN (greatest(wma5, wma10, wma30) - least(wma5, wma10, wma30)) / nullif((wma5 + wma10 + wma30) / 3, 0) <= 0.02
            THEN TRUE ELSE FALSE END AS legacy_g FROM (
SELECT *, avg(p) OVER (PARTITION BY gvkey, iid ORDER BY week_end_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS wma5,
  avg(p) OVER (PARTITION BY gvkey, iid ORDER BY week_end_date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS wma10,
  avg(p) OVER (PARTITION BY gvkey, iid ORDER BY week_end_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS wma30 FROM (
SELECT gvkey, iid, CAST(date_trunc('week', date) AS DATE) AS week_start_date, date AS week_end_date, adjusted_close_price AS p
FROM deduped QUALIFY row_number() OVER (PARTITION BY gvkey, iid, date_trunc('week', date) ORDER BY date DESC) = 1)))
WINDOW w AS (PARTITION BY gvkey, iid ORDER BY week_end_date))"""


@query("w04_legacy_weekly_averages", "gvkey iid week_end_date wma5:float wma10:float wma30:float", _LEGACY_WEEKLY)
def _(spark, sf):
    return weekly.legacy_weekly_metrics(daily.clean_daily(t.raw_daily(spark, sf), t.TIEBREAK))


@query("p17_legacy_weekly_flags", "gvkey iid week_end_date legacy_g legacy_h", _LEGACY_WEEKLY)
def _(spark, sf):
    rows = weekly.legacy_weekly_metrics(daily.clean_daily(t.raw_daily(spark, sf), t.TIEBREAK))
    return rows.withColumnsRenamed({"flag_g": "legacy_g", "flag_h": "legacy_h"})


@query("w12_last_row_of_week", "gvkey iid week_start_date week_end_date", _LEGACY_WEEKLY)
def _(spark, sf):
    return weekly.legacy_weekly_metrics(daily.clean_daily(t.raw_daily(spark, sf), t.TIEBREAK))


def _weekly_history(spark, sf):
    return weekly.weekly_history(t.raw_daily(spark, sf), tiebreak=t.TIEBREAK)


@query(
    "w06_previous_weekly_averages",
    "gvkey iid week_end_date prev_wma10:float prev_wma30:float prev_wma5_wma10_ratio:float prev_wma5_wma30_ratio:float prev_wma10_wma30_ratio:float",
    "weekly",
)
def _(spark, sf):
    return _weekly_history(spark, sf)


@query("p14_flag_g", "gvkey iid week_end_date flag_g", "weekly")
def _(spark, sf):
    rows = weekly.add_weekly_ratios(weekly.add_weekly_averages(_bars(spark, sf)))
    return rows.withColumn("flag_g", weekly.flag_g())


@query("p15_flag_h", "gvkey iid week_end_date flag_h", "weekly")
def _(spark, sf):
    return _weekly_history(spark, sf)


WEEKLY_COLUMNS = (
    f"{BAR_COLUMNS} wma5:float wma10:float wma30:float wma5_wma10_ratio:float wma5_wma30_ratio:float wma10_wma30_ratio:float "
    "weekly_ma_cluster_ratio:float prev_wma10:float prev_wma30:float prev_wma5_wma10_ratio:float prev_wma5_wma30_ratio:float "
    "prev_wma10_wma30_ratio:float flag_g flag_h data_as_of_date"
)
_AS_OF = "(SELECT max(date) FROM raw) AS data_as_of_date"


@query(
    "c04_weekly_metrics",
    WEEKLY_COLUMNS,
    f"SELECT *, {_AS_OF} FROM recent_weekly WHERE week_start_date IN "
    "(SELECT DISTINCT week_start_date FROM recent_weekly ORDER BY 1 DESC LIMIT 8)",
)
def weekly_metrics(spark, sf):
    """Latest eight completed weeks from a 500-day warm-up window."""
    return weekly.weekly_metrics(t.raw_daily(spark, sf), tiebreak=t.TIEBREAK)


@query(
    "c04_weekly_metrics_from_week",
    WEEKLY_COLUMNS,
    f"SELECT *, {_AS_OF} FROM early_weekly WHERE week_start_date >= date_trunc('week', DATE '1996-06-12')",
)
def _(spark, sf):
    raw = t.raw_daily(spark, sf)
    return weekly.weekly_metrics(raw, start_week="1996-06-12", tiebreak=t.TIEBREAK)


@query(
    "o03_latest_weeks",
    "week_start_date",
    "SELECT DISTINCT week_start_date FROM weekly ORDER BY week_start_date DESC LIMIT 8",
)
def _(spark, sf):
    return weekly.latest_weeks(_weekly_history(spark, sf), 8)


@query(
    "j05_keep_target_weeks",
    "gvkey iid week_start_date weekly_close_price",
    "SELECT * FROM weekly WHERE week_start_date IN (SELECT DISTINCT week_start_date FROM weekly ORDER BY 1 DESC LIMIT 8)",
)
def _(spark, sf):
    rows = layer(spark, sf, "weekly")
    return rows.join(F.broadcast(weekly.latest_weeks(rows, 8)), "week_start_date", "left_semi")


# --- fundamentals ---------------------------------------------------------------------

ANNUAL_COLUMNS = (
    "gvkey datadate fyear:int ticker company_name currency exchange_code:int annual_revenue annual_operating_income "
    "prev_annual_revenue prev_annual_operating_income annual_revenue_growth_yoy annual_operating_income_growth_yoy "
    "has_valid_annual_revenue_growth has_valid_annual_operating_income_growth has_valid_annual_growth_pair annual_rank_desc:int"
)
QUARTERLY_COLUMNS = (
    "gvkey datadate fyearq:int fqtr:int ticker company_name currency exchange_code:int quarterly_revenue "
    "quarterly_operating_income prev_year_same_quarter_revenue prev_year_same_quarter_operating_income "
    "quarterly_revenue_growth_yoy quarterly_operating_income_growth_yoy has_valid_quarterly_revenue_growth "
    "has_valid_quarterly_operating_income_growth has_valid_quarterly_growth_pair quarterly_rank_desc:int"
)


@query("c01_annual_growth", ANNUAL_COLUMNS, "annual")
def annual_growth(spark, sf):
    return growth.annual_growth(t.raw_annual(spark, sf), laid_out=True)


@query("c02_quarterly_growth", QUARTERLY_COLUMNS, "quarterly")
def quarterly_growth(spark, sf):
    return growth.quarterly_growth(t.raw_quarterly(spark, sf), laid_out=True)


@query("w07_previous_fiscal_year", "gvkey fyear:int prev_annual_revenue prev_annual_operating_income", "annual")
def _(spark, sf):
    return growth.annual_growth(t.raw_annual(spark, sf), laid_out=True)


@query(
    "j01_same_quarter_last_year",
    "gvkey fyearq:int fqtr:int prev_year_same_quarter_revenue prev_year_same_quarter_operating_income",
    "quarterly",
)
def _(spark, sf):
    return growth.quarterly_growth(t.raw_quarterly(spark, sf), laid_out=True)


@query(
    "p08_p09_growth_and_validity",
    "gvkey fyear:int annual_revenue_growth_yoy annual_operating_income_growth_yoy has_valid_annual_growth_pair",
    "annual",
)
def _(spark, sf):
    return growth.annual_growth(t.raw_annual(spark, sf), laid_out=True)


@query("w11_recency_rank", "gvkey fyearq:int fqtr:int quarterly_rank_desc:int", "quarterly")
def _(spark, sf):
    return growth.quarterly_growth(t.raw_quarterly(spark, sf), laid_out=True)


_IDENTITY = """
SELECT coalesce(a.gvkey, q.gvkey) AS gvkey, coalesce(q.ticker, a.ticker) AS ticker,
  coalesce(q.company_name, a.company_name) AS company_name, coalesce(q.currency, a.currency) AS currency
FROM (SELECT * FROM annual WHERE annual_rank_desc = 1) a
FULL JOIN (SELECT * FROM quarterly WHERE quarterly_rank_desc = 1) q ON a.gvkey = q.gvkey"""


@query("j21_company_identity", "gvkey ticker company_name currency", _IDENTITY)
def _(spark, sf):
    return growth.company_identity(layer(spark, sf, "annual"), layer(spark, sf, "quarterly"))


ANNUAL_STATS = """
SELECT gvkey, max(CASE WHEN annual_rank_desc = 1 THEN fyear END) AS latest_annual_fyear,
  max(CASE WHEN annual_rank_desc = 1 THEN datadate END) AS latest_annual_datadate,
  count(annual_revenue_growth_yoy) AS annual_revenue_growth_obs,
  count(annual_operating_income_growth_yoy) AS annual_operating_income_growth_obs,
  min(annual_revenue_growth_yoy) AS annual_min_revenue_growth,
  min(annual_operating_income_growth_yoy) AS annual_min_operating_income_growth
FROM annual WHERE annual_rank_desc <= {n} GROUP BY gvkey"""
QUARTERLY_STATS = """
SELECT gvkey, max(CASE WHEN quarterly_rank_desc = 1 THEN datadate END) AS latest_quarterly_datadate,
  max(CASE WHEN quarterly_rank_desc = 1 THEN fyearq END) AS latest_fyearq,
  max(CASE WHEN quarterly_rank_desc = 1 THEN fqtr END) AS latest_fqtr,
  count(quarterly_revenue_growth_yoy) AS quarterly_revenue_growth_obs,
  count(quarterly_operating_income_growth_yoy) AS quarterly_operating_income_growth_obs,
  min(quarterly_revenue_growth_yoy) AS quarterly_min_revenue_growth,
  min(quarterly_operating_income_growth_yoy) AS quarterly_min_operating_income_growth
FROM quarterly WHERE quarterly_rank_desc <= {n} GROUP BY gvkey"""


def growth_flag_sql(prefix: str, stats: str, n: int, threshold: float, flag: str) -> str:
    return (
        f"SELECT *, CASE WHEN {prefix}_revenue_growth_obs = {n} AND {prefix}_operating_income_growth_obs = {n} "
        f"AND {prefix}_min_revenue_growth >= {threshold} AND {prefix}_min_operating_income_growth >= {threshold} "
        f"THEN TRUE ELSE FALSE END AS {flag} FROM ({stats.format(n=n)})"
    )


@query(
    "a03_recent_growth_minima",
    "gvkey latest_annual_fyear:int latest_annual_datadate annual_revenue_growth_obs annual_operating_income_growth_obs "
    "annual_min_revenue_growth annual_min_operating_income_growth flag_a",
    growth_flag_sql("annual", ANNUAL_STATS, 2, -0.1, "flag_a"),
)
def _(spark, sf):
    return growth.recent_growth_flag(layer(spark, sf, "annual"), "annual", 2, -0.1, "flag_a")


@query(
    "p29_value_at_rank_one",
    "gvkey latest_quarterly_datadate latest_fyearq:int latest_fqtr:int",
    QUARTERLY_STATS.format(n=4),
)
def _(spark, sf):
    return growth.recent_growth_flag(layer(spark, sf, "quarterly"), "quarterly", 4, 0.1, "flag_b")


@query(
    "a04_recent_pass_count",
    "gvkey annual_pass_count",
    "SELECT gvkey, count(*) FILTER (WHERE annual_revenue_growth_yoy >= 0.05 AND annual_operating_income_growth_yoy >= 0.05) "
    "AS annual_pass_count FROM annual WHERE annual_rank_desc <= 3 GROUP BY gvkey",
)
def _(spark, sf):
    serving = growth.growth_serving(layer(spark, sf, "annual"), "annual")
    return growth.recent_pass_count(serving, "annual", 3, 0.05)


def _fundamentals_sql(years: int, quarters: int, threshold: float) -> str:
    return f"""SELECT *, flag_a AND flag_b AS flag_ab FROM (
SELECT i.*, annual_revenue_growth_obs, annual_min_revenue_growth, latest_annual_fyear, quarterly_revenue_growth_obs,
  quarterly_min_revenue_growth, latest_quarterly_datadate, coalesce(x.flag_a, FALSE) AS flag_a, coalesce(y.flag_b, FALSE) AS flag_b
FROM ({_IDENTITY}) i
LEFT JOIN ({growth_flag_sql("annual", ANNUAL_STATS, years, threshold, "flag_a")}) x ON i.gvkey = x.gvkey
LEFT JOIN ({growth_flag_sql("quarterly", QUARTERLY_STATS, quarters, threshold, "flag_b")}) y ON i.gvkey = y.gvkey)"""


FUNDAMENTAL_COLUMNS = (
    "gvkey ticker company_name currency annual_revenue_growth_obs annual_min_revenue_growth latest_annual_fyear:int "
    "quarterly_revenue_growth_obs quarterly_min_revenue_growth latest_quarterly_datadate flag_a flag_b flag_ab"
)


def _fundamentals(spark, sf, n_pct: float, annual_years: int, quarter_count: int):
    a = growth.annual_growth(t.raw_annual(spark, sf), laid_out=True)
    q = growth.quarterly_growth(t.raw_quarterly(spark, sf), laid_out=True)
    return growth.screen_fundamentals(a, q, n_pct, annual_years, quarter_count)


@query("c09_screen_fundamentals", FUNDAMENTAL_COLUMNS, _fundamentals_sql(2, 2, -0.2))
def screen_fundamentals(spark, sf):
    return _fundamentals(spark, sf, -20, 2, 2)


@query("c09_screen_fundamentals_relaxed", FUNDAMENTAL_COLUMNS, _fundamentals_sql(1, 1, -0.4))
def _(spark, sf):
    """At thresholds that some companies pass on either side, on both and on none."""
    return _fundamentals(spark, sf, -40, 1, 1)


@query(
    "o05_fundamental_order",
    "place:int flag_ab flag_a flag_b annual_min_revenue_growth quarterly_min_revenue_growth",
    "SELECT *, row_number() OVER (ORDER BY flag_ab DESC, flag_a DESC, flag_b DESC, annual_min_revenue_growth DESC NULLS LAST, "
    f"quarterly_min_revenue_growth DESC NULLS LAST) AS place FROM ({_fundamentals_sql(1, 1, -0.4)})",
)
def _(spark, sf):
    """The place of each row in the returned order; companies that tie have equal rows."""
    return screens.numbered(_fundamentals(spark, sf, -40, 1, 1), "place")


@query(
    "c13_growth_serving",
    "gvkey fyearq:int fqtr:int datadate quarterly_rank_desc:int quarterly_revenue quarterly_operating_income "
    "quarterly_revenue_growth quarterly_operating_income_growth source_extract_date:date source_path:string",
    "SELECT *, quarterly_revenue_growth_yoy AS quarterly_revenue_growth, quarterly_operating_income_growth_yoy AS "
    "quarterly_operating_income_growth, NULL AS source_extract_date, 'quarterly' AS source_path FROM quarterly",
)
def _(spark, sf):
    return growth.growth_serving(layer(spark, sf, "quarterly"), "quarterly", "quarterly")


@query(
    "c13_growth_serving_annual",
    "gvkey fyear:int datadate annual_rank_desc:int annual_revenue annual_operating_income annual_revenue_growth "
    "annual_operating_income_growth",
    "SELECT *, annual_revenue_growth_yoy AS annual_revenue_growth, annual_operating_income_growth_yoy AS "
    "annual_operating_income_growth FROM annual",
)
def _(spark, sf):
    return growth.growth_serving(layer(spark, sf, "annual"), "annual", "annual")


@query(
    "p10_safe_ratio",
    "gvkey fyear:int margin",
    "SELECT gvkey, fyear, annual_operating_income / nullif(annual_revenue, 0) AS margin FROM annual",
)
def _(spark, sf):
    margin = safe_ratio("annual_operating_income", "annual_revenue")
    return layer(spark, sf, "annual").withColumn("margin", margin)
