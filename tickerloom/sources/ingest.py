"""Ingest of vendor tables.

Every function takes the vendor table as a DataFrame.  With ``spark.read.jdbc`` (see
:func:`vendor_table`) the filters and the column list are pushed to the vendor database.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import asof_join

# Vendor column -> our column.
DAILY_COLUMNS = {
    "datadate": "date",
    "gvkey": "gvkey",
    "iid": "iid",
    "tic": "ticker",
    "conm": "company_name",
    "cusip": "cusip",
    "cik": "cik",
    "exchg": "exchange_code",
    "secstat": "security_status",
    "tpci": "issue_type_code",
    "prccd": "close_price_raw",
    "prcod": "open_price_raw",
    "prchd": "high_price_raw",
    "prcld": "low_price_raw",
    "cshtrd": "volume",
    "cshoc": "shares_outstanding",
    "ajexdi": "adjustment_factor",
    "trfd": "total_return_factor",
    "curcdd": "currency",
    "fic": "fic",
}
FUNDAMENTAL_RENAMES = {"tic": "ticker", "conm": "company_name", "exchg": "exchange_code"}
ANNUAL_RENAMES = {**FUNDAMENTAL_RENAMES, "curcd": "currency"}
QUARTERLY_RENAMES = {**FUNDAMENTAL_RENAMES, "curcdq": "currency"}
STANDARD_FORMAT = {"indfmt": "INDL", "consol": "C", "popsrc": "D", "datafmt": "STD"}
# Fixed value: source tag of ingested daily rows.
DATA_SOURCE = "compustat_daily_security"
ARCHIVE_V2_COLUMNS = {
    "dlycaldt": "date",
    "dlyprc": "prc",
    "dlyvol": "vol",
    "dlyret": "ret",
    "dlycumfacpr": "cfacpr",
    "dlycumfacshr": "cfacshr",
    "dlyopen": "openprc",
    "dlynumtrd": "numtrd",
}


def vendor_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A vendor table over JDBC.  Give ``partitionColumn``/``lowerBound``/``upperBound``/
    ``numPartitions`` to read it in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def listed_common(
    secd: DataFrame, exchange: int = 14, status: str = "A", issue_type: str = "0"
) -> DataFrame:
    """Active common stock of one exchange."""
    return secd.filter(
        (F.col("exchg") == exchange)
        & (F.col("secstat") == status)
        & (F.col("tpci") == issue_type)
    )


def priced(secd: DataFrame) -> DataFrame:
    return listed_common(secd).filter("prccd IS NOT NULL AND cshtrd IS NOT NULL")


def daily_rows(secd: DataFrame) -> DataFrame:
    """Filtered and renamed daily rows."""
    rows = priced(secd)
    return rows.select(*[F.col(old).alias(new) for old, new in DAILY_COLUMNS.items()])


def latest_trading_dates(secd: DataFrame, lookback_days: int = 10) -> DataFrame:
    dates = priced(secd).select("datadate").distinct()
    return dates.orderBy(F.desc("datadate")).limit(lookback_days)


def ingest_latest(secd: DataFrame, lookback_days: int = 10) -> DataFrame:
    """Daily rows of the latest trading dates, normalised.

    The first of the dates also bounds the scan, which the source can apply by itself.  The dates are ``lookback_days`` rows by construction, so broadcasting them is bounded.
    """
    dates = latest_trading_dates(secd, lookback_days).withColumnRenamed("datadate", "date")
    first = latest_trading_dates(secd, lookback_days).select(F.min("datadate")).scalar()
    recent = secd.filter(F.col("datadate") >= first)
    return normalise_daily(daily_rows(recent).join(F.broadcast(dates), "date", "left_semi"))


def ingest_date(secd: DataFrame, day: dt.date | str) -> DataFrame:
    return normalise_daily(daily_rows(secd.filter(F.col("datadate") == F.lit(day).cast("date"))))


def ingest_year(secd: DataFrame, year: int, today: dt.date | None = None) -> DataFrame:
    """Daily rows of one calendar year, bounded at today for the current year."""
    today = today or dt.datetime.now(dt.timezone.utc).date()
    first, last = dt.date(year, 1, 1), dt.date(year, 12, 31)
    if year == today.year:
        last = today
    return normalise_daily(daily_rows(secd.filter(F.col("datadate").between(first, last))))


def normalise_daily(rows: DataFrame, data_source: str = DATA_SOURCE) -> DataFrame:
    """Missing factor counts as 1; adjusted close, source tag and load time are added."""
    rows = rows.withColumn("adjustment_factor", F.coalesce("adjustment_factor", F.lit(1.0)))
    return rows.withColumns(
        {
            "adjusted_close_price": F.try_divide("close_price_raw", "adjustment_factor"),
            "data_source": F.lit(data_source),
            "created_at": F.current_timestamp(),
        }
    )


def active_companies(secd: DataFrame) -> DataFrame:
    return listed_common(secd).select("gvkey").distinct()


def ingest_annual(funda: DataFrame, secd: DataFrame, start_year: int = 2017) -> DataFrame:
    """Standard-format annual rows of active companies from ``start_year`` on."""
    rows = _standard_format(funda.filter(F.col("fyear") >= start_year))
    kept = rows.join(active_companies(secd), "gvkey", "left_semi")
    return kept.withColumnsRenamed(ANNUAL_RENAMES)


def ingest_quarterly(
    fundq: DataFrame, secd: DataFrame, start_date: dt.date | str = "2019-01-01"
) -> DataFrame:
    """Standard-format quarterly rows of active companies from ``start_date`` on."""
    rows = _standard_format(fundq.filter(F.col("datadate") >= F.lit(start_date).cast("date")))
    kept = rows.join(active_companies(secd), "gvkey", "left_semi")
    return kept.withColumnsRenamed(QUARTERLY_RENAMES)


def _standard_format(rows: DataFrame) -> DataFrame:
    for column, value in STANDARD_FORMAT.items():
        rows = rows.filter(F.col(column) == value)
    return rows


def with_names_in_force(
    prices: DataFrame,
    names: DataFrame,
    key: str = "permno",
    date: str = "date",
    start: str = "namedt",
    end: str = "nameenddt",
) -> DataFrame:
    """Attach each name record whose interval holds the price date.

    Intervals may overlap; one without an end is open, one without a start is in force at no
    time.  The records of a security are cut into segments in which the same ones are in force;
    each of its dates meets one segment, by an ordered scan of both, and never the other
    records.  Prices join their date again, so copies of a row are not gathered.  Dates without
    a record in force are dropped.
    """
    dates = prices.select(key, date).distinct()
    matched = asof_join(dates, name_segments(names, key, start, end), [key], date, "_begin", direction="backward")
    known = matched.select(key, date, F.inline("_records"))
    return prices.join(known, [key, date])


def name_segments(names: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """(key, _begin, _records): from ``_begin`` to the next segment, these records are in force.

    A security has some dozen name records in its life, so its list is small.
    """
    fields = [c for c in names.columns if c != key]
    records = names.filter(F.col(start).isNotNull()).groupBy(key).agg(F.collect_list(F.struct(*fields)).alias("_all"))
    # The day after an end begins a segment too, possibly an empty one.
    ends = F.array_compact(F.transform("_all", lambda r: F.date_add(r[end], 1)))
    begins = F.array_distinct(F.concat(F.transform("_all", lambda r: r[start].cast("date")), ends))
    cut = records.select(key, "_all", F.explode(begins).alias("_begin"))
    in_force = F.filter("_all", lambda r: (r[start] <= F.col("_begin")) & (r[end].isNull() | (r[end] >= F.col("_begin"))))
    return cut.select(key, "_begin", in_force.alias("_records"))


def _within_year(date: str, year: int) -> Column:
    """A year as bounds on the date itself, which a source can push down."""
    return (F.col(date) >= F.lit(dt.date(year, 1, 1))) & (F.col(date) < F.lit(dt.date(year + 1, 1, 1)))


def ingest_archive(
    prices: DataFrame,
    names: DataFrame,
    year: int,
    exchange: int = 3,
    share_codes: Sequence[int] = (10, 11),
) -> DataFrame:
    """One year of the archived source with the names in force."""
    rows = prices.filter(_within_year("date", year))
    listed = names.filter((F.col("exchcd") == exchange) & F.col("shrcd").isin(*share_codes))
    return with_names_in_force(rows, listed).drop("namedt", "nameenddt")


def ingest_archive_v2(
    prices: DataFrame,
    year: int,
    exchange: str = "Q",
    share_type: str = "NS",
    security_type: str = "EQTY",
    security_subtype: str = "COM",
) -> DataFrame:
    """One year of the archived v2 source: type filters and renames."""
    rows = prices.filter(
        _within_year("dlycaldt", year)
        & (F.col("primaryexch") == exchange)
        & (F.col("sharetype") == share_type)
        & (F.col("securitytype") == security_type)
        & (F.col("securitysubtype") == security_subtype)
    )
    return rows.withColumnsRenamed(ARCHIVE_V2_COLUMNS)
