"""The reference data model, derived from the driver tables.

A security is a supplier (``gvkey``) and a line status (``iid``); every line item is one
raw daily price row on its ship date.  Weekend dates count for the Friday before, so all
line items take part and copies of a (security, date) key occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import SECURITY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trading_day(timestamp: str) -> Column:
    day = F.col(timestamp).cast("date")
    return F.date_sub(day, F.greatest(F.weekday(day) - 4, F.lit(0)))


def raw_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw daily security rows with their company names."""
    return with_names(spark, sf_dir, prices(spark, sf_dir))


#: What follows a supplier's name, by its key modulo 24: names that each universe rule excludes, one of
#: them by several, and one that only looks like it.
NAME_SUFFIXES = {
    1: " WARRANTS",
    3: " Rights",
    5: " Units",
    7: " ACQUISITION CORP",
    9: " -REDH",
    11: " Redeemable Unit",
    13: " Warrant Right Unit",
    15: " UNITED WARRANTY",
}


def company_name() -> Column:
    suffix = F.lit("")
    for key, text in NAME_SUFFIXES.items():
        suffix = F.when(F.col("s_suppkey") % 24 == key, text).otherwise(suffix)
    return F.concat("s_name", suffix)


def with_names(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Adds the company names; after deduplication this moves them through one shuffle less."""
    supplier = table(spark, sf_dir, "supplier")
    names = supplier.select(F.col("s_suppkey").cast("string").alias("gvkey"), company_name().alias("company_name"))
    return rows.join(names, "gvkey", "left")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw daily security rows without names, for queries that show none."""
    return table(spark, sf_dir, "lineitem").select(*_price_columns(trading_day("l_shipdate"), F.col("l_suppkey").cast("string"), F.col("l_linestatus")))


#: The values of a line item behind all columns of its price row.
LINE_VALUES = ("l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")


def line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items under their security and date: what moves in place of the wider price rows."""
    line = table(spark, sf_dir, "lineitem")
    key = [F.col("l_suppkey").cast("string").alias("gvkey"), F.col("l_linestatus").alias("iid")]
    return line.select(trading_day("l_shipdate").alias("date"), *key, *LINE_VALUES)


def prices_of(rows: DataFrame) -> DataFrame:
    """Raw daily security rows of ``line_rows``; further columns stay."""
    columns = _price_columns(F.col("date"), F.col("gvkey"), F.col("iid"))
    return rows.select(*columns, *[c for c in rows.columns if c not in ("date", *SECURITY)])


def _price_columns(date: Column, gvkey: Column, iid: Column) -> list[Column]:
    """Some adjusted closes are given, some factors are missing."""
    close = F.try_divide("l_extendedprice", "l_quantity")
    factor = F.when(F.col("l_tax") > 0, F.col("l_tax") + 1)
    given = F.when(F.col("l_returnflag") == "A", close / (F.col("l_tax") + 1))
    return [
        date.alias("date"),
        gvkey.alias("gvkey"),
        iid.alias("iid"),
        F.concat_ws("-", F.lit("T"), gvkey, iid).alias("ticker"),
        F.lit("USD").alias("currency"),
        close.alias("close_price_raw"),
        (close * (1 - F.col("l_discount"))).alias("open_price_raw"),
        (close * (1 + F.col("l_discount"))).alias("high_price_raw"),
        (close * (1 - F.col("l_discount"))).alias("low_price_raw"),
        F.col("l_quantity").alias("volume"),
        F.col("l_partkey").cast("double").alias("shares_outstanding"),
        factor.alias("adjustment_factor"),
        F.lit(1.0).alias("total_return_factor"),
        F.lit(14).alias("exchange_code"),
        F.lit("A").alias("security_status"),
        F.lit("0").alias("issue_type_code"),
        given.alias("adjusted_close_price"),
    ]


# Copies of a (security, date) key: the largest trade wins, further columns break ties.
TIEBREAK = (
    "volume",
    "close_price_raw",
    "adjusted_close_price",
    "adjustment_factor",
    "high_price_raw",
    "shares_outstanding",
)


def vendor_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vendor's daily security table, with rows the ingest filters must drop."""
    line = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", company_name().alias("company_name"))
    close = F.try_divide("l_extendedprice", "l_quantity")
    nothing = F.lit(None).cast("string")
    return line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left").select(
        trading_day("l_shipdate").alias("datadate"),
        F.col("l_suppkey").cast("string").alias("gvkey"),
        F.col("l_linestatus").alias("iid"),
        F.concat_ws("-", F.lit("T"), F.col("l_suppkey").cast("string"), "l_linestatus").alias("tic"),
        F.col("company_name").alias("conm"),
        nothing.alias("cusip"),
        nothing.alias("cik"),
        F.when(F.col("l_tax") < 0.07, 14).otherwise(11).alias("exchg"),
        F.when(F.col("l_returnflag") == "R", "I").otherwise("A").alias("secstat"),
        F.when(F.col("l_discount") < 0.09, "0").otherwise("1").alias("tpci"),
        F.when(F.col("l_quantity") < 49, close).alias("prccd"),
        (close * (1 - F.col("l_discount"))).alias("prcod"),
        (close * (1 + F.col("l_discount"))).alias("prchd"),
        (close * (1 - F.col("l_discount"))).alias("prcld"),
        F.when(F.col("l_quantity") > 2, F.col("l_quantity")).alias("cshtrd"),
        F.col("l_partkey").cast("double").alias("cshoc"),
        F.when(F.col("l_tax") > 0, F.col("l_tax") + 1).alias("ajexdi"),
        F.lit(1.0).alias("trfd"),
        F.lit("USD").alias("curcdd"),
        F.lit("USA").alias("fic"),
    )


def quarter_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of a supplier per fiscal quarter and return flag: restated filings.

    The one pass over line items and orders behind all fundamentals; years are sums of these
    quarters.  Amounts are whole cents and basis points, so sums do not depend on the order of
    addition.
    """
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_returnflag", "l_extendedprice", "l_discount"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    cents = F.rint(F.col("l_extendedprice") * 100).cast("long")
    margin = 6 - F.rint(F.col("l_discount") * 100).cast("long")
    period = {"fyearq": F.year("o_orderdate"), "fqtr": F.quarter("o_orderdate")}
    return (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumns(period)
        .groupBy("l_suppkey", *period, "l_returnflag")
        .agg(
            F.max(F.col("o_orderdate").cast("date")).alias("datadate"),
            F.sum(cents).alias("cents"),
            F.sum(cents * margin).alias("margin"),
        )
        .withColumn("gvkey", F.col("l_suppkey").cast("string"))
        .drop("l_suppkey")
    )


def _filings(spark: SparkSession, sf_dir: str, period: list[Column]) -> DataFrame:
    """Filings per company, period and return flag, summed up from the stored quarters."""
    from .layers import layer

    sums = layer(spark, sf_dir, "filings").groupBy("gvkey", *period, "l_returnflag").agg(
        F.max("datadate").alias("datadate"),
        (F.sum("cents") / F.lit(100.0)).alias("revenue"),
        (F.sum("margin") / F.lit(10000.0)).alias("income"),
    )
    return with_names(spark, sf_dir, sums)


def vendor_annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _filings(spark, sf_dir, [F.col("fyearq").alias("fyear")])
    return rows.select(
        *_filing_header(),
        "fyear",
        F.lit("USD").alias("curcd"),
        F.when(F.col("l_returnflag") != "N", F.col("revenue")).alias("sale"),
        F.col("revenue").alias("revt"),
        F.col("income").alias("oiadp"),
    )


def vendor_quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _filings(spark, sf_dir, [F.col("fyearq"), F.col("fqtr")])
    return rows.select(
        *_filing_header(),
        "fyearq",
        "fqtr",
        F.lit("USD").alias("curcdq"),
        F.when(F.col("l_returnflag") != "N", F.col("revenue")).alias("saleq"),
        F.col("revenue").alias("revtq"),
        F.col("income").alias("oiadpq"),
    )


def _filing_header() -> list[Column | str]:
    return [
        "gvkey",
        F.col("datadate"),
        F.when(F.col("l_returnflag") == "R", "FS").otherwise("INDL").alias("indfmt"),
        F.lit("C").alias("consol"),
        F.lit("D").alias("popsrc"),
        F.lit("STD").alias("datafmt"),
        F.concat_ws("-", F.lit("T"), "gvkey").alias("tic"),
        F.col("company_name").alias("conm"),
        F.lit(14).alias("exchg"),
    ]


def raw_annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.ingest import ANNUAL_RENAMES

    return vendor_annual(spark, sf_dir).withColumnsRenamed(ANNUAL_RENAMES)


def raw_quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.ingest import QUARTERLY_RENAMES

    return vendor_quarterly(spark, sf_dir).withColumnsRenamed(QUARTERLY_RENAMES)
