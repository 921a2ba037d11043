"""Fundamental growth histories and their screens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.flags import or_false
from ..functions.prices import yoy_growth
from .dedup import latest_per_key

IDENTITY = ("ticker", "company_name", "currency", "exchange_code")


def annual_base(raw: DataFrame) -> DataFrame:
    """Keyed annual rows with the first known revenue measure."""
    return raw.filter("gvkey IS NOT NULL AND fyear IS NOT NULL").select(
        "gvkey",
        F.col("datadate").cast("date").alias("datadate"),
        "fyear",
        *IDENTITY,
        F.coalesce("sale", "revt").cast("double").alias("annual_revenue"),
        F.col("oiadp").cast("double").alias("annual_operating_income"),
    )


def annual_growth(raw: DataFrame, laid_out: bool = False) -> DataFrame:
    """Annual growth history: each fiscal year against the previous available one.

    Deduplication bounds a company to one row per fiscal year, and the lag and the
    recency rank share its partitioning.  ``laid_out``: ``raw`` is stored by company, and nothing
    is shuffled.
    """
    rows = latest_per_key(
        annual_base(raw),
        ["gvkey", "fyear"],
        ["datadate", "annual_revenue", "annual_operating_income"],
        laid_out,
    )
    by_year = Window.partitionBy("gvkey").orderBy("fyear")
    recent = Window.partitionBy("gvkey").orderBy(F.desc("fyear"), F.desc_nulls_last("datadate"))
    rows = rows.withColumns(
        {
            "prev_annual_revenue": F.lag("annual_revenue").over(by_year),
            "prev_annual_operating_income": F.lag("annual_operating_income").over(by_year),
        }
    ).withColumns(
        {
            "annual_revenue_growth_yoy": yoy_growth("annual_revenue", "prev_annual_revenue"),
            "annual_operating_income_growth_yoy": yoy_growth(
                "annual_operating_income", "prev_annual_operating_income"
            ),
        }
    )
    return _validity(rows, "annual").withColumn("annual_rank_desc", F.row_number().over(recent))


def quarterly_base(raw: DataFrame) -> DataFrame:
    """Keyed quarterly rows with the first known revenue measure."""
    keyed = raw.filter("gvkey IS NOT NULL AND fyearq IS NOT NULL AND fqtr IS NOT NULL")
    return keyed.select(
        "gvkey",
        F.col("datadate").cast("date").alias("datadate"),
        "fyearq",
        "fqtr",
        *IDENTITY,
        F.coalesce("saleq", "revtq").cast("double").alias("quarterly_revenue"),
        F.col("oiadpq").cast("double").alias("quarterly_operating_income"),
    )


def quarterly_growth(raw: DataFrame, laid_out: bool = False) -> DataFrame:
    """Quarterly growth history: each quarter against the same quarter of the prior year.

    The prior-year match is a lag over ``(gvkey, fqtr)`` kept only when the lagged fiscal
    year is exactly one less: quarters are unique, so this equals the self join and the
    quarters are shuffled once.
    """
    rows = latest_per_key(
        quarterly_base(raw),
        ["gvkey", "fyearq", "fqtr"],
        ["datadate", "quarterly_revenue", "quarterly_operating_income"],
        laid_out,
    )
    same_quarter = Window.partitionBy("gvkey", "fqtr").orderBy("fyearq")
    recent = Window.partitionBy("gvkey").orderBy(
        F.desc_nulls_last("datadate"), F.desc("fyearq"), F.desc("fqtr")
    )
    adjacent = F.lag("fyearq").over(same_quarter) == F.col("fyearq") - 1

    def prior(column: str) -> Column:
        return F.when(adjacent, F.lag(column).over(same_quarter))

    rows = (
        rows.repartition("gvkey")
        .withColumns(
            {
                "prev_year_same_quarter_revenue": prior("quarterly_revenue"),
                "prev_year_same_quarter_operating_income": prior("quarterly_operating_income"),
            }
        )
        .withColumns(
            {
                "quarterly_revenue_growth_yoy": yoy_growth(
                    "quarterly_revenue", "prev_year_same_quarter_revenue"
                ),
                "quarterly_operating_income_growth_yoy": yoy_growth(
                    "quarterly_operating_income", "prev_year_same_quarter_operating_income"
                ),
            }
        )
    )
    return _validity(rows, "quarterly").withColumn(
        "quarterly_rank_desc", F.row_number().over(recent)
    )


def _validity(rows: DataFrame, period: str) -> DataFrame:
    revenue = F.col(f"{period}_revenue_growth_yoy").isNotNull()
    income = F.col(f"{period}_operating_income_growth_yoy").isNotNull()
    return rows.withColumns(
        {
            f"has_valid_{period}_revenue_growth": revenue,
            f"has_valid_{period}_operating_income_growth": income,
            f"has_valid_{period}_growth_pair": revenue & income,
        }
    )


def recent_growth_flag(
    history: DataFrame,
    period: str,
    periods: int,
    threshold: float,
    flag: str,
    carry: dict[str, str] | None = None,
) -> DataFrame:
    """Per company: observations and minima over the last ``periods`` ranks, and the pass flag.

    Semantics (i): each measure must be known in all periods and its minimum must reach
    the threshold.  ``carry`` adds further columns of the latest row as ``{name: column}``.
    """
    revenue, income = f"{period}_revenue_growth_yoy", f"{period}_operating_income_growth_yoy"
    names = [f"{period}_revenue_growth", f"{period}_operating_income_growth"]
    first = F.col(f"{period}_rank_desc") == 1
    latest = (
        {"latest_annual_fyear": "fyear", "latest_annual_datadate": "datadate"}
        if period == "annual"
        else {
            "latest_quarterly_datadate": "datadate",
            "latest_fyearq": "fyearq",
            "latest_fqtr": "fqtr",
        }
    )
    stats = (
        history.filter(F.col(f"{period}_rank_desc") <= periods)
        .groupBy("gvkey")
        .agg(
            *[F.max(F.when(first, F.col(c))).alias(n) for n, c in (latest | (carry or {})).items()],
            *[F.count(c).alias(f"{n}_obs") for n, c in zip(names, (revenue, income))],
            F.min(revenue).alias(f"{period}_min_revenue_growth"),
            F.min(income).alias(f"{period}_min_operating_income_growth"),
        )
    )
    passed = (
        (F.col(f"{names[0]}_obs") == periods)
        & (F.col(f"{names[1]}_obs") == periods)
        & (F.col(f"{period}_min_revenue_growth") >= threshold)
        & (F.col(f"{period}_min_operating_income_growth") >= threshold)
    )
    return stats.withColumn(flag, or_false(passed))


def recent_pass_count(
    history: DataFrame, period: str, periods: int, threshold: float
) -> DataFrame:
    """Per company: rows among the last ``periods`` ranks where both growths pass (semantics ii)."""
    both = (F.col(f"{period}_revenue_growth") >= threshold) & (
        F.col(f"{period}_operating_income_growth") >= threshold
    )
    return (
        history.filter(F.col(f"{period}_rank_desc") <= periods)
        .groupBy("gvkey")
        .agg(F.count_if(both).alias(f"{period}_pass_count"))
    )


def company_identity(annual: DataFrame, quarterly: DataFrame) -> DataFrame:
    """Latest identity per company; the quarterly one wins column by column."""
    columns = ("ticker", "company_name", "currency")

    def latest(history: DataFrame, rank: str, prefix: str) -> DataFrame:
        renamed = [F.col(c).alias(f"{prefix}_{c}") for c in columns]
        return history.filter(F.col(rank) == 1).select("gvkey", *renamed)

    both = latest(annual, "annual_rank_desc", "a").join(
        latest(quarterly, "quarterly_rank_desc", "q"), "gvkey", "full"
    )
    return both.select(
        "gvkey", *[F.coalesce(F.col(f"q_{c}"), F.col(f"a_{c}")).alias(c) for c in columns]
    )


def screen_fundamentals(
    annual: DataFrame,
    quarterly: DataFrame,
    n_pct: float = 10,
    annual_years: int = 3,
    quarter_count: int = 4,
) -> DataFrame:
    """Conditions A and B per company with its identity, best first.

    Each history is aggregated once, identity included; the two meet in one full join.
    """
    threshold = float(n_pct) / 100.0
    identity = ("ticker", "company_name", "currency")
    a = recent_growth_flag(
        annual, "annual", annual_years, threshold, "flag_a", {f"a_{c}": c for c in identity}
    )
    b = recent_growth_flag(
        quarterly, "quarterly", quarter_count, threshold, "flag_b", {f"q_{c}": c for c in identity}
    )
    both = a.drop("latest_annual_datadate").join(
        b.drop("latest_fyearq", "latest_fqtr"), "gvkey", "full"
    )
    result = (
        both.withColumns({c: F.coalesce(F.col(f"q_{c}"), F.col(f"a_{c}")) for c in identity})
        .drop(*[f"{side}_{c}" for side in "aq" for c in identity])
        .withColumns({"flag_a": or_false(F.col("flag_a")), "flag_b": or_false(F.col("flag_b"))})
        .withColumn("flag_ab", F.col("flag_a") & F.col("flag_b"))
    )
    return result.orderBy(
        F.desc("flag_ab"),
        F.desc("flag_a"),
        F.desc("flag_b"),
        F.desc_nulls_last("annual_min_revenue_growth"),
        F.desc_nulls_last("quarterly_min_revenue_growth"),
    )


def growth_serving(history: DataFrame, period: str, source: str | None = None) -> DataFrame:
    """Serving shape of a growth history."""
    key: Sequence[str] = ("fyear",) if period == "annual" else ("fyearq", "fqtr")
    return history.select(
        F.col("gvkey").cast("string").alias("gvkey"),
        *[F.col(c).cast("int").alias(c) for c in key],
        F.col("datadate").cast("date").alias("datadate"),
        F.col(f"{period}_rank_desc").cast("int").alias(f"{period}_rank_desc"),
        f"{period}_revenue",
        f"{period}_operating_income",
        F.col(f"{period}_revenue_growth_yoy").alias(f"{period}_revenue_growth"),
        F.col(f"{period}_operating_income_growth_yoy").alias(f"{period}_operating_income_growth"),
        F.lit(None).cast("date").alias("source_extract_date"),
        F.lit(source).cast("string").alias("source_path"),
    )
