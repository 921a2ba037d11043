"""Universe quality filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import REASON_SEPARATOR, exclusion_reason, search_text

SCREEN_FLAGS = (
    "flag_a",
    "flag_b",
    "flag_c",
    "flag_d",
    "flag_e",
    "flag_f",
    "flag_g",
    "flag_h",
    "flag_ab",
    "flag_cd",
    "flag_all",
)


def annotate_universe(
    df: DataFrame, ticker: str = "ticker", name: str = "company_name", iid: str = "iid"
) -> DataFrame:
    """Add the exclusion reasons and whether the security is excluded."""
    text = search_text(ticker, name, iid)
    # The lambda binds the text and its lower-case form once per row, also when a filter on
    # the result is pushed down and inlines the expression.
    bound = F.array(F.struct(text.alias("text"), F.lower(text).alias("folded")))
    reason = F.transform(bound, lambda r: exclusion_reason(r["text"], r["folded"]))
    return df.withColumn("exclusion_reason", F.element_at(reason, 1)).withColumn(
        "is_excluded_universe", F.col("exclusion_reason") != ""
    )


def kept_universe(annotated: DataFrame, enabled: bool = True) -> DataFrame:
    return annotated.filter(~F.col("is_excluded_universe")) if enabled else annotated


def excluded_universe(annotated: DataFrame) -> DataFrame:
    return annotated.filter("is_excluded_universe")


def exclusion_reason_counts(annotated: DataFrame) -> DataFrame:
    """Rows per exclusion reason, most frequent first."""
    reasons = excluded_universe(annotated).select(
        F.explode(F.split("exclusion_reason", REASON_SEPARATOR)).alias("reason")
    )
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("row_count")).orderBy(
        F.desc("row_count"), "reason"
    )


def universe_summary(annotated: DataFrame, enabled: bool = True) -> DataFrame:
    """Row and flag counts before and after the filter, one row per measure, in one scan."""
    kept = ~F.col("is_excluded_universe") if enabled else F.lit(True)
    flags = [f for f in SCREEN_FLAGS if f in annotated.columns]
    cells = [
        F.struct(
            F.lit("rows").alias("measure"),
            F.count(F.lit(1)).alias("before_filter"),
            F.count_if(kept).alias("after_filter"),
        ),
        *[
            F.struct(
                F.lit(flag).alias("measure"),
                F.count_if(F.col(flag)).alias("before_filter"),
                F.count_if(F.col(flag) & kept).alias("after_filter"),
            )
            for flag in flags
        ],
    ]
    return annotated.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
