"""Performance of parameter sets: comparison table, rankings, coverage, sensitivity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .backtest import HORIZONS

FACTORS = (
    "annual_growth_pct",
    "quarterly_growth_pct",
    "annual_years",
    "quarter_count",
    "volume_ratio_threshold",
    "volume_surge_min_days",
)
SET_COLUMNS = ("parameter_set_id", "parameter_set_name", *FACTORS)
MINIMUM_SAMPLE = {"A_F": 30, "A_H": 15}


def _with_parameters(rows: DataFrame, params: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Attach parameter columns to one-row-per-set results (after aggregation, so both are small)."""
    return rows.join(params.select(*columns), "parameter_set_id")


def performance_comparison(params: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Sample sizes, mean, median and win rate per horizon, and date ranges, per set and screen."""
    cells = [F.count(F.lit(1)).alias("sample_size")]
    for h in HORIZONS:
        value = F.col(f"return_{h}_pct")
        cells += [
            F.count(value).alias(f"sample_size_{h}"),
            F.round(F.avg(value), 2).alias(f"avg_return_{h}_pct"),
            F.round(
                F.try_divide(F.count_if(value > 0) * F.lit(100.0), F.count(value)), 2
            ).alias(f"win_rate_{h}_pct"),
        ]
    cells += [
        F.min("signal_date").alias("earliest_signal_date"),
        F.max("signal_date").alias("latest_signal_date"),
        F.min("selected_date").alias("earliest_entry_date"),
        F.max("selected_date").alias("latest_entry_date"),
    ]
    keys = ["parameter_set_id", "screen_type"]
    measures = {f"median_return_{h}_pct": f"return_{h}_pct" for h in HORIZONS}
    medians = exact_medians(outcomes, keys, measures)
    rounded = {name: F.round(name, 2) for name in measures}
    stats = outcomes.groupBy(*keys).agg(*cells).join(medians.withColumns(rounded), keys, "left")
    return _with_parameters(stats, params, SET_COLUMNS)


def performance_order(perf: DataFrame) -> DataFrame:
    return perf.orderBy("screen_type", F.desc("sample_size"), "parameter_set_id")


def total_return_summary(params: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Total return, drawdown and best return per set and screen."""
    keys = ["parameter_set_id", "screen_type"]
    stats = outcomes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sample_size"),
        F.round(F.avg("return_pct"), 2).alias("avg_return_pct"),
        F.round(F.count_if(F.col("return_pct") > 0) * 100.0 / F.count(F.lit(1)), 2).alias(
            "win_rate_pct"
        ),
        F.round(F.avg("max_drawdown_pct"), 2).alias("avg_drawdown_pct"),
        F.round(F.avg("max_return_pct"), 2).alias("avg_max_return_pct"),
    )
    medians = exact_medians(outcomes, keys, {"median_return_pct": "return_pct"})
    medians = medians.withColumn("median_return_pct", F.round("median_return_pct", 2))
    rows = stats.join(medians, keys, "left")
    return _with_parameters(rows, params, ("parameter_set_id", "parameter_set_name"))


def exact_medians(df: DataFrame, keys: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """Exact continuous median per group, without a group ever meeting in one task.

    1. Equal values are pre-aggregated into counts.  2. A mergeable sketch proposes cut
    points per group; any cut points are correct, good ones make the buckets even.
    3. Bucket counts (a bounded number per group) tell which bucket holds each middle
    element.  4. Only that bucket's values are ranked, with the rows before it as offset.
    """
    keys = list(keys)
    cuts = 64
    cells = [F.struct(F.lit(n).alias("measure"), F.col(c).alias("value")) for n, c in measures.items()]
    long = df.select(*keys, F.explode(F.array(*cells)).alias("_c")).select(*keys, "_c.*")
    group = [*keys, "measure"]
    counts = (
        long.filter("value IS NOT NULL").groupBy(*group, "value").agg(F.count(F.lit(1)).alias("c"))
    )
    points = [i / cuts for i in range(1, cuts)]
    sketch = counts.groupBy(*group).agg(
        F.percentile_approx("value", points, 1000).alias("cut_points"), F.sum("c").alias("n")
    )
    bucketed = counts.join(sketch, group).withColumn(
        "bucket", F.size(F.filter("cut_points", lambda p: p < F.col("value")))
    )
    before = (
        Window.partitionBy(*group)
        .orderBy("bucket")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # Zero-based positions of the two middle elements (equal for odd sizes).
    low, high = F.expr("(n - 1) div 2"), F.expr("n div 2")
    middle = (
        bucketed.groupBy(*group, "bucket", "n")
        .agg(F.sum("c").alias("c"))
        .withColumn("end", F.sum("c").over(before))
        .withColumn("start", F.col("end") - F.col("c"))
        .filter(
            ((F.col("start") <= low) & (low < F.col("end")))
            | ((F.col("start") <= high) & (high < F.col("end")))
        )
        .select(*group, "bucket", "start")
    )
    rank = (
        Window.partitionBy(*group, "bucket")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    picked = (
        bucketed.join(middle, [*group, "bucket"])
        .withColumn("end", F.col("start") + F.sum("c").over(rank))
        .withColumn("start", F.col("end") - F.col("c"))
        .withColumn("is_low", (F.col("start") <= low) & (low < F.col("end")))
        .withColumn("is_high", (F.col("start") <= high) & (high < F.col("end")))
    )
    lower = F.max(F.when(F.col("is_low"), F.col("value")))
    upper = F.max(F.when(F.col("is_high"), F.col("value")))
    medians = picked.filter("is_low OR is_high").groupBy(*group).agg(((lower + upper) / 2).alias("median"))
    return medians.groupBy(*keys).agg(
        *[F.max(F.when(F.col("measure") == n, F.col("median"))).alias(n) for n in measures]
    )


def _minimum_sample(minimums: dict[str, int]):
    pairs = [F.lit(x) for kv in minimums.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("screen_type")), F.lit(0))


def _eligible(horizon: str, minimums: dict[str, int]):
    return (F.col(f"sample_size_{horizon}") >= _minimum_sample(minimums)) & F.col(
        f"avg_return_{horizon}_pct"
    ).isNotNull()


def _horizon_rank(horizon: str) -> Window:
    return Window.partitionBy("screen_type").orderBy(
        F.desc(f"avg_return_{horizon}_pct"), F.desc(f"sample_size_{horizon}"), "parameter_set_id"
    )


def horizon_ranking(
    perf: DataFrame, horizon: str, minimums: dict[str, int] | None = None
) -> DataFrame:
    """Sets with enough completed samples, ranked by mean return within each screen.

    Ranks run over one row per set and screen: the grid bounds a partition.
    """
    rows = perf.filter(_eligible(horizon, MINIMUM_SAMPLE if minimums is None else minimums))
    return rows.withColumn(f"rank_{horizon}", F.row_number().over(_horizon_rank(horizon)))


def combined_ranking(perf: DataFrame, minimums: dict[str, int] | None = None) -> DataFrame:
    """Mean of the three horizon ranks of sets that are eligible in all three."""
    minimums = MINIMUM_SAMPLE if minimums is None else minimums
    rows = perf
    for h in HORIZONS:
        rows = rows.filter(_eligible(h, minimums))
    rows = rows.withColumns({f"rank_{h}": F.row_number().over(_horizon_rank(h)) for h in HORIZONS})
    total = sum((F.col(f"rank_{h}") for h in HORIZONS), F.lit(0))
    return rows.withColumn("combined_rank_score", total / F.lit(len(HORIZONS)))


def combined_leaders(perf: DataFrame, minimums: dict[str, int] | None = None, n: int = 1) -> DataFrame:
    """Best ``n`` sets per screen by combined rank."""
    best = Window.partitionBy("screen_type").orderBy("combined_rank_score", "parameter_set_id")
    ranked = combined_ranking(perf, minimums).withColumn("leader_rank", F.row_number().over(best))
    return ranked.filter(F.col("leader_rank") <= n)


def screen_overview(perf: DataFrame, minimums: dict[str, int] | None = None) -> DataFrame:
    """Per screen: sets, sample sizes, the minimum and the sets eligible at every horizon."""
    minimums = MINIMUM_SAMPLE if minimums is None else minimums
    every = F.lit(True)
    for h in HORIZONS:
        every = every & _eligible(h, minimums)
    return perf.groupBy("screen_type").agg(
        F.count(F.lit(1)).alias("set_count"),
        F.sum("sample_size").alias("selections"),
        *[F.sum(f"sample_size_{h}").alias(f"completed_{h}") for h in HORIZONS],
        F.max(_minimum_sample(minimums)).alias("minimum_sample"),
        F.count_if(every).alias("combined_eligible"),
    )


def selection_counts(params: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Selected stocks per set and screen; sets without any selection stay with a NULL screen."""
    counts = outcomes.groupBy("parameter_set_id", "screen_type").agg(
        F.count(F.lit(1)).alias("selected_stock_count")
    )
    rows = params.join(counts, "parameter_set_id", "left")
    return rows.select(
        "parameter_set_id",
        *FACTORS,
        "daily_ma_tolerance_pct",
        "weekly_ma_tolerance_pct",
        "screen_type",
        F.coalesce("selected_stock_count", F.lit(0)).alias("selected_stock_count"),
    )


def mean_yield_by_factor(counts: DataFrame) -> DataFrame:
    """Mean selected stocks per factor value, one column per screen."""
    cells = [
        F.struct(F.lit(f).alias("factor"), F.col(f).cast("double").alias("factor_value"))
        for f in FACTORS
    ]
    long = counts.filter("screen_type IS NOT NULL").select(
        F.explode(F.array(*cells)).alias("_f"), "screen_type", "selected_stock_count"
    )
    return (
        long.groupBy("_f.factor", "_f.factor_value")
        .pivot("screen_type", ["A_F", "A_H"])
        .agg(F.avg("selected_stock_count"))
        .fillna(0.0, ["A_F", "A_H"])
        .withColumnsRenamed({"A_F": "mean_yield_a_f", "A_H": "mean_yield_a_h"})
    )


def parameter_sensitivity(counts: DataFrame) -> DataFrame:
    """Mean yield at the lowest and the highest value of each factor."""
    value = F.col("factor_value")
    return (
        mean_yield_by_factor(counts)
        .groupBy("factor")
        .agg(
            F.min(value).alias("low_value"),
            F.max(value).alias("high_value"),
            *[
                pick(f"mean_yield_{s}", value).alias(f"{end}_yield_{s}")
                for end, pick in (("low", F.min_by), ("high", F.max_by))
                for s in ("a_f", "a_h")
            ],
        )
    )


def coverage_ranking(counts: DataFrame) -> DataFrame:
    """Selected stocks per set by screen (absent = 0), their total and the A_H share."""
    wide = (
        counts.filter("screen_type IS NOT NULL")
        .groupBy("parameter_set_id", *FACTORS)
        .pivot("screen_type", ["A_F", "A_H"])
        .agg(F.sum("selected_stock_count"))
        .fillna(0, ["A_F", "A_H"])
        .withColumnsRenamed({"A_F": "selected_a_f", "A_H": "selected_a_h"})
    )
    base = F.when(F.col("selected_a_f") == 0, F.lit(1)).otherwise(F.col("selected_a_f"))
    return wide.withColumns(
        {
            "total": F.col("selected_a_f") + F.col("selected_a_h"),
            "a_h_share": F.col("selected_a_h") / base,
        }
    )


def top_coverage(ranking: DataFrame, n: int = 10) -> DataFrame:
    order = (F.desc("total"), F.desc("selected_a_h"), F.asc("parameter_set_id"))
    return ranking.orderBy(*order).limit(n)


def bottom_coverage(ranking: DataFrame, n: int = 10) -> DataFrame:
    return ranking.orderBy("total", "selected_a_h", "selected_a_f", "parameter_set_id").limit(n)
