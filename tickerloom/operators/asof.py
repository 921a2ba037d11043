"""As-of matching without a native as-of join.

Both sides are stacked, sorted once by (key, time) and scanned by a running window:
O(n log n) per key, never a pair of rows per match candidate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    direction: str = "forward",
    how: str = "inner",
) -> DataFrame:
    """Match each left row to the nearest right row of the same key.

    ``forward`` takes the first right time >= the left time, ``backward`` the last
    right time <= it.  At most one match per left row; right times are expected to be
    unique per key.  Left columns win on equal names.

    A key is scanned by one task, so keep its rows bounded: deduplicate to one row per key
    and date first, as all callers here do.
    """
    if direction not in ("forward", "backward"):
        raise ValueError(f"direction must be forward or backward, not {direction!r}")
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    extra = [c for c in right.columns if c not in left.columns]
    left_type = f"struct<{_fields(left, left.columns)}>"
    right_type = f"struct<{_fields(right, extra)}>"
    keys = [F.col(c) for c in by]
    lefts = left.select(
        *keys,
        F.col(left_time).alias("_time"),
        F.lit(1).alias("_side"),
        F.struct(*left.columns).alias("_left"),
        F.lit(None).cast(right_type).alias("_right"),
    )
    rights = right.select(
        *keys,
        F.col(right_time).alias("_time"),
        F.lit(0).alias("_side"),
        F.lit(None).cast(left_type).alias("_left"),
        F.struct(*extra).alias("_right"),
    ).filter(F.col("_time").isNotNull())
    time = F.desc_nulls_first("_time") if direction == "forward" else F.asc_nulls_first("_time")
    scan = (
        Window.partitionBy(*by)
        .orderBy(time, "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    matched = (
        lefts.unionByName(rights)
        .withColumn("_right", F.last("_right", ignorenulls=True).over(scan))
        .filter(F.col("_left").isNotNull())
    )
    if how == "inner":
        matched = matched.filter(F.col("_right").isNotNull() & F.col("_time").isNotNull())
    # Keys come from their own columns and not from the struct, so that the layout by key stays known.
    return matched.select(
        *[F.col(c) if c in by else F.col("_left").getField(c).alias(c) for c in left.columns],
        *[F.col("_right").getField(c).alias(c) for c in extra],
    )


def _fields(df: DataFrame, names: Sequence[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join(f"`{n}`: {types[n]}" for n in names)
