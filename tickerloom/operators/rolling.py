"""Row-frame windows per security.

Every window here is partitioned by security *after* deduplication to one row per
security and date, so a partition holds at most one row per calendar day: a hot
security cannot outgrow a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import SECURITY


def by_time(order: str, keys: Sequence[str] = SECURITY) -> Window:
    return Window.partitionBy(*keys).orderBy(order)


def trailing_mean(
    value: str, rows: int, order: str, keys: Sequence[str] = SECURITY, with_current: bool = True
) -> Column:
    """Mean of the last ``rows`` rows; shorter frames give partial means."""
    first, last = (-(rows - 1), 0) if with_current else (-rows, -1)
    return F.avg(value).over(by_time(order, keys).rowsBetween(first, last))


def add_trailing_means(
    df: DataFrame,
    value: str,
    names: dict[str, int],
    order: str,
    keys: Sequence[str] = SECURITY,
    with_current: bool = True,
) -> DataFrame:
    """Add one trailing mean per ``{column name: rows}``."""
    return df.withColumns(
        {n: trailing_mean(value, k, order, keys, with_current) for n, k in names.items()}
    )


def add_previous(
    df: DataFrame, columns: Sequence[str], order: str, keys: Sequence[str] = SECURITY
) -> DataFrame:
    """Add ``prev_<column>`` from the previous row."""
    w = by_time(order, keys)
    return df.withColumns({f"prev_{c}": F.lag(c).over(w) for c in columns})


def add_next(
    df: DataFrame, renames: dict[str, str], order: str, keys: Sequence[str] = SECURITY
) -> DataFrame:
    """Add the next row's values as ``{new name: source column}``."""
    w = by_time(order, keys)
    return df.withColumns({new: F.lead(old).over(w) for new, old in renames.items()})


def surge_days(
    value: str, threshold: float, order: str, months: int = 3, keys: Sequence[str] = SECURITY
) -> Column:
    """Rows with ``value >= threshold`` in the trailing calendar months, current row included."""
    return F.expr(
        f"count_if({value} >= {float(threshold)!r}D) OVER ("
        f"PARTITION BY {', '.join(keys)} ORDER BY {order} "
        f"RANGE BETWEEN INTERVAL {int(months)} MONTH PRECEDING AND CURRENT ROW)"
    )
