"""Condition flags (two- and three-valued)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def or_false(flag: Column) -> Column:
    """Unknown counts as failed."""
    return F.coalesce(flag, F.lit(False))


def ratios_within(ratios: Sequence[str], low: float, high: float) -> Column:
    """TRUE when every stored ratio lies in [low, high]; unknown ratios fail."""
    return or_false(all_of([F.col(r).between(low, high) for r in ratios]))


def crossed_above(prev_fast: str, prev_slow: str, fast: str, slow: str) -> Column:
    """The fast average was at or below the slow one on the previous row and is above now."""
    return (F.col(prev_fast) <= F.col(prev_slow)) & (F.col(fast) > F.col(slow))


def cluster_flag(
    fast: str, mid: str, slow: str, low: float, high: float, required: Sequence[str] = ()
) -> Column:
    """Three-valued tolerance test of three moving averages.

    NULL while any average (or ``required`` column) is unknown, FALSE for a zero
    denominator, otherwise whether all pairwise ratios lie in [low, high].
    """
    known = all_of([F.col(c).isNotNull() for c in (fast, mid, slow, *required)])
    pairs = [(fast, mid), (mid, slow), (fast, slow)]
    near = all_of([F.try_divide(F.col(x), F.col(y)).between(low, high) for x, y in pairs])
    return F.when(known, or_false(near))


def strict_cluster_flag(
    fast: str, mid: str, slow: str, low: float, high: float, required: Sequence[str] = ()
) -> Column:
    """As :func:`cluster_flag`, but unknown inputs fail."""
    return or_false(cluster_flag(fast, mid, slow, low, high, required))


def tolerance_band(percent: float) -> tuple[float, float]:
    """(1 - t, 1 + t) for a tolerance in percent."""
    t = float(percent) / 100.0
    return 1 - t, 1 + t
