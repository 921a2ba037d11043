"""Price, ratio and growth expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def adjusted_close(given: str, raw: str, factor: str, keep_raw: bool = False) -> Column:
    """Given adjusted close, else raw / factor, else NULL (or the raw close).

    ``keep_raw=True`` is the backtest variant whose last resort is the raw close.
    ``try_divide`` yields NULL for a zero or missing factor, so no branch can raise
    under ANSI mode.
    """
    candidates = [F.col(given), F.try_divide(F.col(raw), F.col(factor))]
    if keep_raw:
        candidates.append(F.col(raw))
    return F.coalesce(*candidates)


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator``, NULL when the denominator is 0 or NULL."""
    return F.try_divide(_col(numerator), _col(denominator))


def cluster_ratio(a: str, b: str, c: str) -> Column:
    """(max - min) / mean of three averages; NULL unless all three are known."""
    known = F.col(a).isNotNull() & F.col(b).isNotNull() & F.col(c).isNotNull()
    spread = F.greatest(a, b, c) - F.least(a, b, c)
    mean = (F.col(a) + F.col(b) + F.col(c)) / F.lit(3)
    return F.when(known, F.try_divide(spread, mean))


def yoy_growth(current: str, previous: str) -> Column:
    """Year-over-year growth, defined only against a positive previous value."""
    base = F.when(F.col(previous) > 0, F.col(previous))
    return F.try_divide(F.col(current) - base, base)


def percent_return(price: str, entry: str) -> Column:
    """Percent move from ``entry`` to ``price``; NULL for an unknown or zero entry."""
    return (F.try_divide(F.col(price), F.col(entry)) - F.lit(1)) * F.lit(100)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
