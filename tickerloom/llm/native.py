"""Helpers for operators made of DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` has lambdas of its own."""
    return F.element_at(F.transform(F.array(value), use), 1)


def upto(n: Column) -> Column:
    """The numbers from 0 to before ``n``; none if ``n`` is 0."""
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
