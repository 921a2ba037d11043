"""Aggregates with the reference dialect's NULL rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def value_at_latest(value: str, by: str) -> Column:
    """Value on the greatest ``by`` among rows whose value is known."""
    return F.max_by(value, F.when(F.col(value).isNotNull(), F.col(by)))


def value_at_earliest(value: str, by: str) -> Column:
    """Value on the smallest ``by`` among rows whose value is known."""
    return F.min_by(value, F.when(F.col(value).isNotNull(), F.col(by)))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)
