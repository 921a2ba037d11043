"""Registry of named queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracle import with_blocks
from .shape import shape, shape_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, columns: str, source: str | None = None, tail: str = ""):
    """Register a query.

    ``columns`` shapes both sides; ``source`` is a block name or a parenthesised SQL
    statement; without it the query has no SQL side.
    """

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return shape(build(spark, sf_dir), columns)

        run.__doc__ = build.__doc__
        run.__name__ = name
        QUERIES[name] = run
        if source is not None:
            from_sql = source if " " not in source.strip() else f"({source.strip()}) AS result"
            ORACLES[name] = with_blocks(shape_sql(from_sql, columns, tail))
        return build

    return register
