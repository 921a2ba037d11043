"""One column list for both sides of a query: Spark select and SQL select.

``"date gvkey ma20:float fyear:int"`` keeps four columns and casts two of them.  Averages
go through single precision, because engines add window frames in different orders and the
last bits of a double differ; all other doubles are compared exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SQL_TYPES = {"int": "INTEGER", "long": "BIGINT", "double": "DOUBLE", "date": "DATE", "string": "VARCHAR"}


def _parts(spec: str):
    for item in spec.split():
        name, _, how = item.partition(":")
        yield name, how


def shape(df: DataFrame, spec: str) -> DataFrame:
    columns = []
    for name, how in _parts(spec):
        c = F.col(name)
        if how == "float":
            c = c.cast("float").cast("double")
        elif how:
            c = c.cast(how)
        columns.append(c.alias(name))
    return df.select(*columns)


def shape_sql(source: str, spec: str, tail: str = "") -> str:
    columns = []
    for name, how in _parts(spec):
        if how == "float":
            columns.append(f"CAST(CAST({name} AS FLOAT) AS DOUBLE) AS {name}")
        elif how:
            columns.append(f"CAST({name} AS {SQL_TYPES[how]}) AS {name}")
        else:
            columns.append(name)
    return f"SELECT {', '.join(columns)} FROM {source} {tail}".strip()
