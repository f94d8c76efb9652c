"""The named queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under ``name`` or its own name."""

    def add(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            SQL[key] = sql
        return function

    return add


def plain(df: DataFrame) -> DataFrame:
    """Dates, times and decimals as text and lists joined, so that any engine shows them alike."""

    def shown(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)):
            column = column.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        return column.alias(field.name)

    return df.select(*[shown(field) for field in df.schema])
