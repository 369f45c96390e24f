"""Registration of queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampertide.functions.numbers import exact_mean
from ampertide.sources.readers import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CENTS = 2
# Wider than any column, so that the SQL does not round before it adds up.
MONEY = "decimal(18,6)"


# Table path to schema, so that a table's footer is read once per process.
_SCHEMAS: dict[str, T.StructType] = {}


class Tables:
    """The test tables of one scale, by name; each is opened once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        table = read_table(self.spark, path, _SCHEMAS.get(path))
        _SCHEMAS[path] = table.schema
        setattr(self, name, table)
        return table


def proof(sql: str | None):
    """Register a function of ``Tables`` under its own name."""

    def register(function: Callable[[Tables], DataFrame]):
        name = function.__name__
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def mean(col: str, digits: int = CENTS) -> Column:
    return exact_mean(F.col(col), digits)


def sql_mean(expr: str, dtype: str = MONEY) -> str:
    """SQL text of ``mean``: exact decimal sum, one division."""
    return f"CAST(SUM(CAST({expr} AS {dtype})) AS DOUBLE) / COUNT({expr})"


def sql_half_up(expr: str, digits: int) -> str:
    """SQL text of decimal half-up rounding of a double."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(18,8)), {digits}) AS DOUBLE)"


def sql_half_up_written(expr: str, digits: int) -> str:
    """The same for large doubles, taken as they are written in decimals."""
    return f"CAST(ROUND(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"
