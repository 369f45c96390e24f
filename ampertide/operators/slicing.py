"""Filters and slices of long-form tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampertide.functions.codes import map_codes


def all_equal(values: Mapping[str, object]) -> Column:
    """Conjunction of equality tests."""
    return reduce(
        lambda a, b: a & b, (F.col(f"`{name}`") == F.lit(value) for name, value in values.items()), F.lit(True)
    )


def in_year(col: Column, year: int) -> Column:
    """Range test on a date or timestamp, which the Parquet scan can use."""
    return (col >= F.lit(dt.date(year, 1, 1))) & (col < F.lit(dt.date(year + 1, 1, 1)))


def optional_filter(df: DataFrame, column: str, value: object | None) -> DataFrame:
    """Equality filter, left out when no value is given."""
    return df if value is None else df.where(F.col(column) == F.lit(value))


def long_slice(
    df: DataFrame,
    *,
    equals: Mapping[str, object],
    entity: str,
    entity_codes: Mapping[str, str],
    period: Column,
    value: Column,
    value_type: str = "decimal(10,4)",
    names: Sequence[str] = ("country_code", "year", "value"),
) -> DataFrame:
    """One variable of a long-form table as (entity code, period, value)."""
    return df.where(all_equal(equals) & F.col(f"`{entity}`").isin(*entity_codes)).select(
        map_codes(F.col(f"`{entity}`"), entity_codes).alias(names[0]),
        period.alias(names[1]),
        value.cast(value_type).alias(names[2]),
    )


def last_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The last ``n`` rows in ascending order of ``order``.

    Each task keeps its own ``n`` rows before they meet.
    """
    return df.orderBy(*(F.col(c).desc_nulls_last() for c in order)).limit(n).orderBy(*order)


def first_match(df: DataFrame, condition: Column, *order: str) -> DataFrame:
    """First row, in a stated total order, that meets a condition."""
    return df.where(condition).orderBy(*(F.col(c).asc_nulls_first() for c in order)).limit(1)
