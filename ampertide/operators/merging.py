"""Keyed merges and backfill, as joins and unions before one write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampertide.functions.collation import collated
from ampertide.operators.joining import on_key
from ampertide.operators.quality import duplicates


def append_rows(target: DataFrame, source: DataFrame) -> DataFrame:
    """Union by name; a column missing on one side is NULL there."""
    return target.unionByName(source, allowMissingColumns=True)


def unique_rows(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``source``; a key that occurs twice fails the query that reads them.

    A key with a NULL part equals no other key and may repeat. The check is one
    grouping of the keys, whose result, one row, is a scalar subquery of the rows.
    """
    repeated = duplicates(source, keys).agg(
        F.min(F.concat_ws(", ", *(F.col(k).cast("string") for k in keys))).alias("key")
    )
    first = repeated.scalar()
    failed = F.raise_error(F.concat(F.lit("repeated merge key: "), first)).cast("boolean")
    return source.where(F.when(first.isNull(), True).otherwise(failed))


def merge_keep(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows stay, source rows with new keys are added; a repeated source key fails the query."""
    source = unique_rows(source, keys)
    new = source.join(target.select(*keys), list(keys), "left_anti").select(*source.columns)
    return append_rows(target, new)


def merge_replace(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows win as a whole, target rows without a source row stay; a repeated source key fails the query."""
    source = unique_rows(source, keys)
    kept = target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns)
    return append_rows(kept, source)


def backfill(
    target: DataFrame,
    target_key: Column,
    column: str,
    source: DataFrame,
    source_key: Column,
    value: Column,
    collation: str | None = None,
) -> DataFrame:
    """Fill NULLs of a column by the lowest source value with the same key. ``collation``: how text keys compare."""
    target_key, source_key = collated(target_key, collation), collated(source_key, collation)
    lookup = source.groupBy(source_key.alias("_k")).agg(F.min(value).alias("_fill"))
    filled = on_key(target, target_key, lookup, F.col("_k"), "left")
    columns = [
        F.coalesce(F.col(c), F.col("_fill")).alias(c) if c == column else F.col(c) for c in target.columns
    ]
    return filled.select(*columns)
