"""Joins beyond the plain ones that DataFrame.join already states."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampertide.functions.collation import collated
from ampertide.operators.numbering import first_per_key, number_in_groups
from ampertide.operators.reshaping import nest


def with_scalars(df: DataFrame, *one_row_frames: DataFrame) -> DataFrame:
    """Attach the columns of frames that hold one row, or none.

    Each frame is a scalar subquery: it runs once and its values enter the plan
    as constants, so nothing is joined. More than one row fails the query; with
    no row the list to unfold is empty, and so is the result.
    """
    for frame in one_row_frames:
        row = frame.select(F.struct(*frame.columns)).scalar()
        df = df.select(*df.columns, F.inline(F.array_compact(F.array(row))))
    return df


def left_chain(anchor: DataFrame, on: Sequence[str], *others: DataFrame) -> DataFrame:
    """Left joins on one key, anchored on the first frame.

    Frames grouped by ``on`` are already placed by that key, so the chain adds
    no further shuffle.
    """
    for other in others:
        anchor = anchor.join(other, list(on), "left")
    return anchor


def attach_matches(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    element: Sequence[str],
    measures: Mapping[str, Column],
    domain: Sequence,
    name: str = "matches",
) -> DataFrame:
    """Group join: matches as an array, empty when there are none.

    The array holds one entry per distinct ``element`` of the declared ``domain`` (see
    ``nest``). Where every match counts, ``match_rows`` gives rows.
    """
    nested = nest(right, on, element, measures, name, domain)
    item_type = nested.schema[name].dataType.simpleString()
    return left.join(nested, list(on), "left").withColumn(
        name, F.coalesce(F.col(name), F.array().cast(item_type))
    )


def left_rows(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join whose right side may hold most of its rows under one key.

    A left outer join can split a hot key of its left side only. Here the matches are an
    inner join, which adaptive execution splits on either side and may broadcast the
    left of, and left rows without a match are added by an anti join on the distinct
    right keys.
    """
    keys = list(on)
    matched = left.join(right, keys)
    alone = left.join(right.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def match_rows(
    left: DataFrame, right: DataFrame, on: Sequence[str], order: Sequence[Column], rank: str = "rn"
) -> DataFrame:
    """Group join in rows: every match with its place inside the key, and left rows without a match with place NULL."""
    return left_rows(left, number_in_groups(right, on, order, rank), on)


def without_match(
    df: DataFrame, key: Column, other: DataFrame, other_key: Column, collation: str | None = None
) -> DataFrame:
    """Rows whose computed key has no partner (NOT EXISTS). ``collation``: how text keys compare, see ``collated``."""
    key, other_key = collated(key, collation), collated(other_key, collation)
    keys = other.select(other_key.alias("_other")).where(F.col("_other").isNotNull()).distinct()
    return df.withColumn("_key", key).join(keys, F.col("_key") == F.col("_other"), "left_anti").drop("_key")


def on_key(
    left: DataFrame,
    left_key: Column,
    right: DataFrame,
    right_key: Column,
    how: str = "inner",
    collation: str | None = None,
) -> DataFrame:
    """Equi-join on computed keys. ``collation``: how text keys compare, see ``collated``."""
    a = left.withColumn("_left_key", collated(left_key, collation))
    b = right.withColumn("_right_key", collated(right_key, collation))
    return a.join(b, F.col("_left_key") == F.col("_right_key"), how).drop("_left_key", "_right_key")


def rank_aligned(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_order: Sequence[Column],
    right_order: Sequence[Column],
    rank: str = "rn",
) -> DataFrame:
    """n-th row of a left group with the n-th row of the same right group.

    The join key (group, rank) is unique on both sides, so a large group is
    spread by its ranks.
    """
    a = number_in_groups(left, on, left_order, rank)
    b = number_in_groups(right, on, right_order, rank)
    return a.join(b, [*on, rank])


def best_match(
    left: DataFrame,
    left_key: Column,
    right: DataFrame,
    right_key: Column,
    order: Sequence[Column],
    collation: str | None = None,
) -> DataFrame:
    """Each left row with the first right row of its key, in ``order``.

    The right side is reduced to one row per key before the join.
    """
    best = first_per_key(right.withColumn("_best_key", collated(right_key, collation)), ["_best_key"], order)
    return on_key(left, collated(left_key, collation), best, F.col("_best_key")).drop("_best_key")
