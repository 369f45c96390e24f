"""Row numbers, surrogate ids and first-per-key.

Numbers over a whole table or inside groups come from a range shuffle: rows are
ordered across partitions, numbered inside each, and shifted by the row counts of the
partitions before. The ordered rows are stored
before they are counted, because sampled range bounds may differ between two
runs of the same shuffle. Equal rows are spread by their place in the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampertide.functions.collation import collated
from ampertide.session import materialise, with_row_tie

_SLOT_BITS = 33


def _partition() -> Column:
    """Number of the range partition in a slot."""
    return F.shiftright("_slot", _SLOT_BITS)


def _position() -> Column:
    """Position inside the range partition, from 0."""
    return F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))


def _stored_in_order(df: DataFrame, order: Sequence[Column], unique: bool) -> DataFrame:
    """Rows in range partitions, with a slot (partition number, position)."""
    rows = df if unique else with_row_tie(df)
    order = list(order) if unique else [*order, F.col("_tie")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    slots = ordered.withColumn("_slot", F.monotonically_increasing_id())
    return materialise(slots.drop("_tie"), "ordered")


def ascending(*names: str) -> list[Column]:
    return [F.col(name).asc_nulls_first() for name in names]


def number_rows(
    df: DataFrame, order: Sequence[Column], name: str = "rn", after: DataFrame | None = None, unique: bool = False
) -> DataFrame:
    """Dense numbers 1..n over the whole table.

    Rows that tie in ``order`` are numbered in some order. ``after``: frame of
    one row and column, the number to continue from. ``unique``: no two rows agree in
    ``order``, so nothing is needed to tell them apart.
    """
    stored = _stored_in_order(df, order, unique)
    sizes = stored.groupBy(_partition().alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # One row per range partition, hence at most spark.sql.shuffle.partitions rows.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    numbered = stored.withColumn("_part", _partition()).join(F.broadcast(starts), "_part")
    number = F.col("_start") + _position() + 1
    if after is not None:
        number = number + after.scalar()
    return numbered.select(*df.columns, number.cast("long").alias(name))


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], weight: Column, name: str, unique: bool = False
) -> DataFrame:
    """Sum of ``weight`` over the rows of the group up to and including this one, as BIGINT.

    Rows are range-shuffled by group and order, so that a large group spans as many
    partitions as it needs and small ones share one. Rows that tie come in some order.
    """
    stored = _stored_in_order(df, [*ascending(*keys), *order], unique).withColumn("_part", _partition())
    runs = stored.groupBy("_part", *keys).agg(F.sum(weight).alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # Only the first group of a partition can continue an earlier one: at most one row per range partition is left.
    carried = (
        runs.withColumn("_start", F.sum("_size").over(before))
        .where(F.col("_start").isNotNull())
        .select(F.col("_part").alias("_cp"), "_start", *(F.col(k).alias(f"_c_{k}") for k in keys))
    )
    same = F.col("_part") == F.col("_cp")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_c_{key}"))
    upto = Window.partitionBy("_part", *keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    return (
        stored.withColumn("_local", F.sum(weight).over(upto))
        .join(F.broadcast(carried), same, "left")
        .select(*df.columns, (F.coalesce("_start", F.lit(0)) + F.col("_local")).cast("long").alias(name))
    )


def _group_keys(df: DataFrame, keys: Sequence[str], collation: str | None) -> tuple[DataFrame, list[str]]:
    """``df`` with the columns to group by, which are ``keys`` themselves unless texts compare under a collation."""
    texts = [k for k in keys if collation is not None and df.schema[k].dataType.typeName() == "string"]
    grouped = df.withColumns({f"_group_{k}": collated(F.col(k), collation) for k in texts})
    return grouped, [f"_group_{k}" if k in texts else k for k in keys]


def number_in_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str = "rn",
    unique: bool = False,
    collation: str | None = None,
) -> DataFrame:
    """Row number inside each group, as BIGINT, however large the group is.

    ``unique``: no two rows agree in keys and order, so nothing is needed to tell them apart.
    ``collation``: how text keys compare, see ``collated``.
    """
    grouped, by = _group_keys(df, keys, collation)
    return running_total(grouped, by, order, F.lit(1), name, unique).select(*df.columns, name)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], collation: str | None = None
) -> DataFrame:
    """First row of each group.

    The filter on the row number lets every task drop all but one row per key
    before the shuffle. ``collation``: how text keys compare, see ``collated``.
    """
    grouped, by = _group_keys(df, keys, collation)
    first = Window.partitionBy(*by).orderBy(*order)
    return grouped.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").select(*df.columns)
