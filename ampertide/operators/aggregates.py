"""Aggregations that stay balanced when one key holds most of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampertide.functions.collation import NAMES, collated
from ampertide.functions.numbers import scaled, unscaled
from ampertide.session import materialise


def mean_over_join(
    facts: DataFrame,
    members: DataFrame,
    on: str | Sequence[str],
    measures: Mapping[str, tuple[Column, int]],
    by: Sequence[str] = (),
    counts: Mapping[str, Column] | None = None,
    fact_by: Sequence[str] = (),
) -> DataFrame:
    """Means of fact columns over ``facts join members``, grouped by member columns.

    ``measures``: output name to (fact column, number of decimals it has at most).
    ``counts``: output name to a condition whose true rows are counted.
    ``fact_by``: further grouping columns that the facts bring along.
    With conditional measures one scan of the facts serves several means.
    Sums are exact (see ``exact_mean``): longs per key, decimals above them.
    The facts are summed per join key first, so a frequent key reaches the join
    as one row per key instead of one per fact; sums and counts then add up to
    the same mean as over the joined rows.
    """
    keys = [on] if isinstance(on, str) else list(on)
    counts = counts or {}
    parts = [F.count_if(condition).alias(f"_count_{name}") for name, condition in counts.items()]
    for name, (col, digits) in measures.items():
        parts += [F.sum(scaled(col, digits)).alias(f"_sum_{name}"), F.count(col).alias(f"_n_{name}")]
    joined = facts.groupBy(*keys, *fact_by).agg(*parts).join(members, keys)
    out = [
        (
            unscaled(F.sum(F.col(f"_sum_{name}").cast("decimal(20,0)")), digits)
            / F.nullif(F.sum(f"_n_{name}"), F.lit(0).cast("bigint"))
        ).alias(name)
        for name, (_, digits) in measures.items()
    ]
    out += [F.coalesce(F.sum(f"_count_{name}"), F.lit(0).cast("long")).alias(name) for name in counts]
    return joined.groupBy(*by, *fact_by).agg(*out)


def grouped_by_name(
    df: DataFrame, keys: Sequence[str], *measures: Column, collation: str | None = NAMES
) -> DataFrame:
    """Groups whose text keys compare under a collation; each is shown by its least spelling."""
    texts = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    by = [collated(F.col(k), collation if k in texts else None).alias(f"_group_{k}") for k in keys]
    shown = [F.min(k).alias(k) for k in keys]
    return df.groupBy(*by).agg(*shown, *measures).drop(*(f"_group_{k}" for k in keys))


def at_least(df: DataFrame, count_column: str, minimum: int) -> DataFrame:
    """HAVING on a count: a group, or the one global row, below ``minimum`` vanishes."""
    return df.where(F.col(count_column) >= F.lit(minimum))


#: Distinct values that the last step of a median ranks per group in one task, and the cuts of a group while it has more.
MEDIAN_VALUES = 1_000_000
_CUTS = 256
_ACCURACY = 10_000


def grouped_median(
    df: DataFrame, keys: Sequence[str], value: str, name: str = "median", most: int = MEDIAN_VALUES
) -> DataFrame:
    """Exact median per group without holding a group in one place.

    Values are counted on the map side, and the value at the middle rank is read off the
    running counts. A group of more than ``most`` rows is narrowed before: quantile
    sketches cut it, rows below the cut around the middle are counted, rows inside are cut
    again, so nothing but counts is shuffled or stored. Doubles have a double as median,
    whole numbers and decimals an exact decimal. NULL values do not count, a group of
    NULLs has no row; without keys there is one group.
    """
    own = list(keys) or ["_all"]
    # Fewer rows than some cuts hold would not be cut any further.
    most = max(most, 4 * _CUTS)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    rows = rows if keys else rows.withColumn("_all", F.lit(True))
    sizes = rows.groupBy(*own).agg(F.count(F.lit(1)).alias("_n"))
    if (sizes.agg(F.max("_n")).first()[0] or 0) > most:
        bounds = _narrowed(rows, sizes, own, most)
        rows = _between(rows, bounds, own)
        tallies = rows.groupBy(*own, "_v", "_n", "_below").agg(F.count(F.lit(1)).alias("_c"))
    else:
        group = Window.partitionBy(*own)
        tallies = rows.groupBy(*own, "_v").agg(F.count(F.lit(1)).alias("_c"))
        tallies = tallies.withColumns({"_n": F.sum("_c").over(group), "_below": F.lit(0)})
    order = Window.partitionBy(*own).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = tallies.withColumn("_upto", F.col("_below") + F.sum("_c").over(order))

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((F.col("_upto") >= rank) & (F.col("_upto") - F.col("_c") < rank), F.col("_v")))

    low, high = _middle_ranks()
    middle = ranked.groupBy(*own).agg(at_rank(low).alias("_low"), at_rank(high).alias("_high"))
    return middle.select(*keys, _halfway(rows.schema["_v"].dataType).alias(name))


def _middle_ranks() -> tuple[Column, Column]:
    return F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2)


def _halfway(kind: T.DataType) -> Column:
    """The mean of the two middle values, in a type that holds it."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (F.col("_low").cast("double") + F.col("_high").cast("double")) / 2.0
    digits, scale = (kind.precision, kind.scale) if isinstance(kind, T.DecimalType) else (20, 0)
    wide = f"decimal({min(38, digits + 2)},{min(37, scale + 1)})"
    # Half of an even distance is exact, half of an odd one has one decimal more.
    return (F.col("_low").cast(wide) + (F.col("_high").cast(wide) - F.col("_low").cast(wide)) * F.lit("0.5").cast("decimal(2,1)")).cast(wide)


def _with_figures(rows: DataFrame, figures: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beside the figures of their group; groups without figures go."""
    of = figures.select(*(F.col(k).alias(f"_of_{k}") if k in keys else F.col(k) for k in figures.columns))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys))
    return rows.join(of, same).drop(*(f"_of_{k}" for k in keys))


def _between(rows: DataFrame, bounds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows within the bounds of their group, which are doubles and inclusive."""
    v, low, high = F.col("_v").cast("double"), F.col("_lo"), F.col("_hi")
    inside = (low.isNull() | (v >= low)) & (high.isNull() | (v <= high))
    return _with_figures(rows, bounds.select(*keys, "_n", "_below", "_lo", "_hi"), keys).where(inside)


def _narrowed(rows: DataFrame, sizes: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """Per group the bounds of a stretch around the middle ranks, and the number of rows below it.

    No more than ``most`` rows are strictly between the bounds. Rows at a bound, however
    many, are of few values. A round leaves some hundredth of the rows between them.
    """
    none, zero = F.lit(None).cast("double"), F.lit(0).cast("long")
    bounds = sizes.select(
        *keys, "_n", zero.alias("_below"), zero.alias("_at_lo"), F.col("_n").alias("_m"), none.alias("_lo"), none.alias("_hi")
    )
    bounds = materialise(bounds, "bounds")
    large = F.col("_m") > most
    grid = [k / _CUTS for k in range(_CUTS + 1)]
    v, (first, last) = F.col("_v").cast("double"), _middle_ranks()
    while not bounds.where(large).isEmpty():
        open_rows = _with_figures(rows, bounds.where(large), keys)
        strictly = (F.col("_lo").isNull() | (v > F.col("_lo"))) & (F.col("_hi").isNull() | (v < F.col("_hi")))
        figures = ["_n", "_below", "_at_lo", "_m", "_lo", "_hi"]
        cuts = open_rows.where(strictly).groupBy(*keys, *figures).agg(F.percentile_approx(v, grid, _ACCURACY).alias("_q"))
        before = F.col("_below") + F.col("_at_lo")

        def cut(rank: Column, aside: int) -> Column:
            """The cut at a rank between the bounds, and one further to be sure; NULL beyond them."""
            at = F.floor((rank - before) * F.lit(float(_CUTS)) / F.col("_m")).cast("int") + aside
            return F.when((at >= 0) & (at <= _CUTS), F.get("_q", at))

        low = F.when(first > before + F.col("_m"), F.col("_hi")).otherwise(F.greatest("_lo", cut(first - 1, -1)))
        high = F.when(last <= before, F.col("_lo")).otherwise(F.least("_hi", cut(last, 2)))
        tried = materialise(cuts.select(*keys, "_n", low.alias("_lo"), high.alias("_hi")), "cuts")
        below, at_low = v < F.col("_lo"), v == F.col("_lo")
        between = (F.col("_lo").isNull() | (v > F.col("_lo"))) & (F.col("_hi").isNull() | (v < F.col("_hi")))
        counted = _with_figures(rows, tried, keys).groupBy(*keys, "_n", "_lo", "_hi").agg(
            F.count_if(below).alias("_below"), F.count_if(at_low).alias("_at_lo"), F.count_if(between).alias("_m")
        )
        narrower = counted.select(*bounds.columns)
        bounds = materialise(bounds.where(~large).unionByName(narrower), "bounds")
    return bounds


def row_counts(tables: Mapping[str, DataFrame], total: str = "total") -> DataFrame:
    """Row count per table and in all."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts.rollup("table_name").agg(F.sum("n").alias("n")).select(
        F.coalesce("table_name", F.lit(total)).alias("table_name"), "n"
    )


def highest(df: DataFrame, column: str, name: str = "top") -> DataFrame:
    """One row: the highest value of an id column, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(column), F.lit(0)).cast("long").alias(name))
