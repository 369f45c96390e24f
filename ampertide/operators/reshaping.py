"""Long to wide, flat to nested and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampertide.operators.slicing import all_equal


def pick(value: Column, when: Mapping[str, object]) -> Column:
    """``value`` where the given columns hold the given values, else NULL."""
    return F.when(all_equal(when), value)


def pivot_max(
    df: DataFrame, keys: Sequence[str | Column], value: Column, columns: Mapping[str, Mapping[str, object]]
) -> DataFrame:
    """Wide columns as the highest value among the rows that qualify."""
    return df.groupBy(*keys).agg(*(F.max(pick(value, when)).alias(name) for name, when in columns.items()))


def pivot_sum(
    df: DataFrame, keys: Sequence[str | Column], value: Column, columns: Mapping[str, Mapping[str, object]]
) -> DataFrame:
    """Wide columns as sums of the rows that qualify, 0 when there are none."""
    return df.groupBy(*keys).agg(
        *(F.coalesce(F.sum(pick(value, when)), F.lit(0)).alias(name) for name, when in columns.items())
    )


def pair_rows(
    df: DataFrame, keys: Sequence[str], role: str, value: str, roles: Mapping[str, object]
) -> DataFrame:
    """Rows of one role beside rows of another: a self-join of a long table on ``keys``.

    Every row of a role meets every row of the other roles with its key; a NULL key
    meets none. Each side holds its role's rows and three columns only, so the
    join's shuffles are as narrow as can be.
    """
    out = None
    for name, wanted in roles.items():
        side = df.where(F.col(role) == F.lit(wanted)).select(*keys, F.col(value).alias(name))
        out = side if out is None else out.join(side, list(keys))
    return out.select(*keys, *roles)


def nest(
    df: DataFrame,
    keys: Sequence[str],
    element: Sequence[str],
    measures: Mapping[str, Column],
    name: str,
    domain: Sequence,
) -> DataFrame:
    """One array of structs (element columns, measures) per key, sorted.

    Rows are first combined per (key, element) on the map side. ``domain`` declares the
    elements there can be (values, or tuples of values for several columns), so an
    array is never longer than that, however many rows a key has. An element that is
    not declared fails the query by its name; data without such a domain stays in rows,
    see ``match_rows``.
    """
    combined = df.groupBy(*keys, *element).agg(*(agg.alias(m) for m, agg in measures.items()))
    declared = [item if isinstance(item, tuple) else (item,) for item in domain]
    known = F.lit(False)
    for item in declared:
        same = [F.col(column).eqNullSafe(F.lit(x)) for column, x in zip(element, item, strict=True)]
        known = known | reduce(lambda a, b: a & b, same)
    label = F.concat_ws(", ", *(F.coalesce(F.col(e).cast("string"), F.lit("NULL")) for e in element))
    stranger = F.raise_error(F.concat(F.lit(f"not declared for {name}: "), label))
    entry = F.struct(*element, *measures)
    checked = combined.select(*keys, F.when(known, entry).otherwise(stranger.cast(_type_of(combined, entry))).alias("_entry"))
    return checked.groupBy(*keys).agg(F.sort_array(F.collect_list("_entry")).alias(name))


def _type_of(df: DataFrame, col: Column) -> str:
    return df.select(col.alias("x")).schema["x"].dataType.simpleString()


def only(col: Column) -> Column:
    """Aggregate: the one value of a group; a second row fails the query."""
    several = F.raise_error(F.lit("more than one row for one entry"))
    return F.when(F.count(F.lit(1)) <= 1, F.max(col)).otherwise(several.cast("double"))


def unnest(df: DataFrame, array: str, keep_empty: bool = False) -> DataFrame:
    """One row per array entry with the entry's fields as columns."""
    explode = F.explode_outer if keep_empty else F.explode
    others = [c for c in df.columns if c != array]
    return df.select(*others, explode(array).alias("_item")).select(*others, "_item.*")


def sum_entries(array: Column, field: str, when: Mapping[str, object]) -> Column:
    """Sum of a field over the array entries that qualify, 0 when none does."""

    def qualifies(item: Column) -> Column:
        test = F.lit(True)
        for name, value in when.items():
            test = test & (item[name] == F.lit(value))
        return test

    chosen = F.transform(F.filter(array, qualifies), lambda item: item[field].cast("double"))
    return F.aggregate(chosen, F.lit(0.0), lambda total, x: total + F.coalesce(x, F.lit(0.0)))


def embed(name: str, **fields: Column) -> Column:
    """One-to-one child as a struct column."""
    return F.struct(*(col.alias(field) for field, col in fields.items())).alias(name)


def point(longitude: Column, latitude: Column) -> Column:
    """GeoJSON point."""
    return F.struct(F.lit("Point").alias("type"), F.array(longitude, latitude).alias("coordinates"))


def years_ahead(df: DataFrame, n: int, name: str = "year") -> DataFrame:
    """Each row once per year 1..n; none for 0 years."""
    if n < 0:
        raise ValueError(f"{n} years")
    return df.select("*", F.explode(F.sequence(F.lit(1), F.lit(max(n, 1)))).alias(name)).where(F.col(name) <= n)
