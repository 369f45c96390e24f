"""Data-quality jobs: profiles, conformance, keys, references, reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampertide.session import materialise


def _long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value) rows, values as text."""
    texts = df.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in columns))
    return texts.unpivot([], list(columns), "column_name", "value")


def profile(df: DataFrame, columns: Sequence[str] | None = None, samples: int = 5) -> DataFrame:
    """Exact profile: rows, nulls, distinct values, type class and least values.

    Values are tallied per column on the map side, so a frequent value costs one
    row per task; all figures are then read off the tallies. Blank text counts
    as null. For wide tables with unique columns see ``quick_profile``.
    """
    columns = list(columns or df.columns)
    value = F.nullif(F.trim("value"), F.lit(""))
    tallies = _long_form(df, columns).groupBy("column_name", value.alias("value")).agg(F.count(F.lit(1)).alias("c"))
    known = F.col("value").isNotNull()
    figures = tallies.groupBy("column_name").agg(
        F.sum("c").alias("n_rows"),
        F.sum(F.when(known, 0).otherwise(F.col("c"))).alias("n_nulls"),
        F.count("value").alias("n_distinct"),
        F.count_if(known & F.col("value").try_cast("bigint").isNull()).alias("_not_int"),
        F.count_if(known & F.col("value").try_cast("double").isNull()).alias("_not_float"),
    )
    # Ranking all tallies, with their counts, lets both readers share one shuffle;
    # each task keeps only its ``samples`` lowest values per column.
    least = Window.partitionBy("column_name").orderBy(F.col("value").asc_nulls_last())
    lowest = (
        tallies.where(F.col("c") > 0)
        .withColumn("rn", F.row_number().over(least))
        .where(F.col("rn") <= samples)
        .where(known)
        .groupBy("column_name")
        .agg(F.array_join(F.sort_array(F.collect_list("value")), "|").alias("least_values"))
    )
    return figures.join(lowest, "column_name", "left").select(
        "column_name", "n_rows", "n_nulls", _share("n_nulls"), "n_distinct", _type_class("n_distinct"), "least_values"
    )


def quick_profile(df: DataFrame, columns: Sequence[str] | None = None, rsd: float = 0.02) -> DataFrame:
    """Profile from a single pass with approximate distinct counts and extremes."""
    columns = list(columns or df.columns)
    rows = _long_form(df, columns).withColumn("value", F.nullif(F.trim("value"), F.lit("")))
    known = F.col("value").isNotNull()
    figures = rows.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~known).alias("n_nulls"),
        F.approx_count_distinct("value", rsd).alias("n_distinct"),
        F.count_if(known & F.col("value").try_cast("bigint").isNull()).alias("_not_int"),
        F.count_if(known & F.col("value").try_cast("double").isNull()).alias("_not_float"),
        F.min("value").alias("least_value"),
        F.max("value").alias("greatest_value"),
    )
    return figures.select(
        "column_name", "n_rows", "n_nulls", _share("n_nulls"), "n_distinct", _type_class("n_distinct"),
        "least_value", "greatest_value",
    )


#: Accuracy of stored profiles: distinct counts to about 1 %, ranks to about 1 %, counts of frequent values by items tracked.
HLL_BITS = 14
KLL_SIZE = 400
TRACKED_ITEMS = 1000


def sketch(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The profile of ``df`` in a form to be stored and merged, one row per column, from a single pass.

    Counts and extremes are exact; distinct values, ranks of numbers and frequent values
    are sketches of bounded size. A column without a number has no ranks.
    """
    columns = list(columns or df.columns)
    rows = _long_form(df, columns).withColumn("value", F.nullif(F.trim("value"), F.lit("")))
    known, number = F.col("value").isNotNull(), F.col("value").try_cast("double")
    return rows.withColumn("_number", number).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~known).alias("n_nulls"),
        F.count_if(known & F.col("value").try_cast("bigint").isNull()).alias("_not_int"),
        F.count_if(known & F.col("_number").isNull()).alias("_not_float"),
        F.min("value").alias("least_value"),
        F.max("value").alias("greatest_value"),
        F.hll_sketch_agg("value", F.lit(HLL_BITS)).alias("_distinct"),
        F.count("_number").alias("_numbers"),
        F.kll_sketch_agg_double("_number", F.lit(KLL_SIZE)).alias("_ranks"),
        F.expr(f"approx_top_k_accumulate(value, {TRACKED_ITEMS})").alias("_frequent"),
    )


def merge_sketches(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The profile of all rows that went into the sketches; none of them is read again."""
    together = reduce(lambda a, b: a.unionByName(b), others, first)
    sums = [F.sum(c).alias(c) for c in ("n_rows", "n_nulls", "_not_int", "_not_float", "_numbers")]
    return together.groupBy("column_name").agg(
        *sums,
        F.min("least_value").alias("least_value"),
        F.max("greatest_value").alias("greatest_value"),
        F.hll_union_agg("_distinct").alias("_distinct"),
        F.kll_merge_agg_double("_ranks").alias("_ranks"),
        F.expr("approx_top_k_combine(_frequent)").alias("_frequent"),
    ).select(*first.columns)


def read_sketch(sketches: DataFrame, ranks: Sequence[float] = (0.25, 0.5, 0.75), frequent: int = 3) -> DataFrame:
    """The profile that sketches tell: as ``quick_profile``, with quantiles of numbers and the most frequent values."""
    quantiles = F.array(*(F.kll_sketch_get_quantile_double("_ranks", F.lit(r)) for r in ranks))
    return sketches.withColumn("n_distinct", F.hll_sketch_estimate("_distinct")).select(
        "column_name", "n_rows", "n_nulls", _share("n_nulls"), "n_distinct", _type_class("n_distinct"), "least_value", "greatest_value",
        F.when(F.col("_numbers") > 0, quantiles).alias("quantiles"),
        F.expr(f"approx_top_k_estimate(_frequent, {frequent})").alias("frequent"),
    )


def _share(count: str) -> Column:
    return F.round(F.try_divide(F.col(count) * F.lit(100.0), F.col("n_rows")), 1).alias("null_pct")


def _type_class(distinct: str) -> Column:
    return (
        F.when((F.col(distinct) > 0) & (F.col("_not_int") == 0), "INTEGER")
        .when((F.col(distinct) > 0) & (F.col("_not_float") == 0), "FLOAT")
        .otherwise("TEXT")
        .alias("type_class")
    )


def cast_failures(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Per column: values that are there but cannot be read as the wanted type.

    One pass; the result has one row per column.
    """
    counts = []
    for name, dtype in types.items():
        text = F.col(f"`{name}`").cast("string")
        counts.append(F.count_if((F.trim(text) != "") & text.try_cast(dtype).isNull()).alias(name))
    wide = df.agg(*counts)
    return wide.unpivot([], list(types), "column_name", "n_failures")


def missing(name: str) -> Column:
    return F.col(f"`{name}`").isNull()


def too_long(name: str, limit: int) -> Column:
    return F.char_length(F.col(f"`{name}`")) > limit


def violations(df: DataFrame, keys: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """One row per (row key, broken rule)."""
    broken = F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in rules.items())))
    return df.select(*keys, F.explode(broken).alias("rule"))


def conformance_rules(df: DataFrame, required: Sequence[str], max_length: Mapping[str, int] | None = None) -> dict[str, Column]:
    """Rules for required columns and text lengths; absent columns always break."""
    rules = {
        f"required:{name}": missing(name) if name in df.columns else F.lit(True) for name in required
    }
    for name, limit in (max_length or {}).items():
        rules[f"length:{name}"] = too_long(name, limit)
    return rules


def type_mismatches(df: DataFrame, expected: Mapping[str, str]) -> list[tuple[str, str, str]]:
    """(column, expected, found) where the schema differs; no data is read."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [(c, t, found.get(c, "absent")) for c, t in expected.items() if found.get(c, "absent") != t]


#: Parent keys go to all tasks as bits if they take no more bytes than this.
BITMAP_BYTES = 64 << 20
_WORD = 6


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str, most: int = BITMAP_BYTES) -> DataFrame:
    """Child rows whose key is set and has no parent.

    The children are not shuffled. Whole-number keys of the parents become a bitmap, 64
    keys a row, that every task looks its children up in. Other keys, or a bitmap of more
    than ``most`` bytes: the distinct keys of the children, one row per key and task, are
    held against the parents, and the children against the keys that have none.
    """
    set_rows = child.where(F.col(foreign_key).isNotNull())
    kinds = {df.schema[c].dataType.typeName() for df, c in ((child, foreign_key), (parent, key))}
    if kinds <= {"byte", "short", "integer", "long"}:
        place = F.col(key).cast("long")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit((1 << _WORD) - 1)).cast("int"))
        words = parent.where(F.col(key).isNotNull()).groupBy(F.shiftright(place, _WORD).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
        words = materialise(words, "parent-bits")
        if 16 * words.count() <= most:
            own = F.col(foreign_key).cast("long")
            found = set_rows.join(F.broadcast(words), F.shiftright(own, _WORD) == F.col("_word"), "left")
            set_bit = F.call_function("shiftright", F.col("_bits"), own.bitwiseAND(F.lit((1 << _WORD) - 1)).cast("int")).bitwiseAND(F.lit(1))
            return found.where(F.coalesce(set_bit, F.lit(0)) == 0).select(*child.columns)
    keys = set_rows.select(F.col(foreign_key).alias("_key")).distinct()
    without = keys.join(parent.select(F.col(key).alias("_parent")), F.col("_key") == F.col("_parent"), "left_anti")
    return set_rows.join(without, F.col(foreign_key) == F.col("_key"), "left_semi").select(*child.columns)


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; a key with a NULL part is exempt."""
    complete = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    return df.where(complete).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


#: Levels of the tree of checksums, in bits of the key's hash; the last one has the leaves.
TREE_BITS = (0, 8, 16)


def _checksums(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Per leaf: rows, and two sums of the hashes of whole rows."""
    leaf = F.pmod(F.xxhash64(*keys), F.lit(1 << TREE_BITS[-1])).cast("int").alias("_leaf")
    row = F.xxhash64(*keys, *measures, *(F.col(m).isNull() for m in measures)).alias("_hash")
    sums = (F.count(F.lit(1)).alias("_n"), F.sum(F.col("_hash").cast("decimal(20,0)")).alias("_sum"), F.bit_xor("_hash").alias("_xor"))
    return materialise(df.select(leaf, row).groupBy("_leaf").agg(*sums), "checksums")


def _differing(left: DataFrame, right: DataFrame) -> list[int]:
    """Leaves whose checksums differ, found from the root down: only below nodes that differ are sums compared."""
    nodes: list[int] = [0]
    for upper, bits in zip((0, *TREE_BITS), TREE_BITS):
        def level(sums: DataFrame) -> DataFrame:
            below = sums.where(F.shiftright("_leaf", TREE_BITS[-1] - upper).isin(nodes))
            node = F.shiftright("_leaf", TREE_BITS[-1] - bits).alias("_node")
            return below.groupBy(node).agg(F.sum("_n").alias("_n"), F.sum("_sum").alias("_sum"), F.bit_xor("_xor").alias("_xor"))

        a, b = level(left), level(right)
        both = a.toDF("_node", "_n", "_sum", "_xor").join(b.toDF("_other", "_m", "_sum2", "_xor2"), F.col("_node") == F.col("_other"), "full")
        same = F.col("_n").eqNullSafe(F.col("_m")) & F.col("_sum").eqNullSafe(F.col("_sum2")) & F.col("_xor").eqNullSafe(F.col("_xor2"))
        nodes = [row[0] for row in both.where(~same).select(F.coalesce("_node", "_other")).collect()]
        if not nodes:
            break
    return nodes


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], measures: Sequence[str], tolerance: float) -> DataFrame:
    """Rows of two results that differ by more than a tolerance or lack a partner.

    Both sides are summed up into a tree of checksums first. Rows are joined only from
    leaves whose checksums differ, none if the results are equal; both inputs are read
    twice, so store what is dear to compute. A NULL key equals a NULL key.
    """
    # The hash of a key depends on its type.
    b = b.withColumns({k: F.col(k).cast(a.schema[k].dataType) for k in keys})
    leaves = _differing(_checksums(a, keys, measures), _checksums(b, keys, measures))
    near = F.pmod(F.xxhash64(*keys), F.lit(1 << TREE_BITS[-1])).cast("int").isin(leaves) if leaves else F.lit(False)
    left = a.where(near).select(*keys, *(F.col(m).alias(f"a_{m}") for m in measures), F.lit(True).alias("_a"))
    right = b.where(near).select(
        *(F.col(k).alias(f"_b_{k}") for k in keys), *(F.col(m).alias(f"b_{m}") for m in measures), F.lit(True).alias("_b")
    )
    same_key = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys))
    both = left.join(right, same_key, "full")
    differs = F.col("_a").isNull() | F.col("_b").isNull()
    for m in measures:
        x, y = F.col(f"a_{m}"), F.col(f"b_{m}")
        differs = differs | (x.isNull() != y.isNull()) | F.coalesce(F.abs(x - y) > tolerance, F.lit(False))
    shown = [F.when(F.col("_a").isNull(), F.col(f"_b_{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    figures = [f"{side}_{m}" for side in "ab" for m in measures]
    return both.where(differs).select(*shown, *figures)
