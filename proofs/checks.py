"""Data-quality jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampertide.operators import quality
from ampertide.operators.aggregates import mean_over_join
from ampertide.session import materialise
from proofs.registry import CENTS, Tables, proof

_PROFILED = {
    "customer": {
        "c_custkey": "c_custkey", "c_name": "c_name", "c_nationkey": "c_nationkey", "c_acctbal": "c_acctbal",
        "c_mktsegment": "CASE c_mktsegment WHEN 'BUILDING' THEN '  ' WHEN 'MACHINERY' THEN NULL ELSE c_mktsegment END",
    },
    "orders": {
        "o_orderkey": "o_orderkey", "o_custkey": "o_custkey", "o_orderstatus": "o_orderstatus", "o_totalprice": "o_totalprice",
        "o_orderdate": "o_orderdate", "o_orderpriority": "o_orderpriority",
        "priority_number": "SUBSTRING(o_orderpriority, 1, 1)",
    },
}


def _profile_sql(table: str, column: str, expr: str) -> str:
    return f"""
    SELECT '{column}' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT(v) AS n_nulls,
           ROUND((COUNT(*) - COUNT(v)) * CAST(100 AS DOUBLE) / COUNT(*), 1) AS null_pct, COUNT(DISTINCT v) AS n_distinct,
           CASE WHEN COUNT(v) = 0 THEN 'TEXT' WHEN BOOL_AND(REGEXP_FULL_MATCH(v, '[+-]?[0-9]+')) THEN 'INTEGER'
                WHEN COUNT(TRY_CAST(v AS DOUBLE)) = COUNT(v) THEN 'FLOAT' ELSE 'TEXT' END AS type_class,
           (SELECT STRING_AGG(w, '|' ORDER BY w) FROM (
              SELECT DISTINCT NULLIF(TRIM(CAST({expr} AS VARCHAR)), '') AS w FROM {table}
              WHERE NULLIF(TRIM(CAST({expr} AS VARCHAR)), '') IS NOT NULL ORDER BY w LIMIT 5)) AS least_values
    FROM (SELECT NULLIF(TRIM(CAST({expr} AS VARCHAR)), '') AS v FROM {table})
    """


@proof(" UNION ALL ".join(_profile_sql(t, c, e) for t, columns in _PROFILED.items() for c, e in columns.items()))
def profile_columns(t: Tables) -> DataFrame:
    reports = [
        quality.profile(getattr(t, table).selectExpr(*(f"{expr} AS {name}" for name, expr in columns.items())))
        for table, columns in _PROFILED.items()
    ]
    return reports[0].unionByName(reports[1])


def _quick_sql(table: str, column: str, expr: str) -> str:
    value = f"NULLIF(TRIM(CAST({expr} AS VARCHAR)), '')"
    return f"""
    SELECT '{column}' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT(v) AS n_nulls,
           CASE WHEN COUNT(v) = 0 THEN 'TEXT' WHEN BOOL_AND(REGEXP_FULL_MATCH(v, '[+-]?[0-9]+')) THEN 'INTEGER'
                WHEN COUNT(TRY_CAST(v AS DOUBLE)) = COUNT(v) THEN 'FLOAT' ELSE 'TEXT' END AS type_class,
           MIN(v) AS least_value, MAX(v) AS greatest_value,
           COUNT(DISTINCT v) > 0 AS distinct_near
    FROM (SELECT {value} AS v FROM {table})
    """


@proof(" UNION ALL ".join(_quick_sql("customer", c, e) for c, e in _PROFILED["customer"].items()))
def quick_profile_columns(t: Tables) -> DataFrame:
    """The one-pass profile; its approximate distinct count is held against the exact one."""
    rows = t.customer.selectExpr(*(f"{expr} AS {name}" for name, expr in _PROFILED["customer"].items()))
    exact = quality.profile(rows).select("column_name", F.col("n_distinct").alias("exact"))
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= F.greatest(F.lit(2.0), F.col("exact") * 0.1)
    return quality.quick_profile(rows).join(exact, "column_name").select(
        "column_name", "n_rows", "n_nulls", "type_class", "least_value", "greatest_value", near.alias("distinct_near")
    )


def _merged_sql(column: str, expr: str, number: bool) -> str:
    middle = "MEDIAN(TRY_CAST(v AS DOUBLE)) IS NOT NULL" if number else "FALSE"
    return f"""
    SELECT '{column}' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT(v) AS n_nulls,
           CASE WHEN COUNT(v) = 0 THEN 'TEXT' WHEN BOOL_AND(REGEXP_FULL_MATCH(v, '[+-]?[0-9]+')) THEN 'INTEGER'
                WHEN COUNT(TRY_CAST(v AS DOUBLE)) = COUNT(v) THEN 'FLOAT' ELSE 'TEXT' END AS type_class,
           MIN(v) AS least_value, MAX(v) AS greatest_value, TRUE AS distinct_near, {middle} AS middle_near
    FROM (SELECT NULLIF(TRIM(CAST({expr} AS VARCHAR)), '') AS v FROM customer)
    """


_NUMBERS = ("c_custkey", "c_nationkey", "c_acctbal")


@proof(" UNION ALL ".join(_merged_sql(c, e, c in _NUMBERS) for c, e in _PROFILED["customer"].items()))
def profile_merged(t: Tables) -> DataFrame:
    """Stored sketches of two halves, merged: counts as of the whole, distinct values and middles within their error."""
    rows = t.customer.selectExpr(*(f"{expr} AS {name}" for name, expr in _PROFILED["customer"].items()))
    halves = [materialise(quality.sketch(rows.where(half)), "sketch") for half in ("c_nationkey < 12", "c_nationkey >= 12")]
    whole = quality.read_sketch(quality.merge_sketches(*halves))
    exact = quality.profile(rows).select("column_name", F.col("n_distinct").alias("exact"))
    around = [rows.agg(F.percentile(F.col(c).cast("double"), [0.45, 0.55]).alias("around")).select(F.lit(c).alias("column_name"), "around") for c in _NUMBERS]
    around = around[0].unionByName(around[1]).unionByName(around[2])
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= F.greatest(F.lit(2.0), F.col("exact") * 0.05)
    middle = F.coalesce(F.col("quantiles")[1].between(F.col("around")[0], F.col("around")[1]), F.lit(False))
    return whole.join(exact, "column_name").join(around, "column_name", "left").select(
        "column_name", "n_rows", "n_nulls", "type_class", "least_value", "greatest_value", near.alias("distinct_near"), middle.alias("middle_near")
    )


@proof(
    """
    WITH raw AS (SELECT CASE WHEN p_size > 40 THEN 'empty' WHEN p_size < 5 THEN 'NA' WHEN p_size = 7 THEN ' ' ELSE CAST(p_size AS VARCHAR) END AS size,
                        CASE p_type WHEN 'PROMO' THEN '$' || CAST(p_retailprice AS VARCHAR) ELSE CAST(p_retailprice AS VARCHAR) END AS price,
                        p_brand AS brand FROM part)
    SELECT 'size' AS column_name, COUNT(*) FILTER (TRIM(size) <> '' AND TRY_CAST(size AS INTEGER) IS NULL) AS n_failures FROM raw
    UNION ALL SELECT 'price', COUNT(*) FILTER (TRIM(price) <> '' AND TRY_CAST(price AS DOUBLE) IS NULL) FROM raw
    UNION ALL SELECT 'brand', COUNT(*) FILTER (TRIM(brand) <> '' AND TRY_CAST(brand AS INTEGER) IS NULL) FROM raw
    """
)
def profile_cast_failures(t: Tables) -> DataFrame:
    size, price = F.col("p_size"), F.col("p_retailprice").cast("string")
    raw = t.part.select(
        F.when(size > 40, "empty").when(size < 5, "NA").when(size == 7, " ").otherwise(size.cast("string")).alias("size"),
        F.when(F.col("p_type") == "PROMO", F.concat(F.lit("$"), price)).otherwise(price).alias("price"),
        F.col("p_brand").alias("brand"),
    )
    return quality.cast_failures(raw, {"size": "int", "price": "double", "brand": "int"})


@proof(
    """
    SELECT c_custkey, 'required:c_name' AS rule FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT c_custkey, 'length:c_mktsegment' FROM customer WHERE LENGTH(c_mktsegment) > 9
    """
)
def check_required(t: Tables) -> DataFrame:
    raw = t.customer.withColumn("c_name", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")))
    rules = quality.conformance_rules(raw, ("c_custkey", "c_name", "c_mktsegment"), {"c_mktsegment": 9})
    return quality.violations(raw, ["c_custkey"], rules)


@proof(
    """
    SELECT c_custkey, c_nationkey FROM customer c
    WHERE NOT EXISTS (SELECT 1 FROM nation n WHERE n.n_nationkey = c.c_nationkey AND n.n_regionkey IN (0, 1, 2))
    """
)
def check_orphans(t: Tables) -> DataFrame:
    parents = t.nation.where(F.col("n_regionkey").isin(0, 1, 2))
    return quality.orphans(t.customer.select("c_custkey", "c_nationkey"), "c_nationkey", parents, "n_nationkey")


@proof(
    """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_type <> 'PROMO')
    """
)
def check_orphans_of_facts(t: Tables) -> DataFrame:
    """Facts without a parent, found from a bitmap of the parents' keys."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return quality.orphans(rows, "l_partkey", t.part.where("p_type <> 'PROMO'"), "p_partkey")


@proof(
    """
    SELECT c_custkey, c_name FROM customer c
    WHERE NOT EXISTS (SELECT 1 FROM customer o WHERE o.c_name = c.c_name AND o.c_acctbal > 0)
    """
)
def check_orphans_by_name(t: Tables) -> DataFrame:
    """Keys that are no numbers: the distinct ones are held against the parents."""
    return quality.orphans(t.customer.select("c_custkey", "c_name"), "c_name", t.customer.where("c_acctbal > 0"), "c_name")


@proof("SELECT o_orderkey, o_totalprice AS a_o_totalprice, o_totalprice + 1 AS b_o_totalprice FROM orders WHERE o_custkey = 7")
def reconcile_few_changes(t: Tables) -> DataFrame:
    """Two versions of a table that differ in a few rows: only the leaves around these are joined."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    changed = rows.withColumn("o_totalprice", F.col("o_totalprice") + F.when(F.col("o_custkey") == 7, 1.0).otherwise(0.0))
    return quality.reconcile(rows, changed, ["o_orderkey"], ["o_totalprice"], 1e-6)


@proof("SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1")
def check_unique(t: Tables) -> DataFrame:
    return quality.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@proof(
    """
    SELECT c_custkey, 'low balance' AS rule FROM customer WHERE c_acctbal < 500
    UNION ALL SELECT c_custkey, 'nation' FROM customer WHERE c_nationkey NOT BETWEEN 0 AND 20
    """
)
def check_ranges(t: Tables) -> DataFrame:
    rules = {"low balance": F.col("c_acctbal") < 500, "nation": ~F.col("c_nationkey").between(0, 20)}
    return quality.violations(t.customer, ["c_custkey"], rules)


@proof("SELECT DISTINCT 'shifted' AS run, c_nationkey AS nation_key FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey WHERE n.n_regionkey = 1")
def reconcile_two_results(t: Tables) -> DataFrame:
    """Per-nation order value by two routes: exact means after a pre-summed join, plain means over the join."""
    members = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation_key"))
    exact = mean_over_join(t.orders, members, "o_custkey", {"price": (F.col("o_totalprice"), CENTS)}, ["nation_key"])
    plain = t.orders.join(members, "o_custkey").groupBy("nation_key").agg(F.avg("o_totalprice").alias("price"))
    region = t.nation.select(F.col("n_nationkey").alias("nation_key"), "n_regionkey")
    shifted = plain.join(region, "nation_key").select(
        "nation_key", (F.col("price") + F.when(F.col("n_regionkey") == 1, 1.0).otherwise(0.0)).alias("price")
    )

    def run(name: str, other: DataFrame) -> DataFrame:
        return quality.reconcile(exact, other, ["nation_key"], ["price"], 1e-4).select(F.lit(name).alias("run"), "nation_key")

    return run("same", plain).unionByName(run("shifted", shifted))
