"""Sources, sinks, projections, filters, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampertide.functions.numbers import positive, positive_or_null, to_double
from ampertide.functions.parse import period_half, period_is_valid, period_year
from ampertide.functions.text import differs_from_empty, has_text
from ampertide.functions.codes import map_codes
from ampertide.operators.aggregates import mean_over_join, row_counts
from ampertide.operators import merging
from ampertide.operators.merging import append_rows, backfill
from ampertide.operators.reshaping import embed, point
from ampertide.operators import slicing
from ampertide.operators.slicing import all_equal, in_year, last_rows, long_slice, optional_filter
from ampertide.session import drop_at_exit, fresh_path
from ampertide.sources.readers import literal_rows, read_csv
from ampertide.sources.sinks import append, clustered, interleaved, overwrite, truncate, write_csv
from proofs.registry import CENTS, Tables, proof, sql_mean

REFERENCE_YEAR = 2000
SUPPLIER_SQL = "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"


# --- sources and sinks -------------------------------------------------------


# Quotes, commas, blanks at both ends, a line break, an empty text: all survive a CSV file.
_CSV_NAME = (
    "CASE s_suppkey % 5 WHEN 0 THEN 'Café \"Sud\", ' || s_name WHEN 1 THEN '  ' || s_name || ' ' WHEN 2 THEN '\"' || s_name || '\"'"
    " WHEN 3 THEN s_name || ',\"' ELSE '' END"
)


@proof(f"SELECT s_suppkey, {_CSV_NAME} AS s_name, s_nationkey, s_acctbal FROM supplier")
def src_csv_roundtrip(t: Tables) -> DataFrame:
    supplier = t.supplier.withColumn("s_name", F.expr(_CSV_NAME))
    path = write_csv(supplier, fresh_path(t.spark, "csv"))
    return read_csv(t.spark, drop_at_exit(t.spark, path), supplier.schema)


@proof("SELECT s_suppkey, s_name || CHR(10) || 'line, two' AS s_name FROM supplier")
def src_csv_line_breaks(t: Tables) -> DataFrame:
    supplier = t.supplier.select("s_suppkey", F.concat("s_name", F.lit("\nline, two")).alias("s_name"))
    path = write_csv(supplier, fresh_path(t.spark, "csv"))
    return read_csv(t.spark, drop_at_exit(t.spark, path), supplier.schema, multi_line=True)


@proof("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal < 0")
def sink_truncate(t: Tables) -> DataFrame:
    """A rebuild: truncated target, then the new rows."""
    path = fresh_path(t.spark, "truncate")
    overwrite(t.supplier, path)
    drop_at_exit(t.spark, path)
    truncate(t.spark.read.parquet(path), path)
    return append(t.supplier.where("s_acctbal < 0"), path)


@proof(SUPPLIER_SQL)
def sink_overwrite_roundtrip(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "overwrite")
    overwrite(t.supplier.unionByName(t.supplier), path)
    drop_at_exit(t.spark, path)
    return overwrite(t.supplier, path)


@proof(SUPPLIER_SQL)
def sink_append_union(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "append")
    append(t.supplier.where("s_acctbal < 5000"), path)
    drop_at_exit(t.spark, path)
    return append(t.supplier.where("s_acctbal >= 5000"), path)


@proof(
    """
    SELECT c.c_custkey, v.code, v.label
    FROM customer c
    JOIN (VALUES ('BUILDING', 'BD', 'Buildings'), ('MACHINERY', 'MC', 'Machines'), ('FURNITURE', 'FN', 'Furniture'))
         v(segment, code, label) ON v.segment = c.c_mktsegment
    """
)
def src_values_join(t: Tables) -> DataFrame:
    rows = (("BUILDING", "BD", "Buildings"), ("MACHINERY", "MC", "Machines"), ("FURNITURE", "FN", "Furniture"))
    segments = literal_rows(t.spark, rows, "c_mktsegment string, code string, label string")
    return t.customer.join(segments, "c_mktsegment").select("c_custkey", "code", "label")


@proof(
    f"""
    SELECT c.c_nationkey AS nation_key, {sql_mean('o.o_totalprice')} AS avg_price, COUNT(*) AS n
    FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
    WHERE YEAR(o.o_orderdate) = {REFERENCE_YEAR}
    GROUP BY c.c_nationkey
    """
)
def param_ref_year(t: Tables) -> DataFrame:
    orders = t.orders.where(in_year(F.col("o_orderdate"), REFERENCE_YEAR)).withColumnRenamed("o_custkey", "c_custkey")
    members = t.customer.select("c_custkey", F.col("c_nationkey").alias("nation_key"))
    measures = {"avg_price": (F.col("o_totalprice"), CENTS)}
    return mean_over_join(orders, members, "c_custkey", measures, ["nation_key"], {"n": F.lit(True)})


_TARGET_SEGMENTS = ("AUTOMOBILE", "BUILDING", "MACHINERY")
_SOURCE_SEGMENTS = ("MACHINERY", "FURNITURE", "HOUSEHOLD")
_MERGE_SQL = f"""
    WITH target AS (SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment IN {_TARGET_SEGMENTS}),
         source AS (SELECT c_custkey, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_mktsegment IN {_SOURCE_SEGMENTS})
"""


def _merge_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    target = t.customer.where(F.col("c_mktsegment").isin(*_TARGET_SEGMENTS)).select("c_custkey", "c_acctbal")
    source = t.customer.where(F.col("c_mktsegment").isin(*_SOURCE_SEGMENTS)).select(
        "c_custkey", (F.col("c_acctbal") + 1).alias("c_acctbal")
    )
    return target, source


@proof(
    _MERGE_SQL
    + """
    SELECT * FROM target
    UNION ALL
    SELECT * FROM source s WHERE NOT EXISTS (SELECT 1 FROM target x WHERE x.c_custkey = s.c_custkey)
    """
)
def merge_keep_existing(t: Tables) -> DataFrame:
    return merging.merge_keep(*_merge_sides(t), ["c_custkey"])


@proof(
    _MERGE_SQL
    + """
    SELECT * FROM source
    UNION ALL
    SELECT * FROM target x WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.c_custkey = x.c_custkey)
    """
)
def merge_replace(t: Tables) -> DataFrame:
    return merging.merge_replace(*_merge_sides(t), ["c_custkey"])


@proof(
    """
    SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation_key, CAST(NULL AS VARCHAR) AS segment FROM supplier
    UNION ALL
    SELECT c_custkey, c_name, CAST(NULL AS INTEGER), c_mktsegment FROM customer
    """
)
def union_by_name_missing(t: Tables) -> DataFrame:
    suppliers = t.supplier.selectExpr("s_suppkey AS id", "s_name AS name", "s_nationkey AS nation_key")
    return append_rows(suppliers, t.customer.selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment"))


@proof(
    """
    WITH gaps AS (SELECT p_partkey, p_brand, CASE WHEN p_size <= 25 THEN NULL ELSE p_type END AS p_type FROM part),
         fill AS (SELECT UPPER(TRIM(p_brand)) AS k, MIN(p_type) AS p_type FROM part GROUP BY 1)
    SELECT g.p_partkey, g.p_brand, COALESCE(g.p_type, f.p_type) AS p_type
    FROM gaps g LEFT JOIN fill f ON f.k = UPPER(TRIM(g.p_brand))
    """
)
def backfill_update_join(t: Tables) -> DataFrame:
    gaps = t.part.select("p_partkey", "p_brand", F.when(F.col("p_size") > 25, F.col("p_type")).alias("p_type"))
    brand = F.upper(F.trim(F.col("p_brand")))
    return backfill(gaps, brand, "p_type", t.part.select("p_brand", "p_type"), brand, F.col("p_type"))


@proof(
    f"""
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity
    FROM lineitem
    WHERE YEAR(l_shipdate) = {REFERENCE_YEAR} AND l_returnflag = 'R' AND l_linestatus = 'F'
    """
)
def layout_slice_lookup(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        F.year("l_shipdate").alias("ship_year"), "l_returnflag", "l_linestatus",
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
    )
    path = fresh_path(t.spark, "clustered")
    stored = clustered(rows, path, ["ship_year"], ["l_returnflag", "l_linestatus", "l_orderkey"])
    drop_at_exit(t.spark, path)
    wanted = {"ship_year": REFERENCE_YEAR, "l_returnflag": "R", "l_linestatus": "F"}
    return stored.where(all_equal(wanted)).select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")


@proof(
    f"""
    SELECT 'flag' AS slice, l_returnflag AS flag, COUNT(*) AS n, CAST(SUM(l_partkey) AS BIGINT) AS parts FROM lineitem WHERE l_returnflag = 'R' GROUP BY 2
    UNION ALL SELECT 'part', l_returnflag, COUNT(*), CAST(SUM(l_partkey) AS BIGINT) FROM lineitem WHERE l_partkey BETWEEN 5 AND 20 GROUP BY 2
    UNION ALL SELECT 'year', l_returnflag, COUNT(*), CAST(SUM(l_partkey) AS BIGINT) FROM lineitem WHERE YEAR(l_shipdate) = {REFERENCE_YEAR} GROUP BY 2
    """
)
def layout_any_column(t: Tables) -> DataFrame:
    """Slices on one column each of a layout that none of them leads."""
    rows = t.lineitem.select("l_returnflag", "l_partkey", F.year("l_shipdate").alias("ship_year"), "l_orderkey")
    path = fresh_path(t.spark, "interleaved")
    stored = interleaved(rows, path, ["ship_year", "l_partkey", "l_returnflag"])
    drop_at_exit(t.spark, path)
    slices = {"flag": F.col("l_returnflag") == "R", "part": F.col("l_partkey").between(5, 20), "year": F.col("ship_year") == REFERENCE_YEAR}
    counts = [
        stored.where(test).groupBy(F.lit(name).alias("slice"), F.col("l_returnflag").alias("flag")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("l_partkey").alias("parts")
        )
        for name, test in slices.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


_STAR = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@proof(
    "WITH c AS ("
    + " UNION ALL ".join(f"SELECT '{name}' AS table_name, COUNT(*) AS n FROM {name}" for name in _STAR)
    + ") SELECT table_name, n FROM c UNION ALL SELECT 'total', CAST(SUM(n) AS BIGINT) FROM c"
)
def audit_row_counts(t: Tables) -> DataFrame:
    return row_counts({name: getattr(t, name) for name in _STAR})


# --- projections -------------------------------------------------------------


@proof("SELECT p_partkey AS vehicle_id, p_brand AS make, p_name AS model, p_type AS vehicle_class FROM part")
def proj_rename(t: Tables) -> DataFrame:
    return t.part.selectExpr("p_partkey AS vehicle_id", "p_brand AS make", "p_name AS model", "p_type AS vehicle_class")


@proof("SELECT p_partkey, 'FLEET_AVG' AS segment, CAST(1.1 AS DOUBLE) AS r_cost FROM part")
def proj_literal(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.lit("FLEET_AVG").alias("segment"), F.lit(1.1).alias("r_cost"))


@proof("SELECT p_partkey, p_retailprice * p_size / CAST(100 AS DOUBLE) AS cost FROM part")
def kpi_cost_per_unit(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", (F.col("p_retailprice") * F.col("p_size") / F.lit(100.0)).alias("cost"))


@proof(
    """
    WITH raw AS (SELECT p_partkey, CASE WHEN p_size > 40 THEN 'empty' ELSE CAST(p_size - 5 AS VARCHAR) END AS price_k
                 FROM part)
    SELECT p_partkey, CASE WHEN TRY_CAST(price_k AS DOUBLE) > 0 THEN TRY_CAST(price_k AS DOUBLE) * 1000 END AS price
    FROM raw
    """
)
def let_parse_positive(t: Tables) -> DataFrame:
    text = F.when(F.col("p_size") > 40, "empty").otherwise((F.col("p_size") - 5).cast("string"))
    parsed = to_double(text)
    return t.part.select("p_partkey", (positive_or_null(parsed) * 1000).alias("price"))


@proof("SELECT s_suppkey AS id, s_acctbal AS balance, s_nationkey AS nation_key FROM supplier WHERE s_acctbal > 0")
def struct_access(t: Tables) -> DataFrame:
    nested = t.supplier.select(
        F.struct(F.col("s_suppkey").alias("id"), F.struct(F.col("s_acctbal").alias("balance"), "s_nationkey").alias("detail")).alias("doc")
    )
    return nested.where(F.col("doc.detail.balance") > 0).select(
        "doc.id", "doc.detail.balance", F.col("doc.detail.s_nationkey").alias("nation_key")
    )


@proof(
    """
    SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance,
           CASE WHEN s_acctbal > 5000 THEN 'high' ELSE 'low' END AS class
    FROM supplier
    """
)
def struct_embed_child(t: Tables) -> DataFrame:
    level = F.when(F.col("s_acctbal") > 5000, "high").otherwise("low")
    docs = t.supplier.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        embed("account", balance=F.col("s_acctbal"), **{"class": level}),
    )
    return docs.select("id", "name", "account.*")


@proof(
    """
    SELECT s_suppkey AS id, 'Point' AS type, s_acctbal / CAST(100 AS DOUBLE) AS lon, CAST(s_nationkey AS DOUBLE) AS lat
    FROM supplier
    """
)
def geo_point(t: Tables) -> DataFrame:
    located = t.supplier.select(
        F.col("s_suppkey").alias("id"),
        point(F.col("s_acctbal") / F.lit(100.0), F.col("s_nationkey").cast("double")).alias("location"),
    )
    place = F.col("location.coordinates")
    return located.select("id", "location.type", place[0].alias("lon"), place[1].alias("lat"))


# --- filters -----------------------------------------------------------------


@proof(
    f"""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND YEAR(o_orderdate) = {REFERENCE_YEAR}
    """
)
def filter_long_slice(t: Tables) -> DataFrame:
    wanted = all_equal({"o_orderstatus": "F", "o_orderpriority": "1-URGENT"})
    return t.orders.where(wanted & in_year(F.col("o_orderdate"), REFERENCE_YEAR)).select("o_orderkey", "o_totalprice")


@proof(
    """
    SELECT CASE l_returnflag WHEN 'A' THEN 'AA' WHEN 'N' THEN 'NN' END AS country_code,
           CAST(YEAR(l_shipdate) AS INTEGER) AS year,
           CAST(l_extendedprice AS DECIMAL(10,4)) AS value
    FROM lineitem
    WHERE l_linestatus = 'F' AND l_tax = 0 AND l_returnflag IN ('A', 'N')
    """
)
def long_slice_value(t: Tables) -> DataFrame:
    return long_slice(
        t.lineitem,
        equals={"l_linestatus": "F", "l_tax": 0.0},
        entity="l_returnflag",
        entity_codes={"A": "AA", "N": "NN"},
        period=F.year("l_shipdate"),
        value=F.col("l_extendedprice"),
    )


@proof("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')")
def filter_in(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW")).select(
        "o_orderkey", "o_orderpriority"
    )


@proof("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20")
def filter_between(t: Tables) -> DataFrame:
    return t.lineitem.where(F.col("l_quantity").between(10, 20)).select("l_orderkey", "l_linenumber", "l_quantity")


@proof(
    """
    SELECT l_orderkey, l_linenumber, NULLIF(l_tax, 0) AS tax FROM lineitem WHERE NULLIF(l_tax, 0) IS NOT NULL
    """
)
def filter_not_null(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax"))
    return rows.where(F.col("tax").isNotNull())


@proof(
    """
    WITH raw AS (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'NA' WHEN 'MACHINERY' THEN '-4'
                                   WHEN 'FURNITURE' THEN NULL ELSE CAST(c_acctbal AS VARCHAR) END AS balance
                 FROM customer)
    SELECT c_custkey, balance FROM raw WHERE TRY_CAST(balance AS DOUBLE) > 0
    """
)
def filter_positive(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    text = (
        F.when(segment == "BUILDING", "NA").when(segment == "MACHINERY", "-4")
        .when(segment != "FURNITURE", F.col("c_acctbal").cast("string"))
    )
    return t.customer.select("c_custkey", text.alias("balance")).where(positive(F.col("balance")))


@proof(
    """
    WITH raw AS (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN '   '
                                   WHEN 'FURNITURE' THEN NULL ELSE c_mktsegment || ' ' END AS memo
                 FROM customer)
    SELECT 'differs' AS test, c_custkey, memo FROM raw WHERE memo IS DISTINCT FROM ''
    UNION ALL
    SELECT 'has_text', c_custkey, memo FROM raw WHERE TRIM(COALESCE(memo, '')) <> ''
    """
)
def filter_nonempty(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    memo = (
        F.when(segment == "BUILDING", "").when(segment == "MACHINERY", "   ")
        .when(segment != "FURNITURE", F.concat(segment, F.lit(" ")))
    )
    raw = t.customer.select("c_custkey", memo.alias("memo"))
    plain = raw.where(differs_from_empty(F.col("memo"))).select(F.lit("differs").alias("test"), "*")
    return plain.unionByName(raw.where(has_text(F.col("memo"))).select(F.lit("has_text").alias("test"), "*"))


_PERIOD_SQL = """
    WITH raw AS (
      SELECT o_orderkey,
             CAST(YEAR(o_orderdate) AS VARCHAR) || CASE o_orderstatus WHEN 'P' THEN '-Q' ELSE '-S' END
             || CASE WHEN MONTH(o_orderdate) <= 6 THEN '1' ELSE '2' END AS period
      FROM orders)
"""


def _periods(t: Tables) -> DataFrame:
    mark = F.when(F.col("o_orderstatus") == "P", "-Q").otherwise("-S")
    half = F.when(F.month("o_orderdate") <= 6, "1").otherwise("2")
    return t.orders.select("o_orderkey", F.concat(F.year("o_orderdate").cast("string"), mark, half).alias("period"))


@proof(_PERIOD_SQL + "SELECT o_orderkey, period FROM raw WHERE REGEXP_MATCHES(period, '^[0-9]{4}-S[12]$')")
def filter_regex_period(t: Tables) -> DataFrame:
    return _periods(t).where(period_is_valid(F.col("period")))


@proof(
    _PERIOD_SQL
    + """
    SELECT o_orderkey, CAST(SUBSTRING(period, 1, 4) AS INTEGER) AS year,
           CAST(RIGHT(period, 1) AS INTEGER) AS half_year
    FROM raw
    WHERE REGEXP_MATCHES(period, '^[0-9]{4}-S[12]$') AND CAST(SUBSTRING(period, 1, 4) AS INTEGER) >= 1997
    """
)
def parse_period(t: Tables) -> DataFrame:
    parsed = _periods(t).where(period_is_valid(F.col("period"))).select(
        "o_orderkey", period_year(F.col("period")).alias("year"), period_half(F.col("period")).alias("half_year")
    )
    return parsed.where(F.col("year") >= 1997)


@proof(
    """
    SELECT 'BUILDING' AS argument, c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT 'none', c_custkey FROM customer
    """
)
def param_optional_filter(t: Tables) -> DataFrame:
    def run(argument: str | None) -> DataFrame:
        chosen = optional_filter(t.customer, "c_mktsegment", argument)
        return chosen.select(F.lit(argument or "none").alias("argument"), "c_custkey")

    return run("BUILDING").unionByName(run(None))


# --- sorts and limits --------------------------------------------------------


@proof(
    """
    SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
    ORDER BY o_orderpriority ASC, o_totalprice DESC, o_orderkey ASC
    """
)
def sort_multi(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy(
        F.col("o_orderpriority").asc(), F.col("o_totalprice").desc(), F.col("o_orderkey").asc()
    )


@proof(
    """
    SELECT * FROM (SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderkey, o_totalprice FROM orders
                   ORDER BY day DESC, o_orderkey DESC LIMIT 15)
    ORDER BY day, o_orderkey
    """
)
def topk_last_n(t: Tables) -> DataFrame:
    rows = t.orders.select(F.to_date("o_orderdate").cast("string").alias("day"), "o_orderkey", "o_totalprice")
    return last_rows(rows, 15, "day", "o_orderkey")


@proof(
    """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O'
    ORDER BY o_orderdate, o_orderkey LIMIT 1
    """
)
def first_match(t: Tables) -> DataFrame:
    wanted = all_equal({"o_orderpriority": "3-MEDIUM", "o_orderstatus": "O"})
    return slicing.first_match(t.orders, wanted, "o_orderdate", "o_orderkey").select("o_orderkey", "o_totalprice")


# --- set operations ----------------------------------------------------------


@proof(
    """
    SELECT 'customer' AS origin, c_nationkey AS nation_key FROM customer
    UNION ALL SELECT 'supplier', s_nationkey FROM supplier
    """
)
def union_all(t: Tables) -> DataFrame:
    customers = t.customer.select(F.lit("customer").alias("origin"), F.col("c_nationkey").alias("nation_key"))
    return customers.unionByName(t.supplier.select(F.lit("supplier").alias("origin"), F.col("s_nationkey").alias("nation_key")))


@proof("SELECT c_nationkey AS nation_key FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t: Tables) -> DataFrame:
    keys = t.customer.select(F.col("c_nationkey").alias("nation_key"))
    return keys.union(t.supplier.select(F.col("s_nationkey").alias("nation_key"))).distinct()
