"""Joins, aggregations, windows and nesting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampertide.functions.numbers import exact_mean
from ampertide.functions.text import match_key
from ampertide.operators.aggregates import at_least, grouped_median, highest, mean_over_join
from ampertide.operators.joining import attach_matches, left_chain, left_rows, match_rows, on_key, rank_aligned, with_scalars, without_match
from ampertide.operators.numbering import ascending, first_per_key, number_in_groups, number_rows
from ampertide.operators import reshaping
from ampertide.operators.reshaping import nest, pair_rows, sum_entries, unnest
from proofs.registry import CENTS, Tables, mean, proof, sql_half_up, sql_mean

# --- joins -------------------------------------------------------------------


@proof(
    """
    SELECT o.o_orderkey, c.c_name, o.o_totalprice FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
    """
)
def join_inner_pk(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return t.orders.join(customers, "o_custkey").select("o_orderkey", "c_name", "o_totalprice")


@proof(
    f"""
    WITH c AS (SELECT c_nationkey AS k, {sql_mean('c_acctbal')} AS customer_avg FROM customer GROUP BY 1),
         s AS (SELECT s_nationkey AS k, {sql_mean('s_acctbal')} AS supplier_avg FROM supplier GROUP BY 1)
    SELECT n.n_nationkey AS nation_key, n.n_name AS nation_name, c.customer_avg, s.supplier_avg
    FROM nation n JOIN c ON c.k = n.n_nationkey JOIN s ON s.k = n.n_nationkey
    """
)
def join_dim_agg(t: Tables) -> DataFrame:
    nations = t.nation.select(F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("nation_name"))
    customers = t.customer.groupBy(F.col("c_nationkey").alias("nation_key")).agg(mean("c_acctbal").alias("customer_avg"))
    suppliers = t.supplier.groupBy(F.col("s_nationkey").alias("nation_key")).agg(mean("s_acctbal").alias("supplier_avg"))
    return nations.join(customers, "nation_key").join(suppliers, "nation_key")


@proof(
    """
    WITH q AS (SELECT l_partkey, l_linestatus, l_returnflag, SUM(l_quantity) AS qty FROM lineitem GROUP BY 1, 2, 3)
    SELECT a.l_partkey, a.l_linestatus, a.qty AS qty_a, r.qty AS qty_r
    FROM q a JOIN q r ON r.l_partkey = a.l_partkey AND r.l_linestatus = a.l_linestatus
    WHERE a.l_returnflag = 'A' AND r.l_returnflag = 'R'
    """
)
def selfjoin_pair_rows(t: Tables) -> DataFrame:
    sums = t.lineitem.groupBy("l_partkey", "l_linestatus", "l_returnflag").agg(F.sum("l_quantity").alias("qty"))
    return pair_rows(sums, ["l_partkey", "l_linestatus"], "l_returnflag", "qty", {"qty_a": "A", "qty_r": "R"})


@proof(
    """
    SELECT a.l_orderkey, a.l_quantity AS qty_a, r.l_quantity AS qty_r
    FROM lineitem a JOIN lineitem r ON r.l_orderkey = a.l_orderkey
    WHERE a.l_returnflag = 'A' AND r.l_returnflag = 'R'
    """
)
def selfjoin_repeated_keys(t: Tables) -> DataFrame:
    """Several rows of a role share a key: every one of them is paired."""
    return pair_rows(t.lineitem, ["l_orderkey"], "l_returnflag", "l_quantity", {"qty_a": "A", "qty_r": "R"})


@proof(
    f"""
    WITH a AS (SELECT {sql_mean('l_quantity')} AS kept_qty FROM lineitem WHERE l_returnflag IN ('A', 'N')),
         r AS (SELECT {sql_mean('l_quantity')} AS returned_qty FROM lineitem WHERE l_returnflag = 'R')
    SELECT n.n_nationkey AS nation_key, a.kept_qty, r.returned_qty FROM nation n CROSS JOIN a CROSS JOIN r
    """
)
def cross_scalar(t: Tables) -> DataFrame:
    flag = F.col("l_returnflag")
    quantity = F.col("l_quantity")
    both = t.lineitem.agg(
        exact_mean(F.when(flag.isin("A", "N"), quantity)).alias("kept_qty"),
        exact_mean(F.when(flag == "R", quantity)).alias("returned_qty"),
    )
    return with_scalars(t.nation.select(F.col("n_nationkey").alias("nation_key")), both)


@proof(
    """
    SELECT n.n_nationkey AS nation_key, n.n_name AS nation_name, s.s_suppkey
    FROM nation n LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 5000) s ON s.s_nationkey = n.n_nationkey
    """
)
def join_left(t: Tables) -> DataFrame:
    nations = t.nation.select(F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("nation_name"))
    rich = t.supplier.where("s_acctbal > 5000").select(F.col("s_nationkey").alias("nation_key"), "s_suppkey")
    return left_rows(nations, rich, ["nation_key"])


@proof(
    f"""
    WITH base AS (SELECT c.c_nationkey AS nation_key, CAST(YEAR(o.o_orderdate) AS INTEGER) AS year,
                         o.o_orderstatus AS status, o.o_orderpriority AS priority, o.o_totalprice AS price
                  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey),
         f AS (SELECT nation_key, year, {sql_mean('price')} AS filled FROM base WHERE status = 'F' GROUP BY 1, 2),
         o AS (SELECT nation_key, year, {sql_mean('price')} AS open FROM base WHERE status = 'O' GROUP BY 1, 2),
         p AS (SELECT nation_key, year, {sql_mean('price')} AS pending FROM base WHERE status = 'P' GROUP BY 1, 2),
         u AS (SELECT nation_key, year, {sql_mean('price')} AS urgent FROM base WHERE priority = '1-URGENT' GROUP BY 1, 2)
    SELECT f.nation_key, f.year, f.filled, o.open, p.pending, u.urgent
    FROM f LEFT JOIN o ON o.nation_key = f.nation_key AND o.year = f.year
           LEFT JOIN p ON p.nation_key = f.nation_key AND p.year = f.year
           LEFT JOIN u ON u.nation_key = f.nation_key AND u.year = f.year
    """
)
def join_left_chain(t: Tables) -> DataFrame:
    members = t.customer.select("c_custkey", F.col("c_nationkey").alias("nation_key"))
    facts = t.orders.withColumns({"c_custkey": F.col("o_custkey"), "year": F.year("o_orderdate")})

    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    measures = {
        "filled": (F.when(status == "F", price), CENTS),
        "open": (F.when(status == "O", price), CENTS),
        "pending": (F.when(status == "P", price), CENTS),
        "urgent": (F.when(F.col("o_orderpriority") == "1-URGENT", price), CENTS),
    }
    anchored = {"_filled": status == "F"}
    means = mean_over_join(facts, members, "c_custkey", measures, ["nation_key"], anchored, fact_by=["year"])
    return at_least(means, "_filled", 1).drop("_filled")


@proof(
    f"""
    WITH c AS (SELECT c_nationkey AS nation_key, {sql_mean('c_acctbal')} AS customer_avg FROM customer GROUP BY 1),
         s AS (SELECT s_nationkey AS nation_key, {sql_mean('s_acctbal')} AS supplier_avg FROM supplier GROUP BY 1)
    SELECT n.n_nationkey AS nation_key, c.customer_avg, s.supplier_avg
    FROM nation n LEFT JOIN c ON c.nation_key = n.n_nationkey LEFT JOIN s ON s.nation_key = n.n_nationkey
    """
)
def join_left_chain_tables(t: Tables) -> DataFrame:
    """Measures of several tables, grouped before they are joined."""
    return left_chain(
        t.nation.select(F.col("n_nationkey").alias("nation_key")),
        ["nation_key"],
        t.customer.groupBy(F.col("c_nationkey").alias("nation_key")).agg(mean("c_acctbal").alias("customer_avg")),
        t.supplier.groupBy(F.col("s_nationkey").alias("nation_key")).agg(mean("s_acctbal").alias("supplier_avg")),
    )


_SEGMENT_ELEMENTS = f"""
    SELECT c_nationkey AS nation_key, c_mktsegment AS segment, COUNT(*) AS n, {sql_mean('c_acctbal')} AS balance
    FROM customer
"""


def _customers(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_nationkey").alias("nation_key"), F.col("c_mktsegment").alias("segment"), "c_acctbal"
    )


# Market segments of the test tables.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
# Regions have no customers of their own: keys without a match at every scale.
_PLACES_SQL = "place AS (SELECT n_nationkey AS nation_key FROM nation UNION ALL SELECT -1 - r_regionkey FROM region)"


def _places(t: Tables) -> DataFrame:
    nations = t.nation.select(F.col("n_nationkey").alias("nation_key"))
    return nations.unionAll(t.region.select(F.lit(-1) - F.col("r_regionkey")))


def _segment_measures() -> dict:
    return {"n": F.count(F.lit(1)), "balance": mean("c_acctbal")}


@proof(
    f"""
    WITH e AS ({_SEGMENT_ELEMENTS} GROUP BY 1, 2), {_PLACES_SQL}
    SELECT p.nation_key, e.segment, e.n, e.balance FROM place p LEFT JOIN e ON e.nation_key = p.nation_key
    """
)
def group_join_array(t: Tables) -> DataFrame:
    nested = attach_matches(_places(t), _customers(t), ["nation_key"], ["segment"], _segment_measures(), SEGMENTS)
    return unnest(nested, "matches", keep_empty=True)


@proof(
    f"""
    WITH c AS (SELECT c_nationkey AS nation_key, c_custkey,
                      ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS rn FROM customer), {_PLACES_SQL}
    SELECT p.nation_key, c.c_custkey, c.rn FROM place p LEFT JOIN c ON c.nation_key = p.nation_key
    """
)
def group_join_rows(t: Tables) -> DataFrame:
    """The group join where every match counts: rows with a place, no array."""
    customers = t.customer.select(F.col("c_nationkey").alias("nation_key"), "c_custkey", "c_acctbal")
    matched = match_rows(_places(t), customers, ["nation_key"], ascending("c_acctbal", "c_custkey"))
    return matched.select("nation_key", "c_custkey", "rn")


_KEY_SQL = "REPLACE(UPPER(CONCAT_WS(' ', p_brand, p_name)), ' ', '')"
_PROMO_SQL = """
    WITH promo AS (SELECT REPLACE(UPPER(TRIM('  ' || LOWER(p_brand) || '  ' || p_name)), ' ', '') AS k,
                          MIN(p_retailprice) AS promo_price
                   FROM part WHERE p_type = 'PROMO' GROUP BY 1)
"""


def _promo(t: Tables) -> DataFrame:
    text = F.concat(F.lit("  "), F.lower("p_brand"), F.lit("  "), "p_name")
    promo = t.part.where("p_type = 'PROMO'").groupBy(match_key(F.trim(text)).alias("k"))
    return promo.agg(F.min("p_retailprice").alias("promo_price"))


@proof(
    _PROMO_SQL
    + f"SELECT p_partkey, p_brand, p_name FROM part WHERE NOT EXISTS (SELECT 1 FROM promo WHERE promo.k = {_KEY_SQL})"
)
def anti_normalised_key(t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", "p_brand", "p_name")
    return without_match(parts, match_key(F.col("p_brand"), F.col("p_name")), _promo(t), F.col("k"))


@proof(_PROMO_SQL + f"SELECT p_partkey, promo_price FROM part JOIN promo ON promo.k = {_KEY_SQL}")
def join_normalised_key(t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", "p_brand", "p_name")
    key = match_key(F.col("p_brand"), F.col("p_name"))
    return on_key(parts, key, _promo(t), F.col("k")).select("p_partkey", "promo_price")


@proof(
    """
    WITH c AS (SELECT c_nationkey AS nation_key, c_custkey,
                      ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS rn FROM customer),
         s AS (SELECT s_nationkey AS nation_key, s_suppkey,
                      ROW_NUMBER() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS rn FROM supplier)
    SELECT c.nation_key, c.rn, c.c_custkey, s.s_suppkey
    FROM c JOIN s ON s.nation_key = c.nation_key AND s.rn = c.rn
    """
)
def join_rank_aligned(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_nationkey").alias("nation_key"), "c_custkey", "c_acctbal")
    suppliers = t.supplier.select(F.col("s_nationkey").alias("nation_key"), "s_suppkey", "s_acctbal")
    return rank_aligned(
        customers, suppliers, ["nation_key"], ascending("c_acctbal", "c_custkey"), ascending("s_acctbal", "s_suppkey")
    ).select("nation_key", "rn", "c_custkey", "s_suppkey")


# --- aggregations ------------------------------------------------------------


_GLOBAL = f"SELECT {sql_mean('l_quantity')} AS qty, {sql_mean('l_extendedprice')} AS price, COUNT(*) AS n FROM lineitem"


@proof(
    f"""
    SELECT 'at least 5' AS rule, * FROM ({_GLOBAL} HAVING COUNT(*) >= 5)
    UNION ALL SELECT 'too many', * FROM ({_GLOBAL} WHERE l_quantity > 1000000 HAVING COUNT(*) >= 5)
    """
)
def global_avg_having(t: Tables) -> DataFrame:
    measures = (mean("l_quantity").alias("qty"), mean("l_extendedprice").alias("price"), F.count(F.lit(1)).alias("n"))

    def run(rule: str, rows: DataFrame) -> DataFrame:
        return at_least(rows.agg(*measures), "n", 5).select(F.lit(rule).alias("rule"), "*")

    return run("at least 5", t.lineitem).unionByName(run("too many", t.lineitem.where("l_quantity > 1000000")))


@proof(
    f"""
    SELECT c_nationkey AS nation_key, c_mktsegment AS segment,
           {sql_half_up(sql_mean('c_acctbal'), 4)} AS avg_balance
    FROM customer GROUP BY 1, 2
    """
)
def group_avg_round(t: Tables) -> DataFrame:
    return _customers(t).groupBy("nation_key", "segment").agg(F.round(mean("c_acctbal"), 4).alias("avg_balance"))


@proof("SELECT c_nationkey AS nation_key, c_mktsegment AS segment, COUNT(*) AS n FROM customer GROUP BY 1, 2")
def group_count_2key(t: Tables) -> DataFrame:
    return _customers(t).groupBy("nation_key", "segment").agg(F.count(F.lit(1)).alias("n"))


@proof(
    f"""
    SELECT c_nationkey AS nation_key, c_mktsegment AS segment, COUNT(*) AS n, {sql_mean('c_acctbal')} AS avg_power
    FROM customer GROUP BY 1, 2 ORDER BY nation_key ASC, n DESC, segment ASC
    """
)
def group_count_avg(t: Tables) -> DataFrame:
    grouped = _customers(t).groupBy("nation_key", "segment").agg(
        F.count(F.lit(1)).alias("n"), mean("c_acctbal").alias("avg_power")
    )
    return grouped.orderBy(F.col("nation_key").asc(), F.col("n").desc(), F.col("segment").asc())


@proof(
    """
    SELECT UPPER(TRIM(p_brand)) AS make, UPPER(TRIM(p_name)) AS model, MIN(p_type) AS vehicle_class
    FROM part GROUP BY 1, 2
    """
)
def group_min_text(t: Tables) -> DataFrame:
    keys = (F.upper(F.trim("p_brand")).alias("make"), F.upper(F.trim("p_name")).alias("model"))
    return t.part.groupBy(*keys).agg(F.min("p_type").alias("vehicle_class"))


@proof("SELECT c_mktsegment AS segment, MEDIAN(c_acctbal) AS median_balance FROM customer GROUP BY 1")
def group_median(t: Tables) -> DataFrame:
    return grouped_median(_customers(t), ["segment"], "c_acctbal", "median_balance")


@proof("SELECT MEDIAN(l_extendedprice) AS median_price FROM lineitem")
def global_median(t: Tables) -> DataFrame:
    return grouped_median(t.lineitem, [], "l_extendedprice", "median_price")


_WIDE = {
    f"{flag.lower()}{status.lower()}": {"l_returnflag": flag, "l_linestatus": status}
    for flag in ("A", "N", "R")
    for status in ("F", "O")
}


_FLAGS = [(w["l_returnflag"], w["l_linestatus"]) for w in _WIDE.values()]


def _wide_sql(aggregate: str) -> str:
    columns = ", ".join(
        aggregate.format(f"CASE WHEN l_returnflag = '{w['l_returnflag']}' AND l_linestatus = '{w['l_linestatus']}' THEN l_quantity END")
        + f" AS {name}"
        for name, w in _WIDE.items()
    )
    return f"SELECT CAST(YEAR(l_shipdate) AS INTEGER) AS year, {columns} FROM lineitem GROUP BY 1"


_SUM_SQL = _wide_sql("COALESCE(SUM({}), 0)")


@proof(_wide_sql("MAX({})"))
def pivot_max_case(t: Tables) -> DataFrame:
    return reshaping.pivot_max(t.lineitem, [F.year("l_shipdate").alias("year")], F.col("l_quantity"), _WIDE)


@proof(_SUM_SQL)
def pivot_sum_case(t: Tables) -> DataFrame:
    return reshaping.pivot_sum(t.lineitem, [F.year("l_shipdate").alias("year")], F.col("l_quantity"), _WIDE)


@proof(_SUM_SQL)
def array_filter_sum(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.year("l_shipdate").alias("year"), "l_returnflag", "l_linestatus", "l_quantity")
    nested = nest(rows, ["year"], ["l_returnflag", "l_linestatus"], {"value": F.sum("l_quantity")}, "entries", _FLAGS)
    return nested.select("year", *(sum_entries(F.col("entries"), "value", w).alias(n) for n, w in _WIDE.items()))


@proof(f"{_SEGMENT_ELEMENTS} GROUP BY 1, 2")
def group_collect_struct(t: Tables) -> DataFrame:
    return unnest(nest(_customers(t), ["nation_key"], ["segment"], _segment_measures(), "mix", SEGMENTS), "mix")


@proof(
    f"""
    WITH e AS ({_SEGMENT_ELEMENTS} GROUP BY 1, 2)
    SELECT nation_key, segment, balance FROM e WHERE balance > 4500 ORDER BY nation_key, balance DESC, segment
    """
)
def unnest_filter_sort(t: Tables) -> DataFrame:
    nested = nest(_customers(t), ["nation_key"], ["segment"], _segment_measures(), "mix", SEGMENTS)
    rows = unnest(nested, "mix").select("nation_key", "segment", "balance").where("balance > 4500")
    return rows.orderBy(F.col("nation_key").asc(), F.col("balance").desc(), F.col("segment").asc())


@proof(
    f"""
    WITH e AS (SELECT * FROM ({_SEGMENT_ELEMENTS} GROUP BY 1, 2) WHERE balance > 5500),
         k AS (SELECT DISTINCT c_nationkey AS nation_key FROM customer)
    SELECT k.nation_key, e.segment, e.n, e.balance FROM k LEFT JOIN e ON e.nation_key = k.nation_key
    """
)
def unnest_outer(t: Tables) -> DataFrame:
    nested = nest(_customers(t), ["nation_key"], ["segment"], _segment_measures(), "mix", SEGMENTS)
    high = nested.withColumn("mix", F.filter("mix", lambda item: item["balance"] > 5500))
    return unnest(high, "mix", keep_empty=True)


# --- windows and ids ---------------------------------------------------------


@proof(
    """
    SELECT 'all' AS scope, COALESCE(MAX(p_partkey), 0) AS top FROM part
    UNION ALL SELECT 'none', COALESCE(MAX(p_partkey), 0) FROM part WHERE p_size > 1000
    """
)
def max_id_offset(t: Tables) -> DataFrame:
    everything = highest(t.part, "p_partkey").select(F.lit("all").alias("scope"), "top")
    return everything.unionByName(highest(t.part.where("p_size > 1000"), "p_partkey").select(F.lit("none").alias("scope"), "top"))


@proof(
    """
    SELECT s_suppkey, s_name,
           (SELECT COALESCE(MAX(p_partkey), 0) FROM part) + ROW_NUMBER() OVER (ORDER BY s_acctbal, s_suppkey) AS vehicle_id
    FROM supplier
    """
)
def surrogate_key_offset(t: Tables) -> DataFrame:
    order = ascending("s_acctbal", "s_suppkey")
    numbered = number_rows(t.supplier, order, "vehicle_id", after=highest(t.part, "p_partkey"))
    return numbered.select("s_suppkey", "s_name", "vehicle_id")


@proof(
    """
    SELECT event_id, ROW_NUMBER() OVER (ORDER BY event_type, user_id, event_id) AS seq FROM events
    """
)
def row_number_global(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "event_type", "user_id")
    return number_rows(rows, ascending("event_type", "user_id", "event_id"), "seq").select("event_id", "seq")


@proof(
    """
    SELECT event_id, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY user_id, event_id) AS rn
    FROM events
    """
)
def row_number_global_scaled(t: Tables) -> DataFrame:
    """Few large groups, each spread over several range partitions."""
    rows = t.events.select("event_id", "event_type", "user_id")
    return number_in_groups(rows, ["event_type"], ascending("user_id", "event_id"), unique=True).select("event_id", "rn")


@proof(
    """
    SELECT p_partkey, UPPER(p_brand) AS brand,
           ROW_NUMBER() OVER (PARTITION BY UPPER(p_brand) ORDER BY p_size, p_partkey) AS rn
    FROM part
    """
)
def row_number_partitioned(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", "p_size", F.upper("p_brand").alias("brand"))
    return number_in_groups(rows, ["brand"], ascending("p_size", "p_partkey")).drop("p_size")


@proof(
    """
    WITH classed AS (SELECT p_partkey, p_size, p_retailprice,
                            CASE p_type WHEN 'ECONOMY' THEN 'cheap' WHEN 'PROMO' THEN 'cheap' WHEN 'LARGE' THEN 'big'
                                        ELSE 'other' END AS class
                     FROM part)
    SELECT p_partkey, class,
           ROW_NUMBER() OVER (PARTITION BY class ORDER BY p_size, p_retailprice, p_partkey) AS rn
    FROM classed
    """
)
def row_number_case_partition(t: Tables) -> DataFrame:
    kind = F.col("p_type")
    label = F.when(kind.isin("ECONOMY", "PROMO"), "cheap").when(kind == "LARGE", "big").otherwise("other")
    rows = t.part.select("p_partkey", "p_size", "p_retailprice", label.alias("class"))
    order = ascending("p_size", "p_retailprice", "p_partkey")
    return number_in_groups(rows, ["class"], order).select("p_partkey", "class", "rn")


@proof(
    """
    SELECT p_brand, p_name, p_partkey, p_size
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY p_brand, p_name ORDER BY p_size, p_partkey) AS rn FROM part)
    WHERE rn = 1
    """
)
def dedup_first_per_key(t: Tables) -> DataFrame:
    parts = t.part.select("p_brand", "p_name", "p_partkey", "p_size")
    return first_per_key(parts, ["p_brand", "p_name"], ascending("p_size", "p_partkey"))
