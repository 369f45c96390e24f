"""Stored tables that change: merges by folder, ids over several loads, sums kept up by changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampertide.operators.bucketed import Bucketed
from ampertide.operators.keys import KeyDictionary
from ampertide.operators.upkeep import KeptSums
from ampertide.plans import decision as dec
from ampertide.session import drop_at_exit, fresh_path
from proofs.basics import _MERGE_SQL, REFERENCE_YEAR, _merge_sides
from proofs.domain import _DECISION_SQL, _countries, _members
from proofs.registry import CENTS, Tables, proof, sql_mean


def _customers_in_folders(t: Tables) -> tuple[Bucketed, DataFrame]:
    target, source = _merge_sides(t)
    path = fresh_path(t.spark, "bucketed")
    table = Bucketed(t.spark, path, target.schema, ["c_custkey"], 16).create(target)
    drop_at_exit(t.spark, path)
    return table, source


@proof(
    _MERGE_SQL
    + """
    SELECT * FROM target
    UNION ALL
    SELECT * FROM source s WHERE NOT EXISTS (SELECT 1 FROM target x WHERE x.c_custkey = s.c_custkey)
    """
)
def merge_keep_in_folders(t: Tables) -> DataFrame:
    table, source = _customers_in_folders(t)
    table.merge_keep(source)
    return table.read()


@proof(
    _MERGE_SQL
    + """
    SELECT * FROM source
    UNION ALL
    SELECT * FROM target x WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.c_custkey = x.c_custkey)
    """
)
def merge_replace_in_folders(t: Tables) -> DataFrame:
    table, source = _customers_in_folders(t)
    table.merge_replace(source)
    return table.read()


@proof(
    """
    WITH early AS (
      SELECT p_brand, p_name, ROW_NUMBER() OVER (ORDER BY p_brand, p_name) AS id
      FROM (SELECT DISTINCT p_brand, p_name FROM part WHERE p_type IN ('ECONOMY', 'SMALL'))
    ), late AS (
      SELECT p_brand, p_name, (SELECT COUNT(*) FROM early) + ROW_NUMBER() OVER (ORDER BY p_brand, p_name) AS id
      FROM (SELECT DISTINCT p_brand, p_name FROM part p
            WHERE NOT EXISTS (SELECT 1 FROM early e WHERE e.p_brand = p.p_brand AND e.p_name = p.p_name))
    )
    SELECT p.p_partkey, k.id AS vehicle_id
    FROM part p JOIN (SELECT * FROM early UNION ALL SELECT * FROM late) k ON k.p_brand = p.p_brand AND k.p_name = p.p_name
    """
)
def surrogate_key_dictionary(t: Tables) -> DataFrame:
    """Two loads: the ids of the first one stay, the second one's new keys get the next ids."""
    keys = T.StructType([t.part.schema["p_brand"], t.part.schema["p_name"]])
    path = fresh_path(t.spark, "keys")
    ids = KeyDictionary(t.spark, path, keys, "vehicle_id", 16).create()
    drop_at_exit(t.spark, path)
    ids.learn(t.part.where(F.col("p_type").isin("ECONOMY", "SMALL")))
    return ids.assign(t.part).select("p_partkey", "vehicle_id")


def _kept(t: Tables, label: str, keys: T.StructType, measures: dict) -> KeptSums:
    path = fresh_path(t.spark, label)
    return KeptSums(t.spark, path, keys, measures, 4)


@proof(
    f"""
    SELECT l_returnflag, l_linestatus, COUNT(*) AS n, {sql_mean("l_quantity")} AS qty, {sql_mean("l_extendedprice")} AS price
    FROM lineitem GROUP BY 1, 2
    """
)
def sums_kept_up(t: Tables) -> DataFrame:
    """What was shipped early, then everything else and half of it twice, then that half taken away again."""
    rows = t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", "l_shipdate", "l_tax")
    keys = T.StructType([rows.schema["l_returnflag"], rows.schema["l_linestatus"]])
    kept = _kept(t, "sums", keys, {"qty": (F.col("l_quantity"), CENTS), "price": (F.col("l_extendedprice"), CENTS)})
    early = F.year("l_shipdate") < REFERENCE_YEAR
    twice = rows.where(~early & (F.col("l_tax") > 0.04))
    kept.build(rows.where(early))
    drop_at_exit(t.spark, kept.table.path)
    kept.apply(1, added=rows.where(~early).unionByName(twice))
    kept.apply(2, removed=twice)
    return kept.read()


@proof(_DECISION_SQL)
def decision_kept_up(t: Tables) -> DataFrame:
    """The recommendation from kept sums: some of the records, prices and grid values first, the rest as a change."""
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity")
    combustion, electric = flag.isin("A", "N"), (flag == "R") & (quantity > 0)
    one = F.lit(dec.SEGMENT).alias("segment")
    known = t.part.select(F.col("p_partkey").alias("l_partkey"))
    records = t.lineitem.where(combustion | electric).join(known, "l_partkey").select(one, "l_returnflag", "l_quantity", "l_tax", "l_shipdate")
    fleets = _kept(
        t,
        "fleets",
        T.StructType([records.schema["segment"]]),
        {
            "l_per_100km": (F.when(combustion, quantity), CENTS),
            "co2_gkm": (F.when(combustion, quantity * (1 + F.col("l_tax"))), 4),
            "kwh_per_100km": (F.when(electric, quantity), CENTS),
        },
    )
    orders = t.orders.join(_members(t, "o_custkey"), "o_custkey").select("nation_key", F.year("o_orderdate").alias("year"), "o_totalprice", "o_orderpriority")
    prices = _kept(t, "prices", T.StructType([orders.schema["nation_key"], orders.schema["year"]]), {"p": (F.col("o_totalprice"), CENTS)})
    bought = t.events.where("event_type = 'purchase'").join(_members(t, "user_id"), "user_id").select("nation_key", "value")
    grid = _kept(t, "grid", T.StructType([bought.schema["nation_key"]]), {"g": (F.col("value"), CENTS)})
    for kept, rows, first in (
        (fleets, records, F.year("l_shipdate") < REFERENCE_YEAR),
        (prices, orders, F.col("o_orderpriority") < "3"),
        (grid, bought, F.col("value") < 100),
    ):
        kept.build(rows.where(first))
        drop_at_exit(t.spark, kept.table.path)
        kept.apply(1, added=rows.where(~first))
    price = prices.read().where(F.col("year") == REFERENCE_YEAR).select("nation_key", (F.col("p") / F.lit(70.0)).alias("price_eur_per_kwh"))
    intensity = grid.read().select("nation_key", (F.col("g") / F.lit(0.45)).alias("co2_g_per_kwh"))
    kpis = dec.fleet_kpis(_countries(t), [fleets.read().drop("segment", "n")], price, intensity, key="nation_key")
    return dec.decide(kpis, "nation_key", "nation_name").orderBy("nation_key")
