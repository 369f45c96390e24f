"""Names that differ in case, accents and blanks at their end, compared as one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampertide.functions.collation import NAMES
from ampertide.functions.text import match_key
from ampertide.operators.aggregates import grouped_by_name
from ampertide.operators.joining import on_key, without_match
from ampertide.operators.merging import backfill
from ampertide.operators.numbering import ascending, first_per_key, number_in_groups
from proofs.registry import CENTS, Tables, mean, proof, sql_mean

# Three spellings of a name, by size of the part: with accents, raised, with blanks at its end.
_SPELT = (
    "CASE p_size % 3 WHEN 0 THEN translate(p_name, 'aeiouldz', 'àéîõüłđž') WHEN 1 THEN upper(p_name) ELSE p_name || '  ' END"
)
_SPELT_SQL = f"spelt AS (SELECT p_partkey, p_brand, p_size, p_type, p_retailprice, {_SPELT} AS name FROM part)"


def _plain(name: str) -> str:
    """SQL text of the key: DuckDB takes accents off, letters with a stroke have to be named."""
    return f"rtrim(strip_accents(replace(replace(lower({name}), 'ł', 'l'), 'đ', 'd')))"


def _spelt(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_brand", "p_size", "p_type", "p_retailprice", F.expr(_SPELT).alias("name"))


_OFFERS_SQL = f"""
    WITH {_SPELT_SQL},
    offers AS (SELECT {_plain("name")} AS k, MIN(p_retailprice) AS price FROM spelt WHERE p_type = 'PROMO' AND p_size > 25 GROUP BY 1)
"""


def _offers(t: Tables) -> DataFrame:
    """The least price of a name, shown in one of its spellings."""
    offers = _spelt(t).where("p_type = 'PROMO' and p_size > 25")
    return grouped_by_name(offers, ["name"], F.min("p_retailprice").alias("price"))


@proof(_OFFERS_SQL + f"SELECT p_partkey, name, price FROM spelt JOIN offers ON offers.k = {_plain('name')}")
def name_join(t: Tables) -> DataFrame:
    offers = _offers(t).withColumnRenamed("name", "offered")
    joined = on_key(_spelt(t), F.col("name"), offers, F.col("offered"), collation=NAMES)
    return joined.select("p_partkey", "name", "price")


@proof(_OFFERS_SQL + f"SELECT p_partkey, name FROM spelt WHERE NOT EXISTS (SELECT 1 FROM offers WHERE offers.k = {_plain('name')})")
def name_anti_join(t: Tables) -> DataFrame:
    rows = _spelt(t).select("p_partkey", "name")
    return without_match(rows, F.col("name"), _offers(t), F.col("name"), NAMES)


@proof(
    f"""
    WITH {_SPELT_SQL},
    gaps AS (SELECT p_partkey, name, CASE WHEN p_size > 10 THEN p_type END AS p_type FROM spelt),
    fill AS (SELECT REPLACE({_plain("name")}, ' ', '') AS k, MIN(p_type) AS p_type FROM spelt GROUP BY 1)
    SELECT g.p_partkey, g.name, COALESCE(g.p_type, f.p_type) AS p_type
    FROM gaps g LEFT JOIN fill f ON f.k = REPLACE({_plain("g.name")}, ' ', '')
    """
)
def name_backfill(t: Tables) -> DataFrame:
    spelt = _spelt(t)
    gaps = spelt.select("p_partkey", "name", F.when(F.col("p_size") > 10, F.col("p_type")).alias("p_type"))
    key = match_key(F.col("name"), collation=NAMES)
    return backfill(gaps, key, "p_type", spelt.select("name", "p_type"), key, F.col("p_type"))


@proof(
    f"""
    WITH {_SPELT_SQL}
    SELECT MIN(name) AS name, COUNT(*) AS n, {sql_mean("p_retailprice")} AS avg_price, MIN(p_size) AS least_size
    FROM spelt GROUP BY {_plain("name")}
    """
)
def name_groups(t: Tables) -> DataFrame:
    measures = (F.count(F.lit(1)).alias("n"), mean("p_retailprice", CENTS).alias("avg_price"), F.min("p_size").alias("least_size"))
    return grouped_by_name(_spelt(t), ["name"], *measures)


@proof(
    f"""
    WITH {_SPELT_SQL}
    SELECT p_partkey, name, ROW_NUMBER() OVER (PARTITION BY {_plain("name")} ORDER BY p_size, p_partkey) AS rn FROM spelt
    """
)
def name_row_number(t: Tables) -> DataFrame:
    rows = _spelt(t).select("p_partkey", "name", "p_size")
    order = ascending("p_size", "p_partkey")
    return number_in_groups(rows, ["name"], order, unique=True, collation=NAMES).select("p_partkey", "name", "rn")


@proof(
    f"""
    WITH {_SPELT_SQL}
    SELECT p_partkey, p_brand, name FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY p_brand, {_plain("name")} ORDER BY p_retailprice, p_partkey) AS rn FROM spelt)
    WHERE rn = 1
    """
)
def name_first(t: Tables) -> DataFrame:
    rows = _spelt(t).select("p_partkey", "p_brand", "name", "p_retailprice")
    return first_per_key(rows, ["p_brand", "name"], ascending("p_retailprice", "p_partkey"), NAMES).drop("p_retailprice")


@proof(
    f"""
    WITH {_SPELT_SQL}
    SELECT LOWER(name) AS lower_name, COUNT(*) AS n FROM spelt GROUP BY 1
    """
)
def name_groups_by_collation(t: Tables) -> DataFrame:
    """Case alone, under Spark's own collation: the comparison that joins and groups may also be given."""
    groups = grouped_by_name(_spelt(t), ["name"], F.count(F.lit(1)).alias("n"), collation="UNICODE_CI")
    return groups.select(F.lower("name").alias("lower_name"), "n")
