"""Column functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampertide.functions import codes, numbers, parse, text
from proofs.registry import Tables, proof, sql_half_up


@proof(
    """
    SELECT p_partkey, UPPER(TRIM('  ' || p_name || ' ')) AS upper_name, LOWER(TRIM('  ' || p_brand || ' ')) AS lower_brand
    FROM part
    """
)
def str_case_trim(t: Tables) -> DataFrame:
    def padded(name: str):
        return F.trim(F.concat(F.lit("  "), F.col(name), F.lit(" ")))

    return t.part.select("p_partkey", F.upper(padded("p_name")).alias("upper_name"), F.lower(padded("p_brand")).alias("lower_brand"))


@proof(
    """
    SELECT c_custkey, TRANSLATE('$ ' || c_name || ',000', '$, ', '') AS clean FROM customer
    """
)
def str_strip_symbols(t: Tables) -> DataFrame:
    wrapped = F.concat(F.lit("$ "), "c_name", F.lit(",000"))
    return t.customer.select("c_custkey", text.strip_symbols(wrapped, ("$", ",", " ")).alias("clean"))


@proof(
    """
    WITH raw AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN '  ' ELSE c_mktsegment END AS segment FROM customer)
    SELECT c_custkey, NULLIF(TRIM(segment), '') AS segment, COALESCE(NULLIF(TRIM(segment), ''), 'Unknown') AS filled FROM raw
    """
)
def null_coalesce(t: Tables) -> DataFrame:
    blanked = F.when(F.col("c_mktsegment") == "BUILDING", "  ").otherwise(F.col("c_mktsegment"))
    clean = text.blank_to_null(blanked)
    return t.customer.select("c_custkey", clean.alias("segment"), F.coalesce(clean, F.lit("Unknown")).alias("filled"))


@proof(
    """
    SELECT p_partkey,
           REPLACE(UPPER(CONCAT_WS(' ', CASE WHEN p_size > 25 THEN p_brand END, p_name)), ' ', '') AS match_key
    FROM part
    """
)
def norm_key(t: Tables) -> DataFrame:
    key = text.match_key(F.when(F.col("p_size") > 25, F.col("p_brand")), F.col("p_name"))
    return t.part.select("p_partkey", key.alias("match_key"))


@proof(
    """
    WITH raw AS (SELECT p_partkey, TRIM(' ' || p_brand || ' ' || p_name || ' ') AS full_name FROM part)
    SELECT p_partkey, SPLIT_PART(full_name, ' ', 1) AS make,
           TRIM(REGEXP_REPLACE(full_name, '^[^ ]+', '')) AS model
    FROM raw
    """
)
def split_first_rest(t: Tables) -> DataFrame:
    full = F.concat(F.lit(" "), "p_brand", F.lit(" "), "p_name", F.lit(" "))
    return t.part.select("p_partkey", text.first_word(full).alias("make"), text.after_first_word(full).alias("model"))


@proof(
    """
    WITH raw AS (SELECT p_partkey, STRING_SPLIT(p_brand || '  ' || p_name || ' ', ' ') AS parts FROM part)
    SELECT p_partkey, parts[1] AS make, CAST(LEN(parts) AS INTEGER) AS n_parts,
           LTRIM(ARRAY_TO_STRING(parts[2:], ' '), ' ') AS model
    FROM raw
    """
)
def array_split_rejoin(t: Tables) -> DataFrame:
    full = F.concat("p_brand", F.lit("  "), "p_name", F.lit(" "))
    return t.part.select(
        "p_partkey", text.split_first(full).alias("make"), F.size(F.split(full, " ")).alias("n_parts"),
        text.rejoin_rest(full).alias("model"),
    )


@proof(
    """
    SELECT e.event_id, TRY_CAST(NULLIF(REGEXP_EXTRACT(e.props, '[0-9]+'), '') AS INTEGER) AS k,
           NULLIF(REGEXP_EXTRACT(e.event_type || CAST(e.value AS VARCHAR), '[0-9]+(\\.[0-9]+)?'), '') AS number_text,
           NULLIF(REGEXP_EXTRACT(e.event_type, '[0-9]+'), '') AS no_number
    FROM events e
    """
)
def parse_first_number(t: Tables) -> DataFrame:
    mixed = F.concat("event_type", F.col("value").cast("string"))
    return t.events.select(
        "event_id",
        numbers.to_int(parse.first_number(F.col("props"))).alias("k"),
        parse.first_number(mixed, parse.DECIMAL_PATTERN).alias("number_text"),
        parse.first_number(F.col("event_type")).alias("no_number"),
    )


@proof(
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE 'Unknown' END AS status,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'first' WHEN '2-HIGH' THEN 'second' END AS level
    FROM orders
    """
)
def map_codes(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        codes.map_codes(F.col("o_orderstatus"), {"F": "Filled", "O": "Open"}, "Unknown").alias("status"),
        codes.map_codes(F.col("o_orderpriority"), {"1-URGENT": "first", "2-HIGH": "second"}).alias("level"),
    )


_FUEL_TEXT = """
    WITH raw AS (SELECT p_partkey, p_type,
                        CASE p_type WHEN 'ECONOMY' THEN ' Petrol/Hybrid' WHEN 'SMALL' THEN 'DIESEL' WHEN 'MEDIUM' THEN 'Plug-in Hybrid'
                                    WHEN 'PROMO' THEN 'Electric ' WHEN 'STANDARD' THEN 'Hybrid electric' ELSE ' Steam ' END AS fuel
                 FROM part)
"""


# Words per label in order of precedence; the last column is a word that rules a match out.
_FUEL_RULES = """
    , relational_rules(place, word, label, blocker) AS (VALUES
        (1, 'plug', 'Plug-in Hybrid', NULL), (2, 'phev', 'Plug-in Hybrid', NULL), (3, 'electric', 'Electric', 'hybrid'),
        (4, 'diesel', 'Diesel', NULL), (5, 'petrol', 'Petrol', NULL), (6, 'gasoline', 'Petrol', NULL), (7, 'hybrid', 'Hybrid', NULL)),
    document_rules(place, word, label) AS (VALUES
        (1, 'electric', 'Electric'), (2, 'diesel', 'Diesel'), (3, 'hybrid', 'Hybrid'), (4, 'petrol', 'Petrol'),
        (5, 'gasoline', 'Petrol'), (6, 'benzin', 'Petrol'))
"""


@proof(
    _FUEL_TEXT
    + _FUEL_RULES
    + """
    , first_relational AS (
      SELECT p_partkey, ARG_MIN(label, place) AS label FROM raw JOIN relational_rules
        ON CONTAINS(LOWER(fuel), word) AND (blocker IS NULL OR NOT CONTAINS(LOWER(fuel), blocker)) GROUP BY p_partkey),
    first_document AS (
      SELECT p_partkey, ARG_MIN(label, place) AS label FROM raw JOIN document_rules ON CONTAINS(LOWER(fuel), word) GROUP BY p_partkey)
    SELECT raw.p_partkey, COALESCE(r.label, NULLIF(TRIM(fuel), '')) AS relational, COALESCE(d.label, fuel) AS document
    FROM raw LEFT JOIN first_relational r ON r.p_partkey = raw.p_partkey LEFT JOIN first_document d ON d.p_partkey = raw.p_partkey
    """
)
def map_like_normalise(t: Tables) -> DataFrame:
    fuels = {
        "ECONOMY": " Petrol/Hybrid", "SMALL": "DIESEL", "MEDIUM": "Plug-in Hybrid", "PROMO": "Electric ",
        "STANDARD": "Hybrid electric",
    }
    raw = t.part.select("p_partkey", codes.map_codes(F.col("p_type"), fuels, " Steam ").alias("fuel"))
    fuel = F.col("fuel")
    return raw.select(
        "p_partkey",
        codes.label_by_rules(fuel, codes.FUEL_RULES_RELATIONAL, text.blank_to_null(fuel)).alias("relational"),
        codes.label_by_rules(fuel, codes.FUEL_RULES_DOCUMENT, fuel).alias("document"),
    )


@proof(
    """
    WITH raw AS (SELECT p_partkey, CASE WHEN p_size > 40 THEN 'empty' WHEN p_size < 5 THEN 'NA' ELSE CAST(p_size AS VARCHAR) END AS s,
                        CASE WHEN p_size > 30 THEN '' ELSE CAST(p_retailprice AS VARCHAR) END AS d FROM part)
    SELECT p_partkey, TRY_CAST(s AS INTEGER) AS size, COALESCE(TRY_CAST(s AS INTEGER), 0) AS size_or_zero,
           TRY_CAST(d AS DOUBLE) AS price, COALESCE(TRY_CAST(d AS DOUBLE), 0) AS price_or_zero
    FROM raw
    """
)
def cast_tolerant(t: Tables) -> DataFrame:
    size = F.when(F.col("p_size") > 40, "empty").when(F.col("p_size") < 5, "NA").otherwise(F.col("p_size").cast("string"))
    price = F.when(F.col("p_size") > 30, "").otherwise(F.col("p_retailprice").cast("string"))
    return t.part.select(
        "p_partkey", numbers.to_int(size).alias("size"), numbers.to_int_or(size, 0).alias("size_or_zero"),
        numbers.to_double(price).alias("price"), numbers.to_double_or(price, 0.0).alias("price_or_zero"),
    )


@proof("SELECT event_id, CAST(value AS DECIMAL(10,4)) AS value FROM events")
def cast_decimal(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.col("value").cast("decimal(10,4)").alias("value"))


@proof("SELECT l_orderkey, l_linenumber, l_discount / NULLIF(l_tax, 0) AS share FROM lineitem")
def kpi_ratio(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", numbers.ratio(F.col("l_discount"), F.col("l_tax")).alias("share")
    )


@proof(
    """
    SELECT l_orderkey, l_linenumber, l_discount / GREATEST(l_tax, CAST(0.0001 AS DOUBLE)) AS share FROM lineitem
    """
)
def kpi_ratio_guarded(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", numbers.guarded_ratio(F.col("l_discount"), F.col("l_tax")).alias("share")
    )


@proof(
    """
    SELECT l_orderkey, l_linenumber, COALESCE(NULLIF(l_tax, 0), 0) + COALESCE(NULLIF(l_discount, 0), 0) AS present_sum,
           NULLIF(l_tax, 0) + NULLIF(l_discount, 0) AS strict_sum
    FROM lineitem
    """
)
def sum_vs_add_null(t: Tables) -> DataFrame:
    tax, discount = (F.nullif(F.col(c), F.lit(0.0)) for c in ("l_tax", "l_discount"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", numbers.sum_present(tax, discount).alias("present_sum"),
        (tax + discount).alias("strict_sum"),
    )


@proof(
    """
    SELECT p_partkey, ROUND(p_partkey + CAST(0.5 AS DOUBLE), 0) AS whole, ROUND(p_partkey / CAST(8 AS DOUBLE), 2) AS cents FROM part
    """
)
def round_half_up(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    return t.part.select("p_partkey", F.round(key + F.lit(0.5), 0).alias("whole"), F.round(key / F.lit(8.0), 2).alias("cents"))


@proof(
    """
    SELECT p_partkey, ROUND_EVEN(p_partkey + CAST(0.5 AS DOUBLE), 0) AS whole, ROUND_EVEN(p_partkey / CAST(8 AS DOUBLE), 2) AS cents
    FROM part
    """
)
def round_half_even(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    return t.part.select("p_partkey", F.bround(key + F.lit(0.5), 0).alias("whole"), F.bround(key / F.lit(8.0), 2).alias("cents"))


_FLAG_TEXT = """
    WITH raw AS (SELECT l_orderkey, l_linenumber,
                        CASE l_returnflag WHEN 'A' THEN CASE l_linestatus WHEN 'F' THEN 'True' ELSE ' yes' END
                                          WHEN 'N' THEN CASE l_linestatus WHEN 'F' THEN 'n' ELSE '0 ' END
                                          ELSE CASE l_linestatus WHEN 'F' THEN 'x' END END AS flag
                 FROM lineitem)
"""


def _flags(t: Tables) -> DataFrame:
    kind, done = F.col("l_returnflag"), F.col("l_linestatus") == "F"
    flag = (
        F.when(kind == "A", F.when(done, "True").otherwise(" yes"))
        .when(kind == "N", F.when(done, "n").otherwise("0 "))
        .otherwise(F.when(done, "x"))
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", flag.alias("flag"))


@proof(
    _FLAG_TEXT
    + """
    SELECT l_orderkey, l_linenumber,
           MAP {'1': TRUE, 'true': TRUE, 'yes': TRUE, 'y': TRUE, '0': FALSE, 'false': FALSE, 'no': FALSE, 'n': FALSE}
             [LOWER(TRIM(flag))]::INTEGER AS is_fast
    FROM raw
    """
)
def parse_bool_tri(t: Tables) -> DataFrame:
    return _flags(t).select("l_orderkey", "l_linenumber", parse.flag_or_null(F.col("flag")).cast("int").alias("is_fast"))


@proof(
    _FLAG_TEXT + "SELECT l_orderkey, l_linenumber, LOWER(COALESCE(flag, 'false')) = 'true' AS is_fast FROM raw"
)
def parse_bool_strict(t: Tables) -> DataFrame:
    return _flags(t).select("l_orderkey", "l_linenumber", parse.flag_is_true(F.col("flag")).alias("is_fast"))


@proof(
    f"""
    SELECT o_orderkey, {sql_half_up('o_totalprice / CAST(100 AS DOUBLE) * CAST(0.94 AS DOUBLE)', 4)} AS price_eur FROM orders
    """
)
def unit_convert(t: Tables) -> DataFrame:
    converted = numbers.rappen_to_eur(F.col("o_totalprice")).cast("decimal(18,8)")
    return t.orders.select("o_orderkey", F.round(converted, 4).cast("double").alias("price_eur"))


_PRICE_TEXT = """
    WITH low AS (SELECT p_partkey, p_type, CAST(CAST(FLOOR(p_retailprice) AS BIGINT) AS VARCHAR) AS n FROM part),
         raw AS (SELECT p_partkey,
                        CASE p_type WHEN 'ECONOMY' THEN '$' || n || ',000-$' || n || ',500'
                                    WHEN 'SMALL' THEN ' $' || n || ',000 - $' || n || ',500'
                                    WHEN 'PROMO' THEN 'n/a' WHEN 'LARGE' THEN NULL
                                    ELSE '$' || n || ',250 ' END AS price,
                        CASE p_type WHEN 'ECONOMY' THEN '1,' || n || ' hp' WHEN 'SMALL' THEN n || '-' || n || ' hp'
                                    WHEN 'PROMO' THEN 'none' ELSE n || ' HP' END AS power
                 FROM low)
"""


def _priced(t: Tables) -> DataFrame:
    kind, n = F.col("p_type"), F.floor("p_retailprice").cast("string")
    price = (
        F.when(kind == "ECONOMY", F.concat(F.lit("$"), n, F.lit(",000-$"), n, F.lit(",500")))
        .when(kind == "SMALL", F.concat(F.lit(" $"), n, F.lit(",000 - $"), n, F.lit(",500")))
        .when(kind == "PROMO", "n/a")
        .when(kind != "LARGE", F.concat(F.lit("$"), n, F.lit(",250 ")))
    )
    power = (
        F.when(kind == "ECONOMY", F.concat(F.lit("1,"), n, F.lit(" hp")))
        .when(kind == "SMALL", F.concat(n, F.lit("-"), n, F.lit(" hp")))
        .when(kind == "PROMO", "none")
        .otherwise(F.concat(n, F.lit(" HP")))
    )
    return t.part.select("p_partkey", price.alias("price"), power.alias("power"))


@proof(
    _PRICE_TEXT
    + """
    SELECT p_partkey,
           TRY_CAST(REGEXP_EXTRACT(REGEXP_REPLACE(price, '[$, ]', '', 'g'), '[0-9]+') AS DECIMAL(12,2)) AS price_usd,
           TRY_CAST(REGEXP_EXTRACT(REGEXP_REPLACE(power, ',', '', 'g'), '[0-9]+') AS INTEGER) AS horsepower
    FROM raw
    """
)
def parse_price_sql(t: Tables) -> DataFrame:
    return _priced(t).select(
        "p_partkey", parse.price_lower_bound(F.col("price")).alias("price_usd"), parse.leading_int(F.col("power")).alias("horsepower")
    )


@proof(
    _PRICE_TEXT
    + """
    SELECT p_partkey,
           TRY_CAST(TRIM(REPLACE(REPLACE(STRING_SPLIT(COALESCE(price, '0'), ' - ')[1], '$', ''), ',', '')) AS DOUBLE) AS price_usd,
           CASE WHEN REGEXP_FULL_MATCH(TRIM(STRING_SPLIT(COALESCE(power, '0'), ' ')[1]), '[0-9]+')
                THEN CAST(TRIM(STRING_SPLIT(COALESCE(power, '0'), ' ')[1]) AS INTEGER) END AS horsepower
    FROM raw
    """
)
def parse_price_doc(t: Tables) -> DataFrame:
    return _priced(t).select(
        "p_partkey", parse.price_first_part(F.col("price")).alias("price_usd"), parse.first_part_int(F.col("power")).alias("horsepower")
    )
