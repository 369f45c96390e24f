"""Composite queries: decision, integration, country-year assembly, dashboard reads.

Stand-ins: nation for country, part for vehicle, lineitem for emission and spec
records, orders for prices, events for grid intensity, customer for stations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampertide.functions.codes import map_codes
from ampertide.functions.numbers import scaled, unscaled
from ampertide.operators.aggregates import at_least, mean_over_join
from ampertide.operators.joining import left_chain, with_scalars
from ampertide.operators.merging import append_rows
from ampertide.operators.reshaping import embed, nest, unnest
from ampertide.operators.slicing import in_year, optional_filter
from ampertide.plans import dashboard, documents, relational
from ampertide.plans import decision as dec
from ampertide.session import materialise
from ampertide.sources.sinks import view
from proofs.basics import REFERENCE_YEAR
from proofs.registry import CENTS, MONEY, Tables, mean, proof, sql_half_up, sql_half_up_written, sql_mean

EXACT = "decimal(18,8)"

# --- decision ----------------------------------------------------------------

_INPUTS_SQL = f"""
    WITH petrol AS (SELECT c_nationkey AS k, {sql_mean('c_acctbal')} AS p FROM customer GROUP BY 1),
         diesel AS (SELECT s_nationkey AS k, {sql_mean('s_acctbal')} AS p FROM supplier GROUP BY 1),
         price AS (SELECT c.c_nationkey AS k, {sql_mean('o.o_totalprice')} / 70.0 AS p
                   FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
                   WHERE YEAR(o.o_orderdate) = {REFERENCE_YEAR} GROUP BY 1),
         grid AS (SELECT c.c_nationkey AS k, {sql_mean('e.value')} / CAST(0.45 AS DOUBLE) AS g
                  FROM events e JOIN customer c ON c.c_custkey = e.user_id
                  WHERE e.event_type = 'purchase' GROUP BY 1),
         ice AS (SELECT {sql_mean('l.l_quantity')} AS l, {sql_mean('l.l_quantity * (1 + l.l_tax)', EXACT)} AS co2
                 FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
                 WHERE l.l_returnflag IN ('A', 'N') HAVING COUNT(*) >= 5),
         ev AS (SELECT {sql_mean('l.l_quantity')} AS kwh
                FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
                WHERE l.l_returnflag = 'R' AND l.l_quantity > 0 HAVING COUNT(*) >= 1),
         kpi AS (SELECT n.n_nationkey AS nation_key, n.n_name AS nation_name,
                        (petrol.p + diesel.p) / CAST(2 AS DOUBLE) * ice.l / CAST(100 AS DOUBLE) AS ice_cost,
                        price.p * ev.kwh / CAST(100 AS DOUBLE) AS ev_cost,
                        grid.g * ev.kwh / CAST(100 AS DOUBLE) AS ev_co2,
                        ice.co2 AS ice_co2
                 FROM nation n CROSS JOIN ice CROSS JOIN ev
                 JOIN petrol ON petrol.k = n.n_nationkey JOIN diesel ON diesel.k = n.n_nationkey
                 JOIN price ON price.k = n.n_nationkey JOIN grid ON grid.k = n.n_nationkey)
"""
_RULE_SQL = """
           CASE WHEN ev_cost <= CAST(1.1 AS DOUBLE) * ice_cost AND ev_co2 <= ice_co2 THEN 1 ELSE 0 END AS recommend_ev
"""
_DECISION_SQL = (
    _INPUTS_SQL
    + f"""
    SELECT nation_key, nation_name, 'FLEET_AVG' AS segment,
           ROUND(ice_cost, 4) AS ice_eur_per_km, ROUND(ev_cost, 4) AS ev_eur_per_km,
           ROUND(ev_co2, 2) AS ev_co2_g_per_km, ROUND(ice_co2, 0) AS ice_co2_g_per_km, {_RULE_SQL},
           ROUND(ev_cost / ice_cost, 2) AS ratio_cost, ROUND(ev_co2 / ice_co2, 2) AS ratio_co2
    FROM kpi ORDER BY nation_key
    """
)
_ROUNDED_SQL = (
    _INPUTS_SQL
    + f""",
         r AS (SELECT nation_key, ROUND_EVEN(ice_cost, 4) AS ice_cost, ROUND_EVEN(ev_cost, 4) AS ev_cost,
                      ROUND_EVEN(ev_co2, 2) AS ev_co2, ROUND_EVEN(ice_co2, 0) AS ice_co2 FROM kpi)
    SELECT nation_key, ice_cost AS ice_eur_per_km, ev_cost AS ev_eur_per_km, ev_co2 AS ev_co2_g_per_km,
           ice_co2 AS ice_co2_g_per_km, {_RULE_SQL},
           ROUND_EVEN(ev_cost / GREATEST(ice_cost, 0.0001), 2) AS ratio_cost,
           ROUND_EVEN(ev_co2 / GREATEST(ice_co2, 0.0001), 2) AS ratio_co2
    FROM r ORDER BY nation_key
    """
)


def _members(t: Tables, key: str = "c_custkey") -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias(key), F.col("c_nationkey").alias("nation_key"))


def _countries(t: Tables) -> DataFrame:
    """Nations with two prices."""
    petrol = t.customer.groupBy(F.col("c_nationkey").alias("nation_key")).agg(mean("c_acctbal").alias("petrol_price_eur_per_l"))
    diesel = t.supplier.groupBy(F.col("s_nationkey").alias("nation_key")).agg(mean("s_acctbal").alias("diesel_price_eur_per_l"))
    nations = t.nation.select(F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("nation_name"))
    return nations.join(petrol, "nation_key").join(diesel, "nation_key")


def _price(t: Tables) -> DataFrame:
    orders = t.orders.where(in_year(F.col("o_orderdate"), REFERENCE_YEAR))
    priced = mean_over_join(orders, _members(t, "o_custkey"), "o_custkey", {"p": (F.col("o_totalprice"), CENTS)}, ["nation_key"])
    return priced.select("nation_key", (F.col("p") / F.lit(70.0)).alias("price_eur_per_kwh"))


def _intensity(t: Tables) -> DataFrame:
    bought = t.events.where("event_type = 'purchase'")
    grid = mean_over_join(bought, _members(t, "user_id"), "user_id", {"g": (F.col("value"), CENTS)}, ["nation_key"])
    return grid.select("nation_key", (F.col("g") / F.lit(0.45)).alias("co2_g_per_kwh"))


def _fleets(t: Tables) -> DataFrame:
    """Both fleets from one scan of their records, one row."""
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity")
    combustion, electric = flag.isin("A", "N"), (flag == "R") & (quantity > 0)
    averages = mean_over_join(
        t.lineitem.where(combustion | electric),
        t.part.select(F.col("p_partkey").alias("l_partkey")),
        "l_partkey",
        {
            "l_per_100km": (F.when(combustion, quantity), CENTS),
            "co2_gkm": (F.when(combustion, quantity * (1 + F.col("l_tax"))), 4),
            "kwh_per_100km": (F.when(electric, quantity), CENTS),
        },
        counts={"n_combustion": combustion, "n_electric": electric},
    )
    large_enough = at_least(at_least(averages, "n_combustion", 5), "n_electric", 1)
    return large_enough.drop("n_combustion", "n_electric")


def _kpis(t: Tables) -> DataFrame:
    return dec.fleet_kpis(_countries(t), [_fleets(t)], _price(t), _intensity(t), key="nation_key")


@proof(_DECISION_SQL)
def decision(t: Tables) -> DataFrame:
    return dec.decide(_kpis(t), "nation_key", "nation_name").orderBy("nation_key")


@proof(_DECISION_SQL)
def decision_view(t: Tables) -> DataFrame:
    view(dec.decide(_kpis(t), "nation_key", "nation_name"), "fleet_decision")
    return t.spark.sql("SELECT * FROM fleet_decision ORDER BY nation_key")


@proof(_DECISION_SQL)
def decision_from_materialized(t: Tables) -> DataFrame:
    price, intensity = materialise(_price(t), "price"), materialise(_intensity(t), "intensity")
    kpis = dec.fleet_kpis(_countries(t), [_fleets(t)], price, intensity, key="nation_key")
    return dec.decide(kpis, "nation_key", "nation_name").orderBy("nation_key")


@proof(_ROUNDED_SQL)
def decision_rounded(t: Tables) -> DataFrame:
    return dec.decide_rounded(_kpis(t), "nation_key").orderBy("nation_key")


@proof(_ROUNDED_SQL)
def mv_decision_read(t: Tables) -> DataFrame:
    stored = materialise(dec.decide_rounded(_kpis(t), "nation_key"), "decision")
    return dashboard.stored_decision(stored, key="nation_key")


@proof(
    f"""
    SELECT p.p_type AS vehicle_class, {sql_mean('l.l_quantity')} AS qty, {sql_mean('l.l_extendedprice')} AS price,
           COUNT(*) AS n
    FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
    WHERE p.p_type IN ('ECONOMY', 'STANDARD', 'PROMO') AND l.l_tax > 0
    GROUP BY 1 HAVING COUNT(*) >= 5
    """
)
def fleet_average(t: Tables) -> DataFrame:
    vehicles = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("vehicle_class"))
    measures = {"qty": (F.col("l_quantity"), CENTS), "price": (F.col("l_extendedprice"), CENTS)}
    return dec.fleet_average(
        vehicles, t.lineitem, "l_partkey", measures, member=F.col("vehicle_class").isin("ECONOMY", "STANDARD", "PROMO"),
        valid=F.col("l_tax") > 0, min_n=5, by=["vehicle_class"],
    )


# --- prices ------------------------------------------------------------------

_REGION_CODES = {0: "CH", 1: "DE", 2: "FR"}
_REGION_SQL = "CASE n.n_regionkey WHEN 0 THEN 'CH' WHEN 1 THEN 'DE' WHEN 2 THEN 'FR' ELSE 'XX' END"


def _focus(t: Tables, key: str) -> DataFrame:
    """Customers with the country code of their region."""
    nations = t.nation.select(
        F.col("n_nationkey").alias("c_nationkey"), map_codes(F.col("n_regionkey"), _REGION_CODES, "XX").alias("country_code")
    )
    return t.customer.join(nations, "c_nationkey").select(F.col("c_custkey").alias(key), "country_code")


@proof(
    f"""
    WITH base AS (SELECT {_REGION_SQL} AS country_code, CAST(YEAR(o.o_orderdate) AS INTEGER) AS year,
                         CASE WHEN MONTH(o.o_orderdate) <= 6 THEN 1 ELSE 2 END AS half, o.o_totalprice AS p
                  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey),
         prices AS (SELECT country_code, year, CAST({sql_mean('p')} / 1000000.0 AS DECIMAL(6,4)) AS price
                    FROM base WHERE country_code IN ('DE', 'FR') AND year >= 1997 GROUP BY country_code, year, half
                    UNION ALL
                    SELECT country_code, year,
                           CAST({sql_half_up(sql_mean('p') + " / 10000.0 / CAST(100 AS DOUBLE) * CAST(0.94 AS DOUBLE)", 4)} AS DECIMAL(6,4))
                    FROM base WHERE country_code = 'CH' GROUP BY country_code, year)
    SELECT country_code, year, {sql_half_up('AVG(price)', 4)} AS price_eur_per_kwh FROM prices GROUP BY 1, 2
    """
)
def yearly_price_union(t: Tables) -> DataFrame:
    facts = t.orders.withColumns(
        {"year": F.year("o_orderdate"), "half": F.when(F.month("o_orderdate") <= 6, "1").otherwise("2")}
    )
    members, price = _focus(t, "o_custkey"), {"p": (F.col("o_totalprice"), CENTS)}
    halves = mean_over_join(facts, members, "o_custkey", price, ["country_code"], fact_by=["year", "half"])
    euro = halves.where(F.col("country_code").isin("DE", "FR")).select(
        "country_code",
        F.concat(F.col("year").cast("string"), F.lit("-S"), "half").alias("period"),
        (F.col("p") / F.lit(1000000.0)).alias("price_eur_per_kwh"),
    )
    years = mean_over_join(facts, members.where("country_code = 'CH'"), "o_custkey", price, fact_by=["year"])
    swiss = years.select("year", (F.col("p") / F.lit(10000.0)).alias("avg_price"))
    prices = dec.half_year_prices(euro, first_year=1997).unionByName(dec.yearly_rappen_prices(swiss))
    return dec.yearly_price(prices).withColumn("price_eur_per_kwh", F.col("price_eur_per_kwh").cast("double"))


# --- country-year data -------------------------------------------------------

_YEARLY_SQL = f"""
    WITH base AS (SELECT n.n_name AS country_code, CAST(YEAR(o.o_orderdate) AS INTEGER) AS year, o.o_orderstatus AS status,
                         o.o_orderpriority AS priority, o.o_totalprice AS p
                  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey),
         intensity AS (SELECT country_code, year, {sql_mean('p')} / 1000.0 AS co2 FROM base WHERE status = 'F' GROUP BY 1, 2),
         price AS (SELECT country_code, year, {sql_mean('p')} / 70.0 AS price FROM base WHERE status <> 'P' GROUP BY 1, 2),
         mix AS (SELECT country_code, year, status AS source, CAST(SUM(CAST(p AS {MONEY})) AS DOUBLE) / 1000000.0 AS twh
                 FROM base GROUP BY 1, 2, 3),
         adoption AS (SELECT country_code, year, COUNT(*) FILTER (priority = '1-URGENT') AS urgent,
                             COUNT(*) FILTER (priority = '5-LOW') AS low FROM base GROUP BY 1, 2)
"""


def _sales(t: Tables, nation: str | None = None, year: int | None = None) -> DataFrame:
    """Orders summed per nation name, year, status and priority, of all or one nation and year.

    Stored, as one scan of the orders serves every yearly frame.
    """
    orders = t.orders if year is None else t.orders.where(in_year(F.col("o_orderdate"), year))
    nations = optional_filter(t.nation, "n_name", nation)
    per_customer = orders.groupBy(
        F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
    ).agg(F.sum(scaled(F.col("o_totalprice"), CENTS)).alias("amount"), F.count(F.lit(1)).alias("n"))
    names = nations.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country_code"))
    places = t.customer.select("c_custkey", "c_nationkey").join(names, "c_nationkey").select("c_custkey", "country_code")
    summed = per_customer.join(places, "c_custkey").groupBy("country_code", "year", "status", "priority").agg(
        F.sum(F.col("amount").cast("decimal(20,0)")).alias("amount"), F.sum("n").alias("n")
    )
    return materialise(summed, "sales")


_YEAR_KEYS = ["country_code", "year"]


def _yearly_average(sales: DataFrame, condition: str, divisor: float, name: str) -> DataFrame:
    quotient = unscaled(F.sum("amount"), CENTS) / F.sum("n") / F.lit(divisor)
    return sales.where(condition).groupBy(*_YEAR_KEYS).agg(quotient.alias(name))


def _yearly_intensity(sales: DataFrame) -> DataFrame:
    return _yearly_average(sales, "status = 'F'", 1000.0, "co2_intensity_gkwh")


def _yearly_price(sales: DataFrame) -> DataFrame:
    return _yearly_average(sales, "status <> 'P'", 70.0, "electricity_price_eur_per_kwh")


def _country_year(t: Tables, nation: str | None = None, year: int | None = None) -> DataFrame:
    sales = _sales(t, nation, year)
    twh = unscaled(F.sum("amount"), CENTS) / F.lit(1000000.0)
    mix = nest(sales.withColumnRenamed("status", "source"), _YEAR_KEYS, ["source"], {"generation_twh": twh}, "grid_mix", ("F", "O", "P"))

    def orders_of(priority: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("priority") == priority, F.col("n"))), F.lit(0).cast("long"))

    counts = sales.groupBy(*_YEAR_KEYS).agg(orders_of("1-URGENT").alias("urgent"), orders_of("5-LOW").alias("low"))
    adoption = counts.select(*_YEAR_KEYS, embed("ev_adoption", urgent=F.col("urgent"), low=F.col("low")))
    return left_chain(_yearly_intensity(sales), _YEAR_KEYS, _yearly_price(sales), mix, adoption)


@proof(
    _YEARLY_SQL
    + """
    SELECT i.country_code, i.year, i.co2 AS co2_intensity, p.price AS electricity_price, m.source, m.twh AS generation_twh,
           a.urgent, a.low
    FROM intensity i LEFT JOIN price p ON p.country_code = i.country_code AND p.year = i.year
         LEFT JOIN mix m ON m.country_code = i.country_code AND m.year = i.year
         LEFT JOIN adoption a ON a.country_code = i.country_code AND a.year = i.year
    """
)
def assemble_country_year(t: Tables) -> DataFrame:
    flat = _country_year(t).select(
        "country_code", "year", F.col("co2_intensity_gkwh").alias("co2_intensity"),
        F.col("electricity_price_eur_per_kwh").alias("electricity_price"), "ev_adoption.urgent", "ev_adoption.low", "grid_mix",
    )
    return unnest(flat, "grid_mix", keep_empty=True)


@proof(
    _YEARLY_SQL
    + """
    SELECT i.country_code, i.year, p.price AS electricity_price
    FROM intensity i JOIN price p ON p.country_code = i.country_code AND p.year = i.year
    WHERE p.price > 3000 ORDER BY i.country_code, i.year
    """
)
def trend_series(t: Tables) -> DataFrame:
    sales = _sales(t)
    yearly = left_chain(_yearly_intensity(sales), _YEAR_KEYS, _yearly_price(sales))
    return dashboard.trend(yearly, F.col("electricity_price_eur_per_kwh"), "electricity_price", above=3000)


_INTERACTIVE_NATION = "NATION_3"


@proof(
    _YEARLY_SQL.replace("WITH base", _INPUTS_SQL.rstrip() + ",\n base", 1).replace(" price AS (SELECT country_code", " yprice AS (SELECT country_code", 1)
    + f"""
    SELECT i.country_code AS country, i.year, p.price AS electricity_price, i.co2 AS co2_intensity,
           ROUND_EVEN(ice.l / 100 * ((pe.p + di.p) / CAST(2 AS DOUBLE)), 4) AS ice_cost_per_km,
           ROUND_EVEN(ev.kwh / 100 * p.price, 4) AS ev_cost_per_km,
           ROUND_EVEN(ev.kwh / 100 * i.co2, 2) AS ev_co2_per_km,
           ROUND_EVEN(ice.co2, 0) AS ice_co2_per_km,
           m.source, m.twh AS generation_twh, a.urgent, a.low, (SELECT COUNT(*) FROM customer c WHERE c.c_nationkey = n.n_nationkey) AS station_count
    FROM intensity i JOIN nation n ON n.n_name = i.country_code
         JOIN petrol pe ON pe.k = n.n_nationkey JOIN diesel di ON di.k = n.n_nationkey CROSS JOIN ice CROSS JOIN ev
         LEFT JOIN yprice p ON p.country_code = i.country_code AND p.year = i.year
         LEFT JOIN mix m ON m.country_code = i.country_code AND m.year = i.year
         LEFT JOIN adoption a ON a.country_code = i.country_code AND a.year = i.year
    WHERE i.country_code = '{_INTERACTIVE_NATION}' AND i.year = {REFERENCE_YEAR}
    """
)
def decision_interactive(t: Tables) -> DataFrame:
    stations = t.customer.groupBy(F.col("c_nationkey").alias("nation_key")).agg(F.count(F.lit(1)).alias("station_count"))
    countries = _countries(t).join(stations, "nation_key").select(
        F.col("nation_name").alias("country_code"), "petrol_price_eur_per_l", "diesel_price_eur_per_l",
        embed("charging_summary", station_count=F.col("station_count")),
    )
    row = dashboard.interactive_decision(countries, _country_year(t, _INTERACTIVE_NATION, REFERENCE_YEAR), [_fleets(t)], _INTERACTIVE_NATION, REFERENCE_YEAR)
    return unnest(row.select("*", "ev_adoption.*", "charging.station_count").drop("ev_adoption", "charging"), "grid_mix")


# --- cost projection ---------------------------------------------------------

_YEARS_AHEAD = 20


@proof(
    _INPUTS_SQL
    + f"""
    , purchase AS (SELECT MEDIAN(p_retailprice) FILTER (p_type IN ('ECONOMY', 'STANDARD', 'SMALL', 'MEDIUM')) AS ice,
                          MEDIAN(p_retailprice) FILTER (p_type IN ('PROMO', 'LARGE')) AS ev FROM part),
      years AS (SELECT CAST(yr AS INTEGER) AS yr FROM RANGE(1, {_YEARS_AHEAD + 1}) AS r(yr))
    SELECT k.nation_key AS country, y.yr AS year,
           {sql_half_up_written('b.ice + CAST(15000 AS DOUBLE) * y.yr * k.ice_cost', 2)} AS ice_total,
           {sql_half_up_written('b.ev + CAST(15000 AS DOUBLE) * y.yr * k.ev_cost', 2)} AS ev_total
    FROM kpi k CROSS JOIN purchase b CROSS JOIN years y
    ORDER BY country, year
    """
)
def tco_projection(t: Tables) -> DataFrame:
    purchase = dashboard.purchase_prices(
        t.part, "p_retailprice", "p_type", ("ECONOMY", "STANDARD", "SMALL", "MEDIUM"), ("PROMO", "LARGE")
    )
    base = with_scalars(_kpis(t), purchase).select(
        "nation_key", "ice_purchase_usd", "ev_purchase_usd",
        F.col("ice_eur_per_km").alias("ice_cost_per_km"), F.col("ev_eur_per_km").alias("ev_cost_per_km"),
    )
    return dashboard.cost_projection(base, _YEARS_AHEAD, key="nation_key")


# --- integration -------------------------------------------------------------

_STAGING_SQL = """
    WITH catalogue AS (
      SELECT p_brand AS company_name, ' ' || p_name || ' ' || CAST(p_size AS VARCHAR) AS car_name,
             CASE p_type WHEN 'ECONOMY' THEN 'Petrol' WHEN 'SMALL' THEN 'diesel engine' WHEN 'MEDIUM' THEN 'Plug-in hybrid'
                         WHEN 'PROMO' THEN 'Electric' WHEN 'LARGE' THEN 'Hybrid' ELSE 'gasoline' END AS fuel_type,
             '$' || CAST(CAST(FLOOR(p_retailprice) AS BIGINT) AS VARCHAR) || ',000-$99,000' AS price,
             CAST(p_size AS VARCHAR) || ' hp' AS horsepower,
             CASE p_type WHEN 'SMALL' THEN '2+2' WHEN 'LARGE' THEN 'many' ELSE '5' END AS seats
      FROM part),
    registry AS (
      SELECT UPPER(p.p_brand) AS make, p.p_name || ' ' || CAST(p.p_size AS VARCHAR) AS model, p.p_type AS vehicle_class,
             MAX(l.l_linenumber) AS cylinders, MAX(l.l_returnflag) AS transmission,
             CASE p.p_type WHEN 'SMALL' THEN 'D' WHEN 'LARGE' THEN 'Z' WHEN 'MEDIUM' THEN '?' ELSE 'X' END AS fuel_type,
             MAX(l.l_quantity) AS fuel_city, MIN(l.l_quantity) AS fuel_hwy, COUNT(*) AS co2_gkm
      FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
      GROUP BY p.p_partkey, p.p_brand, p.p_name, p.p_size, p.p_type),
    specs AS (
      SELECT LOWER(p.p_brand) || '  ' || p.p_name || ' ' || CAST(p.p_size AS VARCHAR) AS car_model,
             CASE WHEN p.p_size > 45 THEN 'empty' ELSE CAST(p.p_size AS VARCHAR) END AS battery,
             CASE WHEN s.s_acctbal < 1000 THEN 'NA' ELSE CAST(CAST(FLOOR(s.s_acctbal / 10) AS BIGINT) AS VARCHAR) END AS reach,
             'AC ' || CAST(s.s_nationkey AS VARCHAR) || '.5 kW' AS ac_power
      FROM supplier s JOIN part p ON p.p_partkey = s.s_suppkey)
"""


def _staging(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    kind, size = F.col("p_type"), F.col("p_size").cast("string")
    name = F.concat("p_name", F.lit(" "), size)
    fuels = {
        "ECONOMY": "Petrol", "SMALL": "diesel engine", "MEDIUM": "Plug-in hybrid", "PROMO": "Electric", "LARGE": "Hybrid",
    }
    catalogue = t.part.select(
        F.col("p_brand").alias("company_name"),
        F.concat(F.lit(" "), name).alias("car_name"),
        map_codes(kind, fuels, "gasoline").alias("fuel_type"),
        F.concat(F.lit("$"), F.floor("p_retailprice").cast("string"), F.lit(",000-$99,000")).alias("price"),
        F.concat(size, F.lit(" hp")).alias("horsepower"),
        map_codes(kind, {"SMALL": "2+2", "LARGE": "many"}, "5").alias("seats"),
    )
    records = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.max("l_linenumber").alias("cylinders"), F.max("l_returnflag").alias("transmission"),
        F.max("l_quantity").alias("fuel_city"), F.min("l_quantity").alias("fuel_hwy"), F.count(F.lit(1)).alias("co2_gkm"),
    )
    registry = records.join(t.part, "p_partkey").select(
        F.upper("p_brand").alias("make"), name.alias("model"), kind.alias("vehicle_class"),
        F.lit(None).cast("string").alias("engine_size_l"), "cylinders", "transmission",
        map_codes(kind, {"SMALL": "D", "LARGE": "Z", "MEDIUM": "?"}, "X").alias("fuel_type"),
        "fuel_city", "fuel_hwy", F.col("fuel_city").alias("fuel_comb"), F.col("co2_gkm").cast("string").alias("co2_gkm"),
    )
    sheet = t.supplier.withColumnRenamed("s_suppkey", "p_partkey").join(t.part, "p_partkey")
    reach = F.floor(F.col("s_acctbal") / 10).cast("string")
    specs = sheet.select(
        F.concat(F.lower("p_brand"), F.lit("  "), name).alias("car_model"),
        F.when(F.col("p_size") > 45, "empty").otherwise(size).alias("battery_capacity_kwh"),
        F.when(F.col("s_acctbal") < 1000, "NA").otherwise(reach).alias("autonomy_wltp_km"),
        F.lit("NA").alias("dc_charge_power_kw"),
        F.concat(F.lit("AC "), F.col("s_nationkey").cast("string"), F.lit(".5 kW")).alias("ac_charge_power"),
        F.lit("empty").alias("release_year"),
    )
    return catalogue, materialise(registry, "registry"), specs


@proof(
    _STAGING_SQL
    + """
    , classes AS (SELECT UPPER(TRIM(make)) AS mk, UPPER(TRIM(model)) AS md, MIN(vehicle_class) AS vehicle_class FROM registry GROUP BY 1, 2),
    cars AS (
      SELECT TRIM(company_name) AS make, TRIM(car_name) AS model,
             MAP {'Petrol': 'Petrol', 'diesel engine': 'Diesel', 'Plug-in hybrid': 'Plug-in Hybrid', 'Electric': 'Electric',
                  'Hybrid': 'Hybrid', 'gasoline': 'Petrol'}[fuel_type] AS fuel_type,
             CAST(REGEXP_EXTRACT(REGEXP_REPLACE(price, '[$,]', '', 'g'), '[0-9]+') AS DOUBLE) AS price_usd,
             CAST(REGEXP_EXTRACT(horsepower, '[0-9]+') AS INTEGER) AS horsepower,
             CAST(NULLIF(REGEXP_EXTRACT(TRIM(seats), '[0-9]+'), '') AS INTEGER) AS seats
      FROM catalogue),
    numbered_cars AS (
      SELECT ROW_NUMBER() OVER (ORDER BY c.make, c.model, fuel_type, price_usd, horsepower, seats NULLS FIRST) AS vehicle_id,
             c.make, c.model, fuel_type, k.vehicle_class, price_usd, horsepower, seats
      FROM cars c LEFT JOIN classes k ON k.mk = UPPER(TRIM(c.make)) AND k.md = UPPER(TRIM(c.model))),
    numbered_registry AS (
      SELECT (SELECT COALESCE(MAX(vehicle_id), 0) FROM numbered_cars)
             + ROW_NUMBER() OVER (ORDER BY make, model, fuel, cylinders, transmission, fuel_city, fuel_hwy, co2_gkm, vehicle_class) AS vehicle_id, *
      FROM (SELECT *, COALESCE(MAP {'X': 'Petrol', 'Z': 'Premium Petrol', 'D': 'Diesel'}[fuel_type], 'Unknown') AS fuel FROM registry)),
    known AS (
      SELECT vehicle_id, make, model, fuel_type, vehicle_class, price_usd, horsepower, seats FROM numbered_cars
      UNION ALL
      SELECT vehicle_id, make, model, fuel, vehicle_class, NULL, NULL, NULL FROM numbered_registry),
    sheet AS (
      SELECT * FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY spec_key ORDER BY car_model, battery, reach) AS rn
        FROM (SELECT car_model, REPLACE(UPPER(TRIM(car_model)), ' ', '') AS spec_key, TRY_CAST(battery AS DECIMAL(8,2)) AS battery,
                     TRY_CAST(reach AS DECIMAL(10,2)) AS reach,
                     CAST(REGEXP_EXTRACT(ac_power, '[0-9]+(\\.[0-9]+)?') AS DOUBLE) AS ac_power FROM specs)
        WHERE battery > 0 AND reach > 0) WHERE rn = 1),
    missing AS (
      SELECT * FROM sheet s WHERE NOT EXISTS (
        SELECT 1 FROM known v WHERE v.fuel_type = 'Electric' AND REPLACE(UPPER(v.make || ' ' || v.model), ' ', '') = s.spec_key)),
    vehicle AS (
      SELECT * FROM known
      UNION ALL
      SELECT (SELECT MAX(vehicle_id) FROM known) + ROW_NUMBER() OVER (ORDER BY spec_key), SPLIT_PART(TRIM(car_model), ' ', 1),
             TRIM(REGEXP_REPLACE(TRIM(car_model), '^[^ ]*', '')), 'Electric', NULL, NULL, NULL, NULL
      FROM missing),
    spec AS (
      SELECT * FROM (
        SELECT v.vehicle_id, s.battery, s.reach, s.ac_power, ROW_NUMBER() OVER (PARTITION BY s.spec_key ORDER BY v.vehicle_id) AS rn
        FROM sheet s JOIN vehicle v ON v.fuel_type = 'Electric' AND REPLACE(UPPER(v.make || ' ' || v.model), ' ', '') = s.spec_key)
      WHERE rn = 1)
    SELECT 'vehicle' AS origin, vehicle_id AS vehicle_id, make, model, fuel_type, vehicle_class,
           CAST(price_usd AS DOUBLE) AS price_usd, horsepower, seats, CAST(NULL AS BIGINT) AS row_id, CAST(NULL AS INTEGER) AS cylinders,
           CAST(NULL AS DOUBLE) AS litres, CAST(NULL AS INTEGER) AS co2, CAST(NULL AS DOUBLE) AS battery, CAST(NULL AS INTEGER) AS reach,
           CAST(NULL AS DOUBLE) AS kwh, CAST(NULL AS DOUBLE) AS ac_power
    FROM vehicle
    UNION ALL
    SELECT 'ice_emission', vehicle_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
           vehicle_id - (SELECT COALESCE(MAX(vehicle_id), 0) FROM numbered_cars), CAST(cylinders AS INTEGER),
           CAST(fuel_city AS DOUBLE), CAST(co2_gkm AS INTEGER), NULL, NULL, NULL, NULL
    FROM numbered_registry
    UNION ALL
    SELECT 'ev_spec', vehicle_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
           ROW_NUMBER() OVER (ORDER BY vehicle_id), NULL, NULL, NULL,
           CAST(battery AS DOUBLE), CAST(reach AS INTEGER),
           CAST(ROUND(CAST(CAST(battery AS DOUBLE) / CAST(reach AS DOUBLE) * 100 AS DECIMAL(18,8)), 1) AS DOUBLE), ac_power
    FROM spec
    """
)
def integrate_three_sources(t: Tables) -> DataFrame:
    tables = relational.integrate_vehicles(*_staging(t))
    vehicle = tables["vehicle"].withColumn("price_usd", F.col("price_usd").cast("double"))
    emission = tables["ice_emission"].select(
        "vehicle_id", F.col("ice_emission_id").alias("row_id"), "cylinders",
        F.col("fuel_consumption_comb").cast("double").alias("litres"), F.col("co2_emissions_gkm").alias("co2"),
    )
    spec = tables["ev_spec"].select(
        "vehicle_id", F.col("ev_spec_id").alias("row_id"), F.col("battery_capacity_kwh").cast("double").alias("battery"),
        F.col("range_wltp_km").alias("reach"), F.col("energy_consumption_kwh_100km").cast("double").alias("kwh"),
        F.col("ac_charge_power_kw").cast("double").alias("ac_power"),
    )
    rows = append_rows(append_rows(vehicle, emission.withColumn("origin", F.lit("ice_emission"))), spec.withColumn("origin", F.lit("ev_spec")))
    return rows.withColumn("origin", F.coalesce("origin", F.lit("vehicle")))


@proof(
    """
    SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment,
           CAST(NULL AS INTEGER) AS nation_key FROM supplier
    UNION ALL
    SELECT c_custkey, c_name, NULL, c_mktsegment, c_nationkey FROM customer
    """
)
def embed_and_union(t: Tables) -> DataFrame:
    suppliers = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), embed("account", balance=F.col("s_acctbal")))
    customers = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        embed("market", segment=F.col("c_mktsegment"), nation_key=F.col("c_nationkey")),
    )
    return append_rows(suppliers, customers).select("id", "name", "account.balance", "market.segment", "market.nation_key")


@proof(
    f"""
    WITH place AS (SELECT n_nationkey AS k, n_name AS name FROM nation UNION ALL SELECT -1 - r_regionkey, r_name FROM region),
         own AS (SELECT c_nationkey AS k, COUNT(*) AS n, {sql_mean('c_acctbal')} / 10000.0 AS share FROM customer GROUP BY 1)
    SELECT p.k AS country_code, p.name AS country_name, CAST(COALESCE(o.n, 0) AS INTEGER) AS station_count,
           ROUND_EVEN(COALESCE(o.share, 0), 4) AS fast_station_share
    FROM place p LEFT JOIN own o ON o.k = p.k
    """
)
def country_with_summary(t: Tables) -> DataFrame:
    """Regions stand for countries without a summary."""
    rich = t.customer.groupBy(F.col("c_nationkey").alias("country_code")).agg(
        F.count(F.lit(1)).alias("station_count"), (mean("c_acctbal") / F.lit(10000.0)).alias("fast_station_share")
    )
    nations = t.nation.select(F.col("n_nationkey").alias("country_code"), F.col("n_name").alias("country_name"))
    nations = nations.unionAll(t.region.select(F.lit(-1) - F.col("r_regionkey"), "r_name"))
    docs = nations.join(rich, "country_code", "left").select(
        "country_code", "country_name",
        embed(
            "charging_summary",
            station_count=F.coalesce(F.col("station_count"), F.lit(0)).cast("int"),
            fast_station_share=F.bround(F.coalesce(F.col("fast_station_share"), F.lit(0.0)), 4),
        ),
    )
    return docs.select("country_code", "country_name", "charging_summary.*")


_STATION_SQL = f"""
    WITH raw AS (
      SELECT CAST(c.c_custkey AS VARCHAR) AS id, c.c_name AS name, {_REGION_SQL} AS country_code,
             CAST(c.c_acctbal / 1000 AS DECIMAL(10,5)) AS lat, CAST(c.c_nationkey AS INTEGER) AS ports,
             CASE c.c_mktsegment WHEN 'BUILDING' THEN '' ELSE CAST(c.c_nationkey AS VARCHAR) || '.5' END AS power_kw,
             c.c_mktsegment AS power_class,
             CASE c.c_mktsegment WHEN 'BUILDING' THEN 'True' WHEN 'MACHINERY' THEN 'False' WHEN 'FURNITURE' THEN 'yes' ELSE 'x' END AS fast
      FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey)
"""


def _stations(t: Tables) -> DataFrame:
    nations = t.nation.select(
        F.col("n_nationkey").alias("c_nationkey"), map_codes(F.col("n_regionkey"), _REGION_CODES, "XX").alias("country_code")
    )
    segment = F.col("c_mktsegment")
    power = F.when(segment == "BUILDING", "").otherwise(F.concat(F.col("c_nationkey").cast("string"), F.lit(".5")))
    return t.customer.join(nations, "c_nationkey").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
        F.lit("Unknown City").alias("city"), F.lit("UNKNOWN").alias("state_province"), "country_code",
        (F.col("c_acctbal") / 1000).cast("decimal(10,5)").cast("string").alias("latitude"),
        F.lit("NA").alias("longitude"), F.col("c_nationkey").cast("string").alias("ports"),
        power.alias("power_kw"), segment.alias("power_class"),
        map_codes(segment, {"BUILDING": "True", "MACHINERY": "False", "FURNITURE": "yes"}, "x").alias("is_fast_dc"),
    )


@proof(
    _STATION_SQL
    + """
    SELECT 'relational' AS form, CAST(id AS BIGINT) AS station_id, name, country_code, CAST(lat AS DOUBLE) AS lat,
           CAST(NULL AS DOUBLE) AS lon, ports, TRY_CAST(power_kw AS DOUBLE) AS power_kw, power_class,
           MAP {'True': 1, 'yes': 1, 'False': 0}[fast] AS is_fast_dc
    FROM raw WHERE country_code IN ('CH', 'DE', 'FR')
    UNION ALL
    SELECT 'document', CAST(id AS BIGINT), name, country_code, CAST(lat AS DOUBLE), 0.0, ports,
           COALESCE(TRY_CAST(power_kw AS DOUBLE), 0.0), power_class, CAST(LOWER(fast) = 'true' AS INTEGER)
    FROM raw WHERE country_code IN ('CH', 'DE', 'FR')
    """
)
def clean_stations(t: Tables) -> DataFrame:
    raw = _stations(t)
    rows = relational.charging_station(raw).select(
        F.lit("relational").alias("form"), "station_id", "name", "country_code", F.col("latitude").cast("double").alias("lat"),
        F.col("longitude").cast("double").alias("lon"), "ports", F.col("power_kw").cast("double").alias("power_kw"),
        "power_class", F.col("is_fast_dc").cast("int").alias("is_fast_dc"),
    )
    docs = documents.charging_stations(raw)
    place = F.col("location.coordinates")
    return rows.unionByName(
        docs.select(
            F.lit("document").alias("form"), "station_id", "name", "country_code", place[1].alias("lat"), place[0].alias("lon"),
            "ports", "power_kw", "power_class", F.col("is_fast_dc").cast("int").alias("is_fast_dc"),
        )
    )
