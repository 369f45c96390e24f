"""The integrations and dashboard reads themselves, on staging frames shaped from the test tables.

Orders stand for measurements: the customer's region names the country, the order's year
is moved into the period the integrations keep, status and priority name the series.
Values are whole numbers, so both sides hold them exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampertide.functions.codes import map_codes
from ampertide.operators.reshaping import unnest
from ampertide.plans import dashboard, documents, relational
from ampertide.plans.relational import GENERATION, INTENSITY
from ampertide.session import materialise
from proofs.registry import Tables, proof

_AREAS = {0: "Switzerland", 1: "Germany", 2: "France"}
_SOURCES = {"F": "Coal", "O": "Gas", "P": "Hydro"}
_TRAINS = {"F": "BEV", "O": "PHEV", "P": "EV"}
_PARAMETERS = {"1-URGENT": "EV sales", "2-HIGH": "EV stock", "3-MEDIUM": "EV sales share", "5-LOW": "EV stock share"}
_SHIFT = 20


def _case(column: str, names: dict, other: str = "'Other'") -> str:
    when = " ".join(f"WHEN {k!r} THEN {v!r}" for k, v in names.items())
    return f"CASE {column} {when} ELSE {other} END"


_CODE_SQL = "CASE area WHEN 'Switzerland' THEN 'CH' WHEN 'Germany' THEN 'DE' WHEN 'France' THEN 'FR' END"
_SALES_SQL = f"""
    sales AS (SELECT {_case('n.n_regionkey', _AREAS)} AS area, CAST(YEAR(o.o_orderdate) + {_SHIFT} AS INTEGER) AS year,
                     o.o_orderstatus AS status, o.o_orderpriority AS priority, COUNT(*) AS n
              FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
              GROUP BY 1, 2, 3, 4),
    mix AS (SELECT area, year, {_case('status', _SOURCES)} AS source, SUM(n) AS twh, SUM(n) % 97 AS pct FROM sales GROUP BY 1, 2, 3),
    intensity AS (SELECT {_CODE_SQL} AS country_code, year, CAST(SUM(n) % 389 AS DOUBLE) AS co2 FROM sales
                  WHERE area <> 'Other' AND status = 'F' GROUP BY 1, 2)
"""
_ADOPTION_SQL = f"""
    adoption AS (SELECT area, year, {_case('status', _TRAINS)} AS powertrain, {_case('priority', _PARAMETERS)} AS parameter, SUM(n) % 1000 AS v
                 FROM sales GROUP BY 1, 2, 3, 4)
"""
_PRICE_SQL = """
    euro AS (SELECT CASE c.c_nationkey % 3 WHEN 0 THEN 'DE' WHEN 1 THEN 'FR' ELSE 'IT' END AS country_code,
                    CAST(YEAR(o.o_orderdate) + 20 AS INTEGER) AS year, CASE WHEN MONTH(o.o_orderdate) <= 6 THEN 1 ELSE 2 END AS half,
                    COUNT(*) % 64 AS v FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1, 2, 3),
    swiss AS (SELECT CAST(YEAR(o_orderdate) + 20 AS INTEGER) AS year, COUNT(*) % 31 AS v FROM orders GROUP BY 1)
"""


def _sales(t: Tables) -> DataFrame:
    """One scan of the orders for all series."""
    areas = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), map_codes(F.col("n_regionkey"), _AREAS, "Other").alias("area"))
    places = t.customer.join(areas, "c_nationkey").select(F.col("c_custkey").alias("o_custkey"), "area")
    per_customer = t.orders.groupBy(
        "o_custkey", (F.year("o_orderdate") + _SHIFT).alias("year"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
    ).agg(F.count(F.lit(1)).alias("n"))
    return materialise(
        per_customer.join(places, "o_custkey").groupBy("area", "year", "status", "priority").agg(F.sum("n").alias("n")), "sales"
    )


def _text(col: Column) -> Column:
    return col.cast("string").alias("value")


def _electricity_long(sales: DataFrame) -> DataFrame:
    by_source = sales.groupBy("area", "year", map_codes(F.col("status"), _SOURCES, "Other").alias("variable")).agg(F.sum("n").alias("n"))
    generation = [F.lit(GENERATION[k]).alias(k) for k in ("category", "subcategory")]
    rows = [
        by_source.select("area", "year", *generation, "variable", F.lit(unit).alias("unit"), _text(value))
        for unit, value in (("TWh", F.col("n")), ("%", F.col("n") % 97), ("%GDP", F.col("n")))
    ]
    clean = sales.where("status = 'F'").groupBy("area", "year").agg((F.sum("n") % 389).alias("n"))
    labels = [F.lit(INTENSITY[k]).alias(k) for k in ("category", "subcategory", "variable", "unit")]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(clean.select("area", "year", *labels, _text(F.col("n"))))


def _titled(df: DataFrame) -> DataFrame:
    return df.toDF(*(name.capitalize() for name in df.columns))


def _adoption_long(sales: DataFrame) -> DataFrame:
    return sales.groupBy(
        F.col("area").alias("region"), "year", map_codes(F.col("status"), _TRAINS, "Other").alias("powertrain"),
        map_codes(F.col("priority"), _PARAMETERS, "Other").alias("parameter"),
    ).agg((F.sum("n") % 1000).cast("string").alias("value")).withColumns({"category": F.lit("Historical"), "mode": F.lit("Cars")})


def _euro(t: Tables) -> DataFrame:
    codes = F.when(F.col("c_nationkey") % 3 == 0, "DE").when(F.col("c_nationkey") % 3 == 1, "FR").otherwise("IT")
    members = t.customer.select(F.col("c_custkey").alias("o_custkey"), codes.alias("country_code"))
    half = F.when(F.month("o_orderdate") <= 6, "-S1").otherwise("-S2")
    period = F.concat((F.year("o_orderdate") + _SHIFT).cast("string"), half).alias("period")
    counts = t.orders.groupBy("o_custkey", period).agg(F.count(F.lit(1)).alias("n")).join(members, "o_custkey")
    return counts.groupBy("country_code", "period").agg((F.sum("n") % 64 / 64).cast("string").alias("price_eur_per_kwh"))


def _swiss(t: Tables) -> DataFrame:
    return t.orders.groupBy((F.year("o_orderdate") + _SHIFT).alias("year")).agg((F.count(F.lit(1)) % 31).cast("string").alias("avgPrice"))


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in names})


@proof(
    f"""
    WITH {_SALES_SQL}
    SELECT ROW_NUMBER() OVER (ORDER BY country_code, year, source_type) AS grid_mix_id, * FROM (
      SELECT {_CODE_SQL} AS country_code, year, source AS source_type, CAST(twh AS DOUBLE) AS generation_twh,
             CAST(pct AS DOUBLE) AS share_pct, CAST(NULL AS DOUBLE) AS co2_intensity_gkwh
      FROM mix WHERE area <> 'Other' AND year BETWEEN 2018 AND 2023)
    """
)
def product_grid_mix(t: Tables) -> DataFrame:
    return _doubles(relational.grid_mix(_electricity_long(_sales(t))), "generation_twh", "share_pct", "co2_intensity_gkwh")


@proof(
    f"""
    WITH {_SALES_SQL}, {_ADOPTION_SQL}
    SELECT ROW_NUMBER() OVER (ORDER BY country_code, year, powertrain) AS ev_adoption_id, * FROM (
      SELECT {_CODE_SQL} AS country_code, year, powertrain,
             CAST(MAX(v) FILTER (parameter = 'EV sales') AS INTEGER) AS ev_sales,
             CAST(MAX(v) FILTER (parameter = 'EV stock') AS INTEGER) AS ev_stock,
             CAST(MAX(v) FILTER (parameter = 'EV sales share') AS DOUBLE) AS ev_sales_share_pct,
             CAST(MAX(v) FILTER (parameter = 'EV stock share') AS DOUBLE) AS ev_stock_share_pct
      FROM adoption
      WHERE area <> 'Other' AND year BETWEEN 2018 AND 2023
        AND (powertrain = 'EV') = (parameter IN ('EV sales share', 'EV stock share')) AND parameter <> 'Other'
      GROUP BY 1, 2, 3)
    """
)
def product_ev_adoption(t: Tables) -> DataFrame:
    return _doubles(relational.ev_adoption(_adoption_long(_sales(t))), "ev_sales_share_pct", "ev_stock_share_pct")


@proof(
    f"""
    WITH {_PRICE_SQL}, prices AS (
      SELECT country_code, year, half AS half_year, CAST(ROUND(CAST(v AS DECIMAL(12,6)) / 64, 4) AS DOUBLE) AS price FROM euro
      WHERE country_code IN ('DE', 'FR') AND year >= 2015
      UNION ALL SELECT 'CH', year, NULL, CAST(CAST(ROUND(CAST(v * 94 AS DECIMAL(12,4)) / 10000, 4) AS DECIMAL(6,4)) AS DOUBLE) FROM swiss)
    SELECT ROW_NUMBER() OVER (ORDER BY country_code, year, half_year NULLS FIRST) AS elec_price_id, country_code, year,
           CAST(half_year AS INTEGER) AS half_year, price AS price_eur_per_kwh FROM prices
    """
)
def product_electricity_price(t: Tables) -> DataFrame:
    swiss = _swiss(t).withColumnRenamed("avgPrice", "avg_price")
    return _doubles(relational.electricity_price(_euro(t), swiss), "price_eur_per_kwh")


_YEARLY_SQL = f"""
    {_SALES_SQL}, {_ADOPTION_SQL}, {_PRICE_SQL},
    price AS (SELECT country_code, year, ROUND_EVEN(AVG(CAST(v AS DOUBLE) / 64), 4) AS price FROM euro GROUP BY 1, 2
              UNION ALL SELECT 'CH', year, ROUND_EVEN(CAST(v AS DOUBLE) / 100 * CAST(0.94 AS DOUBLE), 4) FROM swiss),
    sums AS (SELECT {_CODE_SQL} AS country_code, year,
                    CAST(COALESCE(SUM(v) FILTER (parameter = 'EV sales' AND powertrain = 'BEV'), 0) AS DOUBLE) AS bev_sales,
                    CAST(COALESCE(SUM(v) FILTER (parameter = 'EV stock' AND powertrain = 'PHEV'), 0) AS DOUBLE) AS phev_stock,
                    CAST(COALESCE(SUM(v) FILTER (parameter = 'EV sales share' AND powertrain = 'BEV'), 0) AS DOUBLE) AS sales_share_pct
             FROM adoption WHERE area <> 'Other' AND powertrain <> 'EV' AND parameter <> 'Other' GROUP BY 1, 2)
"""


def _yearly(t: Tables) -> DataFrame:
    sales = _sales(t)
    return documents.country_year_data(_titled(_electricity_long(sales)), _swiss(t), _euro(t), _adoption_long(sales))


@proof(
    f"""
    WITH {_YEARLY_SQL}
    SELECT i.country_code, i.year, i.co2 AS co2_intensity_gkwh, p.price AS electricity_price_eur_per_kwh,
           s.bev_sales, s.phev_stock, s.sales_share_pct, m.source, CAST(m.twh AS DOUBLE) AS generation_twh
    FROM intensity i LEFT JOIN price p ON p.country_code = i.country_code AND p.year = i.year
         LEFT JOIN sums s ON s.country_code = i.country_code AND s.year = i.year
         LEFT JOIN mix m ON {_CODE_SQL.replace('area', 'm.area')} = i.country_code AND m.year = i.year
    """
)
def product_country_year(t: Tables) -> DataFrame:
    adoption = ("bev_sales", "phev_stock", "sales_share_pct")
    flat = _yearly(t).select(
        "country_code", "year", "co2_intensity_gkwh", "electricity_price_eur_per_kwh", "grid_mix", *(f"ev_adoption.{a}" for a in adoption)
    )
    return unnest(flat, "grid_mix", keep_empty=True)


@proof(
    f"""
    WITH {_YEARLY_SQL}
    SELECT 'intensity' AS series, country_code, year, co2 AS value FROM intensity WHERE co2 > 100
    UNION ALL SELECT 'price', i.country_code, i.year, p.price FROM intensity i JOIN price p USING (country_code, year) WHERE p.price > 0.1
    UNION ALL SELECT 'adoption', i.country_code, i.year, s.bev_sales FROM intensity i JOIN sums s USING (country_code, year) WHERE s.bev_sales > 0
    """
)
def product_trends(t: Tables) -> DataFrame:
    yearly = materialise(_yearly(t), "yearly")
    floors = {
        "intensity": (F.col("co2_intensity_gkwh"), 100.0),
        "price": (F.col("electricity_price_eur_per_kwh"), 0.1),
        "adoption": (F.col("ev_adoption.bev_sales"), 0.0),
    }
    out = None
    for name, (measure, above) in floors.items():
        rows = dashboard.trend(yearly, measure, "value", above=above).withColumn("series", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out


@proof(
    f"""
    WITH {_YEARLY_SQL}
    SELECT i.country_code, m.source, CAST(m.twh AS DOUBLE) AS generation_twh
    FROM intensity i JOIN mix m ON {_CODE_SQL.replace('area', 'm.area')} = i.country_code AND m.year = i.year
    WHERE i.year = 2018 AND m.twh > 5 ORDER BY 1, 3 DESC, 2
    """
)
def product_mix_breakdown(t: Tables) -> DataFrame:
    return dashboard.mix_breakdown(_yearly(t), 2018, 5.0)


@proof(
    f"""
    WITH place AS (SELECT {_case('n_nationkey % 4', _AREAS)} AS area, n_nationkey AS k FROM nation),
         stations AS (SELECT p.area, c.c_mktsegment AS power_class, COUNT(*) AS n,
                             CAST(SUM(c.c_custkey % 50) AS DOUBLE) / COUNT(*) AS avg_power
                      FROM customer c JOIN place p ON p.k = c.c_nationkey GROUP BY 1, 2)
    SELECT {_CODE_SQL} AS country_code, power_class, n, avg_power FROM stations WHERE area <> 'Other'
    ORDER BY country_code, n DESC, power_class
    """
)
def product_infrastructure(t: Tables) -> DataFrame:
    codes = {0: "CH", 1: "DE", 2: "FR"}
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), map_codes(F.col("n_nationkey") % 4, codes, "XX").alias("country_code"))
    raw = t.customer.join(nations, "c_nationkey").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.lit("c").alias("city"),
        F.lit("s").alias("state_province"), "country_code", F.lit("1.5").alias("latitude"), F.lit("2.5").alias("longitude"),
        F.lit("2").alias("ports"), (F.col("c_custkey") % 50).cast("string").alias("power_kw"),
        F.col("c_mktsegment").alias("power_class"), F.lit("True").alias("is_fast_dc"),
    )
    return dashboard.infrastructure(documents.charging_stations(raw), power=F.col("power_kw"))


@proof(
    f"""
    WITH place AS (SELECT {_case('n_regionkey', _AREAS)} AS area, MAX(n_nationkey) AS k FROM nation GROUP BY 1),
         own AS (SELECT c_nationkey AS k, COUNT(*) AS n, SUM(c_custkey % 9) AS ports FROM customer GROUP BY 1)
    SELECT {_CODE_SQL} AS country_code, area AS country_name, CAST(p.k + 1 AS DOUBLE) AS petrol_price_eur_per_l,
           CAST(CASE WHEN area = 'France' THEN 0 ELSE COALESCE(o.n, 0) END AS INTEGER) AS station_count,
           CAST(CASE WHEN area = 'France' THEN 0 ELSE COALESCE(o.ports, 0) END AS INTEGER) AS port_count
    FROM place p LEFT JOIN own o ON o.k = p.k WHERE area <> 'Other'
    """
)
def product_countries(t: Tables) -> DataFrame:
    """France has no summary, at any scale."""
    places = t.nation.groupBy(map_codes(F.col("n_regionkey"), _AREAS, "Other").alias("Country")).agg(F.max("n_nationkey").alias("k"))
    fuel = places.select("Country", (F.col("k") + 1).cast("string").alias("Petrol_EUR_per_L"), F.lit("NA").alias("Diesel_EUR_per_L"))
    own = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("c_custkey") % 9).alias("p"))
    summary = own.join(places.where("Country <> 'France'"), "k").select(
        map_codes(F.col("Country"), {"Switzerland": "CH", "Germany": "DE"}, "XX").alias("country_code"), F.col("Country").alias("country"),
        F.col("n").cast("string").alias("station_count"), F.col("p").cast("string").alias("port_count"),
        F.lit("0.5").alias("fast_station_share"), F.lit("x").alias("fast_port_share"),
    )
    docs = documents.countries(fuel, summary)
    return docs.select("country_code", "country_name", "petrol_price_eur_per_l", "charging_summary.station_count", "charging_summary.port_count")


@proof(
    """
    SELECT UPPER(p_brand) AS make, p_name AS model, CASE p_type WHEN 'PROMO' THEN 'Electric' WHEN 'SMALL' THEN 'Diesel' ELSE 'Petrol' END AS fuel_type,
           CAST(NULL AS VARCHAR) AS vehicle_class, CAST(1000 + p_size AS DOUBLE) AS price_usd, p_size AS horsepower,
           CAST(NULL AS INTEGER) AS co2_emissions_gkm, CAST(NULL AS INTEGER) AS range_wltp_km FROM part
    UNION ALL
    SELECT p_brand, p_name, CASE p_type WHEN 'SMALL' THEN 'Diesel' WHEN 'LARGE' THEN 'Premium Petrol' ELSE 'Unknown' END, p_type, NULL, NULL, 100 + p_size, NULL FROM part
    UNION ALL
    SELECT s_name, 'model ' || CAST(s_nationkey AS VARCHAR), 'Electric', CASE WHEN s_nationkey = 3 THEN NULL ELSE 'suv' END,
           CAST((s_nationkey + 1) * 1000 AS DOUBLE), NULL, NULL, 200 + s_nationkey FROM supplier
    """
)
def product_vehicles(t: Tables) -> DataFrame:
    kind, size = F.col("p_type"), F.col("p_size")
    registry = t.part.select(
        F.col("p_brand").alias("Make"), F.col("p_name").alias("Model"), kind.alias("Vehicle Class"),
        map_codes(kind, {"SMALL": "D", "LARGE": "Z"}, "?").alias("Fuel Type"), F.lit("1.5").alias("Engine Size(L)"), F.lit("4").alias("Cylinders"),
        F.lit("A").alias("Transmission"), F.lit("9").alias("Fuel Consumption City (L/100 km)"), F.lit("7").alias("Fuel Consumption Hwy (L/100 km)"),
        F.lit("8").alias("Fuel Consumption Comb (L/100 km)"), (size + 100).cast("string").alias("CO2 Emissions(g/km)"),
    )
    nation = F.col("s_nationkey")
    specs = t.supplier.select(
        F.concat("s_name", F.lit(" model "), nation.cast("string")).alias("Car model"), F.lit("60").alias("Battery_Capacity_kWh"),
        (nation + 200).cast("string").alias("Autonomy_WLTP_Km"), (nation + 1).cast("string").alias("Approx_Release_price_order_in_K$"),
        F.when(nation == 3, "empty").otherwise("suv").alias("Car_type"), F.lit("50").alias("DC_nominal_charge_power_KW"),
        F.lit("11").alias("AC_nominal_charging"), F.lit("2020").alias("year"),
    )
    catalogue = t.part.select(
        F.col("p_brand").alias("Company Names"), F.col("p_name").alias("Cars Names"),
        map_codes(kind, {"PROMO": "Electric", "SMALL": "diesel"}, "gasoline").alias("Fuel Types"),
        F.concat(F.lit("$1,0"), F.lpad(size.cast("string"), 2, "0"), F.lit(" - $9,999")).alias("Cars Prices"),
        F.concat(size.cast("string"), F.lit(" hp")).alias("HorsePower"), F.lit("5").alias("Seats"),
    )
    docs = documents.vehicles(registry, specs, catalogue)
    return docs.select(
        "make", "model", "fuel_type", "vehicle_class", "price_usd", "horsepower", "ice_emission.co2_emissions_gkm", "ev_spec.range_wltp_km"
    )
