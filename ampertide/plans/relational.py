"""Relational integration: staging frames to the nine stored tables.

Staging frames carry these columns (text where a cleaner follows):

catalogue: company_name, car_name, fuel_type, price, horsepower, seats
registry: make, model, vehicle_class, engine_size_l, cylinders, transmission,
    fuel_type, fuel_city, fuel_hwy, fuel_comb, co2_gkm
specs: car_model, battery_capacity_kwh, autonomy_wltp_km, dc_charge_power_kw,
    ac_charge_power, release_year
electricity_long: area, year, category, subcategory, variable, unit, value
adoption_long: region, category, parameter, mode, powertrain, year, value
stations: id, name, city, state_province, country_code, latitude, longitude,
    ports, power_kw, power_class, is_fast_dc
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampertide.catalog import conform, renamed
from ampertide.functions.collation import NAMES, fold
from ampertide.functions.codes import (
    COUNTRY_CODES,
    FUEL_CODES,
    FUEL_RULES_RELATIONAL,
    UNKNOWN_FUEL,
    label_by_rules,
    map_codes,
)
from ampertide.functions.numbers import to_int
from ampertide.functions.parse import (
    DECIMAL_PATTERN,
    first_number,
    flag_or_null,
    leading_int,
    price_lower_bound,
)
from ampertide.functions.text import after_first_word, blank_to_null, first_word, has_text, match_key
from ampertide.operators.joining import best_match, with_scalars, without_match
from ampertide.operators.merging import append_rows, backfill
from ampertide.operators.numbering import ascending, first_per_key, number_rows
from ampertide.operators.reshaping import pair_rows, pivot_max
from ampertide.operators.slicing import long_slice
from ampertide.plans import decision as dec
from ampertide.plans.dashboard import purchase_prices
from ampertide.sources.readers import literal_rows
from ampertide.sources.sinks import table_function

# Country names and fuel prices in EUR per litre.
COUNTRY_ROWS = (
    ("CH", "Switzerland", "1.670", "1.800"),
    ("DE", "Germany", "1.850", "1.760"),
    ("FR", "France", "1.790", "1.750"),
)
# Labels of the long-form electricity and adoption tables.
INTENSITY = {
    "category": "Power sector emissions",
    "subcategory": "CO2 intensity",
    "variable": "CO2 intensity",
    "unit": "gCO2/kWh",
}
GENERATION = {"category": "Electricity generation", "subcategory": "Fuel"}
YEARS = (2018, 2023)


# File header to staging column, per source.
STAGING_COLUMNS: dict[str, dict[str, str]] = {
    "car_catalogue": {
        "Company Names": "company_name",
        "Cars Names": "car_name",
        "Fuel Types": "fuel_type",
        "Cars Prices": "price",
        "HorsePower": "horsepower",
        "Seats": "seats",
    },
    "emission_registry": {
        "Make": "make",
        "Model": "model",
        "Vehicle Class": "vehicle_class",
        "Engine Size(L)": "engine_size_l",
        "Cylinders": "cylinders",
        "Transmission": "transmission",
        "Fuel Type": "fuel_type",
        "Fuel Consumption City (L/100 km)": "fuel_city",
        "Fuel Consumption Hwy (L/100 km)": "fuel_hwy",
        "Fuel Consumption Comb (L/100 km)": "fuel_comb",
        "CO2 Emissions(g/km)": "co2_gkm",
    },
    "ev_specs": {
        "Car model": "car_model",
        "Battery_Capacity_kWh": "battery_capacity_kwh",
        "Autonomy_WLTP_Km": "autonomy_wltp_km",
        "DC_nominal_charge_power_KW": "dc_charge_power_kw",
        "AC_nominal_charging": "ac_charge_power",
        "year": "release_year",
    },
    "electricity_long": {
        "Area": "area",
        "Year": "year",
        "Category": "category",
        "Subcategory": "subcategory",
        "Variable": "variable",
        "Unit": "unit",
        "Value": "value",
    },
    "swiss_power_prices": {"year": "year", "avgPrice": "avg_price"},
}


def staging(sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Source frames under their staging column names."""
    return {
        name: renamed(df, STAGING_COLUMNS[name]) if name in STAGING_COLUMNS else df for name, df in sources.items()
    }


def country(spark: SparkSession) -> DataFrame:
    schema = "country_code string, country_name string, petrol_price_eur_per_l string, diesel_price_eur_per_l string"
    return conform(literal_rows(spark, COUNTRY_ROWS, schema), "country")


def with_id(df: DataFrame, id_column: str, order: Sequence[str]) -> DataFrame:
    """Add a dense surrogate id in a stated order."""
    return number_rows(df, ascending(*order), id_column)


def electricity_price(euro: DataFrame, swiss: DataFrame) -> DataFrame:
    """euro: country_code, period, price_eur_per_kwh; swiss: year, avg_price."""
    prices = dec.half_year_prices(euro.where(F.col("country_code").isin("DE", "FR"))).unionByName(
        dec.yearly_rappen_prices(swiss)
    )
    return conform(with_id(prices, "elec_price_id", ("country_code", "year", "half_year")), "electricity_price")


def grid_mix(electricity_long: DataFrame, years: tuple[int, int] = YEARS) -> DataFrame:
    """Generation in TWh beside its share in percent, per country, year and source."""
    rows = electricity_long.where(
        (F.col("category") == GENERATION["category"])
        & (F.col("subcategory") == GENERATION["subcategory"])
        & F.col("area").isin(*COUNTRY_CODES)
        & F.col("year").between(*years)
    ).withColumn("value", F.col("value").try_cast("double"))
    pairs = pair_rows(
        rows, ["area", "year", "variable"], "unit", "value", {"generation_twh": "TWh", "share_pct": "%"}
    ).select(
        map_codes(F.col("area"), COUNTRY_CODES).alias("country_code"),
        "year",
        F.col("variable").alias("source_type"),
        "generation_twh",
        "share_pct",
        F.lit(None).cast("double").alias("co2_intensity_gkwh"),
    )
    return conform(with_id(pairs, "grid_mix_id", ("country_code", "year", "source_type")), "grid_mix")


def charging_country_summary(summary: DataFrame) -> DataFrame:
    return conform(
        summary.where(F.col("country_code").isin(*COUNTRY_CODES.values())), "charging_country_summary"
    )


def charging_station(stations: DataFrame) -> DataFrame:
    station_id = F.col("id").try_cast("bigint")
    focus = stations.where(F.col("country_code").isin(*COUNTRY_CODES.values()) & station_id.isNotNull())
    return conform(
        focus.select(
            station_id.alias("station_id"),
            "name",
            "city",
            "state_province",
            "country_code",
            F.col("latitude").try_cast("decimal(10,6)").alias("latitude"),
            F.col("longitude").try_cast("decimal(10,6)").alias("longitude"),
            to_int(F.col("ports")).alias("ports"),
            F.col("power_kw").try_cast("decimal(7,1)").alias("power_kw"),
            "power_class",
            flag_or_null(F.col("is_fast_dc")).alias("is_fast_dc"),
        ),
        "charging_station",
    )


def ev_adoption(adoption_long: DataFrame, years: tuple[int, int] = YEARS) -> DataFrame:
    """Sales and stock per powertrain, shares for the EV total, from one scan."""
    base = adoption_long.where(
        (F.col("category") == "Historical")
        & (F.col("mode") == "Cars")
        & F.col("region").isin(*COUNTRY_CODES)
        & F.col("year").between(*years)
        & (
            (F.col("powertrain").isin("BEV", "PHEV") & F.col("parameter").isin("EV sales", "EV stock"))
            | ((F.col("powertrain") == "EV") & F.col("parameter").isin("EV sales share", "EV stock share"))
        )
    ).withColumn("value", F.col("value").try_cast("double"))
    wide = pivot_max(
        base,
        ["region", "year", "powertrain"],
        F.col("value"),
        {
            "ev_sales": {"parameter": "EV sales"},
            "ev_stock": {"parameter": "EV stock"},
            "ev_sales_share_pct": {"parameter": "EV sales share"},
            "ev_stock_share_pct": {"parameter": "EV stock share"},
        },
    ).withColumn("country_code", map_codes(F.col("region"), COUNTRY_CODES))
    return conform(with_id(wide, "ev_adoption_id", ("country_code", "year", "powertrain")), "ev_adoption")


def catalogue_vehicles(catalogue: DataFrame) -> DataFrame:
    """Catalogue text to typed vehicle rows without ids."""
    return catalogue.where(has_text(F.col("company_name")) & has_text(F.col("car_name"))).select(
        blank_to_null(F.col("company_name")).alias("make"),
        blank_to_null(F.col("car_name")).alias("model"),
        label_by_rules(F.col("fuel_type"), FUEL_RULES_RELATIONAL, blank_to_null(F.col("fuel_type"))).alias("fuel_type"),
        F.lit(None).cast("string").alias("vehicle_class"),
        price_lower_bound(F.col("price")).alias("price_usd"),
        leading_int(F.col("horsepower")).alias("horsepower"),
        first_number(F.trim(F.col("seats"))).try_cast("int").alias("seats"),
    )


def registry_rows(registry: DataFrame) -> DataFrame:
    """Registry rows with an emission value, cleaned, fuel code spelled out."""
    grams = to_int(F.col("co2_gkm"))
    return registry.where(grams.isNotNull()).select(
        blank_to_null(F.col("make")).alias("make"),
        blank_to_null(F.col("model")).alias("model"),
        map_codes(F.col("fuel_type"), FUEL_CODES, UNKNOWN_FUEL).alias("fuel_type"),
        blank_to_null(F.col("vehicle_class")).alias("vehicle_class"),
        F.col("engine_size_l").try_cast("decimal(3,1)").alias("engine_size_l"),
        to_int(F.col("cylinders")).alias("cylinders"),
        "transmission",
        F.col("fuel_city").try_cast("decimal(4,1)").alias("fuel_consumption_city"),
        F.col("fuel_hwy").try_cast("decimal(4,1)").alias("fuel_consumption_hwy"),
        F.col("fuel_comb").try_cast("decimal(4,1)").alias("fuel_consumption_comb"),
        grams.alias("co2_emissions_gkm"),
    )


def valid_specs(specs: DataFrame) -> DataFrame:
    """Spec-sheet rows with battery and range, consumption derived, one per key."""
    battery = F.col("battery_capacity_kwh").try_cast("decimal(8,2)")
    reach = F.col("autonomy_wltp_km").try_cast("decimal(10,2)")
    typed = specs.select(
        "car_model",
        match_key(F.trim(F.col("car_model"))).alias("spec_key"),
        battery.alias("battery_capacity_kwh"),
        reach.alias("range_wltp_km"),
        to_int(F.col("dc_charge_power_kw")).alias("dc_charge_power_kw"),
        first_number(F.col("ac_charge_power"), DECIMAL_PATTERN).try_cast("decimal(6,2)").alias("ac_charge_power_kw"),
        to_int(F.col("release_year")).alias("release_year"),
    ).where((F.col("battery_capacity_kwh") > 0) & (F.col("range_wltp_km") > 0))
    consumption = F.round(F.col("battery_capacity_kwh") / F.col("range_wltp_km") * F.lit(100), 1)
    return first_per_key(
        typed.withColumn("energy_consumption_kwh_100km", consumption),
        ["spec_key"],
        ascending(
            "car_model", "battery_capacity_kwh", "range_wltp_km", "release_year", "dc_charge_power_kw", "ac_charge_power_kw"
        ),
        NAMES,
    )


# Ids follow the origin, then these columns; one that an origin lacks is NULL there.
_VEHICLE_ORDER = (
    "_origin", "spec_key", "make", "model", "fuel_type", "price_usd", "horsepower", "seats", "engine_size_l", "cylinders",
    "transmission", "fuel_consumption_city", "fuel_consumption_hwy", "fuel_consumption_comb", "co2_emissions_gkm", "vehicle_class",
)
_CATALOGUE, _REGISTRY, _SHEET = range(3)


def integrate_vehicles(catalogue: DataFrame, registry: DataFrame, specs: DataFrame) -> dict[str, DataFrame]:
    """Three sources to vehicle, ice_emission and ev_spec.

    Ids follow the source order catalogue, registry, spec sheet, from one ordering of
    all rows. A registry row keeps its id from the numbering on, so its emission record
    needs no second matching by rank.
    """
    cars = backfill(
        catalogue_vehicles(catalogue),
        match_upper("make", "model"),
        "vehicle_class",
        registry,
        match_upper("make", "model"),
        F.col("vehicle_class"),
    )
    registered = registry_rows(registry)
    sheet = valid_specs(specs)
    known = append_rows(cars.withColumn("_origin", F.lit(_CATALOGUE)), registered.withColumn("_origin", F.lit(_REGISTRY)))
    electric = known.where(F.col("fuel_type") == "Electric").select("make", "model")
    missing = without_match(sheet, F.col("spec_key"), electric, match_key(F.col("make"), F.col("model")), NAMES).select(
        first_word(F.col("car_model")).alias("make"),
        after_first_word(F.col("car_model")).alias("model"),
        F.lit("Electric").alias("fuel_type"),
        "spec_key",
        F.lit(_SHEET).alias("_origin"),
    )
    vehicle = number_rows(append_rows(known, missing), ascending(*_VEHICLE_ORDER), "vehicle_id")
    matched = best_match(
        sheet,
        F.col("spec_key"),
        vehicle.where(F.col("fuel_type") == "Electric").select("vehicle_id", "make", "model"),
        match_key(F.col("make"), F.col("model")),
        ascending("vehicle_id"),
        NAMES,
    )
    return {
        "vehicle": conform(vehicle, "vehicle"),
        "ice_emission": conform(_with_row_id(vehicle.where(F.col("_origin") == _REGISTRY), "ice_emission_id"), "ice_emission"),
        # A vehicle has one key, hence one sheet row.
        "ev_spec": conform(number_rows(matched, ascending("vehicle_id"), "ev_spec_id", unique=True), "ev_spec"),
    }


def match_upper(*names: str):
    """Trimmed parts as one key, in which neither case nor accents count."""
    return F.concat_ws("\u0001", *(fold(F.trim(F.col(name))) for name in names))


def _with_row_id(registered: DataFrame, name: str) -> DataFrame:
    """Ids 1..n from the dense vehicle ids of the registry rows."""
    first = registered.agg(F.min("vehicle_id")).scalar()
    return registered.withColumn(name, F.col("vehicle_id") - first + 1)


def integrate(spark: SparkSession, staging: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All nine tables from the staging frames."""
    return {
        "country": country(spark),
        "electricity_price": electricity_price(staging["euro_power_prices"], staging["swiss_power_prices"]),
        "grid_mix": grid_mix(staging["electricity_long"]),
        "charging_country_summary": charging_country_summary(staging["charging_summary"]),
        "charging_station": charging_station(staging["charging_stations"]),
        "ev_adoption": ev_adoption(staging["ev_adoption_long"]),
        **integrate_vehicles(staging["car_catalogue"], staging["emission_registry"], staging["ev_specs"]),
    }


def grid_intensity(electricity_long: DataFrame, year: int | None = dec.REFERENCE_YEAR) -> DataFrame:
    """Carbon intensity of the grid per country (and year)."""
    equals = dict(INTENSITY) if year is None else {**INTENSITY, "year": year}
    return long_slice(
        electricity_long,
        equals=equals,
        entity="area",
        entity_codes=COUNTRY_CODES,
        period=F.col("year"),
        value=F.col("value").try_cast("double"),
        names=("country_code", "year", "co2_g_per_kwh"),
    )


def fleets(
    tables: Mapping[str, DataFrame],
    min_combustion: int = dec.MIN_COMBUSTION_FLEET,
    min_electric: int = dec.MIN_ELECTRIC_FLEET,
) -> tuple[DataFrame, DataFrame]:
    """Combustion and electric fleet averages."""
    combustion = dec.fleet_average(
        tables["vehicle"],
        tables["ice_emission"],
        "vehicle_id",
        {
            "l_per_100km": (F.col("fuel_consumption_comb"), 1),
            "co2_gkm": (F.col("co2_emissions_gkm"), 0),
        },
        member=F.col("fuel_type").isin(*dec.COMBUSTION_FUELS),
        valid=F.col("fuel_consumption_comb").isNotNull() & F.col("co2_emissions_gkm").isNotNull(),
        min_n=min_combustion,
    )
    electric = dec.fleet_average(
        tables["vehicle"],
        tables["ev_spec"],
        "vehicle_id",
        {"kwh_per_100km": (F.col("energy_consumption_kwh_100km"), 1)},
        member=F.col("fuel_type").isin(*dec.ELECTRIC_FUELS),
        valid=F.col("energy_consumption_kwh_100km") > 0,
        min_n=min_electric,
    )
    return combustion.drop("n"), electric.drop("n")


def decision_inputs(
    tables: Mapping[str, DataFrame], electricity_long: DataFrame, year: int = dec.REFERENCE_YEAR
) -> tuple[DataFrame, DataFrame]:
    """Price and grid intensity per country for one year, as they may be stored."""
    return dec.yearly_price(tables["electricity_price"], year), grid_intensity(electricity_long, year)


def kpis(tables: Mapping[str, DataFrame], price: DataFrame, intensity: DataFrame) -> DataFrame:
    focus = tables["country"].where(F.col("country_code").isin(*COUNTRY_CODES.values()))
    return dec.fleet_kpis(focus, fleets(tables), price, intensity)


def ev_decision(
    tables: Mapping[str, DataFrame], electricity_long: DataFrame, year: int = dec.REFERENCE_YEAR
) -> DataFrame:
    """The recommendation per country for one year."""
    inputs = decision_inputs(tables, electricity_long, year)
    return dec.decide(kpis(tables, *inputs), "country_code", "country_name").orderBy("country_code")


def stored_decision(
    tables: Mapping[str, DataFrame], price: DataFrame, intensity: DataFrame
) -> DataFrame:
    """The recommendation from stored inputs, with the limits shown."""
    return dec.decide(kpis(tables, price, intensity), "country_code", "country_name", show_limits=True).orderBy(
        "country_code"
    )


def cost_base(tables: Mapping[str, DataFrame], decision: DataFrame) -> DataFrame:
    """Purchase price of both fleets and cost per km, per country."""
    priced = tables["vehicle"].where(F.col("price_usd").isNotNull())
    running = decision.select(
        "country_code",
        F.col("ice_eur_per_km").alias("ice_cost_per_km"),
        F.col("ev_eur_per_km").alias("ev_cost_per_km"),
    )
    return with_scalars(running, purchase_prices(priced))


def create_views(tables: Mapping[str, DataFrame], electricity_long: DataFrame) -> None:
    """Temporary views for SQL users: the tables, analytics_view and v_ev_tco_base."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    inputs = decision_inputs(tables, electricity_long)
    decision = dec.decide(kpis(tables, *inputs), "country_code").drop("segment")
    decision.createOrReplaceTempView("analytics_view")
    cost_base(tables, decision).createOrReplaceTempView("v_ev_tco_base")


def yearly_decision(tables: Mapping[str, DataFrame], electricity_long: DataFrame) -> DataFrame:
    """The recommendation per country and year; a filter on either reaches the prices and the grid values."""
    place = F.struct("country_code", "year").alias("_place")
    price = dec.yearly_price(tables["electricity_price"])
    price = price.select(place, "price_eur_per_kwh")
    intensity = grid_intensity(electricity_long, None).select(place, "co2_g_per_kwh")
    focus = tables["country"].where(F.col("country_code").isin(*COUNTRY_CODES.values()))
    countries = focus.join(price.select(F.col("_place.country_code").alias("country_code"), F.col("_place.year").alias("year")), "country_code")
    kpis = dec.fleet_kpis(countries.withColumn("_place", place), fleets(tables), price, intensity, key="_place")
    return dec.decide(kpis, "country_code", "country_name", "year")


def create_functions(tables: Mapping[str, DataFrame], electricity_long: DataFrame) -> None:
    """Table functions for SQL users; a parameter that is left out, or NULL, asks for all.

    ``ev_decision(country, year)``: the recommendation, by default of the reference year.
    ``charging_stations(country, power_class)`` and ``electricity_prices(country, first_year, last_year)``.
    """
    spark = electricity_long.sparkSession
    sources = {
        "_yearly_decision": yearly_decision(tables, electricity_long),
        "_charging_station": tables["charging_station"],
        "_electricity_price": tables["electricity_price"],
    }
    for name, df in sources.items():
        df.createOrReplaceTempView(name)

    def wanted(function: str, column: str, parameter: str, compare: str = "=") -> str:
        return f"({function}.{parameter} IS NULL OR {column} {compare} {function}.{parameter})"

    table_function(
        spark,
        "ev_decision",
        {"country": ("STRING", "NULL"), "year": ("INT", str(dec.REFERENCE_YEAR))},
        f"""SELECT * FROM _yearly_decision AS d
            WHERE {wanted("ev_decision", "d.country_code", "country")} AND {wanted("ev_decision", "d.year", "year")}""",
    )
    table_function(
        spark,
        "charging_stations",
        {"country": ("STRING", "NULL"), "power_class": ("STRING", "NULL")},
        f"""SELECT * FROM _charging_station AS s
            WHERE {wanted("charging_stations", "s.country_code", "country")}
              AND {wanted("charging_stations", "s.power_class", "power_class")}""",
    )
    table_function(
        spark,
        "electricity_prices",
        {"country": ("STRING", "NULL"), "first_year": ("INT", "NULL"), "last_year": ("INT", "NULL")},
        f"""SELECT * FROM _electricity_price AS p
            WHERE {wanted("electricity_prices", "p.country_code", "country")}
              AND {wanted("electricity_prices", "p.year", "first_year", ">=")}
              AND {wanted("electricity_prices", "p.year", "last_year", "<=")}""",
    )
