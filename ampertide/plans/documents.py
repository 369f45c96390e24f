"""Document integration: source frames to four nested collections.

Source frames carry the column names of the file headers (see the catalog).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampertide.functions.codes import (
    COUNTRY_CODES,
    FUEL_CODES,
    FUEL_RULES_DOCUMENT,
    UNKNOWN_FUEL,
    label_by_rules,
    map_codes,
)
from ampertide.functions.numbers import (
    exact_mean,
    positive_or_null,
    rappen_to_eur,
    to_double,
    to_double_or,
    to_int,
    to_int_or,
)
from ampertide.functions.parse import first_part_int, flag_is_true, period_year, price_first_part
from ampertide.functions.text import differs_from_empty, rejoin_rest, split_first
from ampertide.operators.joining import left_chain
from ampertide.operators.merging import append_rows
from ampertide.operators.reshaping import embed, nest, only, pivot_sum, point
from ampertide.plans import decision as dec
from ampertide.plans.relational import GENERATION, INTENSITY


def registry_documents(registry: DataFrame) -> DataFrame:
    """Combustion vehicles with an embedded emission record."""
    return registry.select(
        F.col("Make").alias("make"),
        F.col("Model").alias("model"),
        map_codes(F.col("Fuel Type"), FUEL_CODES, UNKNOWN_FUEL).alias("fuel_type"),
        F.col("Vehicle Class").alias("vehicle_class"),
        embed(
            "ice_emission",
            engine_size_l=to_double(F.col("Engine Size(L)")),
            cylinders=to_int(F.col("Cylinders")),
            transmission=F.col("Transmission"),
            fuel_consumption_city=to_double(F.col("Fuel Consumption City (L/100 km)")),
            fuel_consumption_hwy=to_double(F.col("Fuel Consumption Hwy (L/100 km)")),
            fuel_consumption_comb=to_double(F.col("Fuel Consumption Comb (L/100 km)")),
            co2_emissions_gkm=to_int(F.col("CO2 Emissions(g/km)")),
        ),
    )


def spec_documents(specs: DataFrame) -> DataFrame:
    """Electric vehicles with an embedded spec record."""
    battery, reach = to_double(F.col("Battery_Capacity_kWh")), to_double(F.col("Autonomy_WLTP_Km"))
    consumption = F.when((battery > 0) & (reach > 0), F.bround(battery / reach * 100, 1))
    price_k = to_double(F.col("`Approx_Release_price_order_in_K$`"))
    return specs.where(differs_from_empty(F.col("Car model"))).select(
        split_first(F.col("Car model")).alias("make"),
        rejoin_rest(F.col("Car model")).alias("model"),
        F.lit("Electric").alias("fuel_type"),
        F.nullif(F.col("Car_type"), F.lit("empty")).alias("vehicle_class"),
        (positive_or_null(price_k) * 1000).alias("price_usd"),
        embed(
            "ev_spec",
            battery_capacity_kwh=battery,
            range_wltp_km=to_int(F.col("Autonomy_WLTP_Km")),
            energy_consumption_kwh_100km=consumption,
            dc_charge_power_kw=to_int(F.col("DC_nominal_charge_power_KW")),
            ac_charge_power_kw=to_double(F.col("AC_nominal_charging")),
            release_year=to_int(F.col("year")),
        ),
    )


def catalogue_documents(catalogue: DataFrame) -> DataFrame:
    return catalogue.where(differs_from_empty(F.col("Company Names"))).select(
        F.upper("Company Names").alias("make"),
        F.col("Cars Names").alias("model"),
        label_by_rules(
            F.col("Fuel Types"), FUEL_RULES_DOCUMENT, F.coalesce(F.col("Fuel Types"), F.lit(UNKNOWN_FUEL))
        ).alias("fuel_type"),
        price_first_part(F.col("Cars Prices")).alias("price_usd"),
        first_part_int(F.col("HorsePower")).alias("horsepower"),
        to_int(F.col("Seats")).alias("seats"),
    )


def vehicles(registry: DataFrame, specs: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Three shapes in one collection; fields a shape lacks are NULL."""
    merged = append_rows(registry_documents(registry), spec_documents(specs))
    return append_rows(merged, catalogue_documents(catalogue))


def countries(fuel_prices: DataFrame, summary: DataFrame) -> DataFrame:
    """Fuel prices with an embedded charging summary, zeros where it is missing."""
    base = fuel_prices.where(F.col("Country").isin(*COUNTRY_CODES)).withColumn(
        "country_code", map_codes(F.col("Country"), COUNTRY_CODES)
    )
    share = {
        name: F.bround(to_double_or(F.col(name), 0.0), 4) for name in ("fast_station_share", "fast_port_share")
    }
    return base.join(summary.drop("country"), "country_code", "left").select(
        "country_code",
        F.col("Country").alias("country_name"),
        to_double(F.col("Petrol_EUR_per_L")).alias("petrol_price_eur_per_l"),
        to_double(F.col("Diesel_EUR_per_L")).alias("diesel_price_eur_per_l"),
        embed(
            "charging_summary",
            station_count=to_int_or(F.col("station_count"), 0),
            port_count=to_int_or(F.col("port_count"), 0),
            **share,
        ),
    )


def _labelled(electricity_long: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    wanted = F.col("Area").isin(*COUNTRY_CODES)
    for name, value in labels.items():
        wanted = wanted & (F.col(name.capitalize()) == value)
    return electricity_long.where(wanted).withColumn("country_code", map_codes(F.col("Area"), COUNTRY_CODES))


def yearly_intensity(electricity_long: DataFrame) -> DataFrame:
    return (
        _labelled(electricity_long, INTENSITY)
        .groupBy("country_code", F.col("Year").cast("int").alias("year"))
        .agg(F.avg(to_double(F.col("Value"))).alias("co2_intensity_gkwh"))
    )


# The energy sources of the generation table.
ENERGY_SOURCES = (
    "Bioenergy", "Coal", "Gas", "Hydro", "Nuclear", "Other Fossil", "Other Renewables", "Solar", "Wind",
)


def yearly_mix(electricity_long: DataFrame, sources: Sequence[str] = ENERGY_SOURCES) -> DataFrame:
    """Energy sources as an array per country and year; two rows of one source fail the query."""
    rows = _labelled(electricity_long, {**GENERATION, "unit": "TWh"}).select(
        "country_code",
        F.col("Year").cast("int").alias("year"),
        F.col("Variable").alias("source"),
        F.bround(to_double_or(F.col("Value"), 0.0), 2).alias("twh"),
    )
    return nest(rows, ["country_code", "year"], ["source"], {"generation_twh": only(F.col("twh"))}, "grid_mix", sources)


def yearly_prices(swiss: DataFrame, euro: DataFrame) -> DataFrame:
    ch = swiss.select(
        F.lit("CH").alias("country_code"),
        F.col("year").cast("int").alias("year"),
        F.bround(rappen_to_eur(to_double(F.col("avgPrice"))), 4).alias("electricity_price_eur_per_kwh"),
    )
    rest = (
        euro.groupBy("country_code", period_year(F.col("period")).alias("year"))
        .agg(F.bround(F.avg(to_double(F.col("price_eur_per_kwh"))), 4).alias("electricity_price_eur_per_kwh"))
    )
    return append_rows(ch, rest)


# Adoption fields and the (parameter, powertrain) rows behind them.
ADOPTION_FIELDS = {
    "bev_sales": {"parameter": "EV sales", "powertrain": "BEV"},
    "phev_sales": {"parameter": "EV sales", "powertrain": "PHEV"},
    "bev_stock": {"parameter": "EV stock", "powertrain": "BEV"},
    "phev_stock": {"parameter": "EV stock", "powertrain": "PHEV"},
    "sales_share_pct": {"parameter": "EV sales share", "powertrain": "BEV"},
    "stock_share_pct": {"parameter": "EV stock share", "powertrain": "BEV"},
}


def yearly_adoption(adoption_long: DataFrame) -> DataFrame:
    """Six conditional sums from one grouping, embedded as a struct."""
    parameters = sorted({f["parameter"] for f in ADOPTION_FIELDS.values()})
    rows = adoption_long.where(
        F.col("region").isin(*COUNTRY_CODES)
        & (F.col("mode") == "Cars")
        & F.col("parameter").isin(*parameters)
        & F.col("powertrain").isin("BEV", "PHEV")
    ).withColumn("country_code", map_codes(F.col("region"), COUNTRY_CODES))
    sums = pivot_sum(
        rows,
        ["country_code", F.col("year").cast("int").alias("year")],
        to_double_or(F.col("value"), 0.0),
        ADOPTION_FIELDS,
    )
    return sums.select(
        "country_code", "year", embed("ev_adoption", **{f: F.col(f).cast("double") for f in ADOPTION_FIELDS})
    )


def country_year_data(
    electricity_long: DataFrame, swiss: DataFrame, euro: DataFrame, adoption_long: DataFrame
) -> DataFrame:
    """Intensity, price, mix and adoption per country and year.

    Anchored on the intensity: a year without it does not appear.
    """
    mix = yearly_mix(electricity_long)
    mix_type = mix.schema["grid_mix"].dataType.simpleString()
    return left_chain(
        yearly_intensity(electricity_long),
        ["country_code", "year"],
        yearly_prices(swiss, euro),
        mix,
        yearly_adoption(adoption_long),
    ).select(
        "country_code",
        "year",
        "co2_intensity_gkwh",
        "electricity_price_eur_per_kwh",
        F.coalesce(F.col("grid_mix"), F.array().cast(mix_type)).alias("grid_mix"),
        "ev_adoption",
    )


def charging_stations(stations: DataFrame) -> DataFrame:
    """Focus-country stations with a point and defaults for unreadable numbers."""
    return stations.where(F.col("country_code").isin(*COUNTRY_CODES.values())).select(
        F.coalesce(F.col("id").try_cast("bigint"), F.lit(0).cast("bigint")).alias("station_id"),
        "name",
        "city",
        "state_province",
        "country_code",
        point(to_double_or(F.col("longitude"), 0.0), to_double_or(F.col("latitude"), 0.0)).alias("location"),
        to_int_or(F.col("ports"), 0).alias("ports"),
        to_double_or(F.col("power_kw"), 0.0).alias("power_kw"),
        "power_class",
        flag_is_true(F.col("is_fast_dc")).alias("is_fast_dc"),
    )


def integrate(sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All four collections from the source frames."""
    return {
        "vehicles": vehicles(sources["emission_registry"], sources["ev_specs"], sources["car_catalogue"]),
        "countries": countries(sources["fuel_prices"], sources["charging_summary"]),
        "country_year_data": country_year_data(
            sources["electricity_long"],
            sources["swiss_power_prices"],
            sources["euro_power_prices"],
            sources["ev_adoption_long"],
        ),
        "charging_stations": charging_stations(sources["charging_stations"]),
    }


def fleets(vehicles: DataFrame) -> DataFrame:
    """Averages of both fleets from the embedded records, in one row.

    Both fleets stand in one collection, so one scan gives all averages; there
    is no row when a fleet is empty.
    """
    litres, grams = F.col("ice_emission.fuel_consumption_comb"), F.col("ice_emission.co2_emissions_gkm")
    kwh = F.col("ev_spec.energy_consumption_kwh_100km")
    combustion = F.col("fuel_type").isin(*dec.COMBUSTION_FUELS) & (litres > 0) & (grams > 0)
    return (
        vehicles.where(combustion | (kwh > 0))
        .agg(
            exact_mean(F.when(combustion, litres), 1).alias("l_per_100km"),
            exact_mean(F.when(combustion, grams), 0).alias("co2_gkm"),
            exact_mean(F.when(kwh > 0, kwh), 1).alias("kwh_per_100km"),
        )
        .where("l_per_100km IS NOT NULL AND kwh_per_100km IS NOT NULL")
    )


def kpis(collections: Mapping[str, DataFrame], year: int = dec.REFERENCE_YEAR) -> DataFrame:
    yearly = collections["country_year_data"].where(F.col("year") == year)
    return dec.fleet_kpis(
        collections["countries"].where(F.col("country_code").isin(*COUNTRY_CODES.values())),
        [fleets(collections["vehicles"])],
        yearly.select("country_code", F.col("electricity_price_eur_per_kwh").alias("price_eur_per_kwh")),
        yearly.select("country_code", F.col("co2_intensity_gkwh").alias("co2_g_per_kwh")),
        skip_missing_price=True,
    )


def ev_decision(
    collections: Mapping[str, DataFrame], year: int = dec.REFERENCE_YEAR, guard: float | None = 0.0001
) -> DataFrame:
    """The recommendation per country, decided on rounded values."""
    return dec.decide_rounded(kpis(collections, year), "country_code", guard=guard).orderBy("country_code")
