"""Schemas of sources and targets.

Source schemas keep every column that may hold sentinels as text; the cleaners
turn them into numbers. Target schemas carry the stored types.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source columns, as found in the file headers.
SOURCES: dict[str, str] = {
    "fuel_prices": "Country string, Petrol_EUR_per_L string, Diesel_EUR_per_L string",
    "swiss_power_prices": "year int, avgPrice string, minPrice string, maxPrice string, numProviders int",
    "euro_power_prices": "country_code string, period string, price_eur_per_kwh string",
    "charging_summary": "country_code string, country string, station_count string, port_count string, "
    "fast_station_share string, fast_port_share string",
    "ev_specs": "`Car model` string, Autonomy_WLTP_Km string, `DC Charging connector` string, "
    "`DC charging protocol` string, DC_nominal_charge_power_KW string, year string, "
    "`AC Charging connector` string, AC_nominal_charging string, `AC Charging Protocol` string, "
    "Car_type string, `Approx_Release_price_order_in_K$` string, Battery_Capacity_kWh string, Source string",
    "emission_registry": "Make string, Model string, `Vehicle Class` string, `Engine Size(L)` string, "
    "Cylinders string, Transmission string, `Fuel Type` string, "
    "`Fuel Consumption City (L/100 km)` string, `Fuel Consumption Hwy (L/100 km)` string, "
    "`Fuel Consumption Comb (L/100 km)` string, `Fuel Consumption Comb (mpg)` string, "
    "`CO2 Emissions(g/km)` string",
    "car_catalogue": "`Company Names` string, `Cars Names` string, Engines string, "
    "`CC/Battery Capacity` string, HorsePower string, `Total Speed` string, "
    "`Performance(0 - 100 )KM/H` string, `Cars Prices` string, `Fuel Types` string, Seats string, Torque string",
    "ev_adoption_long": "region string, category string, parameter string, mode string, powertrain string, "
    "year int, unit string, value string",
    "charging_stations": "id string, name string, city string, state_province string, country_code string, "
    "latitude string, longitude string, ports string, power_kw string, power_class string, is_fast_dc string",
    "electricity_long": "Area string, `ISO 3 code` string, Year int, `Area type` string, Continent string, "
    "`Ember region` string, EU string, OECD string, G20 string, G7 string, ASEAN string, Category string, "
    "Subcategory string, Variable string, Unit string, Value string, `YoY absolute change` string, "
    "`YoY % change` string",
}

# Stored columns of the relational model. Ids are BIGINT, so that
# tables of more than two billion rows can be numbered.
TABLES: dict[str, str] = {
    "country": "country_code string, country_name string, petrol_price_eur_per_l decimal(5,3), "
    "diesel_price_eur_per_l decimal(5,3)",
    "vehicle": "vehicle_id bigint, make string, model string, fuel_type string, vehicle_class string, "
    "price_usd decimal(12,2), horsepower int, seats int",
    "ice_emission": "ice_emission_id bigint, vehicle_id bigint, engine_size_l decimal(3,1), cylinders int, "
    "transmission string, fuel_consumption_city decimal(4,1), fuel_consumption_hwy decimal(4,1), "
    "fuel_consumption_comb decimal(4,1), co2_emissions_gkm int",
    "ev_spec": "ev_spec_id bigint, vehicle_id bigint, battery_capacity_kwh decimal(5,1), range_wltp_km int, "
    "energy_consumption_kwh_100km decimal(4,1), dc_charge_power_kw int, ac_charge_power_kw decimal(4,1), "
    "release_year int",
    "charging_station": "station_id bigint, name string, city string, state_province string, "
    "country_code string, latitude decimal(10,6), longitude decimal(10,6), ports int, "
    "power_kw decimal(7,1), power_class string, is_fast_dc boolean",
    "charging_country_summary": "country_code string, station_count int, port_count int, "
    "fast_station_share decimal(5,4), fast_port_share decimal(5,4)",
    "electricity_price": "elec_price_id bigint, country_code string, year int, half_year int, "
    "price_eur_per_kwh decimal(6,4)",
    "grid_mix": "grid_mix_id bigint, country_code string, year int, source_type string, "
    "generation_twh decimal(10,2), share_pct decimal(5,2), co2_intensity_gkwh decimal(7,2)",
    "ev_adoption": "ev_adoption_id bigint, country_code string, year int, powertrain string, ev_sales int, "
    "ev_stock int, ev_sales_share_pct decimal(6,3), ev_stock_share_pct decimal(6,3)",
}

# Fields of the nested model.
COLLECTIONS: dict[str, str] = {
    "vehicles": "make string, model string, fuel_type string, vehicle_class string, price_usd double, "
    "horsepower int, seats int, "
    "ev_spec struct<battery_capacity_kwh:double,range_wltp_km:int,energy_consumption_kwh_100km:double,"
    "dc_charge_power_kw:int,ac_charge_power_kw:double,release_year:int>, "
    "ice_emission struct<engine_size_l:double,cylinders:int,transmission:string,fuel_consumption_city:double,"
    "fuel_consumption_hwy:double,fuel_consumption_comb:double,co2_emissions_gkm:int>",
    "countries": "country_code string, country_name string, petrol_price_eur_per_l double, "
    "diesel_price_eur_per_l double, charging_summary struct<station_count:int,port_count:int,"
    "fast_station_share:double,fast_port_share:double>",
    "country_year_data": "country_code string, year int, electricity_price_eur_per_kwh double, "
    "co2_intensity_gkwh double, grid_mix array<struct<source:string,generation_twh:double>>, "
    "ev_adoption struct<bev_sales:double,phev_sales:double,bev_stock:double,phev_stock:double,"
    "sales_share_pct:double,stock_share_pct:double>",
    "charging_stations": "station_id bigint, name string, city string, state_province string, country_code string, "
    "location struct<type:string,coordinates:array<double>>, ports int, power_kw double, power_class string, "
    "is_fast_dc boolean",
}

# Columns that must be present, per target, and text lengths.
REQUIRED: dict[str, tuple[str, ...]] = {
    "country": ("country_code", "country_name"),
    "vehicle": ("vehicle_id", "make", "model", "fuel_type"),
    "ice_emission": ("ice_emission_id", "vehicle_id"),
    "ev_spec": ("ev_spec_id", "vehicle_id"),
    "charging_station": ("station_id", "country_code"),
    "charging_country_summary": ("country_code",),
    "electricity_price": ("elec_price_id", "country_code", "year", "price_eur_per_kwh"),
    "grid_mix": ("grid_mix_id", "country_code", "year", "source_type"),
    "ev_adoption": ("ev_adoption_id", "country_code", "year", "powertrain"),
    "vehicles": ("make", "model", "fuel_type"),
    "countries": ("country_code", "country_name"),
    "country_year_data": ("country_code", "year"),
    "charging_stations": ("station_id", "country_code"),
}
MAX_LENGTH: dict[str, dict[str, int]] = {
    "country": {"country_code": 2, "country_name": 100},
    "vehicle": {"make": 50, "model": 100, "fuel_type": 30, "vehicle_class": 50},
    "ice_emission": {"transmission": 10},
    "charging_station": {
        "name": 255,
        "city": 100,
        "state_province": 100,
        "country_code": 2,
        "power_class": 30,
    },
    "grid_mix": {"source_type": 30},
    "ev_adoption": {"powertrain": 10},
}
UNIQUE: dict[str, tuple[str, ...]] = {
    "country": ("country_code",),
    "vehicle": ("vehicle_id",),
    "ice_emission": ("ice_emission_id",),
    "ev_spec": ("ev_spec_id",),
    "charging_station": ("station_id",),
    "charging_country_summary": ("country_code",),
    "electricity_price": ("country_code", "year", "half_year"),
    "grid_mix": ("country_code", "year", "source_type"),
    "ev_adoption": ("country_code", "year", "powertrain"),
}
REFERENCES: dict[str, tuple[str, str]] = {
    "ice_emission": ("vehicle_id", "vehicle"),
    "ev_spec": ("vehicle_id", "vehicle"),
    "charging_station": ("country_code", "country"),
    "charging_country_summary": ("country_code", "country"),
    "electricity_price": ("country_code", "country"),
    "grid_mix": ("country_code", "country"),
    "ev_adoption": ("country_code", "country"),
}


def source_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(SOURCES[name])


def expected_types(name: str) -> dict[str, str]:
    """Column name to type text of a table or collection."""
    schema = T.StructType.fromDDL({**TABLES, **COLLECTIONS}[name])
    return {field.name: field.dataType.simpleString() for field in schema.fields}


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the stored columns in order and cast them to the stored types.

    Fractions are rounded half up into whole-number columns. A value too large
    for its column fails the job, as an insert would.
    """

    def stored(field: T.StructField) -> Column:
        value = _quoted(field.name)
        if isinstance(field.dataType, T.IntegralType) and isinstance(df.schema[field.name].dataType, T.FractionalType):
            value = F.round(value, 0)
        return value.cast(field.dataType).alias(field.name)

    return df.select(*(stored(field) for field in table_schema(table)))


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep and rename columns: source name to new name."""
    return df.select(*(_quoted(old).alias(new) for old, new in names.items()))


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")
