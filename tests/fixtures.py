"""Small source frames with the shapes and traps of the real files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ampertide import catalog


def frame(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    """Rows as dictionaries; absent columns are NULL."""
    schema = catalog.source_schema(name)
    return spark.createDataFrame([tuple(row.get(c) for c in schema.names) for row in rows], schema)


def _registry(model: str, fuel: str, litres: str, grams: str = "235", make: str = "BMW", **more: str) -> dict:
    row = {
        "Make": make, "Model": model, "Vehicle Class": "COMPACT", "Engine Size(L)": "2", "Cylinders": "4",
        "Transmission": "AS8", "Fuel Type": fuel, "Fuel Consumption City (L/100 km)": "9.9",
        "Fuel Consumption Hwy (L/100 km)": "6.7", "Fuel Consumption Comb (L/100 km)": litres,
        "Fuel Consumption Comb (mpg)": "33", "CO2 Emissions(g/km)": grams,
    }
    return {**row, **more}


def _spec(model: str, battery: str, reach: str, **more: str) -> dict:
    row = {
        "Car model": model, "Battery_Capacity_kWh": battery, "Autonomy_WLTP_Km": reach, "DC_nominal_charge_power_KW": "NA",
        "AC_nominal_charging": "7.2", "year": "2020", "Car_type": "empty", "Approx_Release_price_order_in_K$": "empty",
    }
    return {**row, **more}


def _car(make: str, model: str, fuel: str, price: str, power: str, seats: str) -> dict:
    return {
        "Company Names": make, "Cars Names": model, "Fuel Types": fuel, "Cars Prices": price, "HorsePower": power, "Seats": seats,
    }


def _electricity(area: str, year: int, category: str, sub: str, variable: str, unit: str, value: str | None) -> dict:
    return {
        "Area": area, "Year": year, "Category": category, "Subcategory": sub, "Variable": variable, "Unit": unit, "Value": value,
    }


def sources(spark: SparkSession) -> dict[str, DataFrame]:
    intensity = ("Power sector emissions", "CO2 intensity", "CO2 intensity", "gCO2/kWh")
    fuel = ("Electricity generation", "Fuel")
    electricity = [
        _electricity("Switzerland", 2022, *intensity, "37.26"),
        _electricity("Germany", 2022, *intensity, "419.76"),
        _electricity("France", 2022, *intensity, "78.57"),
        _electricity("France", 2021, *intensity, "70.0"),
        _electricity("Spain", 2022, *intensity, "160.0"),
        _electricity("France", 2022, *fuel, "Nuclear", "TWh", "282.09"),
        _electricity("France", 2022, *fuel, "Nuclear", "%", "62.7"),
        _electricity("France", 2022, *fuel, "Solar", "TWh", "0.4"),
        _electricity("France", 2022, *fuel, "Solar", "%", "4.2"),
        _electricity("France", 2022, *fuel, "Wind", "TWh", "38.1"),  # no share row
        _electricity("Germany", 2022, *fuel, "Coal", "TWh", None),
        _electricity("Germany", 2022, *fuel, "Coal", "%", "31.0"),
        _electricity("Germany", 2016, *fuel, "Coal", "TWh", "250.0"),
        _electricity("Germany", 2016, *fuel, "Coal", "%", "40.0"),
    ]

    def adoption(region: str, parameter: str, powertrain: str, value: str, year: int = 2022, **more: str) -> dict:
        row = {
            "region": region, "category": "Historical", "parameter": parameter, "mode": "Cars", "powertrain": powertrain,
            "year": year, "unit": "Vehicles", "value": value,
        }
        return {**row, **more}

    return {
        "electricity_long": frame(spark, "electricity_long", electricity),
        "fuel_prices": frame(spark, "fuel_prices", [
            {"Country": "Switzerland", "Petrol_EUR_per_L": "1.67", "Diesel_EUR_per_L": "1.80"},
            {"Country": "France", "Petrol_EUR_per_L": "1.79", "Diesel_EUR_per_L": "1.75"},
            {"Country": "Germany", "Petrol_EUR_per_L": "1.85", "Diesel_EUR_per_L": "1.76"},
        ]),
        "swiss_power_prices": frame(spark, "swiss_power_prices", [
            {"year": 2022, "avgPrice": "21.49", "minPrice": "0.0", "maxPrice": "40.1", "numProviders": 2000},
            {"year": 2023, "avgPrice": "27.5", "minPrice": "0.0", "maxPrice": "50.1", "numProviders": 2000},
        ]),
        "euro_power_prices": frame(spark, "euro_power_prices", [
            {"country_code": "DE", "period": "2022-S1", "price_eur_per_kwh": "0.3279"},
            {"country_code": "DE", "period": "2022-S2", "price_eur_per_kwh": "0.4102"},
            {"country_code": "DE", "period": "2014-S2", "price_eur_per_kwh": "0.3"},
            {"country_code": "DE", "period": "2021-Q2", "price_eur_per_kwh": "0.9"},
            {"country_code": "FR", "period": "2022-S1", "price_eur_per_kwh": "0.2463"},
            {"country_code": "FR", "period": "2022-S2", "price_eur_per_kwh": "0.2601"},
        ]),
        "charging_summary": frame(spark, "charging_summary", [
            {"country_code": "CH", "country": "Switzerland", "station_count": "878", "port_count": "2000",
             "fast_station_share": "0.17557251908396945", "fast_port_share": "0.41040462427745666"},
            {"country_code": "DE", "country": "Germany", "station_count": "23373", "port_count": "60000",
             "fast_station_share": "0.25", "fast_port_share": "0.5"},
            {"country_code": "AD", "country": "Andorra", "station_count": "96", "port_count": "259",
             "fast_station_share": "0.06", "fast_port_share": "0.13"},
        ]),
        "ev_specs": frame(spark, "ev_specs", [
            *(_spec(f"Volt Model {i}", "18.5", "100") for i in range(29)),
            _spec("Tesla S", "18.5", "100", Car_type="Sedan", **{"Approx_Release_price_order_in_K$": "80"}),
            _spec("Renault ZOE ", "18.5", "100"),
            _spec("Citroen C  Zero", "19.9", "100"),
            _spec("Ford focus Electric", "empty", "207"),
            _spec("Honda Fit", "30", "empty"),
        ]),
        "emission_registry": frame(spark, "emission_registry", [
            *(_registry(f"320i v{i}", "X" if i % 3 else "D", "10.0") for i in range(24)),
            _registry("320i v0", "D", "10.7"),
            _registry("M3", "Z", "14.0", "320"),
            _registry("Flex", "E", "16.0", "250", make="FORD"),
            _registry("124 SPIDER", "Q", "8.0", "190", make="FIAT", **{"Vehicle Class": "TWO-SEATER"}),
        ]),
        "car_catalogue": frame(spark, "car_catalogue", [
            _car("FERRARI", "SF90 STRADALE", "plug in hyrbrid", "$1,100,000 ", "963 hp", "2"),
            _car("Ford", "KA+", "Petrol", "$12,000-$15,000", "70-85 hp", "5"),
            _car("Toyota", "Yaris", "Petrol/Hybrid", "$10,000 - $12,000", "1,020 hp", "2+2"),
            _car("Tesla", " S", "Electric", "$60,000", "500 HP", "5"),
            _car("BMW", "320I V0", "Diesel", "$41,000", "184 hp", "5"),
            _car(" ", "Ghost", "Petrol", "$1", "1 hp", "1"),
            _car("Volvo", "EX", "Electric Hybrid", "n/a", "n/a", "x"),
        ]),
        "ev_adoption_long": frame(spark, "ev_adoption_long", [
            adoption("France", "EV sales", "BEV", "210000"),
            adoption("France", "EV stock", "BEV", "600000"),
            adoption("France", "EV sales", "PHEV", "130000"),
            adoption("France", "EV sales share", "EV", "21.0"),
            adoption("France", "EV stock share", "EV", "2.5"),
            adoption("France", "EV sales share", "BEV", "13.0"),
            adoption("France", "EV sales", "BEV", "999999", category="Projection-STEPS"),
            adoption("France", "EV sales", "BEV", "5", mode="Buses"),
            adoption("Norway", "EV sales", "BEV", "138000"),
        ]),
        "charging_stations": frame(spark, "charging_stations", [
            {"id": "1", "name": "A", "city": "Unknown City", "state_province": "UNKNOWN", "country_code": "CH", "latitude": "46.9",
             "longitude": "7.4", "ports": "-4", "power_kw": "", "power_class": "AC_L2_(7.5-21kW)", "is_fast_dc": "False"},
            {"id": "2", "name": "B", "city": "Paris", "state_province": None, "country_code": "FR", "latitude": "48.8",
             "longitude": "x", "ports": "3", "power_kw": "150.0", "power_class": "DC_ULTRA_(>=150kW)", "is_fast_dc": "True"},
            {"id": "3", "name": "C", "city": "Rome", "state_province": None, "country_code": "IT", "latitude": "41.9",
             "longitude": "12.5", "ports": "3", "power_kw": "50.0", "power_class": "DC_FAST_(50-149kW)", "is_fast_dc": "True"},
            {"id": None, "name": "D", "city": "Bonn", "state_province": None, "country_code": "DE", "latitude": "50.7",
             "longitude": "7.1", "ports": "1", "power_kw": "22", "power_class": "AC_HIGH_(22-49kW)", "is_fast_dc": "yes"},
        ]),
    }
