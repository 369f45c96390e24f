"""Both integrations on domain-shaped sources, up to the published decision."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ampertide import catalog
from ampertide.operators import quality
from ampertide.plans import dashboard, documents, relational, storage
from ampertide.session import fresh_path, materialise
from ampertide.sources.readers import read_source
from ampertide.sources.sinks import write_csv
from tests.fixtures import sources as source_frames

# The published result for reference year 2022.
GOLDEN = {
    "CH": (0.1740, 0.0375, 6.91, 235.0, 1, 0.22, 0.03),
    "DE": (0.1810, 0.0684, 77.84, 235.0, 1, 0.38, 0.33),
    "FR": (0.1775, 0.0470, 14.57, 235.0, 1, 0.26, 0.06),
}
KPIS = ("ice_eur_per_km", "ev_eur_per_km", "ev_co2_g_per_km", "ice_co2_g_per_km", "recommend_ev", "ratio_cost", "ratio_co2")


@pytest.fixture(scope="module")
def sources(spark):
    return source_frames(spark)


@pytest.fixture(scope="module")
def tables(spark, sources):
    built = relational.integrate(spark, relational.staging(sources))
    return {name: materialise(df, name) for name, df in built.items()}


@pytest.fixture(scope="module")
def collections(sources):
    return {name: materialise(df, name) for name, df in documents.integrate(sources).items()}


def result(df):
    return {row["country_code"]: tuple(row[k] for k in KPIS) for row in df.collect()}


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_relational_decision(tables, sources):
    electricity = relational.staging(sources)["electricity_long"]
    assert result(relational.ev_decision(tables, electricity)) == GOLDEN


def test_document_decision(collections):
    assert result(documents.ev_decision(collections)) == GOLDEN


def test_document_decision_plain_ratio(collections):
    assert result(documents.ev_decision(collections, guard=None)) == GOLDEN


def test_both_forms_reconcile(tables, collections, sources):
    a = relational.ev_decision(tables, relational.staging(sources)["electricity_long"])
    b = documents.ev_decision(collections)
    assert quality.reconcile(a, b, ["country_code"], list(KPIS), 1e-4).count() == 0


def test_tables_have_stored_types(tables):
    for name, df in tables.items():
        assert df.schema.simpleString() == catalog.table_schema(name).simpleString(), name


def test_vehicle_ids_are_dense_and_ordered_by_source(tables):
    vehicle = tables["vehicle"]
    ids = sorted(r[0] for r in vehicle.select("vehicle_id").collect())
    # 6 catalogue rows with a make, 28 registry rows, 31 sheet rows without a catalogue match
    assert ids == list(range(1, 6 + 28 + 31 + 1))
    assert vehicle.where("vehicle_id <= 6").where("price_usd IS NOT NULL OR model = 'EX'").count() == 6


def test_catalogue_cleaning(tables):
    got = {r["model"]: r for r in tables["vehicle"].where("vehicle_id <= 6").collect()}
    assert (got["SF90 STRADALE"]["fuel_type"], got["SF90 STRADALE"]["price_usd"], got["SF90 STRADALE"]["horsepower"]) == (
        "Plug-in Hybrid", 1100000, 963)
    assert (got["KA+"]["price_usd"], got["KA+"]["horsepower"]) == (12000, 70)
    assert (got["Yaris"]["fuel_type"], got["Yaris"]["price_usd"], got["Yaris"]["horsepower"], got["Yaris"]["seats"]) == (
        "Petrol", 10000, 1020, 2)
    assert (got["EX"]["fuel_type"], got["EX"]["price_usd"], got["EX"]["seats"]) == ("Hybrid", None, None)
    # class filled from the registry by case-free make and model
    assert got["320I V0"]["vehicle_class"] == "COMPACT" and got["KA+"]["vehicle_class"] is None


def test_emissions_follow_their_vehicle(tables):
    joined = tables["ice_emission"].join(tables["vehicle"], "vehicle_id")
    assert joined.count() == 28
    assert rows(joined.where("model = '320i v0'"), "fuel_type", "fuel_consumption_comb") == [
        ("Diesel", catalog_decimal("10.0")), ("Diesel", catalog_decimal("10.7"))]
    assert rows(joined.where("make = 'FIAT'"), "fuel_type", "vehicle_class") == [("Unknown", "TWO-SEATER")]


def catalog_decimal(text):
    from decimal import Decimal

    return Decimal(text)


def test_specs_match_existing_vehicle_once(tables):
    spec = tables["ev_spec"].join(tables["vehicle"], "vehicle_id")
    assert spec.count() == 32
    tesla = spec.where("make = 'Tesla'").collect()
    assert len(tesla) == 1 and tesla[0]["vehicle_id"] <= 6
    assert rows(spec.where("make IN ('Renault', 'Citroen')"), "make", "model") == [("Citroen", "C  Zero"), ("Renault", "ZOE")]


def test_grid_mix_needs_both_units(tables):
    assert rows(tables["grid_mix"], "country_code", "year", "source_type", "share_pct") == [
        ("DE", 2022, "Coal", catalog_decimal("31.00")),
        ("FR", 2022, "Nuclear", catalog_decimal("62.70")),
        ("FR", 2022, "Solar", catalog_decimal("4.20")),
    ]


def test_ev_adoption_rows(tables):
    assert rows(tables["ev_adoption"], "country_code", "powertrain", "ev_sales", "ev_stock", "ev_sales_share_pct") == [
        ("FR", "BEV", 210000, 600000, None),
        ("FR", "EV", None, None, catalog_decimal("21.000")),
        ("FR", "PHEV", 130000, None, None),
    ]


def test_electricity_prices(tables):
    assert rows(tables["electricity_price"], "country_code", "year", "half_year") == [
        ("CH", 2022, None), ("CH", 2023, None), ("DE", 2022, 1), ("DE", 2022, 2), ("FR", 2022, 1), ("FR", 2022, 2)]


def test_stations_in_both_forms(tables, collections):
    assert rows(tables["charging_station"], "station_id", "ports", "power_kw", "longitude", "is_fast_dc") == [
        (1, -4, None, catalog_decimal("7.400000"), False), (2, 3, catalog_decimal("150.0"), None, True)]
    docs = collections["charging_stations"]
    assert rows(docs, "station_id", "ports", "power_kw", "is_fast_dc") == [(0, 1, 22.0, False), (1, -4, 0.0, False), (2, 3, 150.0, True)]
    assert [list(r[0]) for r in docs.where("station_id = 2").select("location.coordinates").collect()] == [[0.0, 48.8]]


def test_document_shapes(collections):
    vehicles = collections["vehicles"]
    assert vehicles.count() == 28 + 34 + 7
    assert vehicles.where("ice_emission IS NOT NULL").count() == 28
    assert vehicles.where("ev_spec IS NOT NULL").count() == 34
    got = {(r["make"], r["model"]): r for r in vehicles.collect()}
    assert got[("Tesla", "S")]["price_usd"] == 80000 and got[("Tesla", "S")]["vehicle_class"] == "Sedan"
    assert got[("Renault", "ZOE ")]["vehicle_class"] is None
    assert ("Citroen", "C  Zero") in got
    assert got[("FORD", "KA+")]["price_usd"] is None and got[("FORD", "KA+")]["horsepower"] is None
    assert got[("TOYOTA", "Yaris")]["fuel_type"] == "Hybrid" and got[("TOYOTA", "Yaris")]["price_usd"] == 10000
    assert got[("FERRARI", "SF90 STRADALE")]["fuel_type"] == "plug in hyrbrid"


def test_countries_default_summary(collections):
    got = {r["country_code"]: r["charging_summary"].asDict() for r in collections["countries"].collect()}
    assert got["FR"] == {"station_count": 0, "port_count": 0, "fast_station_share": 0.0, "fast_port_share": 0.0}
    assert got["CH"]["fast_station_share"] == 0.1756


def test_country_year_data(collections):
    got = {(r["country_code"], r["year"]): r for r in collections["country_year_data"].collect()}
    assert set(got) == {("CH", 2022), ("DE", 2022), ("FR", 2022), ("FR", 2021)}
    france = got[("FR", 2022)]
    assert {(m["source"], m["generation_twh"]) for m in france["grid_mix"]} == {("Nuclear", 282.09), ("Solar", 0.4), ("Wind", 38.1)}
    assert france["ev_adoption"]["bev_sales"] == 210000 + 999999 and france["ev_adoption"]["sales_share_pct"] == 13.0
    assert got[("DE", 2022)]["grid_mix"][0]["generation_twh"] == 0.0
    assert got[("FR", 2021)]["grid_mix"] == [] and got[("FR", 2021)]["ev_adoption"] is None


def test_interactive_decision(collections):
    row = dashboard.interactive_decision(
        collections["countries"], collections["country_year_data"], [documents.fleets(collections["vehicles"])], "CH", 2022
    ).first()
    assert (row["ice_cost_per_km"], row["ev_cost_per_km"], row["ev_co2_per_km"], row["ice_co2_per_km"]) == (0.1740, 0.0375, 6.91, 235.0)
    assert row["charging"]["station_count"] == 878


def test_dashboard_reads(tables, collections):
    yearly = collections["country_year_data"]
    assert rows(dashboard.mix_breakdown(yearly, 2022), "source", "generation_twh") == [("Nuclear", 282.09), ("Wind", 38.1)]
    assert rows(dashboard.trend(yearly, F.col("ev_adoption.bev_sales"), "bev_sales"), "country_code", "bev_sales") == [("FR", 1209999.0)]
    assert dashboard.infrastructure(tables["charging_station"], power=F.col("power_kw")).count() == 2


def test_cost_projection(tables):
    purchase = dashboard.purchase_prices(tables["vehicle"].where("price_usd IS NOT NULL")).first()
    assert (purchase["ice_purchase_usd"], purchase["ev_purchase_usd"]) == (12000.0, 60000.0)
    base = tables["country"].select(
        "country_code", F.lit(12000.0).alias("ice_purchase_usd"), F.lit(60000.0).alias("ev_purchase_usd"),
        F.lit(0.174).alias("ice_cost_per_km"), F.lit(0.0375).alias("ev_cost_per_km"))
    got = dashboard.cost_projection(base, 2, country="CH").collect()
    assert [tuple(r) for r in got] == [("CH", 1, 14610.0, 60562.5), ("CH", 2, 17220.0, 61125.0)]


def test_small_fleet_gives_no_decision(tables, sources):
    few = {**tables, "ice_emission": tables["ice_emission"].limit(4)}
    combustion, _ = relational.fleets(few)
    assert combustion.count() == 0


def test_model_has_expected_types(tables, collections):
    for name, df in {**tables, **collections}.items():
        assert quality.type_mismatches(df, catalog.expected_types(name)) == [], name
        assert set(df.columns) == set(catalog.expected_types(name)), name


def test_collections_have_required_fields(collections):
    broken = {
        name: quality.violations(df, ["*"], quality.conformance_rules(df, catalog.REQUIRED[name])).count()
        for name, df in collections.items()
    }
    assert broken == {"vehicles": 0, "countries": 0, "country_year_data": 0, "charging_stations": 0}


def test_stored_model_is_sound(tables):
    for name, df in tables.items():
        rules = quality.conformance_rules(df, catalog.REQUIRED[name], catalog.MAX_LENGTH.get(name))
        assert quality.violations(df, [catalog.UNIQUE[name][0]], rules).count() == 0, name
        assert quality.duplicates(df, catalog.UNIQUE[name]).count() == 0, name
    for name, (column, parent) in catalog.REFERENCES.items():
        assert quality.orphans(tables[name], column, tables[parent], column).count() == 0, name


def test_malformed_period(tables, sources):
    """The relational form drops it, the document form reads its year."""
    assert tables["electricity_price"].where("country_code = 'DE' AND year = 2021").count() == 0
    prices = documents.yearly_prices(sources["swiss_power_prices"], sources["euro_power_prices"])
    assert rows(prices.where("country_code = 'DE' AND year = 2021"), "electricity_price_eur_per_kwh") == [(0.9,)]


def test_sql_views(spark, tables, sources):
    relational.create_views(tables, relational.staging(sources)["electricity_long"])
    one = spark.sql("SELECT * FROM analytics_view WHERE country_code = :country ORDER BY country_code", {"country": "DE"})
    assert result(one) == {"DE": GOLDEN["DE"]}
    projection = spark.sql(
        """
        SELECT b.country_code AS country, y.yr AS year,
               ROUND(b.ice_purchase_usd + :km * y.yr * b.ice_cost_per_km, 2) AS ice_total,
               ROUND(b.ev_purchase_usd + :km * y.yr * b.ev_cost_per_km, 2) AS ev_total
        FROM v_ev_tco_base b LATERAL VIEW explode(sequence(1, :years)) y AS yr
        WHERE b.country_code = :country ORDER BY year
        """,
        {"country": "CH", "km": 15000, "years": 2},
    )
    assert [tuple(r) for r in projection.collect()] == [("CH", 1, 14610.0, 60562.5), ("CH", 2, 17220.0, 61125.0)]


def test_sql_functions(spark, tables, sources):
    relational.create_functions(tables, relational.staging(sources)["electricity_long"])
    assert result(spark.sql("SELECT * FROM ev_decision()")) == GOLDEN
    one = spark.sql("SELECT country_code, year FROM ev_decision(year => 2022, country => 'CH')").collect()
    assert [tuple(r) for r in one] == [("CH", 2022)]
    years = {r.year for r in spark.sql("SELECT * FROM ev_decision(year => NULL)").collect()}
    assert 2022 in years
    assert spark.sql("SELECT * FROM charging_stations()").count() == tables["charging_station"].count()
    classes = spark.sql("SELECT DISTINCT country_code FROM charging_stations(country => 'DE')").collect()
    assert [r[0] for r in classes] in (["DE"], [])
    prices = spark.sql("SELECT * FROM electricity_prices(first_year => 2022, last_year => 2022)").collect()
    assert prices and {r.year for r in prices} == {2022}


def test_decision_from_stored_inputs(spark, tables, sources):
    inputs = relational.decision_inputs(tables, relational.staging(sources)["electricity_long"])
    price, intensity = storage.store(dict(zip(("price", "intensity"), inputs)), fresh_path(spark, "inputs")).values()
    got = {r["country_code"]: (r["ice_eur_per_km"], r["recommend_ev"], r["r_cost"], r["r_co2"]) for r in relational.stored_decision(tables, price, intensity).collect()}
    assert got == {c: (v[0], 1, 1.1, 1.0) for c, v in GOLDEN.items()}


def test_store_is_repeatable(spark, collections):
    folder = fresh_path(spark, "model")
    storage.store(collections, folder)
    storage.store(collections, folder)
    again = storage.stored(spark, folder, collections)
    assert {n: df.count() for n, df in again.items()} == {n: df.count() for n, df in collections.items()}
    assert result(documents.ev_decision(again)) == GOLDEN


def test_electricity_layout_serves_the_slice(spark, tables, sources):
    electricity = relational.staging(sources)["electricity_long"]
    laid_out = storage.store_electricity_long(electricity, fresh_path(spark, "electricity"))
    slice_ = relational.grid_intensity(laid_out)
    assert values_of(slice_) == values_of(relational.grid_intensity(electricity))
    assert "(year#" in slice_._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]


def values_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_source_files(spark, sources):
    """Header CSV written and read back: blank cells stay text, traps survive."""
    for name in ("ev_specs", "charging_stations", "electricity_long", "car_catalogue"):
        path = fresh_path(spark, name)
        write_csv(sources[name], path)
        back = read_source(spark, path, name)
        assert back.schema.simpleString() == sources[name].schema.simpleString()
        assert back.count() == sources[name].count()
        assert sorted(map(repr, back.collect())) == sorted(map(repr, sources[name].na.fill("").collect()))

