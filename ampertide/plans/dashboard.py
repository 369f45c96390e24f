"""Dashboard reads: interactive decision, cost projection, trends, breakdowns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampertide.operators.aggregates import grouped_median
from ampertide.operators.joining import with_scalars
from ampertide.operators.reshaping import unnest, years_ahead
from ampertide.operators.slicing import optional_filter
from ampertide.plans import decision as dec

# Dashboard defaults.
KM_PER_YEAR = 15_000
SMALLEST_GENERATION = 0.5


def stored_decision(result: DataFrame, country: str | None = None, key: str = "country_code") -> DataFrame:
    """Read of a stored decision, for one country or all."""
    return optional_filter(result, key, country).orderBy(key)


def interactive_decision(
    countries: DataFrame, yearly: DataFrame, fleets: Sequence[DataFrame], country: str, year: int
) -> DataFrame:
    """KPIs of one country and year with mix, adoption and charging attached.

    countries: country_code, petrol and diesel price, charging_summary.
    yearly: country_code, year, electricity_price_eur_per_kwh,
    co2_intensity_gkwh, grid_mix, ev_adoption.
    fleets: one-row frames that hold l_per_100km, co2_gkm and kwh_per_100km.
    """
    place = F.col("country_code") == F.lit(country)
    base = yearly.where(place & (F.col("year") == F.lit(year))).join(countries.where(place), "country_code")
    row = with_scalars(base, *fleets)
    price, intensity = F.col("electricity_price_eur_per_kwh"), F.col("co2_intensity_gkwh")
    fuel_price = (F.col("petrol_price_eur_per_l") + F.col("diesel_price_eur_per_l")) / F.lit(2.0)
    litres, kwh = F.col("l_per_100km"), F.col("kwh_per_100km")
    return row.select(
        F.col("country_code").alias("country"),
        "year",
        price.alias("electricity_price"),
        intensity.alias("co2_intensity"),
        F.bround(litres / 100 * fuel_price, 4).alias("ice_cost_per_km"),
        F.bround(kwh / 100 * price, 4).alias("ev_cost_per_km"),
        F.bround(kwh / 100 * intensity, 2).alias("ev_co2_per_km"),
        F.bround(F.col("co2_gkm"), 0).alias("ice_co2_per_km"),
        "grid_mix",
        "ev_adoption",
        F.col("charging_summary").alias("charging"),
    )


def purchase_prices(
    vehicles: DataFrame,
    price: str = "price_usd",
    fuel: str = "fuel_type",
    combustion: Sequence[str] = dec.COMBUSTION_FUELS,
    electric: Sequence[str] = dec.ELECTRIC_FUELS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Median purchase price of both fleets, one row (or one per ``by``)."""
    drive = F.when(F.col(fuel).isin(*combustion), F.lit("ice")).when(F.col(fuel).isin(*electric), F.lit("ev"))
    classed = vehicles.select(*by, drive.alias("_drive"), F.col(price).cast("double").alias("_price"))
    medians = grouped_median(classed.where(F.col("_drive").isNotNull()), [*by, "_drive"], "_price", "_median")
    return medians.groupBy(*by).agg(
        F.max(F.when(F.col("_drive") == "ice", F.col("_median"))).alias("ice_purchase_usd"),
        F.max(F.when(F.col("_drive") == "ev", F.col("_median"))).alias("ev_purchase_usd"),
    )


def cost_projection(
    base: DataFrame,
    years: int,
    km_per_year: float = KM_PER_YEAR,
    country: str | None = None,
    key: str = "country_code",
) -> DataFrame:
    """Total cost after 1..years, both drives.

    base: key, ice_purchase_usd, ev_purchase_usd, ice_cost_per_km, ev_cost_per_km.
    Purchase is in USD and running cost in EUR, so the sum is indicative only.
    """
    rows = years_ahead(optional_filter(base, key, country), years)

    def total(purchase: str, per_km: str) -> Column:
        driven = F.lit(float(km_per_year)) * F.col("year")
        return F.round(F.col(purchase) + driven * F.col(per_km), 2)

    return rows.select(
        F.col(key).alias("country"),
        "year",
        total("ice_purchase_usd", "ice_cost_per_km").alias("ice_total"),
        total("ev_purchase_usd", "ev_cost_per_km").alias("ev_total"),
    ).orderBy("country", "year")


def trend(
    yearly: DataFrame,
    measure: Column,
    name: str,
    *more: Column,
    keys: Sequence[str] = ("country_code", "year"),
    above: float = 0.0,
) -> DataFrame:
    """Values of one measure above a floor, in key order."""
    return yearly.where(measure > above).select(*keys, measure.alias(name), *more).orderBy(*keys)


def mix_breakdown(yearly: DataFrame, year: int, smallest: float = SMALLEST_GENERATION) -> DataFrame:
    """Energy sources of one year above a size, largest first per country."""
    rows = unnest(yearly.where(F.col("year") == year).select("country_code", "grid_mix"), "grid_mix")
    return rows.where(F.col("generation_twh") > smallest).orderBy(
        F.col("country_code").asc(), F.col("generation_twh").desc(), F.col("source").asc()
    )


def infrastructure(
    stations: DataFrame, keys: Sequence[str] = ("country_code", "power_class"), power: Column | None = None
) -> DataFrame:
    """Station count, and mean power if asked for, by country and power class."""
    measures = [F.count(F.lit(1)).alias("n")]
    if power is not None:
        measures.append(F.avg(power).alias("avg_power"))
    return stations.groupBy(*keys).agg(*measures).orderBy(F.col(keys[0]).asc(), F.col("n").desc(), F.col(keys[1]).asc())
