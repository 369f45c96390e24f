"""Fleet averages, yearly prices and the two-threshold recommendation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampertide.functions.numbers import guarded_ratio, per_km, rappen_to_eur, ratio, sum_present
from ampertide.functions.parse import period_half, period_is_valid, period_year
from ampertide.operators.aggregates import at_least, mean_over_join
from ampertide.operators.joining import with_scalars

# Fleets, reference year and thresholds of the rule.
COMBUSTION_FUELS = ("Petrol", "Diesel")
ELECTRIC_FUELS = ("Electric",)
REFERENCE_YEAR = 2022
COST_LIMIT = 1.10
CO2_LIMIT = 1.00
MIN_COMBUSTION_FLEET = 5
MIN_ELECTRIC_FLEET = 1
SEGMENT = "FLEET_AVG"
FIRST_PRICE_YEAR = 2015

Measures = Mapping[str, tuple[Column, int]]


def fleet_average(
    vehicles: DataFrame,
    details: DataFrame,
    on: str,
    measures: Measures,
    *,
    member: Column | None = None,
    valid: Column | None = None,
    min_n: int = 0,
    by: Sequence[str] = (),
    count_as: str = "n",
) -> DataFrame:
    """Average detail measures over the vehicles of a fleet.

    One row (or one per ``by``); no row when fewer than ``min_n`` details count.
    """
    chosen = vehicles if member is None else vehicles.where(member)
    counted = details if valid is None else details.where(valid)
    averages = mean_over_join(counted, chosen.select(on, *by), on, measures, by, {count_as: F.lit(True)})
    return at_least(averages, count_as, min_n)


def half_year_prices(raw: DataFrame, *, first_year: int | None = FIRST_PRICE_YEAR) -> DataFrame:
    """(country_code, period "YYYY-Sn", price) to (country_code, year, half_year, price)."""
    prices = raw.where(period_is_valid(F.col("period"))).select(
        "country_code",
        period_year(F.col("period")).alias("year"),
        period_half(F.col("period")).alias("half_year"),
        F.col("price_eur_per_kwh").try_cast("decimal(6,4)").alias("price_eur_per_kwh"),
    )
    return prices if first_year is None else prices.where(F.col("year") >= first_year)


def yearly_rappen_prices(raw: DataFrame, country_code: str = "CH") -> DataFrame:
    """(year, avg_price in Rappen) to the shape of ``half_year_prices``."""
    return raw.select(
        F.lit(country_code).alias("country_code"),
        F.col("year").cast("int").alias("year"),
        F.lit(None).cast("int").alias("half_year"),
        F.round(rappen_to_eur(F.col("avg_price").try_cast("double")), 4).cast("decimal(6,4)").alias("price_eur_per_kwh"),
    )


def yearly_price(prices: DataFrame, year: int | None = None, digits: int = 4, half_even: bool = False) -> DataFrame:
    """Mean price per country and year, rounded."""
    rounding = F.bround if half_even else F.round
    chosen = prices if year is None else prices.where(F.col("year") == year)
    return chosen.groupBy("country_code", "year").agg(
        rounding(F.avg("price_eur_per_kwh"), digits).alias("price_eur_per_kwh")
    )


def fleet_kpis(
    countries: DataFrame,
    fleets: Sequence[DataFrame],
    price: DataFrame,
    intensity: DataFrame,
    key: str = "country_code",
    skip_missing_price: bool = False,
) -> DataFrame:
    """Cost and emissions per km of both fleets, unrounded, one row per country.

    A missing fuel price makes the cost NULL, or counts as 0 with
    ``skip_missing_price`` (the document form's sum).

    countries: key, petrol_price_eur_per_l, diesel_price_eur_per_l, and more.
    fleets: one-row frames that hold l_per_100km, co2_gkm and kwh_per_100km.
    price: key, price_eur_per_kwh. intensity: key, co2_g_per_kwh.
    """
    inputs = countries.join(intensity.select(key, "co2_g_per_kwh"), key).join(price.select(key, "price_eur_per_kwh"), key)
    petrol, diesel = F.col("petrol_price_eur_per_l"), F.col("diesel_price_eur_per_l")
    fuel_price = (sum_present(petrol, diesel) if skip_missing_price else petrol + diesel) / F.lit(2.0)
    return with_scalars(inputs, *fleets).withColumns(
        {
            "ice_eur_per_km": per_km(fuel_price, F.col("l_per_100km")),
            "ev_eur_per_km": per_km(F.col("price_eur_per_kwh"), F.col("kwh_per_100km")),
            "ev_co2_g_per_km": per_km(F.col("co2_g_per_kwh"), F.col("kwh_per_100km")),
            "ice_co2_g_per_km": F.col("co2_gkm"),
        }
    )


def recommend(
    ev_cost: Column, ice_cost: Column, ev_co2: Column, ice_co2: Column,
    r_cost: float = COST_LIMIT, r_co2: float = CO2_LIMIT,
) -> Column:
    """1 when the electric fleet is cheap enough and clean enough, else 0."""
    good = (ev_cost <= F.lit(r_cost) * ice_cost) & (ev_co2 <= F.lit(r_co2) * ice_co2)
    return F.when(good, 1).otherwise(0)


_KPIS = ("ice_eur_per_km", "ev_eur_per_km", "ev_co2_g_per_km", "ice_co2_g_per_km")
_DIGITS = dict(zip(_KPIS, (4, 4, 2, 0)))


def decide(
    kpis: DataFrame,
    *keep: str,
    r_cost: float = COST_LIMIT,
    r_co2: float = CO2_LIMIT,
    show_limits: bool = False,
) -> DataFrame:
    """Relational form: rule and ratios on unrounded values, half-up rounding last.

    ``show_limits`` gives the two thresholds instead of the two ratios.
    """
    ice_cost, ev_cost, ev_co2, ice_co2 = (F.col(c) for c in _KPIS)
    if show_limits:
        last = (F.lit(r_cost).alias("r_cost"), F.lit(r_co2).alias("r_co2"))
    else:
        last = (
            F.round(ratio(ev_cost, ice_cost), 2).alias("ratio_cost"),
            F.round(ratio(ev_co2, ice_co2), 2).alias("ratio_co2"),
        )
    return kpis.select(
        *keep,
        F.lit(SEGMENT).alias("segment"),
        *(F.round(F.col(c), _DIGITS[c]).alias(c) for c in _KPIS),
        recommend(ev_cost, ice_cost, ev_co2, ice_co2, r_cost, r_co2).alias("recommend_ev"),
        *last,
    )


def decide_rounded(
    kpis: DataFrame, *keep: str, r_cost: float = COST_LIMIT, r_co2: float = CO2_LIMIT, guard: float | None = 0.0001
) -> DataFrame:
    """Document form: half-even rounding first, rule and ratios on the rounded values.

    ``guard``: lower bound of the ratio denominators, ``None`` for plain division.
    """
    rounded = kpis.withColumns({c: F.bround(F.col(c), _DIGITS[c]) for c in _KPIS})
    ice_cost, ev_cost, ev_co2, ice_co2 = (F.col(c) for c in _KPIS)

    def quotient(a: Column, b: Column) -> Column:
        return F.bround(ratio(a, b) if guard is None else guarded_ratio(a, b, guard), 2)

    return rounded.select(
        *keep,
        *_KPIS,
        recommend(ev_cost, ice_cost, ev_co2, ice_co2, r_cost, r_co2).alias("recommend_ev"),
        quotient(ev_cost, ice_cost).alias("ratio_cost"),
        quotient(ev_co2, ice_co2).alias("ratio_co2"),
    )
