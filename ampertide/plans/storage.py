"""Full rebuilds of the stored model, and its layout for slice lookups."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ampertide.sources.readers import read_table
from ampertide.sources.sinks import clustered, interleaved, overwrite

# Columns that a slice of the long-form electricity table fixes.
SLICE_COLUMNS = ("area", "category", "subcategory", "variable", "unit")


def store(frames: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Overwrite every table or collection below ``folder`` and return readers."""
    return {name: overwrite(df, f"{folder}/{name}") for name, df in frames.items()}


def stored(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: read_table(spark, f"{folder}/{name}") for name in names}


def store_electricity_long(electricity_long: DataFrame, path: str) -> DataFrame:
    """One folder per year, sorted by the columns that slices fix."""
    return clustered(electricity_long, path, ["year"], SLICE_COLUMNS)


def store_electricity_any(electricity_long: DataFrame, path: str) -> DataFrame:
    """Laid out for slices on any of year, area, variable and unit, with or without the others."""
    return interleaved(electricity_long, path, ("year", "area", "variable", "unit"))
