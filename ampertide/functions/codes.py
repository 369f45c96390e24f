"""Code maps and ordered label rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Focus countries.
COUNTRY_CODES = {"Switzerland": "CH", "Germany": "DE", "France": "FR"}

# Fuel codes of the emission registry.
FUEL_CODES = {
    "D": "Diesel",
    "E": "E85",
    "N": "Natural Gas",
    "X": "Petrol",
    "Z": "Premium Petrol",
}
UNKNOWN_FUEL = "Unknown"

# Ordered rules (label, any of these, none of these).
FUEL_RULES_RELATIONAL = (
    ("Plug-in Hybrid", ("plug", "phev"), ()),
    ("Electric", ("electric",), ("hybrid",)),
    ("Diesel", ("diesel",), ()),
    ("Petrol", ("petrol", "gasoline"), ()),
    ("Hybrid", ("hybrid",), ()),
)
FUEL_RULES_DOCUMENT = (
    ("Electric", ("electric",), ()),
    ("Diesel", ("diesel",), ()),
    ("Hybrid", ("hybrid",), ()),
    ("Petrol", ("petrol", "gasoline", "benzin"), ()),
)


def map_codes(col: Column, codes: Mapping[str, str], default: str | None = None) -> Column:
    """Exact lookup in a short fixed map."""
    out = reduce(
        lambda acc, item: acc.when(col == item[0], F.lit(item[1])),
        codes.items(),
        F.when(F.lit(False), F.lit(None).cast("string")),
    )
    return out if default is None else out.otherwise(F.lit(default))


def label_by_rules(
    col: Column,
    rules: Sequence[tuple[str, Sequence[str], Sequence[str]]],
    default: Column,
) -> Column:
    """Label of the first rule whose words occur in the lower-cased text."""
    text = F.lower(F.trim(F.coalesce(col, F.lit(""))))
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for label, wanted, unwanted in rules:
        hit = reduce(lambda a, b: a | b, (text.contains(word) for word in wanted))
        for word in unwanted:
            hit = hit & ~text.contains(word)
        out = out.when(hit, F.lit(label))
    return out.otherwise(default)
