"""Text cleaning. All functions take and return columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ampertide.functions.collation import collated


def blank_to_null(col: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(col), F.lit(""))


def has_text(col: Column) -> Column:
    """True when something other than blanks is there."""
    return F.trim(F.coalesce(col, F.lit(""))) != ""


def differs_from_empty(col: Column) -> Column:
    """Document-store inequality with "": a missing value passes."""
    return ~col.eqNullSafe(F.lit(""))


def strip_symbols(col: Column, symbols: Iterable[str]) -> Column:
    """Remove literal substrings one after the other."""
    for symbol in symbols:
        col = F.replace(col, F.lit(symbol), F.lit(""))
    return col


def match_key(*cols: Column, collation: str | None = None) -> Column:
    """Case- and blank-free key; NULL parts are skipped. Under ``NAMES`` accents do not count either."""
    return collated(F.replace(F.upper(F.concat_ws(" ", *cols)), F.lit(" "), F.lit("")), collation)


def first_word(col: Column) -> Column:
    return F.substring_index(F.trim(col), " ", 1)


def after_first_word(col: Column) -> Column:
    """Everything behind the first blank, trimmed."""
    return F.trim(F.coalesce(F.get(F.split(F.trim(col), " ", 2), F.lit(1)), F.when(col.isNotNull(), "")))


def split_first(col: Column) -> Column:
    """First part of a blank-separated text, which is not trimmed before."""
    return F.split(col, " ")[0]


def rejoin_rest(col: Column) -> Column:
    """Parts two to last joined again; leading empty parts are dropped."""
    parts = F.split(col, " ")
    return F.ltrim(F.array_join(F.slice(parts, F.lit(2), F.size(parts)), " "))
