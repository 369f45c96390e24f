"""Parsers for text that holds numbers, prices, flags and periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ampertide.functions.text import strip_symbols

# Accepted spellings and patterns.
TRUE_WORDS = ("1", "true", "yes", "y")
FALSE_WORDS = ("0", "false", "no", "n")
PERIOD_PATTERN = "^[0-9]{4}-S[12]$"
INTEGER_PATTERN = "[0-9]+"
DECIMAL_PATTERN = "[0-9]+(\\.[0-9]+)?"


def first_number(col: Column, pattern: str = INTEGER_PATTERN) -> Column:
    """First match of a number pattern, NULL when there is none."""
    return F.nullif(F.regexp_substr(col, F.lit(pattern)), F.lit(""))


def price_lower_bound(col: Column) -> Column:
    """Price as decimal; a range gives its lower end."""
    return first_number(F.regexp_replace(col, "[$, ]", "")).try_cast("decimal(12,2)")


def leading_int(col: Column) -> Column:
    """First whole number of a text such as "1,020 hp"."""
    return first_number(F.replace(F.trim(col), F.lit(","), F.lit(""))).try_cast("int")


def price_first_part(col: Column) -> Column:
    """Document form: only " - " separates a range; the rest must be a number."""
    part = F.split(F.coalesce(col, F.lit("0")), " - ")[0]
    return F.trim(strip_symbols(part, ("$", ","))).try_cast("double")


def first_part_int(col: Column) -> Column:
    """Document form: the part before the first blank must be a whole number."""
    return F.trim(F.split(F.coalesce(col, F.lit("0")), " ")[0]).try_cast("int")


def flag_or_null(col: Column) -> Column:
    """Three-valued flag: known true word, known false word, else NULL."""
    word = F.lower(F.trim(col))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def flag_is_true(col: Column) -> Column:
    """Two-valued flag: exactly "true" in any letter case."""
    return F.lower(F.coalesce(col.cast("string"), F.lit("false"))) == "true"


def period_is_valid(col: Column) -> Column:
    return col.rlike(PERIOD_PATTERN)


def period_year(col: Column) -> Column:
    return F.substring(col, 1, 4).try_cast("int")


def period_half(col: Column) -> Column:
    half = F.substring(col, 7, 1)
    return F.when(half == "1", 1).when(half == "2", 2)
