"""Arithmetic with stated rounding, division and NULL behaviour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: Swiss franc to euro.
CHF_TO_EUR = 0.94


def to_double(col: Column) -> Column:
    """Tolerant cast; sentinels such as "empty" or "NA" become NULL."""
    return col.try_cast("double")


def to_int(col: Column) -> Column:
    return col.try_cast("int")


def to_double_or(col: Column, default: float) -> Column:
    return F.coalesce(to_double(col), F.lit(default).cast("double"))


def to_int_or(col: Column, default: int) -> Column:
    return F.coalesce(to_int(col), F.lit(default).cast("int"))


def positive(col: Column) -> Column:
    """True for numbers above zero; text that is no number never passes."""
    return F.coalesce(to_double(col) > 0, F.lit(False))


def positive_or_null(col: Column) -> Column:
    return F.when(col > 0, col)


def scaled(col: Column, digits: int) -> Column:
    """A number with at most ``digits`` decimals as a whole number of its last unit.

    A number with more decimals fails the query; nothing is rounded away. What the
    binary form of a double adds behind its decimals is no decimal.
    """
    unit = col.cast("double") * F.lit(float(10**digits))
    whole = F.rint(unit)
    beyond = F.abs(unit - whole) > F.lit(1e-6) + F.abs(unit) * F.lit(1e-12)
    too_fine = F.raise_error(F.lit(f"more than {digits} decimals in a sum of whole units")).cast("bigint")
    return F.when(beyond, too_fine).otherwise(whole.cast("bigint"))


def unscaled(total: Column, digits: int) -> Column:
    return total.cast("double") / F.lit(float(10**digits))


def exact_mean(col: Column, digits: int = 2) -> Column:
    """Mean over an exact sum of scaled whole numbers, divided once at the end.

    Doubles added up in another order differ in the last digits; this sum does
    not, so a re-run task or another partitioning gives the same mean. ``digits``:
    decimals that the values have at most; more fail the query.
    """
    total = F.sum(scaled(col, digits).cast("decimal(18,0)"))
    return unscaled(total, digits) / F.nullif(F.count(col), F.lit(0).cast("bigint"))


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL for a zero denominator."""
    return F.try_divide(a, b)


def guarded_ratio(a: Column, b: Column, floor: float = 0.0001) -> Column:
    """a / b with the denominator kept at or above ``floor``."""
    return a / F.greatest(b.cast("double"), F.lit(floor))


def sum_present(*cols: Column) -> Column:
    """Sum of the operands that are there; 0 when none is."""
    total = F.coalesce(cols[0], F.lit(0))
    for col in cols[1:]:
        total = total + F.coalesce(col, F.lit(0))
    return total


def per_km(price: Column, per_100km: Column) -> Column:
    return price * per_100km / F.lit(100.0)


def rappen_to_eur(col: Column) -> Column:
    return col / F.lit(100.0) * F.lit(CHF_TO_EUR)
