"""Exact arithmetic: integer and decimal only, so results do not depend on summation order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(numerator: Column, denominator: Column) -> Column:
    """Integer division truncated toward zero; NULL for a zero divisor."""
    return F.call_function("div", numerator, F.nullif(denominator, F.lit(0)))


def wide_ratio(numerator: Column, denominator: Column) -> Column:
    """Unrounded decimal quotient of two whole numbers; NULL for a zero divisor."""
    below = F.nullif(denominator.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return numerator.cast("decimal(20,0)") / below


def ratio(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """Quotient of two whole numbers, rounded half away from zero to ``scale`` digits."""
    return F.round(wide_ratio(numerator, denominator), scale).cast(f"decimal(20,{scale})")


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    """Share of the whole in percent, rounded half away from zero; NULL for no whole.

    In whole numbers of up to 38 digits, so that the largest bigint sums neither
    overflow nor are rounded twice.
    """
    part, whole = part.cast("decimal(20,0)"), whole.cast("decimal(20,0)")
    doubled = F.abs(part) * F.lit(2 * 10 ** (scale + 2)).cast("decimal(10,0)") + F.abs(whole)
    units = int_div(doubled, F.abs(whole) * F.lit(2).cast("decimal(1,0)"))
    signed = units * F.signum(part).cast("bigint") * F.signum(whole).cast("bigint")
    return (signed.cast("decimal(20,0)") * F.lit(f"{10 ** -scale:.{scale}f}").cast(f"decimal({scale + 1},{scale})")).cast(f"decimal(20,{scale})")


def percent_text(value: Column) -> Column:
    """Decimal percent as text with a percent sign; a missing share gives just the sign."""
    return F.concat(F.coalesce(value.cast("string"), F.lit("")), F.lit("%"))
