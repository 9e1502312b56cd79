"""Date expressions. Every one is a built-in column expression, no UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_months(later: Column, earlier: Column) -> Column:
    """Completed calendar months from ``earlier`` to ``later``.

    A month counts once the day of month is reached again, so 31 January to
    28 February is 0 months (``months_between`` would call it 1). Negative
    when ``later`` lies before ``earlier``.
    """
    months = (F.year(later) * 12 + F.month(later)) - (F.year(earlier) * 12 + F.month(earlier))
    day_later, day_earlier = F.dayofmonth(later), F.dayofmonth(earlier)
    return F.when(
        later >= earlier, months - F.when(day_later < day_earlier, 1).otherwise(0)
    ).when(later < earlier, months + F.when(day_later > day_earlier, 1).otherwise(0))


def whole_years(later: Column, earlier: Column) -> Column:
    """Completed years, truncated toward zero."""
    return F.call_function("div", whole_months(later, earlier), F.lit(12)).cast("int")


def _parts(number: Column) -> tuple[Column, Column, Column]:
    """Year, month and day of a ``yyyymmdd`` number, by whole-number arithmetic."""
    without_day = F.call_function("div", number, F.lit(100))
    year = F.call_function("div", number, F.lit(10000))
    return year.cast("int"), (without_day % 100).cast("int"), (number % 100).cast("int")


def calendar_day(number: Column) -> Column:
    """The day a positive eight-digit ``yyyymmdd`` names; NULL where there is no such day.

    Never fails, whatever the ANSI mode, and parses no text.
    """
    year, month, day = _parts(number)
    plausible = number.between(10000000, 99999999) & month.between(1, 12) & day.between(1, 31)
    moved = F.date_add(F.make_date(year, month, F.lit(1)), day - 1)
    return F.when(plausible & (F.month(moved) == month), moved)


def parse_yyyymmdd(number: Column, on_invalid: str = "error") -> Column:
    """Integer ``yyyymmdd`` to a date; NULL unless it is written with exactly 8 characters.

    Eight characters that are no calendar day fail the job, or become NULL
    with ``on_invalid="null"``.
    """
    if on_invalid == "null":
        return calendar_day(number)
    if on_invalid != "error":
        raise ValueError("on_invalid is 'error' or 'null'")
    eight_characters = number.between(10000000, 99999999) | number.between(-9999999, -1000000)
    # make_date fails by itself in ANSI mode and gives NULL otherwise.
    no_day = F.raise_error(F.concat(F.lit("not a calendar day: "), number.cast("string")))
    return F.when(eight_characters, F.coalesce(F.make_date(*_parts(number)), no_day.cast("date")))


def month_label(day: Column) -> Column:
    """Short English month name."""
    return F.date_format(day, "MMM")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def year_start(day: Column) -> Column:
    return F.trunc(day, "year")
