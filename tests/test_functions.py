import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.functions import (
    concat_skip_null,
    int_div,
    map_codes,
    month_label,
    parse_yyyymmdd,
    ratio,
    strip_prefix,
    whole_months,
    whole_years,
)
from lakemart.functions.numbers import percent, percent_text

D = dt.date


def _age_in_months(later, earlier):
    if later < earlier:
        return -_age_in_months(earlier, later)
    return (later.year - earlier.year) * 12 + later.month - earlier.month - (later.day < earlier.day)


def test_whole_months(values):
    rows = [
        (D(2014, 2, 28), D(2014, 1, 31)), (D(2014, 2, 28), D(2013, 2, 28)), (D(2014, 5, 1), D(2014, 5, 1)),
        (D(2014, 1, 31), D(2014, 2, 28)), (D(2013, 2, 28), D(2012, 2, 29)), (D(2013, 1, 1), D(2014, 3, 2)),
        (None, D(2014, 1, 1)),
    ]
    got = values(rows, "b date, a date", whole_months(F.col("b"), F.col("a")))
    assert got == [0, 12, 0, 0, 11, -14, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(*[st.dates(D(1950, 1, 1), D(2050, 1, 1))] * 2), min_size=50, max_size=200))
def test_whole_months_of_random_pairs(spark, pairs):
    df = spark.createDataFrame(pairs, "b date, a date")
    for row in df.withColumn("m", whole_months(F.col("b"), F.col("a"))).collect():
        assert row["m"] == _age_in_months(row["b"], row["a"])


def test_whole_years(values):
    rows = [(D(2026, 6, 25), D(1986, 6, 25)), (D(2026, 6, 24), D(1986, 6, 25)), (D(2026, 6, 25), None)]
    assert values(rows, "b date, a date", whole_years(F.col("b"), F.col("a"))) == [40, 39, None]


def test_parse_yyyymmdd(values):
    rows = [(20101229,), (0,), (32154,), (5489,), (None,)]
    assert values(rows, "d int", parse_yyyymmdd(F.col("d"))) == [D(2010, 12, 29), None, None, None, None]


@pytest.mark.parametrize("number", [20140230, -2014010])
def test_parse_impossible_day(values, number):
    with pytest.raises(Exception, match="not a calendar day|DATETIME_FIELD_OUT_OF_BOUNDS"):
        values([(number,)], "d int", parse_yyyymmdd(F.col("d")))
    assert values([(number,)], "d int", parse_yyyymmdd(F.col("d"), on_invalid="null")) == [None]


def test_parse_every_day_and_no_other(spark):
    numbers = spark.range(19990000, 20010000).select(F.col("id").cast("int").alias("n"))
    got = dict(numbers.select("n", parse_yyyymmdd(F.col("n"), on_invalid="null")).collect())
    for n, day in got.items():
        try:
            wanted = D(n // 10000, n // 100 % 100, n % 100)
        except ValueError:
            wanted = None
        assert day == wanted, n


def test_parse_rejects_unknown_mode():
    with pytest.raises(ValueError):
        parse_yyyymmdd(F.lit(1), on_invalid="guess")


def test_month_label(values):
    assert values([(D(2020, 3, 5),), (None,)], "d date", month_label(F.col("d"))) == ["Mar", None]


def test_concat_skip_null(values):
    rows = [("Jon", "Yang"), (None, "Yang"), ("Jon", None), (None, None)]
    got = values(rows, "a string, b string", concat_skip_null(F.col("a"), " ", F.col("b")))
    assert got == ["Jon Yang", " Yang", "Jon ", " "]


def test_map_codes(values):
    rows = [(" m ",), ("F",), ("x",), ("",), (None,), ("\tF",)]
    got = values(rows, "c string", map_codes(F.col("c"), {"F": "Female", "M": "Male"}))
    assert got == ["Male", "Female", "n/a", "n/a", "n/a", "n/a"]


def test_strip_prefix(values):
    rows = [("NASAW1",), ("AW1",), ("NAS",), (None,), ("nasAW1",)]
    assert values(rows, "c string", strip_prefix(F.col("c"), "NAS")) == ["AW1", "AW1", "", None, "nasAW1"]


def test_division(values):
    rows = [(7, 2), (-7, 2), (7, 0), (None, 2), (201, 200), (-201, 200)]
    got = values(rows, "a int, b int", int_div(F.col("a"), F.col("b")), ratio(F.col("a"), F.col("b")))
    assert got == [
        (3, Decimal("3.50")), (-3, Decimal("-3.50")), (None, None), (None, None),
        (1, Decimal("1.01")), (-1, Decimal("-1.01")),
    ]


def test_percent(values):
    got = values([(1, 3), (None, 3)], "a int, b int", percent_text(percent(F.col("a"), F.col("b"))))
    assert got == ["33.33%", "%"]


def test_percent_of_the_largest_sums(values):
    """No overflow, halves away from zero, signs kept."""
    huge = 2**63 - 1
    rows = [(10**17, 3 * 10**17), (huge, huge), (1, huge), (1, 200), (1, 16000), (-1, 16000), (3, 0), (0, 5)]
    got = values(rows, "a bigint, b bigint", percent(F.col("a"), F.col("b")))
    assert got == [Decimal(x) if x else None for x in ("33.33", "100.00", "0.00", "0.50", "0.01", "-0.01", None, "0.00")]
