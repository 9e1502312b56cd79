"""Column repairs used on the way from raw to clean tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import int_div, map_codes
from lakemart.functions.text import UNKNOWN

# Code lists of the source systems.
MARITAL_STATUS = {"S": "Single", "M": "Married"}
CRM_GENDER = {"F": "Female", "M": "Male"}
ERP_GENDER = {"F": "Female", "FEMALE": "Female", "M": "Male", "MALE": "Male"}
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
COUNTRY = {"DE": "Germany", "US": "United States", "USA": "United States"}


def trim_columns(df: DataFrame, *names: str) -> DataFrame:
    """Remove leading and trailing blanks (blanks only, tabs stay)."""
    return df.withColumns({name: F.trim(name) for name in names})


def country_name(code: Column) -> Column:
    """Known codes (case matters) to names, blank to unknown, anything else trimmed."""
    known = map_codes(code, COUNTRY, default=None, ignore_case=False)
    return F.coalesce(known, F.nullif(F.trim(code), F.lit("")), F.lit(UNKNOWN))


def category_id(product_key: Column) -> Column:
    """The first five characters of the raw key, in the spelling of the category table."""
    return F.upper(F.replace(F.substring(product_key, 1, 5), F.lit("-"), F.lit("_")))


def product_number(product_key: Column) -> Column:
    """The raw key without its category part."""
    return F.upper(F.substr(product_key, F.lit(7)))


def drop_dashes(key: Column) -> Column:
    return F.replace(key, F.lit("-"), F.lit(""))


def no_future(day: Column, as_of: dt.date) -> Column:
    """NULL for days after ``as_of``."""
    return F.when(day <= F.lit(as_of), day)


def repaired_sales(sales: Column, quantity: Column, price: Column) -> Column:
    """Quantity times absolute price where sales is missing, not positive or disagrees."""
    expected = quantity * F.abs(price)
    wrong = sales.isNull() | (sales <= 0) | (sales != expected)
    return F.when(wrong, expected).otherwise(sales)


def repaired_price(sales: Column, quantity: Column, price: Column) -> Column:
    """Raw sales per unit, truncated, where the price is missing or not positive."""
    wrong = price.isNull() | (price <= 0)
    return F.when(wrong, int_div(sales, quantity)).otherwise(price).cast("int")
