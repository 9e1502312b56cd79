"""Known product figures, from sample exports where there are some.

Set LAKEMART_SAMPLES to a folder with the product and category exports.
"""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemart.operators import checks
from lakemart.plans import explore, gold, segments, silver
from lakemart.sources.csv_files import default_file, read_exports

FOLDER = os.environ.get("LAKEMART_SAMPLES", "")
TABLES = ("crm_prd_info", "erp_px_cat_g1v2")

@pytest.fixture(scope="module")
def raw(spark):
    return read_exports(spark, FOLDER, tables=TABLES)


@pytest.fixture(scope="module")
def products(raw):
    return gold.dim_products(silver.products(raw["crm_prd_info"]), silver.categories(raw["erp_px_cat_g1v2"])).cache()


def pairs(df):
    return [tuple(r) for r in df.collect()]


def test_versions_and_current_products(raw, products):
    assert raw["crm_prd_info"].count() == 397
    assert products.count() == 295
    assert products.agg(F.count_distinct("product_name")).first()[0] == 295
    assert products.agg(F.max("product_key")).first()[0] == 295


def test_products_by_category(products):
    assert pairs(explore.members_by(products, "category", "product_key", "total_products")) == [
        ("Components", 127), ("Bikes", 97), ("Clothing", 35), ("Accessories", 29), (None, 7)]


def test_average_cost(products):
    assert pairs(explore.average_cost_by_category(products)) == [
        ("Bikes", Decimal("949.44")), ("Components", Decimal("264.72")), (None, Decimal("28.57")),
        ("Clothing", Decimal("24.80")), ("Accessories", Decimal("13.17"))]


def test_cost_bands(products):
    assert pairs(segments.products_by_cost(products)) == [
        ("Below 100", 110), ("100-500", 101), ("500-1000", 45), ("Above 1000", 39)]


def test_products_without_cost(raw):
    bad = raw["crm_prd_info"].filter(checks.missing_or_negative("prd_cost"))
    assert sorted(r["prd_id"] for r in bad.collect()) == [210, 211]


def test_raw_ends_are_unusable_and_rebuilt(raw):
    late = checks.ends_before_start("prd_start_dt", "prd_end_dt")
    assert raw["crm_prd_info"].filter(late).count() == 200
    assert silver.products(raw["crm_prd_info"]).filter(late).count() == 0
    starts = raw["crm_prd_info"].agg(F.min("prd_start_dt")).first()[0]
    assert starts == dt.datetime(2003, 7, 1)
