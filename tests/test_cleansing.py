import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemart.functions import map_codes
from lakemart.operators import cleansing as clean
from lakemart.plans import gold, silver

D = dt.date


def test_trim_removes_blanks_only(spark):
    df = spark.createDataFrame([("  a ",), ("\ta",), (None,)], "x string")
    assert [r[0] for r in clean.trim_columns(df, "x").collect()] == ["a", "\ta", None]


def test_product_line_codes_carry_blanks(values):
    rows = [("R ",), ("m",), ("S",), ("T ",), (None,), ("Z",)]
    assert values(rows, "c string", map_codes(F.col("c"), clean.PRODUCT_LINE)) == [
        "Road", "Mountain", "Other Sales", "Touring", "n/a", "n/a"]


def test_erp_gender(values):
    rows = [("F",), ("Female",), (" male ",), ("",), (None,)]
    assert values(rows, "c string", map_codes(F.col("c"), clean.ERP_GENDER)) == [
        "Female", "Female", "Male", "n/a", "n/a"]


def test_country(values):
    rows = [("DE",), (" US ",), ("USA",), (" ",), ("",), (None,), (" France ",), ("de",)]
    assert values(rows, "c string", clean.country_name(F.col("c"))) == [
        "Germany", "United States", "United States", "n/a", "n/a", "n/a", "France", "de"]


def test_keys(values):
    rows = [("CO-RF-fr-r92b-58",), ("AC",), (None,)]
    got = values(rows, "k string", clean.category_id(F.col("k")), clean.product_number(F.col("k")))
    assert got == [("CO_RF", "FR-R92B-58"), ("AC", ""), (None, None)]
    assert values([("AW-0-1",)], "k string", clean.drop_dashes(F.col("k"))) == ["AW01"]


def test_amounts(values):
    rows = [(None, 2, 5), (0, 2, 5), (-10, 2, 5), (11, 2, 5), (10, 2, None), (10, 2, -5), (10, 0, None),
            (None, 2, None), (-10, 2, -5), (7, 2, None), (10, 2, 5)]
    columns = [F.col(c) for c in ("s", "q", "p")]
    got = values(rows, "s int, q int, p int", clean.repaired_sales(*columns), clean.repaired_price(*columns))
    assert got == [(10, 5), (10, 5), (10, 5), (10, 5), (10, 5), (10, 5), (10, None),
                   (None, None), (10, -5), (7, 3), (10, 5)]


def test_no_future(values):
    day = D(2020, 5, 1)
    rows = [(day,), (day + dt.timedelta(1),), (None,)]
    assert values(rows, "d date", clean.no_future(F.col("d"), day)) == [day, None, None]


def test_latest_customer(spark):
    rows = [
        (1, "k", "old", "l", "S", "F", D(2020, 1, 1)), (1, "k", " new ", "l", " m", "f", D(2020, 1, 2)),
        (2, "k", "b", "l", None, None, D(2020, 1, 1)), (2, "k", "a", "l", "x", "x", D(2020, 1, 1)),
        (3, "k", "dated", "l", "S", "M", D(2020, 1, 1)), (3, "k", "undated", "l", "S", "M", None),
        (None, "k", "nobody", "l", "S", "M", D(2020, 1, 1)),
    ]
    raw = spark.createDataFrame(
        rows, "cst_id int, cst_key string, cst_firstname string, cst_lastname string,"
              " cst_marital_status string, cst_gndr string, cst_create_date date")
    got = {r["cst_id"]: r for r in silver.customers(raw).collect()}
    assert {k: r["cst_firstname"] for k, r in got.items()} == {1: "new", 2: "a", 3: "undated"}
    assert (got[1]["cst_marital_status"], got[1]["cst_gndr"]) == ("Married", "Female")


def test_products(spark):
    at = dt.datetime
    rows = [
        (3, "AC-HE-h1", "Helmet", None, "R ", at(2013, 7, 1), None),
        (1, "AC-HE-h1", "Helmet", 5, "R ", at(2011, 7, 1), at(2007, 12, 28)),
        (2, "AC-HE-h1", "Helmet", 6, "R ", at(2012, 7, 1), at(2008, 12, 27)),
        (4, "CO-PE-x", "Pedal", 7, None, at(2011, 7, 1), None),
    ]
    raw = spark.createDataFrame(
        rows, "prd_id int, prd_key string, prd_nm string, prd_cost int, prd_line string,"
              " prd_start_dt timestamp_ntz, prd_end_dt timestamp_ntz")
    got = {r["prd_id"]: r for r in silver.products(raw).collect()}
    assert [got[i]["prd_end_dt"] for i in (1, 2, 3, 4)] == [D(2012, 6, 30), D(2013, 6, 30), None, None]
    assert (got[3]["prd_cost"], got[3]["prd_key"], got[3]["cat_id"]) == (0, "H1", "AC_HE")
    categories = spark.createDataFrame([("AC_HE", "Accessories", "Helmets", "Yes")], "id string, cat string, subcat string, maintenance string")
    dim = {r["product_number"]: r for r in gold.dim_products(silver.products(raw), categories).collect()}
    assert {k: (r["product_key"], r["category"]) for k, r in dim.items()} == {
        "X": (1, None), "H1": (2, "Accessories")}


def test_master_gender(spark):
    crm = spark.createDataFrame(
        [(1, "a", "Female"), (2, "b", "n/a"), (3, "c", "n/a"), (4, "d", "n/a")], "cst_id int, cst_key string, cst_gndr string"
    ).selectExpr("cst_id", "cst_key", "'f' cst_firstname", "'l' cst_lastname", "'Single' cst_marital_status",
                 "cst_gndr", "date'2020-01-01' cst_create_date")
    erp = spark.createDataFrame([("a", None, "Male"), ("b", None, "Male"), ("c", None, "n/a")], "cid string, bdate date, gen string")
    places = spark.createDataFrame([("a", "France")], "cid string, cntry string")
    got = {r["customer_id"]: r for r in gold.joined_customers(crm, erp, places).collect()}
    assert [got[i]["gender"] for i in (1, 2, 3, 4)] == ["Female", "Male", "n/a", "n/a"]
    assert [got[i]["country"] for i in (1, 2)] == ["France", None]


@pytest.mark.parametrize("mode", ["error", "null"])
def test_sales_dates(spark, mode):
    rows = [("SO1", "P", 1, 20101229, 20110105, 0, 10, 2, 5)]
    if mode == "null":
        rows.append(("SO2", "P", 1, 20140230, 20110105, 0, 10, 2, 5))
    raw = spark.createDataFrame(
        rows, "sls_ord_num string, sls_prd_key string, sls_cust_id int, sls_order_dt int, sls_ship_dt int,"
              " sls_due_dt int, sls_sales int, sls_quantity int, sls_price int")
    got = silver.sales(raw, mode).orderBy("sls_ord_num").collect()
    assert got[0]["sls_order_dt"] == D(2010, 12, 29) and got[0]["sls_due_dt"] is None
    assert mode == "error" or got[1]["sls_order_dt"] is None
