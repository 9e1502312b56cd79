"""Raw tables to clean tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import map_codes, parse_yyyymmdd, strip_prefix
from lakemart.operators import cleansing as clean
from lakemart.operators.history import date_versions, latest_per_key


def customers(raw: DataFrame) -> DataFrame:
    """Latest record per customer, names trimmed, codes spelled out."""
    return trim_and_name(latest_per_key(raw, "cst_id", "cst_create_date"))


def trim_and_name(raw: DataFrame) -> DataFrame:
    return clean.trim_columns(raw, "cst_firstname", "cst_lastname").withColumns({
        "cst_marital_status": map_codes(F.col("cst_marital_status"), clean.MARITAL_STATUS),
        "cst_gndr": map_codes(F.col("cst_gndr"), clean.CRM_GENDER),
    })


def products(raw: DataFrame) -> DataFrame:
    """Every version with its category id, short key, cost, line and validity."""
    dated = date_versions(
        raw, "prd_key", "prd_start_dt", "prd_end_dt", tie_break=["prd_id", "prd_nm", "prd_cost", "prd_line"]
    )
    return dated.select(
        "prd_id",
        clean.category_id(F.col("prd_key")).alias("cat_id"),
        clean.product_number(F.col("prd_key")).alias("prd_key"),
        "prd_nm",
        F.coalesce("prd_cost", F.lit(0)).alias("prd_cost"),
        map_codes(F.col("prd_line"), clean.PRODUCT_LINE).alias("prd_line"),
        F.col("prd_start_dt").cast("date").alias("prd_start_dt"),
        "prd_end_dt",
    )


def sales(raw: DataFrame, on_invalid: str = "error") -> DataFrame:
    """Order lines with real dates and repaired amounts (both repairs read the raw values)."""
    amount, quantity, price = F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price")
    days = {n: parse_yyyymmdd(F.col(n), on_invalid) for n in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")}
    return raw.withColumns({
        **days,
        "sls_sales": clean.repaired_sales(amount, quantity, price),
        "sls_price": clean.repaired_price(amount, quantity, price),
    })


def erp_customers(raw: DataFrame, as_of: dt.date) -> DataFrame:
    return raw.select(
        strip_prefix(F.col("cid"), "NAS").alias("cid"),
        clean.no_future(F.col("bdate"), as_of).alias("bdate"),
        map_codes(F.col("gen"), clean.ERP_GENDER).alias("gen"),
    )


def locations(raw: DataFrame) -> DataFrame:
    return raw.select(
        clean.drop_dashes(F.col("cid")).alias("cid"),
        clean.country_name(F.col("cntry")).alias("cntry"),
    )


def categories(raw: DataFrame) -> DataFrame:
    return raw.select("id", "cat", "subcat", "maintenance")


def clean_tables(raw: dict[str, DataFrame], as_of: dt.date, on_invalid: str = "error") -> dict[str, DataFrame]:
    """All six clean tables of a set of raw tables."""
    return {
        "crm_cust_info": customers(raw["crm_cust_info"]),
        "crm_prd_info": products(raw["crm_prd_info"]),
        "crm_sales_details": sales(raw["crm_sales_details"], on_invalid),
        "erp_cust_az12": erp_customers(raw["erp_cust_az12"], as_of),
        "erp_loc_a101": locations(raw["erp_loc_a101"]),
        "erp_px_cat_g1v2": categories(raw["erp_px_cat_g1v2"]),
    }
