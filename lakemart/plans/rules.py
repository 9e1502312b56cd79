"""The quality rules of each layer. What bronze finds, silver should have repaired."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.text import UNKNOWN
from lakemart.operators.checks import (
    KeyRule,
    RowRule,
    Rule,
    bad_day_number,
    check_table,
    ends_before_start,
    in_future,
    inconsistent_amounts,
    missing_or_negative,
    not_among,
    ordered_too_late,
    untrimmed,
)
from lakemart.operators.measures import stack

GENDERS = ("Female", "Male", UNKNOWN)


def _shared(as_of: dt.date) -> dict[str, list[Rule]]:
    return {
        "crm_cust_info": [
            KeyRule("cst_id_key", "cst_id"),
            *(RowRule(f"{c}_untrimmed", untrimmed(c))
              for c in ("cst_firstname", "cst_lastname", "cst_gndr", "cst_marital_status")),
        ],
        "crm_prd_info": [
            KeyRule("prd_id_key", "prd_id"),
            RowRule("prd_nm_untrimmed", untrimmed("prd_nm")),
            RowRule("prd_cost_missing_or_negative", missing_or_negative("prd_cost")),
            RowRule("prd_end_before_start", ends_before_start("prd_start_dt", "prd_end_dt")),
        ],
        "crm_sales_details": [
            RowRule("order_after_ship_or_due", ordered_too_late("sls_order_dt", "sls_ship_dt", "sls_due_dt")),
            RowRule("amounts_inconsistent", inconsistent_amounts("sls_sales", "sls_quantity", "sls_price")),
        ],
        "erp_cust_az12": [KeyRule("cid_key", "cid"), RowRule("bdate_in_future", in_future("bdate", as_of))],
        "erp_loc_a101": [KeyRule("cid_key", "cid")],
        "erp_px_cat_g1v2": [
            KeyRule("id_key", "id"),
            RowRule("text_untrimmed", untrimmed("cat", "subcat", "maintenance")),
        ],
    }


def bronze_rules(as_of: dt.date) -> dict[str, list[Rule]]:
    rules = _shared(as_of)
    rules["crm_sales_details"] += [
        RowRule(f"{c}_not_a_day", bad_day_number(c)) for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")
    ]
    return rules


def silver_rules(as_of: dt.date) -> dict[str, list[Rule]]:
    rules = _shared(as_of)
    rules["crm_cust_info"] += [
        RowRule("cst_gndr_unknown_code", not_among("cst_gndr", *GENDERS)),
        RowRule("cst_marital_status_unknown_code", not_among("cst_marital_status", "Single", "Married", UNKNOWN)),
    ]
    rules["erp_cust_az12"] += [RowRule("gen_unknown_code", not_among("gen", *GENDERS))]
    return rules


def gold_rules() -> dict[str, list[Rule]]:
    return {
        "dim_customers": [
            KeyRule("customer_key_key", "customer_key"),
            RowRule("gender_unknown_code", not_among("gender", *GENDERS)),
            RowRule("gender_unresolved", F.col("gender") == UNKNOWN),
            RowRule("country_unresolved", F.col("country").isNull() | (F.col("country") == UNKNOWN)),
        ],
        "dim_products": [
            KeyRule("product_key_key", "product_key"),
            RowRule("category_missing", F.col("category").isNull()),
        ],
        "fact_sales": [
            RowRule("customer_missing", F.col("customer_key").isNull()),
            RowRule("product_missing", F.col("product_key").isNull()),
            RowRule("order_date_missing", F.col("order_date").isNull()),
        ],
    }


def check_layer(layer: str, tables: dict[str, DataFrame], rules: dict[str, list[Rule]]) -> DataFrame:
    return stack(*(check_table(tables[t], layer, t, r) for t, r in rules.items()))
