"""Table contracts of the three layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_TEXT = 50

_TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "text": T.StringType(),
    "date": T.DateType(),
    "time": T.TimestampNTZType(),
}


def _table(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


def _stamped(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("dwh_create_date", T.TimestampNTZType())])


# The column names and types of the warehouse tables.
BRONZE = {
    "crm_cust_info": _table(
        cst_id="int", cst_key="text", cst_firstname="text", cst_lastname="text",
        cst_marital_status="text", cst_gndr="text", cst_create_date="date",
    ),
    "crm_prd_info": _table(
        prd_id="int", prd_key="text", prd_nm="text", prd_cost="int", prd_line="text",
        prd_start_dt="time", prd_end_dt="time",
    ),
    "crm_sales_details": _table(
        sls_ord_num="text", sls_prd_key="text", sls_cust_id="int", sls_order_dt="int",
        sls_ship_dt="int", sls_due_dt="int", sls_sales="int", sls_quantity="int", sls_price="int",
    ),
    "erp_loc_a101": _table(cid="text", cntry="text"),
    "erp_px_cat_g1v2": _table(id="text", cat="text", subcat="text", maintenance="text"),
    "erp_cust_az12": _table(cid="text", bdate="date", gen="text"),
}

SILVER = {
    **{name: _stamped(schema) for name, schema in BRONZE.items()},
    "crm_prd_info": _stamped(_table(
        prd_id="int", cat_id="text", prd_key="text", prd_nm="text", prd_cost="int",
        prd_line="text", prd_start_dt="date", prd_end_dt="date",
    )),
    "crm_sales_details": _stamped(_table(
        sls_ord_num="text", sls_prd_key="text", sls_cust_id="int", sls_order_dt="date",
        sls_ship_dt="date", sls_due_dt="date", sls_sales="int", sls_quantity="int",
        sls_price="int",
    )),
}

GOLD = {
    "dim_customers": _table(
        customer_key="long", customer_id="int", customer_number="text", first_name="text",
        last_name="text", country="text", marital_status="text", gender="text",
        birth_date="date", create_date="date",
    ),
    "dim_products": _table(
        product_key="long", product_id="int", product_number="text", product_name="text",
        category_id="text", category="text", sub_category="text", maintenance="text",
        cost="int", product_line="text", start_date="date",
    ),
    "fact_sales": _table(
        order_number="text", product_key="long", customer_key="long", order_date="date",
        shipping_date="date", due_date="date", sales_amount="int", quantity="int", price="int",
    ),
}

LAYERS = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD}


def conform(df: DataFrame, schema: T.StructType, optional: tuple[str, ...] = ()) -> DataFrame:
    """Columns of ``schema`` in order and type; missing or extra columns are an error."""
    wanted = [f for f in schema.fields if f.name in df.columns or f.name not in optional]
    missing = [f.name for f in wanted if f.name not in df.columns]
    extra = [c for c in df.columns if c not in {f.name for f in schema.fields}]
    if missing or extra:
        raise ValueError(f"columns missing: {missing}, not in the table: {extra}")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted))


def limit_text(df: DataFrame, longest: int = MAX_TEXT) -> DataFrame:
    """Fail the job on text longer than the declared length, in the same pass as the load.

    Blanks beyond the length are cut. The test is a filter over all text
    columns, so it runs whichever of them are read later.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return df
    fits = F.lit(True)
    for name in texts:
        value = F.col(name)
        fault = F.raise_error(F.concat(F.lit(f"{name} is longer than {longest} characters: "), value)).cast("boolean")
        fits = F.when(F.length(F.rtrim(value)) > longest, fault).otherwise(fits)
    cut = {name: F.substring(name, 1, longest) for name in texts}
    return df.filter(fits).withColumns(cut)
