"""Clean tables to the star schema.

Both dimensions can be as large as the business; no join here is forced to
broadcast. Spark broadcasts a side when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and sort-merges otherwise, with AQE
splitting hot keys on the sales side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.text import UNKNOWN
from lakemart.operators.keys import add_dense_key
from lakemart.sources.clustered import Clustered, cluster_partner, look_up
from lakemart.sources.key_books import KeyBook


def joined_customers(crm: DataFrame, erp: DataFrame, locations: DataFrame) -> DataFrame:
    """CRM customers with birth date, country and the better of two genders, by business names.

    CRM is the master for gender. Both joins use the customer number, so the
    clean customers are shuffled once.
    """
    erp = erp.select(F.col("cid").alias("_erp_id"), "bdate", "gen")
    places = locations.select(F.col("cid").alias("_place_id"), "cntry")
    joined = crm.join(erp, F.col("cst_key") == F.col("_erp_id"), "left").join(
        places, F.col("cst_key") == F.col("_place_id"), "left"
    )
    gender = F.when(F.col("cst_gndr") != UNKNOWN, F.col("cst_gndr")).otherwise(
        F.coalesce("gen", F.lit(UNKNOWN))
    )
    return joined.select(
        F.col("cst_id").alias("customer_id"),
        F.col("cst_key").alias("customer_number"),
        F.col("cst_firstname").alias("first_name"),
        F.col("cst_lastname").alias("last_name"),
        F.col("cntry").alias("country"),
        F.col("cst_marital_status").alias("marital_status"),
        gender.alias("gender"),
        F.col("bdate").alias("birth_date"),
        F.col("cst_create_date").alias("create_date"),
    )


def current_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Open versions with their category, by business names; no category is kept as NULL."""
    current = products.filter(F.col("prd_end_dt").isNull())
    joined = current.join(categories, F.col("cat_id") == F.col("id"), "left")
    return joined.select(
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_number"),
        F.col("prd_nm").alias("product_name"),
        F.col("cat_id").alias("category_id"),
        F.col("cat").alias("category"),
        F.col("subcat").alias("sub_category"),
        "maintenance",
        F.col("prd_cost").alias("cost"),
        F.col("prd_line").alias("product_line"),
        F.col("prd_start_dt").alias("start_date"),
    )


CUSTOMER_ORDER = ("customer_id", "customer_number", "birth_date", "country", "gender")
PRODUCT_ORDER = ("start_date", "product_number", "product_id", "sub_category")


def customer_book(spark: SparkSession, base: str) -> KeyBook:
    """Customers are known by their id."""
    return KeyBook(spark, f"{base.rstrip('/')}/_keys/customers", "customer_key", "customer_id long")


def product_book(spark: SparkSession, base: str) -> KeyBook:
    """Products are known by their number, whichever version is open."""
    return KeyBook(spark, f"{base.rstrip('/')}/_keys/products", "product_key", "product_number string")


def _order(names: tuple[str, ...]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in names]


def dim_customers(crm: DataFrame, erp: DataFrame, locations: DataFrame, book: KeyBook | None = None) -> DataFrame:
    """Keys are dense and stable within one load; with a ``book`` they stay the same in every load."""
    rows = joined_customers(crm, erp, locations)
    if book:
        return book.keyed(rows, *_order(CUSTOMER_ORDER))
    return add_dense_key(rows, "customer_key", *_order(CUSTOMER_ORDER))


def dim_products(products: DataFrame, categories: DataFrame, book: KeyBook | None = None) -> DataFrame:
    """Keys are dense and stable within one load; with a ``book`` they stay the same in every load."""
    rows = current_products(products, categories)
    if book:
        return book.keyed(rows, *_order(PRODUCT_ORDER))
    return add_dense_key(rows, "product_key", *_order(PRODUCT_ORDER))


#: Columns of the lines and their names in the fact.
FACT_COLUMNS = {
    "sls_order_dt": "order_date", "sls_ship_dt": "shipping_date", "sls_due_dt": "due_date",
    "sls_sales": "sales_amount", "sls_quantity": "quantity", "sls_price": "price",
}


def fact_sales(sales: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Order lines with surrogate keys; a line without match keeps a NULL key."""
    product_keys = products.select("product_number", "product_key")
    customer_keys = customers.select("customer_id", "customer_key")
    keyed = sales.join(
        product_keys, F.col("sls_prd_key") == F.col("product_number"), "left"
    ).join(customer_keys, F.col("sls_cust_id") == F.col("customer_id"), "left")
    return keyed.select(
        F.col("sls_ord_num").alias("order_number"), "product_key", "customer_key",
        *(F.col(a).alias(b) for a, b in FACT_COLUMNS.items()),
    )


def fact_sales_in_place(lines: Clustered, products: DataFrame, customers: DataFrame, path: str) -> DataFrame:
    """``fact_sales`` from lines that are laid out by customer: the keys come to them.

    Only the customers' ids and keys are moved, to the layout of the lines, and
    products as far as Spark doesn't broadcast them by their measured size. To
    be used where lines are keyed anew more often than they change.
    """
    known = customers.select("customer_id", "customer_key").filter("customer_id IS NOT NULL")
    keys = cluster_partner(known, path, "customer_id", lines)
    product_keys = products.select("product_number", "product_key")
    return look_up(lines, keys).join(product_keys, F.col("sls_prd_key") == F.col("product_number"), "left").select(
        F.col("sls_ord_num").alias("order_number"), "product_key", "customer_key",
        *(F.col(a).alias(b) for a, b in FACT_COLUMNS.items()),
    )


def unknown_keys(fact: DataFrame, key: str, dimension: DataFrame, flag: str) -> DataFrame:
    """The keys in use that the dimension doesn't have, NULL included: (``_key_of_flag``, ``flag``).

    Lines are cut to different keys before anything is shuffled, so a hot key
    is one row a task and no line moves.
    """
    known = dimension.select(F.col(key).alias("_known"))
    missing = fact.select(key).distinct().join(known, F.col(key) == F.col("_known"), "left_anti")
    return missing.select(F.col(key).alias(f"_key_of_{flag}"), F.lit(True).alias(flag))


def orphans(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Fact lines that miss a dimension row, with the two findings as columns.

    Lines are looked up in the unknown keys, which are few where data is sound;
    Spark broadcasts them by their measured size.
    """
    found = fact
    for key, dimension, flag in (("customer_key", customers, "customer_missing"), ("product_key", products, "product_missing")):
        missing = unknown_keys(fact, key, dimension, flag)
        found = found.join(missing, F.col(key).eqNullSafe(F.col(f"_key_of_{flag}")), "left").drop(f"_key_of_{flag}")
    flags = {flag: F.coalesce(flag, F.lit(False)) for flag in ("customer_missing", "product_missing")}
    return found.filter("customer_missing OR product_missing").withColumns(flags)
