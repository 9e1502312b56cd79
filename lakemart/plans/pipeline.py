"""The load jobs: raw files to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.plans import gold, reports, silver
from lakemart.plans.rules import silver_rules
from lakemart.plans.segments import CustomerRule, ProductRule
from lakemart.sources.csv_files import read_exports
from lakemart.sources.layers import LayerStore
from lakemart.sources.schemas import BRONZE, GOLD, LAYERS, SILVER, conform

GOLD_TABLES = (*GOLD, "report_customers", "report_products")


def create_layers(spark: SparkSession) -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")


def load_bronze(
    spark: SparkSession, source: str, store: LayerStore, files: Mapping[str, str] | None = None, **options: str | bool
) -> str:
    """Land the six exports as they are; ``options`` (delimiter, multi_line, null_text) tell how they are written."""
    return store.load("bronze", read_exports(spark, source, files, **options))


def load_silver(store: LayerStore, as_of: dt.date, on_invalid: str = "error", rules: str | None = None) -> str:
    """Clean the current bronze load; every row gets the time of loading.

    With ``rules`` the layer's quality rules are observed while it is written:
    ``record`` keeps the findings, ``refuse`` commits only if all rules hold.
    """
    raw = store.read_all("bronze", tuple(BRONZE))
    cleaned = {
        table: conform(df, SILVER[table], optional=("dwh_create_date",))
        .withColumn("dwh_create_date", F.localtimestamp())
        for table, df in silver.clean_tables(raw, as_of, on_invalid).items()
    }
    if rules:
        return store.load("silver", cleaned, silver_rules(as_of), rules)
    return store.load("silver", cleaned)


def load_gold(
    store: LayerStore, as_of: dt.date, customer_rule: CustomerRule = CustomerRule(),
    product_rule: ProductRule = ProductRule(), keep_keys: bool = False,
) -> str:
    """Star schema and reports of the current silver load.

    The dimensions are numbered once and read back for the fact, the fact is
    read back for the reports: nothing upstream is computed twice. By default
    every load numbers its members 1, 2, 3, …; with ``keep_keys`` members keep
    the keys of earlier loads, and only new ones are numbered, above these.
    """
    clean = store.read_all("silver", tuple(SILVER))
    customer_book = gold.customer_book(store.spark, store.base) if keep_keys else None
    product_book = gold.product_book(store.spark, store.base) if keep_keys else None
    return store.load("gold", {
        "dim_customers": lambda done: conform(
            gold.dim_customers(clean["crm_cust_info"], clean["erp_cust_az12"], clean["erp_loc_a101"], customer_book), GOLD["dim_customers"]
        ),
        "dim_products": lambda done: conform(
            gold.dim_products(clean["crm_prd_info"], clean["erp_px_cat_g1v2"], product_book), GOLD["dim_products"]
        ),
        "fact_sales": lambda done: conform(
            gold.fact_sales(clean["crm_sales_details"], done["dim_products"], done["dim_customers"]), GOLD["fact_sales"]
        ),
        "report_customers": lambda done: reports.report_customers(
            done["fact_sales"], done["dim_customers"], as_of, customer_rule
        ),
        "report_products": lambda done: reports.report_products(
            done["fact_sales"], done["dim_products"], as_of, product_rule
        ),
    })


def publish_views(tables: Mapping[str, DataFrame], prefix: str = "gold_") -> None:
    """Make tables readable in SQL for this session, as views under ``prefix``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def row_counts(tables: Mapping[str, DataFrame], layer: str) -> DataFrame:
    """Rows per table of any set of tables, as one result."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(layer).alias("layer"), F.lit(t).alias("table_name"), "rows")
        for t, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def columns_of(spark: SparkSession, tables: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Columns of the tables of each layer: schema, table, column, type, nullable."""
    rows = [
        (layer, table, field.name, field.dataType.simpleString(), "YES" if field.nullable else "NO")
        for layer, members in tables.items()
        for table, df in members.items()
        for field in df.schema.fields
    ]
    names = "table_schema string, table_name string, column_name string, data_type string, is_nullable string"
    return spark.createDataFrame(rows, names).orderBy("table_schema", "table_name")


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows by key, so that a preview can be repeated."""
    return df.orderBy(*(F.col(c).asc_nulls_last() for c in order)).limit(n)
