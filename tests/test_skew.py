"""Whole results when one key holds a third of the rows, and more lines than the test tables have."""

import duckdb
import pytest
from pyspark.sql import functions as F

from lakemart.registry import QUERIES
from oracles import ORACLES
from tests.test_oracles import _rows

NAMES = [
    "c3_latest_customers", "c7_version_dates", "m1_customer_keys", "m1_product_keys", "j3_fact_sales", "j6_catalog_sales",
    "j7_orphans", "a4_distinct_counts", "a8_category_reach", "n5_kpi_sheet", "n6_kpi_sheet_dated",
    "n9_revenue_by_category", "n11_units_by_country", "n12_top_products", "n13_top_customers", "n14_fewest_orders",
    "n15_sales_by_year", "n20_running_by_month", "n21_product_year_over_year", "n22_category_shares",
    "n24_customer_segments", "r1_report_customers", "r3_report_products", "r5_reconcile", "q9_amounts_bronze",
    "i2_line_value_mix", "i7_date_impact", "i9_segment_shift", "i10_agg_sales_monthly",
]


@pytest.fixture(scope="module")
def hot(spark, testdata, tmp_path_factory):
    """A third of the orders on one customer; of the lines, a third on one part and a third on one order."""
    folder = tmp_path_factory.mktemp("hot")

    def read(name):
        return spark.read.parquet(f"{testdata}/{name}.parquet")

    order, part = F.col("l_orderkey"), F.col("l_partkey")
    lines = read("lineitem").withColumn("_row", F.monotonically_increasing_id() % 6)
    tables = {
        "customer": read("customer"), "nation": read("nation"),
        # Copies of one part: equal versions, a third of all.
        "part": read("part").unionByName(read("part").filter("p_partkey = 17").crossJoin(spark.range(99)).drop("id")),
        "orders": read("orders").withColumn(
            "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, 23).otherwise(F.col("o_custkey"))),
        "lineitem": lines.withColumn("l_partkey", F.when(F.col("_row") < 2, 41).otherwise(part))
        .withColumn("l_orderkey", F.when(F.col("_row").isin(2, 3), 5).otherwise(order)).drop("_row"),
    }
    connection = duckdb.connect()
    for name, df in tables.items():
        df.repartition(5).write.parquet(f"{folder}/{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return str(folder), connection


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys(name, spark, hot):
    folder, connection = hot
    df = QUERIES[name](spark, folder)
    result = connection.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert _rows(df.columns, df.collect()) == _rows(columns, result.fetchall())


def test_repeated_part_has_one_current_version(spark, hot):
    folder, _ = hot
    found = QUERIES["m2_dim_products"](spark, folder).filter("product_number = 'PN-17'")
    assert found.count() == 1
