"""Statements that hold on any data."""

from pyspark.sql import functions as F

from lakemart.plans import explore, insights, reports, segments, trends


def test_keys_are_dense_and_unique(warehouse):
    for df, key in ((warehouse.customers, "customer_key"), (warehouse.products, "product_key")):
        row = df.agg(F.count("*").alias("n"), F.count_distinct(key).alias("d"), F.min(key).alias("lo"), F.max(key).alias("hi")).first()
        assert row["n"] == row["d"] == row["hi"] and row["lo"] == 1


def test_one_current_version_and_no_overlap(warehouse):
    versions = warehouse.clean("crm_prd_info")
    current = versions.groupBy("cat_id", "prd_key").agg(F.count_if(F.col("prd_end_dt").isNull()).alias("n"))
    assert current.filter("n <> 1").count() == 0
    assert versions.filter("prd_end_dt < prd_start_dt").count() == 0


def test_fact_keeps_every_line(spark, testdata, warehouse):
    lines = spark.read.parquet(f"{testdata}/lineitem.parquet").count()
    assert warehouse.fact.count() == warehouse.raw("crm_sales_details").count() == lines


def test_report_totals(warehouse):
    dated = warehouse.fact.filter("order_date is not null").agg(F.sum("sales_amount")).first()[0]
    assert warehouse.report_customers.agg(F.sum("total_sales")).first()[0] == dated
    assert warehouse.report_products.agg(F.sum("total_sales")).first()[0] == dated
    gaps = reports.reconcile(warehouse.report_products, warehouse.fact, warehouse.products)
    assert gaps.filter("difference <> 0").count() == 0
    assert trends.running_by_year(warehouse.fact).agg(F.max("running_sales")).first()[0] == dated


def test_segments_partition_the_buyers(warehouse):
    rows = segments.customer_segments(warehouse.fact, warehouse.settings.customer_rule)
    buyers = explore.buyers(warehouse.fact, warehouse.customers).count()
    assert rows.agg(F.sum("total_customers")).first()[0] == buyers


def test_mix_shares_sum_to_100(warehouse):
    years = insights.line_value_mix(warehouse.fact, warehouse.products).groupBy("order_year").agg(
        F.sum("sales_share").alias("s"))
    assert years.filter(F.abs(F.col("s") - 100) > 0.05).count() == 0


def test_both_join_directions_agree(warehouse):
    fact = warehouse.fact.filter("product_key is not null")
    a = explore.revenue_by_category(fact, warehouse.products)
    b = explore.revenue_by_category_of_catalog(fact, warehouse.products)
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_rewritten_input_is_read_again(spark, testdata, tmp_path):
    from lakemart.plans.warehouse import Warehouse
    from lakemart.sources.order_tables import TABLES

    for name in TABLES:
        spark.read.parquet(f"{testdata}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    first = Warehouse(spark, str(tmp_path)).fact.count()
    lines = spark.read.parquet(f"{testdata}/lineitem.parquet")
    lines.unionByName(lines).write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    assert Warehouse(spark, str(tmp_path)).fact.count() == 2 * first
