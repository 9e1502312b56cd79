"""Properties of the physical plans that decide whether a query scales."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from lakemart.operators.history import date_versions, latest_per_key
from lakemart.plans import explore, gold, insights, reports, trends
from lakemart.registry import PLANS
from lakemart.sources.order_tables import RAW_TABLES


def plan(df, settled=False):
    """The initial plan, or the one AQE settled on after running."""
    if settled:
        df.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("simple")
    whole = text.getvalue()
    if "== Initial Plan ==" not in whole:
        return whole
    final, initial = whole.split("== Initial Plan ==", 1)
    return final if settled else initial


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when both sides are large."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(PLANS))
def test_no_python_rows_and_no_cross_joins(name, warehouse):
    text = plan(PLANS[name](warehouse))
    for forbidden in ("Python", "ArrowEval", "CartesianProduct", "NestedLoop"):
        assert forbidden not in text


def test_lines_meet_no_single_partition(warehouse, no_broadcast):
    """Only aggregated rows are ever gathered in one partition."""
    for name in sorted(PLANS):
        lines = plan(PLANS[name](warehouse)).splitlines()
        for number, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = next(text for text in lines[number + 1:] if "- Project" not in text)
                assert "Aggregate" in below, f"{name}: {below}"


def test_date_filter_and_columns_reach_the_scan(warehouse):
    text = plan(trends.sales_by_year(warehouse.fact))
    assert "PushedFilters: [IsNotNull(order_date)]" in text
    scan = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {c.split(":")[0] for c in scan.split(",")} == {"order_date", "customer_key", "sales_amount", "quantity"}


def test_fact_is_reduced_before_it_is_joined(warehouse, no_broadcast):
    for df in (
        explore.revenue_by_category(warehouse.fact, warehouse.products),
        explore.units_by_country(warehouse.fact, warehouse.customers),
        reports.report_customers(warehouse.fact, warehouse.customers, warehouse.settings.as_of),
        insights.line_value_mix(warehouse.fact, warehouse.products),
    ):
        text = plan(df)
        join = text.index("SortMergeJoin")
        assert "partial_sum" in text[join:]


def test_duplicates_are_cut_before_the_shuffle(spark, warehouse):
    text = plan(latest_per_key(RAW_TABLES["crm_cust_info"](spark, warehouse.base), "cst_id", "cst_create_date"))
    exchange = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[exchange:]


def test_version_window_runs_over_days(spark, warehouse):
    raw = RAW_TABLES["crm_prd_info"](spark, warehouse.base)
    text = plan(date_versions(raw, "prd_key", "prd_start_dt", "prd_end_dt"))
    below_window = text[text.index("Window ["):]
    assert "partial_max" in below_window


def test_versions_are_dated_without_a_join(spark, warehouse, no_broadcast):
    raw = RAW_TABLES["crm_prd_info"](spark, warehouse.base)
    text = plan(date_versions(raw, "prd_key", "prd_start_dt", "prd_end_dt"), settled=True)
    assert "Join" not in text
    written = [line for line in text.splitlines() if "Exchange" in line and "Reused" not in line]
    assert len(written) <= 5


@pytest.mark.parametrize("name", ["a8_category_reach", "i10_agg_sales_monthly", "q12_missing_references"])
def test_lines_are_reduced_before_the_category(name, warehouse, no_broadcast):
    """Below every join with a dimension the lines are aggregated."""
    text = plan(PLANS[name](warehouse))
    lines = text.splitlines()
    for scan in (i for i, line in enumerate(lines) if "FileScan" in line and "fact_sales" in line):
        depth = lines[scan].index("FileScan")
        above = []  # from the scan to the top
        for line in reversed(lines[:scan]):
            at = len(line) - len(line.lstrip(" :+-*(0123456789)"))
            if at < depth:
                above.append(line)
                depth = at
        first = next(line for line in above if "Join" in line or "Aggregate" in line)
        assert "Aggregate" in first, name


def test_both_customer_joins_use_one_shuffle_of_customers(warehouse, no_broadcast):
    text = plan(gold.joined_customers(
        warehouse.clean("crm_cust_info"), warehouse.clean("erp_cust_az12"), warehouse.clean("erp_loc_a101")))
    assert text.count("Exchange hashpartitioning(cst_key") == 1


def test_ranking_reads_the_fact_once(warehouse):
    text = plan(explore.customer_ranking(warehouse.fact, warehouse.customers), settled=True)
    assert "ReusedExchange" in text


def test_hot_key_is_split(spark, tmp_path):
    """A third of the lines on one product and one customer: AQE splits both joins of the fact."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        n = F.col("id")
        sales = spark.range(300000, numPartitions=8).select(
            F.concat(F.lit("SO"), n).alias("sls_ord_num"),
            F.concat(F.lit("P"), F.when(n % 3 == 0, 7).otherwise(n % 500)).alias("sls_prd_key"),
            F.when(n % 3 == 1, 11).otherwise(n % 700).alias("sls_cust_id"),
            *(F.lit("2020-01-01").cast("date").alias(c) for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")),
            (n % 97).cast("int").alias("sls_sales"), F.lit(1).alias("sls_quantity"), (n % 97).cast("int").alias("sls_price"),
        )
        products = spark.range(500).select(F.concat(F.lit("P"), n).alias("product_number"), n.alias("product_key"))
        customers = spark.range(700).select(n.alias("customer_id"), (n + 1).alias("customer_key"))
        fact = gold.fact_sales(sales, products, customers)
        text = plan(fact, settled=True)
        assert text.count("skew=true") >= 2
        assert fact.filter("product_key = 7").count() == sales.filter("sls_prd_key = 'P7'").count()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
