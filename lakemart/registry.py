"""Every query by name. The names start with the inventory id of the blueprint."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions import (
    concat_skip_null,
    map_codes,
    parse_yyyymmdd,
    strip_prefix,
    whole_months,
    whole_years,
)
from lakemart.operators import checks
from lakemart.operators import cleansing as clean
from lakemart.operators.history import date_versions, latest_per_key
from lakemart.plans import (
    explore,
    gold,
    insights,
    pipeline,
    reports,
    rules,
    segments,
    silver,
    star,
    trends,
)
from lakemart.plans.report_states import ReportStates
from lakemart.plans.warehouse import Warehouse
from lakemart.sources.buckets import Refresh, Upsert, hash_buckets
from lakemart.sources.clustered import cluster
from lakemart.sources.contracts import ContractBroken
from lakemart.sources.csv_files import read_csv, write_csv
from lakemart.sources.layers import LayerStore, RulesBroken, export

Plan = Callable[[Warehouse], DataFrame]

CUSTOMERS, PRODUCTS, SALES = "crm_cust_info", "crm_prd_info", "crm_sales_details"
PEOPLE, PLACES, CATEGORIES = "erp_cust_az12", "erp_loc_a101", "erp_px_cat_g1v2"


#: The day of the earlier exports that queries on a second load begin with.
EARLIER = dt.date(1996, 6, 30)
EARLIER_VERSIONS = dt.date(1995, 1, 15)


def _preview(table: str) -> Plan:
    def plan(w: Warehouse) -> DataFrame:
        rows = w.raw(table)
        return pipeline.preview(rows, 1000, *rows.columns)

    return plan


def _row_counts(w: Warehouse) -> DataFrame:
    return pipeline.row_counts(w.raw_tables(), "bronze").unionByName(
        pipeline.row_counts(w.clean_tables(), "silver")
    )


def _csv_round_trip(table: str) -> Plan:
    """Land a raw table as CSV and read it back strictly."""

    def plan(w: Warehouse) -> DataFrame:
        rows, path = w.raw(table), f"{w.new_folder()}/{table}"
        write_csv(rows, path)
        return read_csv(w.spark, path, rows.schema)

    return plan


def _load_audit(w: Warehouse) -> DataFrame:
    """Load the clean layer and report the rows its audit has seen."""
    store = LayerStore(w.spark, w.new_folder())
    store.load("silver", w.clean_tables())
    return store.row_counts("silver")


def _published_reports(w: Warehouse) -> DataFrame:
    """Read the reports as a SQL user does."""
    pipeline.publish_views({"report_customers": w.report_customers, "report_products": w.report_products})
    return w.spark.sql("""
        SELECT 'customers' AS report, customer_segments AS segment, count(*) AS members, sum(total_sales) AS sales
        FROM gold_report_customers GROUP BY customer_segments
        UNION ALL
        SELECT 'products', product_segment, count(*), sum(total_sales) FROM gold_report_products GROUP BY product_segment
    """)


def _published_star(w: Warehouse) -> DataFrame:
    """Join the published star as a SQL user does: the fact is reduced to its keys, then named."""
    pipeline.publish_views({"dim_customers": w.customers, "dim_products": w.products, "fact_sales": w.fact})
    return w.spark.sql("""
        SELECT category, country, sum(lines) AS lines, sum(sales) AS sales
        FROM (SELECT product_key, customer_key, count(*) AS lines, sum(sales_amount) AS sales
              FROM gold_fact_sales GROUP BY product_key, customer_key) f
        LEFT JOIN gold_dim_products p ON f.product_key = p.product_key
        LEFT JOIN gold_dim_customers c ON f.customer_key = c.customer_key
        GROUP BY category, country
    """)


def _exported_monthly(w: Warehouse) -> DataFrame:
    """Hand the dashboard table over as files and read them as the other tool would."""
    path = f"{w.new_folder()}/agg_sales_monthly"
    table = insights.agg_sales_monthly(w.fact, w.products, w.settings.customer_rule)
    export(table, "parquet", path)
    return w.spark.read.schema(table.schema).parquet(path)


def _reloaded_sales(w: Warehouse) -> DataFrame:
    """Load the clean sales twice, reclaim the first load and read the current one."""
    store = LayerStore(w.spark, w.new_folder())
    for _ in range(2):
        store.load("silver", {SALES: w.clean(SALES)})
    store.reclaim("silver")
    return store.read("silver", SALES)


def _refreshed_sales(w: Warehouse) -> DataFrame:
    """Load the clean sales shipped by an earlier day, then all: only the months that changed are written again."""
    store, by_month = LayerStore(w.spark, w.new_folder()), "date_format(sls_ship_dt, 'yyyy-MM')"
    sales = w.clean(SALES)
    store.load("silver", {SALES: Refresh(sales.filter(F.col("sls_ship_dt") <= F.lit(EARLIER)), by_month)})
    store.load("silver", {SALES: Refresh(sales, by_month)})
    return store.read("silver", SALES)


def _merged_customers(w: Warehouse) -> DataFrame:
    """Keep the latest record per customer up to date: records of an earlier day, then the others as changes."""
    store, bucket = LayerStore(w.spark, w.new_folder()), hash_buckets(16, "cst_id")
    raw = w.raw(CUSTOMERS)
    latest = lambda rows: latest_per_key(rows, "cst_id", "cst_create_date")
    earlier = F.coalesce(F.col("cst_create_date") <= F.lit(EARLIER), F.lit(False))
    store.load("latest", {CUSTOMERS: Refresh(latest(raw.filter(earlier)), bucket)})
    store.load("latest", {CUSTOMERS: Upsert(latest(raw.filter(~earlier)), ("cst_id",), bucket, latest)})
    return silver.trim_and_name(store.read("latest", CUSTOMERS))


def _sales_across_loads(w: Warehouse) -> DataFrame:
    """Load sales of an earlier day without their price, then all with price and wider amounts; read both loads by
    the contract. A third load that lost a column is refused."""
    store = LayerStore(w.spark, w.new_folder())
    sales = w.clean(SALES).select("sls_ord_num", "sls_prd_key", "sls_ship_dt", "sls_sales")
    wider = w.clean(SALES).select("sls_ord_num", "sls_prd_key", "sls_ship_dt", F.col("sls_sales").cast("long"), "sls_price")
    first = store.load("silver", {SALES: sales.filter(F.col("sls_ship_dt") <= F.lit(EARLIER))}, contracts={SALES: "widen"})
    store.load("silver", {SALES: wider})
    try:
        store.load("silver", {SALES: wider.drop("sls_sales")})
    except ContractBroken:
        pass
    return store.read_loads("silver", SALES).withColumn("load", F.when(F.col("load_id") == first, 1).otherwise(2)).drop("load_id")


def _sales_after_failure(w: Warehouse) -> DataFrame:
    """Load the clean sales, let a second load fail half-way, and read what is current."""
    store = LayerStore(w.spark, w.new_folder())
    store.load("silver", {SALES: w.clean(SALES)})
    broken = w.clean(SALES).withColumn("sls_sales", F.raise_error(F.lit("this load fails")).cast("int"))
    try:
        store.load("silver", {CUSTOMERS: w.clean(CUSTOMERS).limit(0), SALES: broken})
    except PySparkException:
        return store.read("silver", SALES)
    raise RuntimeError("the second load should have failed")


LOADS: dict[str, Plan] = {
    **{f"s4_csv_{name}": _csv_round_trip(table) for name, table in {
        "customers": CUSTOMERS, "products": PRODUCTS, "sales": SALES, "erp_customers": PEOPLE,
        "locations": PLACES, "categories": CATEGORIES,
    }.items()},
    "s5_reloaded_sales": _reloaded_sales,
    "s7_failed_load_keeps_sales": _sales_after_failure,
    "s2_sales_across_loads": _sales_across_loads,
    "s8_load_audit": _load_audit,
    "s10_published_reports": _published_reports,
    "s10_published_star": _published_star,
    "s14_exported_monthly": _exported_monthly,
    "s5_refreshed_sales": _refreshed_sales,
    "s6_merged_customers": _merged_customers,
    "s6_silver_customers": lambda w: w.clean(CUSTOMERS),
    "s6_silver_products": lambda w: w.clean(PRODUCTS),
    "s6_silver_sales": lambda w: w.clean(SALES),
    "s6_silver_erp_customers": lambda w: w.clean(PEOPLE),
    "s6_silver_locations": lambda w: w.clean(PLACES),
    "s6_silver_categories": lambda w: w.clean(CATEGORIES),
    "s9_row_counts": _row_counts,
    "s11_preview_customers": _preview(CUSTOMERS),
    "s11_preview_products": _preview(PRODUCTS),
    "s11_preview_sales": _preview(SALES),
    "s11_preview_erp_customers": _preview(PEOPLE),
    "s11_preview_locations": _preview(PLACES),
    "s11_preview_categories": _preview(CATEGORIES),
    "s13_bronze_sales": lambda w: w.raw(SALES),
}

CLEANSING: dict[str, Plan] = {
    "c1_trimmed_names": lambda w: clean.trim_columns(
        w.raw(CUSTOMERS).select("cst_id", "cst_key", "cst_firstname", "cst_lastname"),
        "cst_firstname", "cst_lastname",
    ),
    "c2a_marital_status": lambda w: w.raw(CUSTOMERS).select(
        "cst_key", "cst_create_date",
        map_codes(F.col("cst_marital_status"), clean.MARITAL_STATUS).alias("cst_marital_status"),
    ),
    "c2b_crm_gender": lambda w: w.raw(CUSTOMERS).select(
        "cst_key", "cst_create_date", map_codes(F.col("cst_gndr"), clean.CRM_GENDER).alias("cst_gndr")
    ),
    "c2c_product_line": lambda w: w.raw(PRODUCTS).select(
        "prd_id", map_codes(F.col("prd_line"), clean.PRODUCT_LINE).alias("prd_line")
    ),
    "c2d_erp_gender": lambda w: w.raw(PEOPLE).select(
        "cid", map_codes(F.col("gen"), clean.ERP_GENDER).alias("gen")
    ),
    "c2e_country": lambda w: w.raw(PLACES).select(
        "cid", clean.country_name(F.col("cntry")).alias("cntry")
    ),
    "c3_latest_customers": lambda w: latest_per_key(w.raw(CUSTOMERS), "cst_id", "cst_create_date"),
    "c4_known_customers": lambda w: w.raw(CUSTOMERS).filter(F.col("cst_id").isNotNull()),
    "c5a_category_ids": lambda w: w.raw(PRODUCTS).select(
        "prd_id", clean.category_id(F.col("prd_key")).alias("cat_id")
    ),
    "c5b_product_numbers": lambda w: w.raw(PRODUCTS).select(
        "prd_id", clean.product_number(F.col("prd_key")).alias("prd_key")
    ),
    "c6_default_cost": lambda w: w.raw(PRODUCTS).select(
        "prd_id", F.coalesce("prd_cost", F.lit(0)).alias("prd_cost")
    ),
    "c7_version_dates": lambda w: date_versions(
        w.raw(PRODUCTS).select("prd_id", "prd_key", "prd_start_dt"),
        "prd_key", "prd_start_dt", "prd_end_dt",
    ).select("prd_id", "prd_key", "prd_end_dt"),
    "c8_sales_dates": lambda w: w.raw(SALES).select("sls_ord_num", *(
        parse_yyyymmdd(F.col(c)).alias(c) for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")
    )),
    "c9_repaired_sales": lambda w: w.raw(SALES).select(
        "sls_ord_num", "sls_quantity",
        clean.repaired_sales(F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price")).alias("sls_sales"),
    ),
    "c10_repaired_price": lambda w: w.raw(SALES).select(
        "sls_ord_num", "sls_quantity",
        clean.repaired_price(F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price")).alias("sls_price"),
    ),
    "c11_erp_customer_keys": lambda w: w.raw(PEOPLE).select(
        F.col("cid").alias("raw_cid"), strip_prefix(F.col("cid"), "NAS").alias("cid")
    ),
    "c12_birth_dates": lambda w: w.raw(PEOPLE).select(
        "cid", clean.no_future(F.col("bdate"), w.settings.as_of).alias("bdate")
    ),
    "c13_location_keys": lambda w: w.raw(PLACES).select(
        F.col("cid").alias("raw_cid"), clean.drop_dashes(F.col("cid")).alias("cid")
    ),
    "c14_categories": lambda w: silver.categories(w.raw(CATEGORIES)),
    "c15_start_dates": lambda w: w.raw(PRODUCTS).select(
        "prd_id", F.col("prd_start_dt").cast("date").alias("prd_start_dt")
    ),
}


def _gender_sources(w: Warehouse) -> DataFrame:
    crm = w.clean(CUSTOMERS).select("cst_key", F.col("cst_gndr").alias("crm_gender"))
    erp = w.clean(PEOPLE).select(F.col("cid").alias("cst_key"), F.col("gen").alias("erp_gender"))
    resolved = w.customers.select(F.col("customer_number").alias("cst_key"), "gender")
    rows = crm.join(erp, "cst_key", "left").join(resolved, "cst_key")
    return rows.groupBy("crm_gender", "erp_gender", "gender").agg(F.count("*").alias("customers"))


def _sales_lines(w: Warehouse) -> DataFrame:
    return (
        w.fact.join(w.products.select("product_key", "product_name", "category"), "product_key", "left")
        .join(w.customers.select("customer_key", "country"), "customer_key", "left")
        .select("order_number", "product_name", "category", "country", "sales_amount", "quantity")
    )


def _catalog_sales(w: Warehouse) -> DataFrame:
    sums = w.fact.groupBy("product_key").agg(F.sum("sales_amount").alias("total_revenue"))
    return w.products.select("product_key", "product_number").join(sums, "product_key", "left")


def _missing_references(w: Warehouse) -> DataFrame:
    """Lines and sales without a dimension row."""
    lines = w.fact.select("customer_key", "product_key", "sales_amount")
    return gold.orphans(lines, w.customers, w.products).groupBy("customer_missing", "product_missing").agg(
        F.count("*").alias("lines"), F.sum("sales_amount").alias("sales")
    )


def _fact_in_place(w: Warehouse) -> DataFrame:
    """Lay the clean lines out by customer once, then key them where they lie."""
    folder = w.new_folder()
    lines = cluster(w.clean(SALES), f"{folder}/lines", "sls_cust_id", "sls_ord_num", buckets=8)
    return gold.fact_sales_in_place(lines, w.products, w.customers, f"{folder}/keys")


def _customer_keys_of_second_load(w: Warehouse) -> DataFrame:
    """Number the customers of an earlier export, then all: known ones keep their keys, new ones follow."""
    book = gold.customer_book(w.spark, w.new_folder())
    earlier = silver.customers(w.raw(CUSTOMERS).filter(F.col("cst_create_date") <= F.lit(EARLIER)))
    gold.dim_customers(earlier, w.clean(PEOPLE), w.clean(PLACES), book)
    return gold.dim_customers(w.clean(CUSTOMERS), w.clean(PEOPLE), w.clean(PLACES), book).select("customer_key", "customer_id")


def _product_keys_of_second_load(w: Warehouse) -> DataFrame:
    """Number the products that had a version by an earlier day, then all of today."""
    book = gold.product_book(w.spark, w.new_folder())
    earlier = silver.products(w.raw(PRODUCTS).filter(F.col("prd_start_dt") <= F.lit(EARLIER_VERSIONS)))
    gold.dim_products(earlier, w.clean(CATEGORIES), book)
    return gold.dim_products(w.clean(PRODUCTS), w.clean(CATEGORIES), book).select("product_key", "product_number")


STAR: dict[str, Plan] = {
    "m1_customer_keys": lambda w: w.customers.select("customer_key", "customer_id"),
    "m1_product_keys": lambda w: w.products.select("product_key", "product_number"),
    "m1_customer_keys_of_second_load": _customer_keys_of_second_load,
    "m1_product_keys_of_second_load": _product_keys_of_second_load,
    "m2_dim_customers": lambda w: w.customers,
    "m2_dim_products": lambda w: w.products,
    "m3_master_gender": _gender_sources,
    "j1_joined_customers": lambda w: gold.joined_customers(w.clean(CUSTOMERS), w.clean(PEOPLE), w.clean(PLACES)),
    "j2_current_products": lambda w: gold.current_products(w.clean(PRODUCTS), w.clean(CATEGORIES)),
    "j3_fact_sales": lambda w: w.fact,
    "j3_fact_sales_in_place": _fact_in_place,
    "j4_buyers": lambda w: explore.buyers(star.dated(w.fact), w.customers).agg(
        F.count("customer_key").alias("total_customers")
    ),
    "j5_sales_lines": _sales_lines,
    "j6_catalog_sales": _catalog_sales,
    "j7_orphans": lambda w: gold.orphans(w.fact, w.customers, w.products),
}

FUNCTIONS: dict[str, Plan] = {
    "f3_customer_names": lambda w: w.customers.select(
        "customer_key", concat_skip_null(F.col("first_name"), " ", F.col("last_name")).alias("customer_name")
    ),
    "f7_shipping_months": lambda w: w.fact.groupBy(
        whole_months(F.col("shipping_date"), F.col("order_date")).alias("months")
    ).agg(F.count("*").alias("lines")),
    "f8_customer_ages": lambda w: w.customers.select(
        "customer_key", whole_years(F.lit(w.settings.as_of), F.col("birth_date")).alias("age")
    ),
    "a4_distinct_counts": lambda w: w.fact.agg(
        F.count_distinct("order_number").alias("total_orders"),
        F.count_distinct("customer_key").alias("total_customers"),
        F.count_distinct("product_key").alias("total_products"),
    ),
    "a4_distinct_counts_from_sets": lambda w: star.reach(w.member_sets),
    "a8_category_reach": lambda w: star.reach(w.member_sets, "category").drop("total_products"),
    "a8_reach_by_year_and_category": lambda w: star.reach(w.member_sets, F.year("month").alias("order_year"), "category"),
    "n15_reach_by_year": lambda w: star.reach(w.member_sets, F.year("month").alias("order_year")),
    "n18_reach_by_month": lambda w: star.reach(w.member_sets, F.col("month").alias("order_month")),
}

EXPLORE: dict[str, Plan] = {
    "n1_countries": lambda w: explore.countries(w.customers),
    "n1_product_tree": lambda w: explore.product_tree(w.products),
    "n2_order_range": lambda w: explore.order_range(w.fact),
    "n3_birth_range": lambda w: explore.birth_range(w.customers, w.settings.as_of),
    "n4_key_figures": lambda w: explore.key_figures(w.fact, w.customers, w.products),
    "n5_kpi_sheet": lambda w: explore.kpi_sheet(w.fact, w.customers, w.products),
    "n6_kpi_sheet_dated": lambda w: explore.kpi_sheet_dated(w.fact, w.customers, w.products),
    "n7_customers_by_country": lambda w: explore.members_by(w.customers, "country", "customer_key", "total_customers"),
    "n7_customers_by_gender": lambda w: explore.members_by(w.customers, "gender", "customer_key", "total_customers"),
    "n8_products_by_category": lambda w: explore.members_by(w.products, "category", "product_key", "total_products"),
    "n8_average_cost": lambda w: explore.average_cost_by_category(w.products),
    "n9_revenue_by_category": lambda w: explore.revenue_by_category(w.fact, w.products),
    "n10_revenue_of_catalog": lambda w: explore.revenue_by_category_of_catalog(w.fact, w.products),
    "n11_units_by_country": lambda w: explore.units_by_country(w.fact, w.customers),
    "n12_top_products": lambda w: explore.product_ranking(w.fact, w.products),
    "n12_bottom_products": lambda w: explore.product_ranking(w.fact, w.products, largest=False),
    "n13_top_customers": lambda w: explore.customer_ranking(w.fact, w.customers),
    "n14_fewest_orders": lambda w: explore.fewest_orders(w.fact, w.customers),
}

TRENDS: dict[str, Plan] = {
    "n15_sales_by_year": lambda w: trends.sales_by_year(w.fact),
    "n16_sales_by_calendar_month": lambda w: trends.sales_by_calendar_month(w.fact),
    "n17_sales_by_year_and_month": lambda w: trends.sales_by_year_and_month(w.fact),
    "n18_sales_by_month_start": lambda w: trends.sales_by_month_start(w.fact),
    "n19_running_by_year": lambda w: trends.running_by_year(w.fact),
    "n20_running_by_month": lambda w: trends.running_by_month(w.fact),
    "n21_product_year_over_year": lambda w: trends.product_year_over_year(w.fact, w.products),
    "n22_category_shares": lambda w: trends.category_shares(w.fact, w.products),
    "w6_running_sales_by_line": lambda w: w.finished(lambda: trends.running_by_line(w.fact)),
    "w7_running_sales_by_line_and_year": lambda w: w.finished(
        lambda: trends.running_by_line(w.fact, F.year("order_date"))
    ),
    "n23_products_by_cost": lambda w: segments.products_by_cost(w.products),
    "n24_customer_segments": lambda w: segments.customer_segments(w.fact, w.settings.customer_rule),
    "n25_customer_segments_dated": lambda w: segments.customer_segments_dated(w.fact, w.settings.customer_rule),
}

def _states_of_two_batches(w: Warehouse, key: str) -> ReportStates:
    """Merge the lines shipped by an earlier day, then the others, then these once more, which changes nothing."""
    states = ReportStates(LayerStore(w.spark, w.new_folder()), 8, (key,))
    early = F.coalesce(F.col("shipping_date") <= F.lit(EARLIER), F.lit(False))
    for lines, batch in ((early, "first"), (~early, "second"), (~early, "second")):
        states.add(w.fact.filter(lines), batch)
    return states


REPORTS: dict[str, Plan] = {
    "r1_report_customers_from_states": lambda w: _states_of_two_batches(w, "customer_key").report_customers(
        w.customers, w.settings.as_of, w.settings.customer_rule
    ),
    "r3_report_products_from_states": lambda w: _states_of_two_batches(w, "product_key").report_products(
        w.products, w.settings.as_of, w.settings.product_rule
    ),
    "r1_report_customers": lambda w: w.report_customers,
    "r2_top_customers": lambda w: reports.top_customers(w.report_customers),
    "r3_report_products": lambda w: w.report_products,
    "r4_margins_top": lambda w: reports.unit_margins(w.report_products),
    "r4_margins_bottom": lambda w: reports.unit_margins(w.report_products, largest=False),
    "r5_reconcile": lambda w: reports.reconcile(w.report_products, w.fact, w.products),
}


def _bad_day(column: str) -> Plan:
    return lambda w: w.raw(SALES).filter(checks.bad_day_number(column)).select(
        F.nullif(F.col(column), F.lit(0)).alias(column)
    )


def _late(df: DataFrame) -> DataFrame:
    return df.filter(checks.ordered_too_late("sls_order_dt", "sls_ship_dt", "sls_due_dt"))


def _offending_amounts(df: DataFrame) -> DataFrame:
    amounts = ["sls_sales", "sls_quantity", "sls_price"]
    bad = df.filter(checks.inconsistent_amounts(*amounts)).select(*amounts).distinct()
    return bad.orderBy(*(F.col(c).asc_nulls_last() for c in amounts))


def _quality_in_load(w: Warehouse) -> DataFrame:
    """The rules of the clean layer, observed while it is written."""
    store = LayerStore(w.spark, w.new_folder())
    store.load("silver", w.clean_tables(), rules.silver_rules(w.settings.as_of), on_broken="record")
    return store.findings("silver").drop("load_id")


def _sales_after_refusal(w: Warehouse) -> DataFrame:
    """Load the lines with consistent amounts; a load of all lines breaks the rule and is refused."""
    store, rule = LayerStore(w.spark, w.new_folder()), checks.RowRule("amounts", checks.inconsistent_amounts("sls_sales", "sls_quantity", "sls_price"))
    sales = w.clean(SALES)
    store.load("silver", {SALES: sales.filter(~rule.bad)}, {SALES: [rule]})
    try:
        store.load("silver", {SALES: sales}, {SALES: [rule]})
    except RulesBroken:
        pass
    return store.read("silver", SALES)


QUALITY: dict[str, Plan] = {
    "q1_customer_ids_bronze": lambda w: checks.violations(w.raw(CUSTOMERS), checks.KeyRule("", "cst_id")),
    "q1_customer_ids_silver": lambda w: checks.violations(w.clean(CUSTOMERS), checks.KeyRule("", "cst_id")),
    "q1_product_ids_bronze": lambda w: checks.violations(w.raw(PRODUCTS), checks.KeyRule("", "prd_id")),
    "q1_customer_keys_gold": lambda w: checks.violations(w.customers, checks.KeyRule("", "customer_key")),
    "q1_product_keys_gold": lambda w: checks.violations(w.products, checks.KeyRule("", "product_key")),
    "q2_untrimmed_first_names": lambda w: w.raw(CUSTOMERS).filter(checks.untrimmed("cst_firstname")).select("cst_firstname"),
    "q2_untrimmed_last_names": lambda w: w.raw(CUSTOMERS).filter(checks.untrimmed("cst_lastname")).select("cst_lastname"),
    "q2_untrimmed_product_names": lambda w: w.raw(PRODUCTS).filter(checks.untrimmed("prd_nm")).select("prd_nm"),
    "q3_untrimmed_categories": lambda w: w.raw(CATEGORIES).filter(checks.untrimmed("cat", "subcat", "maintenance")),
    "q4_crm_genders_bronze": lambda w: checks.distinct_values(w.raw(CUSTOMERS), "cst_gndr"),
    "q4_crm_genders_silver": lambda w: checks.distinct_values(w.clean(CUSTOMERS), "cst_gndr"),
    "q4_marital_statuses_bronze": lambda w: checks.distinct_values(w.raw(CUSTOMERS), "cst_marital_status"),
    "q4_marital_statuses_silver": lambda w: checks.distinct_values(w.clean(CUSTOMERS), "cst_marital_status"),
    "q4_product_lines_bronze": lambda w: checks.distinct_values(w.raw(PRODUCTS), "prd_line"),
    "q4_product_lines_silver": lambda w: checks.distinct_values(w.clean(PRODUCTS), "prd_line"),
    "q4_erp_genders_bronze": lambda w: checks.distinct_values(w.raw(PEOPLE), "gen", with_length=True),
    "q4_erp_genders_silver": lambda w: checks.distinct_values(w.clean(PEOPLE), "gen", with_length=True),
    "q4_countries_bronze": lambda w: checks.distinct_values(w.raw(PLACES), "cntry", with_length=True),
    "q4_countries_silver": lambda w: checks.distinct_values(w.clean(PLACES), "cntry", with_length=True),
    "q4_categories": lambda w: checks.distinct_values(w.raw(CATEGORIES), "cat"),
    "q4_sub_categories": lambda w: checks.distinct_values(w.raw(CATEGORIES), "subcat"),
    "q4_maintenance": lambda w: checks.distinct_values(w.raw(CATEGORIES), "maintenance"),
    "q4_genders_gold": lambda w: checks.distinct_values(w.customers, "gender"),
    "q5_costs_bronze": lambda w: w.raw(PRODUCTS).filter(checks.missing_or_negative("prd_cost")),
    "q5_costs_silver": lambda w: w.clean(PRODUCTS).filter(checks.missing_or_negative("prd_cost")),
    "q6_end_before_start_bronze": lambda w: w.raw(PRODUCTS).filter(
        checks.ends_before_start("prd_start_dt", "prd_end_dt")
    ),
    "q6_end_before_start_silver": lambda w: w.clean(PRODUCTS).filter(
        checks.ends_before_start("prd_start_dt", "prd_end_dt")
    ),
    "q7_bad_order_dates": _bad_day("sls_order_dt"),
    "q7_bad_ship_dates": _bad_day("sls_ship_dt"),
    "q7_bad_due_dates": _bad_day("sls_due_dt"),
    "q8_late_orders_bronze": lambda w: _late(w.raw(SALES)),
    "q8_late_orders_silver": lambda w: _late(w.clean(SALES)),
    "q9_amounts_bronze": lambda w: _offending_amounts(w.raw(SALES)),
    "q9_amounts_silver": lambda w: _offending_amounts(w.clean(SALES)),
    "q10_future_births_bronze": lambda w: w.raw(PEOPLE).filter(
        checks.in_future("bdate", w.settings.as_of)
    ).select("cid", "bdate"),
    "q10_future_births_silver": lambda w: w.clean(PEOPLE).filter(
        checks.in_future("bdate", w.settings.as_of)
    ).select("cid", "bdate"),
    "q11_gender_mapping": lambda w: w.raw(PEOPLE).select(
        F.trim("gen").alias("raw_gen"), map_codes(F.col("gen"), clean.ERP_GENDER).alias("gen")
    ).distinct(),
    "q11_location_preview": lambda w: w.raw(PLACES).select(
        F.col("cid").alias("raw_cid"), clean.drop_dashes(F.col("cid")).alias("cid"), "cntry"
    ),
    "q12_missing_references": _missing_references,
    "q13_undated_sales": lambda w: w.fact.filter(F.col("order_date").isNull()).agg(
        F.sum("sales_amount").alias("excluded_sales")
    ),
    "q14_unresolved_gender": lambda w: w.customers.groupBy("gender").agg(F.count("*").alias("customers")),
    "q14_unresolved_country": lambda w: w.customers.groupBy("country").agg(F.count("*").alias("customers")),
    "q14_uncategorised": lambda w: w.products.groupBy("category").agg(F.count("product_id").alias("products")),
    "q15_category_scan": lambda w: w.raw(CATEGORIES).select("id", "cat", "subcat", "maintenance"),
    "q15_location_scan": lambda w: w.raw(PLACES).select("cid", "cntry"),
    "quality_bronze": lambda w: rules.check_layer("bronze", w.raw_tables(), rules.bronze_rules(w.settings.as_of)),
    "quality_silver": lambda w: rules.check_layer("silver", w.clean_tables(), rules.silver_rules(w.settings.as_of)),
    "quality_silver_in_load": _quality_in_load,
    "q9_refused_load_keeps_sales": _sales_after_refusal,
    "quality_gold": lambda w: rules.check_layer(
        "gold", {"dim_customers": w.customers, "dim_products": w.products, "fact_sales": w.fact}, rules.gold_rules()
    ),
}

INSIGHTS: dict[str, Plan] = {
    "i1_revenue_by_year_and_category": lambda w: insights.revenue_by_year_and_category(w.fact, w.products),
    "i2_line_value_mix": lambda w: insights.line_value_mix(w.fact, w.products),
    "i3_sales_by_quarter": lambda w: trends.sales_by_quarter(w.fact),
    "i4_unsold_catalog": lambda w: insights.unsold_catalog(w.fact, w.products),
    "i5_segment_concentration": lambda w: insights.segment_concentration(w.fact, w.settings.customer_rule),
    "i5_customer_concentration": lambda w: w.finished(lambda: insights.customer_concentration(w.fact)),
    "n22_product_concentration": lambda w: w.finished(lambda: insights.product_concentration(w.fact, w.products)),
    "i6_markups": lambda w: insights.markups(w.report_products),
    "i6_margin_ratio": lambda w: insights.margin_ratio(w.report_products),
    "i7_date_impact": lambda w: insights.date_impact(w.fact),
    "i8_completeness": lambda w: insights.completeness(w.customers, w.products),
    "i9_segment_shift": lambda w: insights.segment_shift(w.fact, w.settings.customer_rule),
    "i10_agg_sales_monthly": lambda w: insights.agg_sales_monthly(w.fact, w.products, w.settings.customer_rule),
}

PLANS: dict[str, Plan] = {
    **LOADS, **CLEANSING, **STAR, **FUNCTIONS, **EXPLORE, **TRENDS, **REPORTS, **QUALITY, **INSIGHTS,
}


_warehouses: dict[tuple[str, str], Warehouse] = {}


def warehouse_of(spark: SparkSession, base: str, refresh: bool = False) -> Warehouse:
    """The warehouse that all queries of an application share, so that the input is listed once.

    After the input files were changed, ``refresh`` lists them again.
    """
    key = (spark.sparkContext.applicationId, base)
    if refresh or key not in _warehouses:
        _warehouses[key] = Warehouse(spark, base)
    return _warehouses[key]


def _runner(plan: Plan) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, base: plan(warehouse_of(spark, base))


QUERIES = {name: _runner(plan) for name, plan in PLANS.items()}
