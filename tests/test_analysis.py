"""Edge cases of the analyses on a small hand-written star."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemart.plans import explore, gold, insights, reports, segments, trends

D = dt.date
AS_OF = D(2014, 6, 1)


@pytest.fixture(scope="module")
def star(spark):
    customers = spark.createDataFrame(
        [(1, 11, "AW1", "Ann", "Lee", "France", D(1980, 6, 1)), (2, 12, "AW2", None, "Ray", None, None),
         (3, 13, "AW3", "Cy", None, "n/a", D(1994, 6, 2)), (4, 14, "AW4", "Di", "Fox", "France", D(2000, 1, 1))],
        "customer_key bigint, customer_id int, customer_number string, first_name string, last_name string,"
        " country string, birth_date date").withColumn("gender", F.lit("Female"))
    products = spark.createDataFrame(
        [(1, "P1", "Bike", "Bikes", "Road", 100), (2, "P2", "Lamp", "Parts", "Road", 5), (3, "P3", "Nut", None, "n/a", 0)],
        "product_key bigint, product_number string, product_name string, category string, product_line string, cost int"
    ).withColumn("sub_category", F.col("category"))
    fact = spark.createDataFrame(
        [
            ("S1", 1, 1, D(2012, 1, 31), 3000, 10, 300), ("S2", 1, 1, D(2013, 1, 31), 2001, 7, 300),
            ("S2", 2, 1, None, 50, 5, 10), ("S3", 2, 2, D(2013, 2, 28), 20, 0, 10),
            ("S4", 2, 2, D(2014, 2, 27), 30, 3, 10), ("S5", 2, None, None, 7, 1, 7),
            ("S6", None, None, D(2014, 3, 1), 9, 1, None), ("S7", 2, 3, None, 4, 1, 4),
        ],
        "order_number string, product_key bigint, customer_key bigint, order_date date, sales_amount int,"
        " quantity int, price int").withColumns({"shipping_date": F.col("order_date"), "due_date": F.col("order_date")})
    return fact, customers, products


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_customer_report(star):
    fact, customers, _ = star
    got = by(reports.report_customers(fact, customers, AS_OF), "customer_key")
    assert set(got) == {1, 2, None}
    ann, ray, nobody = got[1], got[2], got[None]
    assert (ann["customer_name"], ann["age"], ann["age_group"]) == ("Ann Lee", 34, "30-39")
    assert (ann["lifespan_months"], ann["total_sales"], ann["customer_segments"]) == (12, 5001, "VIP")
    assert (ann["total_orders"], ann["avg_order_value"], ann["avg_monthly_spend"]) == (2, 2500, Decimal("416.75"))
    assert (ray["customer_name"], ray["age"], ray["age_group"]) == (" Ray", None, "50 and above")
    assert (ray["lifespan_months"], ray["customer_segments"], ray["recency_months"]) == (11, "New", 3)
    assert (nobody["customer_name"], nobody["lifespan_months"], nobody["avg_monthly_spend"]) == (" ", 0, Decimal("9.00"))


def test_product_report(star):
    fact, _, products = star
    got = by(reports.report_products(fact, products, AS_OF, segments.ProductRule(5000, 50)), "product_key")
    assert [got[k]["product_segment"] for k in (1, 2, None)] == ["High-Performer", "Mid-Range", "Low-Performer"]
    assert (got[2]["total_customers"], got[2]["total_orders"], got[2]["avg_order_revenue"]) == (1, 2, 25)
    assert got[1]["avg_selling_price"] == Decimal("294.2")


def test_product_figures_hold_no_line_three_times(star, spark):
    """Orders of two customers and repeated lines; each distinct count has a shuffle of its own columns."""
    fact, _, products = star
    n = F.col("id")
    more = spark.range(300).select(
        F.concat(F.lit("M"), n % 70).alias("order_number"), F.when(n % 9 > 0, n % 4).alias("product_key"),
        F.when(n % 11 > 0, n % 13).alias("customer_key"), F.date_add(F.lit(D(2014, 1, 1)), (n % 50).cast("int")).alias("order_date"),
        F.when(n % 5 > 0, n).cast("int").alias("sales_amount"), (n % 3).cast("int").alias("quantity"),
    )
    lines = fact.unionByName(more, allowMissingColumns=True)
    report = reports.report_products(lines, products, AS_OF)
    assert "Expand" not in report._jdf.queryExecution().executedPlan().toString()
    direct = lines.filter("order_date IS NOT NULL").groupBy("product_key").agg(
        F.max("order_date"), F.sum("sales_amount"), F.sum("quantity"), F.count_distinct("customer_key"), F.count_distinct("order_number"))
    names = ("product_key", "last_sale_order", "total_sales", "total_quantity", "total_customers", "total_orders")
    assert sorted(map(tuple, report.select(*names).collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)


def test_zero_quantity_has_no_price(star, spark):
    fact, _, products = star
    got = reports.report_products(fact.filter("order_number = 'S3'"), products, AS_OF).collect()[0]
    assert got["avg_selling_price"] is None and got["avg_monthly_revenue"] == Decimal("20.00")


def test_reconcile(star):
    fact, _, products = star
    report = reports.report_products(fact, products, AS_OF)
    got = by(reports.reconcile(report, fact, products), "category")
    assert set(got) == {"Bikes", "Parts", None} and all(r["difference"] == 0 for r in got.values())
    short = by(reports.reconcile(report.filter("category = 'Bikes'"), fact, products), "category")
    assert (short["Parts"]["report_sales"], short["Parts"]["difference"]) == (None, -50)


@pytest.mark.parametrize("lifespan, spend, label", [
    (11, 9000, "New"), (12, 5000, "Regular"), (12, 5001, "VIP"), (None, 9000, "New"), (12, None, "New")])
def test_customer_rule(values, lifespan, spend, label):
    got = values([(lifespan, spend)], "m int, s int", segments.CustomerRule().label(F.col("m"), F.col("s")))
    assert got == [label]


def test_bands(values):
    costs = [(c,) for c in (99, 100, 500, 501, 1000, 1001, None)]
    assert values(costs, "c int", segments.COST_BANDS.label(F.col("c"))) == [
        "Below 100", "100-500", "100-500", "500-1000", "500-1000", "Above 1000", "Above 1000"]
    ages = [(a,) for a in (19, 20, 29, 30, 49, 50, None)]
    assert values(ages, "a int", segments.AGE_BANDS.label(F.col("a"))) == [
        "Under 20", "20-29", "20-29", "30-39", "40-49", "50 and above", "50 and above"]
    assert values([(None,)], "a int", replace(segments.AGE_BANDS, unknown="unknown").label(F.col("a"))) == ["unknown"]
    revenue = [(r,) for r in (50000, 50001, 9999, 10000)]
    assert values(revenue, "r int", segments.ProductRule().label(F.col("r"))) == [
        "Mid-Range", "High-Performer", "Low-Performer", "Mid-Range"]


def test_unsold_products_stay(star):
    fact, _, products = star
    got = by(explore.revenue_by_category_of_catalog(fact, products), "category")
    assert got[None]["total_revenue"] is None and got["Parts"]["total_revenue"] == 111
    sold = by(explore.revenue_by_category(fact, products), "category")
    assert sold[None]["total_revenue"] == 9
    unsold = by(insights.unsold_catalog(fact, products), "category")
    assert unsold[None]["unsold"] == 1 and unsold[None]["share_of_catalog"] == Decimal("33.33")


def test_orphans(star):
    fact, customers, products = star
    rows = gold.orphans(fact, customers, products).collect()
    assert {(r["order_number"], r["customer_missing"], r["product_missing"]) for r in rows} == {
        ("S5", True, False), ("S6", True, True)}


def test_year_over_year(star):
    fact, _, products = star
    got = by(trends.product_year_over_year(fact, products), "product_name", "order_year")
    bike = got["Bike", D(2013, 1, 1)]
    assert (bike["avg_sales_prod"], bike["diff_avg"], bike["avg_change"]) == (
        Decimal("2500.50"), Decimal("-499.50"), "Below Avg")
    assert (bike["diff_prev_yr"], bike["prev_yr_change"]) == (-999, "Decrease")
    assert got["Bike", D(2012, 1, 1)]["prev_yr_change"] == "No Change"
    assert got[None, D(2014, 1, 1)]["avg_change"] == "Avg"
    assert got["Lamp", D(2014, 1, 1)]["prev_yr_change"] == "Increase"


def test_running_totals_restart_each_year(star):
    fact, _, _ = star
    months = by(trends.running_by_month(fact), "order_date")
    assert months[D(2013, 2, 1)]["running_sales"] == 2021 and months[D(2014, 2, 1)]["running_sales"] == 30
    assert months[D(2014, 3, 1)]["avg_price"] is None
    years = [tuple(r) for r in trends.running_by_year(fact).orderBy("order_year").collect()]
    assert [r[2] for r in years] == [3000, 5021, 5060]
    assert years[1][3:] == (Decimal("155.00"), Decimal("227.50"))


def test_shares_add_up(star):
    fact, _, products = star
    rows = trends.category_shares(fact, products).collect()
    assert [r["category"] for r in rows] == ["Bikes", "Parts", None]
    assert sum(float(r["percentage_of_total_sales"][:-1]) for r in rows) == pytest.approx(100, abs=0.02)
    assert {r["overall_sales"] for r in rows} == {5121}


def test_fewest_orders_is_repeatable(star):
    fact, customers, _ = star
    got = [(r["customer_key"], r["total_orders"]) for r in explore.fewest_orders(fact, customers).collect()]
    assert got == [(3, 1), (1, 2), (2, 2)]


def test_ranking_ties(star, spark):
    fact, _, products = star
    tied = fact.union(fact.filter("order_number = 'S6'").withColumn("sales_amount", F.lit(5001 - 9)))
    got = by(explore.product_ranking(tied, products, 1), "product_name")
    assert set(got) == {"Bike", None} and {r["prod_rank"] for r in got.values()} == {1}


def test_segment_shift_equals_two_runs(star):
    fact, _, _ = star
    rule = segments.CustomerRule(12, 40)
    shift = insights.segment_shift(fact, rule).collect()
    for column, direct in (
        ("segment_all", segments.customer_segments(fact, rule)),
        ("segment_dated", segments.customer_segments_dated(fact, rule)),
    ):
        counts = {}
        for row in shift:
            if row[column]:
                counts[row[column]] = counts.get(row[column], 0) + row["total_customers"]
        assert counts == {r["customer_segments"]: r["total_customers"] for r in direct.collect()}
    assert {(r["segment_all"], r["segment_dated"]) for r in shift} >= {("New", None)}


def test_date_impact(star):
    fact, _, _ = star
    got = {r[0]: int(r[1]) for r in insights.date_impact(fact).collect()}
    assert got == {"undated_lines": 3, "undated_sales": 61, "customers": 2, "products": 1, "orders": 3,
                   "orders_with_dated_line": 1, "orders_lost": 2}


def test_monthly_table_keeps_all_dated_sales(star):
    fact, _, products = star
    rows = insights.agg_sales_monthly(fact, products, segments.CustomerRule()).collect()
    assert sum(r["total_sales"] for r in rows) == 5060 and sum(r["total_lines"] for r in rows) == 5
    assert {r["customer_segment"] for r in rows} == {"VIP", "New"}


def test_lines_of_the_monthly_table_meet_before_they_are_hashed(star):
    fact, _, products = star
    text = insights.agg_sales_monthly(fact, products, segments.CustomerRule())._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in text


def test_order_and_birth_range(star):
    fact, customers, _ = star
    assert tuple(explore.order_range(fact).first()) == (D(2012, 1, 31), D(2014, 3, 1), 2, 26)
    assert tuple(explore.birth_range(customers, AS_OF).first())[2:] == (34, 14)
