"""Wide reports per customer and per product, and their reconciliation with the fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import concat_skip_null, int_div, ratio, whole_months, whole_years
from lakemart.operators.ranking import best_with_ties
from lakemart.operators.spreading import spread
from lakemart.plans.segments import CustomerRule, ProductRule, AGE_BANDS
from lakemart.plans.star import dated, per_member, quantity_sum, sales_sum


def _first_and_last(last: str) -> list[Column]:
    return [F.max("order_date").alias(last), F.min("order_date").alias("_first")]


def _lifespan(last: str) -> Column:
    return whole_months(F.col(last), F.col("_first"))


def _per_order() -> Column:
    sales, orders = F.col("total_sales"), F.col("total_orders")
    return F.when(orders == 0, F.lit(0)).otherwise(int_div(sales, orders))


def _per_month() -> Column:
    """Average per whole month; the total itself where there is no whole month."""
    sales, months = F.col("total_sales"), F.col("lifespan_months")
    return F.when(months == 0, sales.cast("decimal(20,2)")).otherwise(ratio(sales, months))


def report_customers(
    fact: DataFrame, customers: DataFrame, as_of: dt.date, rule: CustomerRule = CustomerRule()
) -> DataFrame:
    """One row per customer with dated orders.

    Orders are counted distinct: Spark shuffles by customer *and* order first, so
    a customer with very many lines is spread over the tasks.
    """
    figures = dated(fact).groupBy("customer_key").agg(
        F.count_distinct("order_number").alias("total_orders"), sales_sum(), quantity_sum(), *_first_and_last("latest_order")
    )
    return customers_of(figures, customers, as_of, rule)


def customers_of(figures: DataFrame, customers: DataFrame, as_of: dt.date, rule: CustomerRule) -> DataFrame:
    """The report from orders, sales, quantity, first and last order of each customer."""
    today = F.lit(as_of)
    attributes = customers.select("customer_key", "customer_number", "first_name", "last_name", "birth_date")
    rows = figures.join(attributes, "customer_key", "left").withColumns({
        "age": whole_years(today, F.col("birth_date")),
        "lifespan_months": _lifespan("latest_order"),
    })
    return rows.select(
        "customer_key",
        "customer_number",
        concat_skip_null(F.col("first_name"), " ", F.col("last_name")).alias("customer_name"),
        "age",
        AGE_BANDS.label(F.col("age")).alias("age_group"),
        rule.label(F.col("lifespan_months"), F.col("total_sales")).alias("customer_segments"),
        "total_orders",
        "total_sales",
        "total_quantity",
        "latest_order",
        "lifespan_months",
        whole_months(today, F.col("latest_order")).alias("recency_months"),
        _per_order().alias("avg_order_value"),
        _per_month().alias("avg_monthly_spend"),
    )


def report_products(
    fact: DataFrame, products: DataFrame, as_of: dt.date, rule: ProductRule = ProductRule()
) -> DataFrame:
    """One row per product with dated orders.

    Lines are cut to pairs of product and customer, with their sums, and to
    pairs of product and order, so a product with very many lines is spread over
    the tasks. Each kind of pairs is a shuffle of its own columns: both distinct
    counts in one aggregation would hold every line three times, with all columns.
    """
    lines, count = dated(fact), fact.count()
    pairs = spread(
        lines.select("product_key", "customer_key", "order_date", "sales_amount", "quantity"), count, "product_key", "customer_key"
    ).groupBy("product_key", "customer_key").agg(sales_sum(), quantity_sum(), *_first_and_last("last_sale_order"))
    orders = spread(lines.select("product_key", "order_number"), count, "product_key", "order_number").distinct()
    member = lambda key: F.col(key).isNotNull().cast("long")
    both = pairs.withColumns({"_customer": member("customer_key"), "_order": F.lit(0).cast("long")}).unionByName(
        orders.withColumns({"_customer": F.lit(0).cast("long"), "_order": member("order_number")}), allowMissingColumns=True
    )
    figures = both.groupBy("product_key").agg(
        F.max("last_sale_order").alias("last_sale_order"), F.min("_first").alias("_first"),
        F.sum("total_sales").alias("total_sales"), F.sum("total_quantity").alias("total_quantity"),
        F.sum("_customer").alias("total_customers"), F.sum("_order").alias("total_orders"),
    )
    return products_of(figures, products, as_of, rule)


def products_of(figures: DataFrame, products: DataFrame, as_of: dt.date, rule: ProductRule) -> DataFrame:
    """The report from first and last sale, sales, quantity, customers and orders of each product."""
    attributes = ["product_name", "category", "sub_category", "product_line", "cost"]
    rows = figures.join(products.select("product_key", *attributes), "product_key", "left").withColumn(
        "lifespan_months", _lifespan("last_sale_order")
    )
    return rows.select(
        "product_key",
        *attributes,
        "last_sale_order",
        "lifespan_months",
        whole_months(F.lit(as_of), F.col("last_sale_order")).alias("recency_months"),
        rule.label(F.col("total_sales")).alias("product_segment"),
        "total_sales",
        "total_quantity",
        "total_customers",
        "total_orders",
        ratio(F.col("total_sales"), F.col("total_quantity"), 1).alias("avg_selling_price"),
        _per_order().alias("avg_order_revenue"),
        _per_month().alias("avg_monthly_revenue"),
    )


def top_customers(report: DataFrame, n: int = 3) -> DataFrame:
    rows = report.select("customer_name", "total_sales", "customer_segments")
    return best_with_ties(rows, "total_sales", n, "rn")


def unit_margins(report: DataFrame, n: int = 5, largest: bool = True) -> DataFrame:
    """Margin per unit of the products with the highest (or lowest) revenue."""
    margin = (F.col("avg_selling_price") - F.col("cost")).cast("decimal(20,2)")
    rows = report.select(
        "product_name", "category", "product_line", "cost", "avg_selling_price",
        margin.alias("margin_per_unit"), "total_quantity", "total_sales",
    )
    return best_with_ties(rows, "total_sales", n, "rn", largest)


def reconcile(report: DataFrame, fact: DataFrame, products: DataFrame) -> DataFrame:
    """Category totals of the report next to those of the fact; the difference must be 0.

    The two sides are stacked and summed by category, so NULL meets NULL and a
    category missing on one side shows.
    """
    nothing = F.lit(None).cast("bigint")
    direct = per_member(
        dated(fact), "product_key", [F.sum("sales_amount").alias("fact_sales")], products, ["category"]
    )
    both = report.select("category", F.col("total_sales").alias("report_sales"), nothing.alias("fact_sales")).unionByName(
        direct.select("category", nothing.alias("report_sales"), "fact_sales")
    )
    return both.groupBy("category").agg(
        F.sum("report_sales").alias("report_sales"), F.sum("fact_sales").alias("fact_sales")
    ).withColumn(
        "difference",
        F.coalesce("report_sales", F.lit(0)) - F.coalesce("fact_sales", F.lit(0)),
    )
