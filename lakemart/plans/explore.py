"""First look at the star schema: domains, ranges, key figures, totals and rankings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import ratio, whole_years
from lakemart.operators.measures import measure_rows, stack
from lakemart.operators.ranking import best_with_ties, first_rows
from lakemart.plans.star import dated, per_member


def countries(customers: DataFrame) -> DataFrame:
    return customers.select("country").distinct()


def product_tree(products: DataFrame) -> DataFrame:
    names = ["category", "sub_category", "product_line", "product_name"]
    rows = products.select(*names).distinct()
    return rows.orderBy(*(F.col(n).asc_nulls_last() for n in names[:3]))


def order_range(fact: DataFrame) -> DataFrame:
    """First and last order with the calendar (not elapsed) difference in years and months."""
    ends = fact.agg(F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order"))
    first, last = F.col("first_order"), F.col("last_order")
    years = F.year(last) - F.year(first)
    return ends.select(
        first, last, years.alias("order_range_years"),
        (years * 12 + F.month(last) - F.month(first)).alias("order_range_months"),
    )


def birth_range(customers: DataFrame, as_of: dt.date) -> DataFrame:
    ends = customers.agg(
        F.min("birth_date").alias("oldest_birth_date"), F.max("birth_date").alias("youngest_birth_date")
    )
    today = F.lit(as_of)
    return ends.withColumns({
        "oldest_age": whole_years(today, F.col("oldest_birth_date")),
        "youngest_age": whole_years(today, F.col("youngest_birth_date")),
    })


def average_price() -> Column:
    return ratio(F.sum("price"), F.count("price"))


def key_figures(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """All single figures, one aggregation per table."""
    return stack(
        measure_rows(fact, {
            "total_sales": F.sum("sales_amount"),
            "total_items_sold": F.sum("quantity"),
            "avg_selling_price": average_price(),
            "total_order_lines": F.count("order_number"),
            "total_orders": F.count_distinct("order_number"),
        }),
        measure_rows(fact, {"customers_with_orders": F.count_distinct("customer_key")}),
        measure_rows(products, {
            "total_products": F.count("product_name"),
            "total_distinct_products": F.count_distinct("product_name"),
        }),
        measure_rows(customers, {"total_customers": F.count("customer_key")}),
    )


def _sheet(fact: DataFrame, products: DataFrame) -> list[DataFrame]:
    return [
        measure_rows(fact, {
            "Total Sales": F.sum("sales_amount"),
            "Total Quantity Sold": F.sum("quantity"),
            "Avg Selling Price": average_price(),
            "Total Orders": F.count_distinct("order_number"),
        }),
        measure_rows(products, {"Total Products": F.count_distinct("product_name")}),
    ]


def kpi_sheet(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    return stack(*_sheet(fact, products),
                 measure_rows(customers, {"Total Customers": F.count("customer_key")}))


def kpi_sheet_dated(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Dated lines only; customers are those with a dated order."""
    return stack(*_sheet(dated(fact), products),
                 measure_rows(buyers(dated(fact), customers), {"Total Customers": F.count("customer_key")}))


def buyers(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers with at least one line: the fact is reduced to its keys before the join."""
    return customers.select("customer_key").join(
        fact.select("customer_key").distinct(), "customer_key", "left_semi"
    )


def members_by(dimension: DataFrame, attribute: str, key: str, name: str) -> DataFrame:
    """Number of members per attribute value, largest first; NULL is its own group."""
    counted = dimension.groupBy(attribute).agg(F.count(key).alias(name))
    return counted.orderBy(F.col(name).desc(), F.col(attribute).asc_nulls_last())


def average_cost_by_category(products: DataFrame) -> DataFrame:
    rows = products.groupBy("category").agg(ratio(F.sum("cost"), F.count("cost")).alias("avg_cost"))
    return rows.orderBy(F.col("avg_cost").desc_nulls_first(), F.col("category").asc_nulls_last())


def revenue_by_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Seen from the fact: only categories that were sold."""
    sums = per_member(fact, "product_key", [F.sum("sales_amount").alias("revenue")], products, ["category"])
    return _revenue(sums)


def revenue_by_category_of_catalog(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Seen from the products: unsold categories stay with a NULL revenue."""
    sums = fact.groupBy("product_key").agg(F.sum("sales_amount").alias("revenue"))
    return _revenue(products.select("product_key", "category").join(sums, "product_key", "left"))


def _revenue(per_product: DataFrame) -> DataFrame:
    rows = per_product.groupBy("category").agg(F.sum("revenue").alias("total_revenue"))
    return rows.orderBy(F.col("total_revenue").desc_nulls_first(), F.col("category").asc_nulls_last())


def units_by_country(fact: DataFrame, customers: DataFrame) -> DataFrame:
    sums = per_member(fact, "customer_key", [F.sum("quantity").alias("units")], customers, ["country"])
    rows = sums.groupBy("country").agg(F.sum("units").alias("total_quantity"))
    return rows.orderBy(F.col("total_quantity").desc_nulls_first(), F.col("country").asc_nulls_last())


def product_ranking(fact: DataFrame, products: DataFrame, n: int = 5, largest: bool = True) -> DataFrame:
    """The n best (or worst) products by revenue, ties included."""
    names = ["category", "product_line", "product_name"]
    sums = per_member(fact, "product_key", [F.sum("sales_amount").alias("revenue")], products, names)
    rows = sums.groupBy(*names).agg(F.sum("revenue").alias("total_revenue"))
    return best_with_ties(rows, "total_revenue", n, "prod_rank", largest)


def customer_ranking(fact: DataFrame, customers: DataFrame, n: int = 10) -> DataFrame:
    """Ranked by key first, so names are looked up for the winners only."""
    sums = fact.groupBy("customer_key").agg(F.sum("sales_amount").alias("total_revenue"))
    best = best_with_ties(sums, "total_revenue", n, "cust_rank")
    names = customers.select("customer_key", "first_name", "last_name")
    return best.join(names, "customer_key", "left").select(
        "customer_key", "first_name", "last_name", "total_revenue", "cust_rank"
    )


def fewest_orders(fact: DataFrame, customers: DataFrame, n: int = 3) -> DataFrame:
    """Customers with the fewest orders; equal counts go by key."""
    counts = fact.groupBy("customer_key").agg(F.count_distinct("order_number").alias("total_orders"))
    order = [F.col("total_orders").asc(), F.col("customer_key").asc_nulls_last()]
    names = customers.select("customer_key", "first_name", "last_name")
    return first_rows(counts, n, *order).join(names, "customer_key", "left").select(
        "customer_key", "first_name", "last_name", "total_orders"
    ).orderBy(*order)
