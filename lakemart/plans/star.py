"""Aggregation over the star: the fact is reduced by its own key before a dimension is joined.

The keys in the fact come from the dimensions, so a key that is not NULL always
resolves. Reducing first means the join never sees more than one row per key,
which makes hot products and customers (and the NULL key) harmless.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import month_start
from lakemart.operators.keys import add_dense_key
from lakemart.operators.member_sets import distinct_counts, member_sets
from lakemart.sources.files import scratch_folder


def dated(fact: DataFrame) -> DataFrame:
    """Lines with a readable order date; pushed into the scan."""
    return fact.filter(F.col("order_date").isNotNull())


def per_member(
    fact: DataFrame, key: str, measures: Sequence[Column], dimension: DataFrame,
    attributes: Sequence[str], *more_keys: Column,
) -> DataFrame:
    """Aggregate by dimension key (and ``more_keys``), then look the attributes up."""
    reduced = fact.groupBy(key, *more_keys).agg(*measures)
    return reduced.join(dimension.select(key, *attributes), key, "left")


def sales_sum() -> Column:
    return F.sum("sales_amount").alias("total_sales")


def quantity_sum() -> Column:
    return F.sum("quantity").alias("total_quantity")


def member_sets_by_month(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Per month and category the sets of customers, orders and products, to be merged for any period or category.

    Order numbers are texts, so orders are numbered first: in the order of their
    first months, as the orders of a month then share few buckets. Undated lines
    have a NULL month, lines without a category a NULL category. The lines are
    written once, with numbers only, for the sets to be read off. To be used
    inside a ``scratch_space``.
    """
    month = month_start(F.col("order_date")).alias("month")
    first = fact.filter(F.col("order_number").isNotNull()).groupBy("order_number").agg(F.min(month).alias("_month"))
    orders = add_dense_key(first, "_order", F.col("_month"), F.col("order_number")).select("order_number", "_order")
    lines = (
        fact.select(month, "product_key", "customer_key", "order_number").join(orders, "order_number", "left")
        .join(products.select("product_key", "category"), "product_key", "left").drop("order_number")
    )
    folder = scratch_folder(fact.sparkSession)
    lines.write.parquet(folder)
    lines = fact.sparkSession.read.schema(lines.schema).parquet(folder)
    return member_sets(lines, ["month", "category"], {"customer": "customer_key", "order": "_order", "product": "product_key"})


#: What the sets count, and the names of the figures.
REACH = {"customer": "total_customers", "order": "total_orders", "product": "total_products"}


def reach(sets: DataFrame, *by: Column | str) -> DataFrame:
    """Different customers, orders and products per period or category (all in one without any), from stored sets."""
    return distinct_counts(sets, by, REACH)
