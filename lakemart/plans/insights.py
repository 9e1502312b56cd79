"""Findings behind the narrative: mix, unsold catalog, concentration, effect of bad data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions import month_start, ratio, whole_months
from lakemart.functions.numbers import percent
from lakemart.functions.text import UNKNOWN
from lakemart.operators.measures import measure_rows, stack
from lakemart.operators.running import running_totals
from lakemart.operators.spreading import spread
from lakemart.plans.reports import unit_margins
from lakemart.plans.segments import CustomerRule, customer_segments, customer_spending
from lakemart.plans.star import dated, per_member


def _by_year_and_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    measures = [
        F.count("*").alias("lines"), F.sum("quantity").alias("units"), F.sum("sales_amount").alias("sales"),
    ]
    per_key = per_member(
        dated(fact), "product_key", measures, products, ["category"],
        F.year("order_date").alias("order_year"),
    )
    return per_key.groupBy("order_year", "category").agg(
        F.sum("lines").alias("lines"), F.sum("units").alias("units"), F.sum("sales").alias("sales")
    )


def revenue_by_year_and_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    rows = _by_year_and_category(fact, products)
    return rows.select("order_year", "category", F.col("sales").alias("total_sales")).orderBy(
        "order_year", F.col("total_sales").desc_nulls_first(), F.col("category").asc_nulls_last()
    )


def line_value_mix(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Why the average line value moves: lines, units and sales of each category in a year."""
    year = Window.partitionBy("order_year")
    rows = _by_year_and_category(fact, products)
    lines, sales = F.sum("lines").over(year), F.sum("sales").over(year)
    return rows.select(
        "order_year", "category", "lines", "units", "sales",
        ratio(F.col("sales"), F.col("lines")).alias("avg_line_value"),
        ratio(sales, lines).alias("year_avg_line_value"),
        percent(F.col("lines"), lines).alias("line_share"),
        percent(F.col("units"), F.sum("units").over(year)).alias("unit_share"),
        percent(F.col("sales"), sales).alias("sales_share"),
    )


def unsold_catalog(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Products without any sale per category, as a share of the category and of the catalog."""
    sold = fact.select("product_key").distinct().withColumn("_sold", F.lit(1))
    rows = (
        products.select("product_key", "category").join(sold, "product_key", "left")
        .groupBy("category").agg(
            F.count("*").alias("products"), F.count_if(F.col("_sold").isNull()).alias("unsold")
        )
    )
    catalog = F.sum("products").over(Window.partitionBy())  # one row per category
    return rows.select(
        "category", "products", "unsold",
        percent(F.col("unsold"), F.col("products")).alias("unsold_share"),
        percent(F.col("unsold"), catalog).alias("share_of_catalog"),
    )


def segment_concentration(fact: DataFrame, rule: CustomerRule) -> DataFrame:
    """Share of customers and revenue per segment, and revenue per customer against New."""
    rows = customer_segments(fact, rule)
    whole = Window.partitionBy()  # at most three rows
    new = F.max(F.when(F.col("customer_segments") == "New", F.col("avg_revenue"))).over(whole)
    return rows.select(
        "customer_segments", "total_customers", "total_revenue", "avg_revenue",
        percent(F.col("total_customers"), F.sum("total_customers").over(whole)).alias("customer_share"),
        percent(F.col("total_revenue"), F.sum("total_revenue").over(whole)).alias("revenue_share"),
        ratio(F.col("avg_revenue") * 100, new * 100, 1).alias("times_new"),
    )


def concentration(members: DataFrame, key: str, value: str, shares: Sequence[int] = (1, 5, 10, 20, 50, 80)) -> DataFrame:
    """How much of the amount the top members hold, and how few hold so much of it, for each share in percent.

    ``members`` has one row per ``key``. ``top_members`` is the share of all
    members, rounded up; ``fewest_members`` the smallest number of top members
    that hold the share of the amount (NULL without members). A NULL amount
    counts as 0. Exact for any number of members: places and running amounts
    come from ranges, and all shares are read off in one aggregation. Members of
    one amount may change places, which changes no figure.
    """
    amounts = members.select(key, F.coalesce(F.col(value), F.lit(0)).cast("bigint").alias("_amount"))
    ranked = running_totals(amounts, [F.col("_amount").desc(), F.col(key)], {"_place": F.lit(1), "_held": F.col("_amount")})
    whole = ranked.agg(F.count("*").alias("n"), F.sum("_amount").alias("total"))
    n, total = whole.select("n").scalar(), whole.select("total").scalar()
    figures = []
    for share in shares:
        top = F.call_function("div", n * share + 99, F.lit(100))
        reached = F.col("_held").cast("decimal(38,0)") * 100 >= total.cast("decimal(38,0)") * share
        figures += [
            F.coalesce(F.sum(F.when(F.col("_place") <= top, F.col("_amount"))), F.lit(0)).alias(f"_top_{share}"),
            F.min(F.when(reached, F.col("_place"))).alias(f"_fewest_{share}"),
        ]
    sums = ranked.agg(F.count("*").alias("members"), F.coalesce(F.sum("_amount"), F.lit(0)).alias("amount"), *figures)
    per_share = F.array(*(
        F.struct(
            F.lit(share).alias("share"),
            F.call_function("div", F.col("members") * share + 99, F.lit(100)).alias("top_members"),
            F.col(f"_top_{share}").alias("top_amount"),
            F.col(f"_fewest_{share}").alias("fewest_members"),
        )
        for share in shares
    ))
    return sums.select("amount", F.inline(per_share)).select(
        "share", "top_members", "top_amount", percent(F.col("top_amount"), F.col("amount")).alias("top_amount_share"), "fewest_members"
    )


def customer_concentration(fact: DataFrame) -> DataFrame:
    """The top shares of all buyers and their part of all sales; lines without a customer are left out."""
    known = fact.filter(F.col("customer_key").isNotNull())
    return concentration(known.groupBy("customer_key").agg(F.sum("sales_amount").alias("sales")), "customer_key", "sales")


def product_concentration(fact: DataFrame, products: DataFrame) -> DataFrame:
    """The top shares of the whole catalog, products without a sale included, and their part of the sales."""
    sold = fact.groupBy("product_key").agg(F.sum("sales_amount").alias("sales"))
    return concentration(products.select("product_key").join(sold, "product_key", "left"), "product_key", "sales")


def _markups(report: DataFrame, n: int, largest: bool) -> DataFrame:
    margin, cost = F.col("margin_per_unit"), F.col("cost")
    return unit_margins(report, n, largest).select(
        F.lit("top" if largest else "bottom").alias("revenue_group"),
        "product_name", "cost", "avg_selling_price", "margin_per_unit", "total_sales",
        percent((margin * 100).cast("bigint"), cost * 100).alias("markup_percent"),
    )


def markups(report: DataFrame, n: int = 5) -> DataFrame:
    """Markup on cost of the products with the highest and the lowest revenue."""
    return stack(_markups(report, n, True), _markups(report, n, False))


def margin_ratio(report: DataFrame, n: int = 5) -> DataFrame:
    """Average unit margin of both ends and how far they are apart."""
    cents = (F.col("margin_per_unit") * 100).cast("bigint")
    is_top = F.col("revenue_group") == "top"
    top, bottom = F.when(is_top, cents), F.when(~is_top, cents)
    sums = markups(report, n).agg(
        F.sum(top).alias("t"), F.count(top).alias("nt"), F.sum(bottom).alias("b"), F.count(bottom).alias("nb")
    )
    return sums.select(
        ratio(F.col("t"), F.col("nt") * 100).alias("top_margin"),
        ratio(F.col("b"), F.col("nb") * 100).alias("bottom_margin"),
        ratio(F.col("t") * F.col("nb"), F.col("b") * F.col("nt"), 1).alias("times_bottom"),
    )


def date_impact(fact: DataFrame) -> DataFrame:
    """What the lines without a readable date amount to, and which orders still show."""
    undated = fact.filter(F.col("order_date").isNull())
    per_order = fact.groupBy("order_number").agg(
        F.count_if(F.col("order_date").isNull()).alias("_undated"), F.count("order_date").alias("_dated")
    )
    hit = F.col("_undated") > 0
    return stack(
        measure_rows(undated, {
            "undated_lines": F.count("*"),
            "undated_sales": F.sum("sales_amount"),
            "customers": F.count_distinct("customer_key"),
            "products": F.count_distinct("product_key"),
        }),
        measure_rows(per_order, {
            "orders": F.count_if(hit),
            "orders_with_dated_line": F.count_if(hit & (F.col("_dated") > 0)),
            "orders_lost": F.count_if(hit & (F.col("_dated") == 0)),
        }),
    )


def _shares(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    counts = df.agg(
        F.count("*").alias("total"), *(F.count_if(flag).alias(name) for name, flag in flags.items())
    )
    rows = counts.unpivot(["total"], list(flags), "finding", "affected")
    return rows.select(
        "finding", "affected", "total", percent(F.col("affected"), F.col("total")).alias("affected_share")
    )


def completeness(customers: DataFrame, products: DataFrame) -> DataFrame:
    """Share of members whose attributes stayed unknown."""
    return stack(
        _shares(customers, {
            "unknown_country": F.col("country").isNull() | (F.col("country") == UNKNOWN),
            "unknown_gender": F.col("gender") == UNKNOWN,
            "no_birth_date": F.col("birth_date").isNull(),
        }),
        _shares(products, {
            "no_category": F.col("category").isNull(),
            "no_cost": F.col("cost") == 0,
        }),
    )


def segment_shift(fact: DataFrame, rule: CustomerRule) -> DataFrame:
    """Customers by segment with all lines and with dated lines only.

    First and last order ignore missing dates either way, so one aggregation
    gives both spendings; a customer without dated line has no second segment.
    """
    has_date = F.col("order_date").isNotNull()
    both = fact.groupBy("customer_key").agg(
        F.sum("sales_amount").alias("total_spending"),
        F.sum(F.when(has_date, F.col("sales_amount"))).alias("_dated_spending"),
        F.count("order_date").alias("_dated"),
        F.max("order_date").alias("_last"),
        F.min("order_date").alias("_first"),
    )
    months = whole_months(F.col("_last"), F.col("_first"))
    labelled = both.select(
        "customer_key",
        rule.label(months, F.col("total_spending")).alias("segment_all"),
        F.when(F.col("_dated") > 0, rule.label(months, F.col("_dated_spending"))).alias("segment_dated"),
    )
    return labelled.groupBy("segment_all", "segment_dated").agg(
        F.count("customer_key").alias("total_customers")
    )


def agg_sales_monthly(fact: DataFrame, products: DataFrame, rule: CustomerRule) -> DataFrame:
    """Dashboard table: month by category by customer segment, dated lines.

    Lines are reduced to customer, product and month before both joins. Those of
    a customer and product meet first, as they are few and lie anywhere in the fact.
    """
    lines = dated(fact)
    segments = customer_spending(lines).select(
        F.col("customer_key").alias("_customer"),
        rule.label(F.col("lifespan_months"), F.col("total_spending")).alias("customer_segment"),
    )
    needed = lines.select("customer_key", "product_key", month_start(F.col("order_date")).alias("order_month"), "sales_amount", "quantity")
    reduced = (
        spread(needed, fact.count(), "customer_key", "product_key").groupBy("customer_key", "product_key", "order_month")
        .agg(F.sum("sales_amount").alias("sales"), F.sum("quantity").alias("units"), F.count("*").alias("lines"))
        .join(products.select("product_key", "category"), "product_key", "left")
    )
    joined = reduced.join(segments, F.col("customer_key").eqNullSafe(F.col("_customer")), "left")
    return joined.groupBy("order_month", "category", "customer_segment").agg(
        F.sum("sales").alias("total_sales"), F.sum("units").alias("total_quantity"),
        F.sum("lines").alias("total_lines"),
    )
