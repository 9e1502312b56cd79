"""Change over time, running totals, year over year, shares.

Windows run over aggregated rows only: at most one per calendar period, or one
per product name and year. Running totals of single lines are summed in ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions import month_label, month_start, percent_text, ratio, wide_ratio, year_start
from lakemart.functions.numbers import percent
from lakemart.operators.running import running_totals
from lakemart.plans.star import dated, per_member, quantity_sum, sales_sum


def _by_period(fact: DataFrame, *periods: Column) -> DataFrame:
    return dated(fact).groupBy(*periods).agg(
        sales_sum(), F.count_distinct("customer_key").alias("total_customers"), quantity_sum()
    )


def sales_by_year(fact: DataFrame) -> DataFrame:
    return _by_period(fact, F.year("order_date").alias("order_year")).orderBy("order_year")


def sales_by_calendar_month(fact: DataFrame) -> DataFrame:
    """Seasonality: each month summed over all years."""
    rows = _by_period(fact, F.month("order_date").alias("_month"), month_label(F.col("order_date")).alias("order_month"))
    return rows.orderBy("_month").drop("_month")


def sales_by_year_and_month(fact: DataFrame) -> DataFrame:
    rows = _by_period(
        fact, F.year("order_date").alias("order_year"), F.month("order_date").alias("_month"),
        month_label(F.col("order_date")).alias("order_month"),
    )
    return rows.orderBy("order_year", "_month").drop("_month")


def sales_by_month_start(fact: DataFrame) -> DataFrame:
    return _by_period(fact, month_start(F.col("order_date")).alias("order_month")).orderBy("order_month")


def sales_by_quarter(fact: DataFrame) -> DataFrame:
    return _by_period(
        fact, F.year("order_date").alias("order_year"), F.quarter("order_date").alias("order_quarter")
    ).orderBy("order_year", "order_quarter")


def _running(fact: DataFrame, period: Column, name: str, *restart: Column) -> DataFrame:
    rows = dated(fact).groupBy(period.alias(name)).agg(
        sales_sum(), wide_ratio(F.sum("price"), F.count("price")).alias("_price")
    )
    window = Window.partitionBy(*restart).orderBy(name)
    return rows.select(
        name,
        "total_sales",
        F.sum("total_sales").over(window).alias("running_sales"),
        F.round("_price", 2).cast("decimal(20,2)").alias("avg_price"),
        F.round(F.avg("_price").over(window), 2).cast("decimal(20,2)").alias("moving_avg_price"),
    )


def running_by_year(fact: DataFrame) -> DataFrame:
    """Running total and the mean of the yearly mean prices so far."""
    return _running(fact, year_start(F.col("order_date")), "order_year")


def running_by_month(fact: DataFrame) -> DataFrame:
    """The same by month, starting anew each year."""
    return _running(fact, month_start(F.col("order_date")), "order_date", F.year("order_date"))


_LINE = ["order_date", "order_number", "product_key", "customer_key", "shipping_date", "due_date", "quantity", "price", "sales_amount"]


def running_by_line(fact: DataFrame, restart: Column | None = None) -> DataFrame:
    """Sales so far and the mean price so far at every dated line, by order date; anew for each ``restart`` period.

    As many rows as lines, so the series is summed in ranges. Lines of a day
    follow by order number and the remaining columns.
    """
    lines = dated(fact).select(*_LINE)
    totals = {"running_sales": F.col("sales_amount"), "_prices": F.col("price"), "_priced": F.when(F.col("price").isNotNull(), 1)}
    if restart is not None:
        lines = lines.withColumn("_period", restart)
    rows = running_totals(lines, _LINE, totals, [] if restart is None else ["_period"])
    return rows.select(
        "order_date", "order_number", "product_key", "sales_amount", "running_sales",
        ratio(F.col("_prices"), F.col("_priced")).alias("moving_avg_price"),
    )


def _sign_label(difference: Column, above: str, below: str, same: str) -> Column:
    return F.when(difference > 0, above).when(difference < 0, below).otherwise(same)


def product_year_over_year(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Each product's year against its own average year and against the year before."""
    per_key = per_member(
        dated(fact), "product_key", [F.sum("sales_amount").alias("_sales")], products,
        ["product_name"], year_start(F.col("order_date")).alias("order_year"),
    )
    yearly = per_key.groupBy("product_name", "order_year").agg(F.sum("_sales").alias("current_sales"))
    product = Window.partitionBy("product_name")
    average = wide_ratio(
        F.sum("current_sales").over(product), F.count("current_sales").over(product)
    )
    sales = F.col("current_sales")
    rows = yearly.withColumns({
        "_average": average,
        "prev_yr_sales": F.lag("current_sales").over(product.orderBy("order_year")),
    })
    over_average, over_previous = sales - F.col("_average"), sales - F.col("prev_yr_sales")
    return rows.select(
        "order_year",
        "product_name",
        "current_sales",
        F.round("_average", 2).cast("decimal(20,2)").alias("avg_sales_prod"),
        F.round(over_average, 2).cast("decimal(20,2)").alias("diff_avg"),
        _sign_label(over_average, "Above Avg", "Below Avg", "Avg").alias("avg_change"),
        "prev_yr_sales",
        over_previous.alias("diff_prev_yr"),
        _sign_label(over_previous, "Increase", "Decrease", "No Change").alias("prev_yr_change"),
    ).orderBy(F.col("product_name").asc_nulls_last(), "order_year")


def category_shares(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Share of each category in sales and units, largest first (ordered by the number, not the text)."""
    sums = per_member(fact, "product_key", [sales_sum(), quantity_sum()], products, ["category"])
    rows = sums.groupBy("category").agg(
        F.sum("total_sales").alias("total_sales"), F.sum("total_quantity").alias("total_quantity")
    )
    whole = Window.partitionBy()  # one row per category
    rows = rows.select(
        "category",
        "total_sales",
        F.sum("total_sales").over(whole).alias("overall_sales"),
        "total_quantity",
        F.sum("total_quantity").over(whole).alias("overall_quantity"),
    )
    sales_share = percent(F.col("total_sales"), F.col("overall_sales"))
    unit_share = percent(F.col("total_quantity"), F.col("overall_quantity"))
    return rows.orderBy(sales_share.desc_nulls_first(), F.col("category").asc_nulls_last()).select(
        "category",
        "total_sales",
        "overall_sales",
        percent_text(sales_share).alias("percentage_of_total_sales"),
        "total_quantity",
        "overall_quantity",
        percent_text(unit_share).alias("percentage_of_total_quantity"),
    )
