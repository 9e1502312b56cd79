"""Best and worst members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_with_ties(
    df: DataFrame, measure: str, n: int, rank: str, largest: bool = True
) -> DataFrame:
    """Rows whose ``measure`` is among the ``n`` best distinct values, with their dense rank.

    A missing measure ranks first among the largest and last among the
    smallest. Only the ``n`` distinct values are ordered and broadcast; rows
    that share a value, however many, stay where they are.
    """
    order = F.col("_value").desc_nulls_first() if largest else F.col("_value").asc_nulls_last()
    values = df.select(F.col(measure).alias("_value")).distinct().orderBy(order).limit(n)
    ranked = values.withColumn(rank, F.row_number().over(Window.orderBy(order)))
    return df.join(
        F.broadcast(ranked), F.col(measure).eqNullSafe(F.col("_value"))
    ).drop("_value")


def first_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """Exactly ``n`` rows by an order that leaves no ties open."""
    return df.orderBy(*order).limit(n)
