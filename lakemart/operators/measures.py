"""Key figures: one aggregation, shown as one row per figure."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame

MEASURE_TYPE = "decimal(20,2)"


def measure_rows(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """Aggregate ``df`` once and return (measure_name, measure_value) rows."""
    row = df.agg(*(c.cast(MEASURE_TYPE).alias(name) for name, c in measures.items()))
    return row.unpivot([], list(measures), "measure_name", "measure_value")


def stack(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)

