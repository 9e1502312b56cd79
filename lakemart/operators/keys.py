"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.sources.files import scratch_folder


def add_dense_key(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """Number the rows 1, 2, 3, … in the given order, without one task sorting all of them.

    Rows are range-partitioned, sorted inside their partition and written once,
    with partition number and place. The files are read for the partition
    counts and for the result, so both see the same split even if executors are
    lost. A row's number is its place in its partition plus the sizes of the
    partitions before; the latter is a table of one row per partition, the only
    thing broadcast. The files go when the enclosing ``scratch_space`` ends.

    ``order`` should identify a row, else the order of equal rows is open.
    """
    spark = df.sparkSession
    # The id holds the partition number above 33 bits for the place inside it.
    place = F.monotonically_increasing_id()
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        F.shiftright(place, 33).alias("_part"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"), *df.columns
    )
    folder = scratch_folder(spark)
    placed.write.parquet(folder)
    placed = spark.read.schema(placed.schema).parquet(folder)
    before = Window.orderBy("_first_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(F.col("_part").alias("_first_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_first_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    return placed.join(F.broadcast(offsets), F.col("_part") == F.col("_first_part")).select(
        (F.col("_before") + F.col("_row") + 1).alias(name), *df.columns
    )
