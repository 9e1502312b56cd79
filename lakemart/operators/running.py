"""Running totals over a series that is too long for one task.

A window without partitions puts all rows into one task. Here the rows are cut
into ranges of the order; each range is summed on its own, and a range's start is
the sum of the ranges before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.sources.files import scratch_folder

_PLACE_BITS = 33


def running_totals(
    df: DataFrame, order: Sequence[Column | str], totals: Mapping[str, Column], by: Sequence[str] = ()
) -> DataFrame:
    """The rows with the sum of each of ``totals`` up to and with the row, starting anew for each ``by``.

    A NULL adds nothing and a total begins at 0; ``F.lit(1)`` gives the place.
    ``order`` should identify a row, else the order of equal rows is open; then
    any number of rows with one leading value (a busy day) is cut into ranges, too.

    The rows are written once, so that the sums of the ranges and the rows see
    the same cut even if executors are lost, and moved a second time, by range.
    Groups lie one after another in the ranges, so a range begins inside one
    group at most: the starts that are broadcast are never more than the ranges.
    The files go when the enclosing ``scratch_space`` ends.
    """
    spark = df.sparkSession
    groups = [F.col(c) for c in by]
    values = {f"_value_{i}": value for i, value in enumerate(totals.values())}
    place = F.monotonically_increasing_id()  # the partition's number above the place inside it
    placed = df.withColumns(values).repartitionByRange(*groups, *order).sortWithinPartitions(*groups, *order).select(
        "*", F.shiftright(place, _PLACE_BITS).alias("_part"), place.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("_row")
    )
    folder = scratch_folder(spark)
    placed.write.parquet(folder)
    placed = spark.read.schema(placed.schema).parquet(folder)

    earlier = Window.partitionBy(*by).orderBy("_part")
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(*by, "_part").agg(*(F.sum(v).alias(v) for v in values))
    starts = sums.select(
        *(F.col(c).alias(f"_of_{c}") for c in by),
        F.col("_part").alias("_of_part"),
        *(F.sum(v).over(before).alias(f"_before{v}") for v in values),
        F.row_number().over(earlier).alias("_nth"),
    ).filter(F.col("_nth") > 1).drop("_nth")
    same = F.col("_part") == F.col("_of_part")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    inside = Window.partitionBy("_part", *by).orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nothing = F.lit(0)
    return placed.join(F.broadcast(starts), same, "left").select(
        *df.columns,
        *(
            (F.coalesce(F.col(f"_before{v}"), nothing) + F.coalesce(F.sum(v).over(inside), nothing)).alias(name)
            for name, v in zip(totals, values, strict=True)
        ),
    )
