"""Several records of one entity: keep the latest, or date the versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, key: str, recency: str, tie_break: Sequence[str] | None = None
) -> DataFrame:
    """One row per non-NULL key, the one with the latest ``recency``.

    A missing recency counts as latest. Ties are decided by the other columns,
    so the result does not depend on input order. Spark cuts every input
    partition to one row per key (WindowGroupLimit) before the shuffle, hence a
    key with very many copies does not load one task.
    """
    ties = tie_break if tie_break is not None else [c for c in df.columns if c not in (key, recency)]
    order = [F.col(recency).desc_nulls_first(), *(F.col(c).asc_nulls_last() for c in ties)]
    window = Window.partitionBy(key).orderBy(*order)
    return (
        df.filter(F.col(key).isNotNull())
        .withColumn("_position", F.row_number().over(window))
        .filter(F.col("_position") == 1)
        .drop("_position")
    )


def date_versions(
    df: DataFrame, key: str, start: str, end: str, tie_break: Sequence[str] | None = None
) -> DataFrame:
    """Set ``end`` to the day before the next version of the same key starts.

    The last version stays open (NULL). Versions with equal start are ordered by
    ``tie_break``, by default all other columns.

    Within a key only the last row of a calendar day looks to another day; all
    others are followed by a row of their own day. So the window runs over one
    row per key and day, which an ordinary aggregation finds together with all
    its columns, and is bounded by the calendar however many versions a key has.
    That row is written out from there. Taken off the input as a row with count
    -1, it leaves the others, identical ones as one row with a count.
    """
    rows = df.drop(end)
    ties = tie_break if tie_break is not None else [c for c in rows.columns if c not in (key, start)]
    position = F.struct(start, *ties, *(c for c in rows.columns if c not in (key, start, *ties)))
    day = F.col(start).cast("date")

    days = rows.groupBy(F.col(key).alias("_key"), day.alias("_day")).agg(F.max(position).alias("_last"))
    by_day = Window.partitionBy("_key").orderBy(F.col("_day").asc_nulls_last())
    last = days.withColumn(end, F.date_sub(F.lead("_day").over(by_day), 1)).select(
        *((F.col("_key") if c == key else F.col("_last")[c]).alias(c) for c in rows.columns), end
    )
    counted = rows.withColumn("_copies", F.lit(1)).unionByName(
        last.select(*rows.columns, F.lit(-1).alias("_copies"))
    ).groupBy(*rows.columns).agg(F.sum("_copies").alias("_copies"))
    others = repeat_rows(counted, "_copies").withColumn(end, F.date_sub(day, 1))
    return last.unionByName(others).select(*(c for c in df.columns if c != end), end)


def repeat_rows(df: DataFrame, times: str, at_once: int = 100_000) -> DataFrame:
    """Each row ``times`` times. Rows repeated more than ``at_once`` times are cut into pieces that are dealt out."""
    kept = [c for c in df.columns if c != times]

    def written(rows: DataFrame, number: str) -> DataFrame:
        return rows.select(*kept, F.explode(F.sequence(F.lit(1), F.col(number).cast("int"))).alias("_n")).drop("_n")

    few = df.filter(F.col(times).between(1, at_once))
    many = df.filter(F.col(times) > at_once).select(
        *df.columns,
        F.explode(F.sequence(F.lit(0), F.call_function("div", F.col(times) - 1, F.lit(at_once)))).alias("_piece"),
    )
    size = F.least(F.col(times) - F.col("_piece") * at_once, F.lit(at_once)).cast("int")
    # As many tasks as any shuffle has: AQE would merge the pieces, which are small until they are repeated.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = many.withColumn("_size", size).repartition(tasks, "_piece", *df.columns)
    return written(few, times).unionByName(written(spread, "_size"))
