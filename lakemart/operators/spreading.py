"""Rows dealt to so many tasks that none holds more than a fixed number, however large the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

ROWS_A_TASK = 500_000


def tasks_for(rows: int, spark_partitions: int, rows_a_task: int = ROWS_A_TASK) -> int:
    """As many as any shuffle has, and more where a task would get too many rows."""
    return max(spark_partitions, -(-rows // rows_a_task))


def spread(df: DataFrame, rows: int, *columns: Column | str) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt by the hash of ``columns``.

    What is grouped by these columns and others afterwards moves no more. AQE
    doesn't merge partitions whose number is given: rows of few bytes would
    else be merged to tens of megabytes, which are gigabytes once they are
    hashed or sorted.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks_for(rows, partitions), *columns)
