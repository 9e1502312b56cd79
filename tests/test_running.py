"""Running totals in ranges, and the concentration figures made of them."""

import contextlib
import io
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakemart.operators.running import running_totals
from lakemart.plans.insights import concentration
from lakemart.sources.files import scratch_space

SCHEMA = "id int, day int, kind string, amount int"


def lines(spark, n, seed=1, hot=0):
    """``hot`` of ten lines fall on one day and kind."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        busy = rng.randrange(10) < hot
        day = 7 if busy else rng.choice([None, *range(30)])
        kind = "a" if busy else rng.choice(["a", "b", "c", None])
        rows.append((i, day, kind, rng.choice([None, rng.randrange(-50, 100)])))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("by", [(), ("kind",), ("kind", "day")])
@pytest.mark.parametrize("hot", [0, 6])
def test_like_a_window(spark, by, hot):
    df = lines(spark, 900, hot=hot)
    window = Window.partitionBy(*by).orderBy("day", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    expected = df.select(
        "*", F.coalesce(F.sum("amount").over(window), F.lit(0)).alias("total"), F.row_number().over(window).cast("long").alias("place")
    )
    with scratch_space(spark):
        found = running_totals(df, ["day", "id"], {"total": F.col("amount"), "place": F.lit(1)}, by)
        assert found.columns == expected.columns
        assert rows(found) == rows(expected)


def test_descending_and_equal_rows(spark):
    df = spark.createDataFrame([(5,)] * 40 + [(9,)] * 3 + [(None,)], "v int")
    with scratch_space(spark):
        found = running_totals(df, [F.col("v").desc_nulls_last()], {"total": F.col("v"), "place": F.lit(1)})
        totals = [r["total"] for r in found.orderBy("place").collect()]
    assert totals == [9, 18, 27, *(27 + 5 * i for i in range(1, 41)), 227]


def test_no_rows(spark):
    with scratch_space(spark):
        assert running_totals(lines(spark, 0), ["id"], {"total": F.col("amount")}).collect() == []


def test_no_task_takes_all_rows(spark):
    """Only the sums of the ranges, one row each, come together in one task."""
    with scratch_space(spark):
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            running_totals(lines(spark, 500), ["day", "id"], {"total": F.col("amount")}).explain("simple")
        plan = text.getvalue()
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert len(single) <= 1  # below the broadcast of the starts
    assert "hashpartitioning(_part" in plan and "BroadcastHashJoin" in plan


def plain(values, share):
    """Members and amount of the top share, and the fewest members that hold as much of the amount."""
    ranked = sorted((v or 0 for v in values), reverse=True)
    top = -(-len(ranked) * share // 100)
    total, run, fewest = sum(ranked), 0, None
    for place, v in enumerate(ranked, 1):
        run += v
        if fewest is None and run * 100 >= total * share:
            fewest = place
    return share, top, sum(ranked[:top]), fewest


@pytest.mark.parametrize("values", [[10, 0, None, 5, 5, 5, 80], [3] * 17, [1], [100, *range(40)]])
def test_concentration(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "k int, v int")
    with scratch_space(spark):
        found = concentration(df, "k", "v", (1, 20, 50, 100)).collect()
    assert [(r["share"], r["top_members"], r["top_amount"], r["fewest_members"]) for r in found] == [
        plain(values, s) for s in (1, 20, 50, 100)
    ]


def test_concentration_of_nobody(spark):
    df = spark.createDataFrame([], "k int, v int")
    with scratch_space(spark):
        found = concentration(df, "k", "v", (10,)).collect()
    assert [tuple(r) for r in found] == [(10, 0, 0, None, None)]
