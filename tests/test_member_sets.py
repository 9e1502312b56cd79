"""Distinct counts from stored sets."""

import random

from pyspark.sql import functions as F

from lakemart.operators.member_sets import distinct_counts, member_sets, merged_sets
from lakemart.plans import star
from lakemart.sources.files import scratch_space

SCHEMA = "day int, kind string, a long, b int"


def lines(spark, n, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        a = rng.choice([None, 0, -1, -32768, 1, 32768, 32769, 2**40, rng.randrange(-70_000, 70_000)])
        rows.append((rng.choice([1, 2, 3, None]), rng.choice(["x", "y", None]), a, rng.randrange(5) or None))
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def counted(df, *by):
    return df.groupBy(*by).agg(F.count_distinct("a").alias("as_"), F.count_distinct("b").alias("bs"))


def test_counts_for_any_group(spark):
    df = lines(spark, 1500, 1).cache()
    sets = member_sets(df, ["day", "kind"], {"a": "a", "b": "b"}).cache()
    names = {"a": "as_", "b": "bs"}
    for by in (["day"], ["kind"], ["day", "kind"], []):
        assert rows(distinct_counts(sets, by, names)) == rows(counted(df, *by))
    odd = (F.col("day") % 2).alias("odd")
    assert rows(distinct_counts(sets, [odd], names)) == rows(counted(df, odd))
    assert sets.agg(F.max(F.octet_length("bits"))).first()[0] == 4096  # a row doesn't grow


def test_sets_of_loads_are_merged(spark):
    """Sets of new lines are put to the stored ones, old lines aren't read again."""
    first, second = lines(spark, 600, 2), lines(spark, 300, 3)
    by, members = ["day", "kind"], {"a": "a", "b": "b"}
    together = merged_sets(member_sets(first, by, members).union(member_sets(second, by, members)), by)
    assert rows(distinct_counts(together, ["day"], {"a": "as_", "b": "bs"})) == rows(counted(first.union(second), "day"))


def test_sets_without_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    sets = member_sets(empty, ["day"], {"a": "a"})
    assert sets.count() == 0 and distinct_counts(sets, ["day"], {"a": "n"}).count() == 0


def test_members_meet_before_bitmaps_are_made(spark):
    """No bitmap of one task's members is moved, and AQE doesn't merge the members, which are small until they are sorted."""
    sets = member_sets(lines(spark, 300, 4), ["day", "kind"], {"a": "a", "b": "b"})
    text = sets._jdf.queryExecution().executedPlan().toString()
    assert text.count("REPARTITION_BY_NUM") == 4 and "ENSURE_REQUIREMENTS" not in text


def test_orders_of_a_month_lie_together(spark):
    """Order numbers that take turns in three months: a month has bitmaps of its own share of the orders only."""
    n = F.col("id")
    fact = spark.range(70_000).select(
        F.concat(F.lit("SO"), n).alias("order_number"), (n % 7).alias("product_key"), (n % 5).alias("customer_key"),
        F.add_months(F.lit("1997-01-15").cast("date"), (n % 3).cast("int")).alias("order_date"),
    )
    more = fact.limit(1).select(
        F.explode(F.array(F.lit("SO1"), F.lit("SO2"), F.lit(None).cast("string"))).alias("order_number"), "product_key", "customer_key",
        F.lit(None).cast("date").alias("order_date"),
    )
    products = spark.range(7).select(F.col("id").alias("product_key"), F.lit("Bikes").alias("category"))
    with scratch_space(spark):
        sets = star.member_sets_by_month(fact.unionByName(more), products).cache()
        assert sets.filter("member = 'order'").count() <= 7
        found = {str(r["month"]): tuple(r)[1:] for r in star.reach(sets, "month").collect()}
        assert tuple(star.reach(sets).first()) == (5, 70_000, 7)
    each = {f"1997-0{m + 1}-01": (5, len(range(m, 70_000, 3)), 7) for m in range(3)}
    assert found == each | {"None": (1, 2, 1)}
