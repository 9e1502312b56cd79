import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakemart.operators import checks
from lakemart.operators.history import date_versions, latest_per_key, repeat_rows
from lakemart.operators.keys import add_dense_key
from lakemart.operators.measures import measure_rows
from lakemart.operators.ranking import best_with_ties, first_rows

D = dt.date


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _plain_versions(df):
    window = Window.partitionBy("k").orderBy(F.col("start").asc_nulls_last(), "id")
    return df.withColumn("end", F.date_sub(F.lead("start").over(window).cast("date"), 1))


def test_date_versions_equals_plain_lead(spark):
    """Many versions of one key, several per day, missing starts and a missing key."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 else rng.choice(["a", "b", None])
        start = dt.datetime(2020, 1, 1) + dt.timedelta(hours=rng.randrange(2400))
        rows.append((i, key, None if rng.random() < 0.01 else start))
    df = spark.createDataFrame(rows, "id int, k string, start timestamp_ntz").repartition(7)
    assert rows_of(date_versions(df, "k", "start", "end")) == rows_of(_plain_versions(df))


def test_date_versions_with_a_third_of_copies(spark):
    at = dt.datetime
    rows = [(i, f"k{i % 40}", at(2020, 1, 1 + i % 9)) for i in range(600)] + [(700, "k1", at(2020, 1, 4))] * 150
    rows += [(701, "k2", at(2020, 3, 1))] * 150
    df = spark.createDataFrame(rows, "id int, k string, start timestamp_ntz")
    got = date_versions(df, "k", "start", "end")
    assert rows_of(got) == rows_of(_plain_versions(df))
    assert got.filter("k = 'k2' and end is null").count() == 1


def test_repeat_rows_in_pieces(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 25), ("d", 10)], "k string, n bigint")
    got = repeat_rows(df, "n", at_once=10).groupBy("k").count()
    assert rows_of(got) == [("b", 1), ("c", 25), ("d", 10)]


def test_latest_per_key_with_a_hot_key(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"),
        F.date_add(F.lit(D(2020, 1, 1)), (F.col("id") % 700).cast("int")).alias("d"),
        F.col("id").alias("v"),
    )
    window = Window.partitionBy("k").orderBy(F.col("d").desc_nulls_first(), "v")
    plain = df.withColumn("n", F.row_number().over(window)).filter("n = 1").drop("n")
    assert rows_of(latest_per_key(df, "k", "d")) == rows_of(plain)


def test_dense_key_over_many_partitions(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"), (F.col("id") % 3).alias("g"))
    got = add_dense_key(df.repartition(9), "key", F.col("g").asc(), F.col("v").desc())
    window = Window.orderBy(F.col("g").asc(), F.col("v").desc())
    plain = df.select(F.row_number().over(window).cast("bigint").alias("key"), "v", "g")
    assert rows_of(got) == rows_of(plain)
    assert rows_of(got) == rows_of(got)


def test_dense_key_of_nothing(spark):
    empty = spark.createDataFrame([], "v int")
    assert add_dense_key(empty, "key", F.col("v")).count() == 0


def _ranked(df, measure, n, ascending):
    order = F.col(measure).asc_nulls_last() if ascending else F.col(measure).desc_nulls_first()
    return df.withColumn("rk", F.dense_rank().over(Window.orderBy(order))).filter(F.col("rk") <= n)


def test_best_with_ties(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 3), ("d", None), ("e", 1), ("f", 1), ("g", None)], "m string, v int")
    for n in (1, 2, 3, 20):
        for largest in (True, False):
            assert rows_of(best_with_ties(df, "v", n, "rk", largest)) == rows_of(_ranked(df, "v", n, not largest))


def test_first_rows(spark):
    df = spark.createDataFrame([(2, 1), (1, 1), (3, 0)], "k int, v int")
    assert [r["k"] for r in first_rows(df, 2, F.col("v"), F.col("k")).collect()] == [3, 1]


def test_measure_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 4)], "k string, v int")
    got = {r[0]: float(r[1]) for r in measure_rows(df, {
        "lines": F.count("*"), "values": F.count("v"), "keys": F.count_distinct("k"), "sum": F.sum("v"),
    }).collect()}
    assert got == {"lines": 3, "values": 2, "keys": 2, "sum": 5}


def test_check_table(spark):
    df = spark.createDataFrame(
        [(1, " a", 5, D(2020, 1, 2), D(2020, 1, 1)), (1, "b", -1, None, None), (None, "c", None, None, None)],
        "id int, name string, cost int, a date, b date")
    rules = [
        checks.KeyRule("key", "id"),
        checks.RowRule("blanks", checks.untrimmed("name")),
        checks.RowRule("cost", checks.missing_or_negative("cost")),
        checks.RowRule("dates", checks.ends_before_start("a", "b")),
        checks.RowRule("codes", checks.not_among("name", "b", "c")),
        checks.RowRule("future", checks.in_future("a", D(2021, 1, 1))),
    ]
    result = {r["check_name"]: r for r in checks.check_table(df, "bronze", "t", rules).collect()}
    assert {k: r["violations"] for k, r in result.items()} == {
        "key": 2, "blanks": 1, "cost": 2, "dates": 1, "codes": 1, "future": 0}
    assert result["future"]["passed"] and not result["key"]["passed"]
    assert rows_of(checks.violations(df, rules[0])) == rows_of(
        spark.createDataFrame([(1, 2), (None, 1)], "id int, rows bigint"))


def test_bad_day_number(values):
    rows = [(20101229,), (0,), (-5,), (32154,), (20140230,), (18991231,), (20600101,), (None,)]
    got = values(rows, "d int", F.coalesce(checks.bad_day_number("d"), F.lit(False)))
    assert got == [False, True, True, True, True, True, True, False]


def test_inconsistent_amounts(values):
    rows = [(10, 2, 5), (11, 2, 5), (None, 2, 5), (10, 2, None), (0, 0, 5), (-10, 2, -5)]
    got = values(rows, "s int, q int, p int", F.coalesce(checks.inconsistent_amounts("s", "q", "p"), F.lit(False)))
    assert got == [False, True, True, True, True, True]


def test_late_orders(values):
    a, b = D(2020, 1, 1), D(2020, 1, 2)
    rows = [(a, b, b), (b, a, b), (b, b, a), (None, a, a), (b, None, a)]
    got = values(rows, "o date, s date, d date", F.coalesce(checks.ordered_too_late("o", "s", "d"), F.lit(False)))
    assert got == [False, True, True, False, True]
