"""Joins of tables that are laid out alike."""

import pytest
from pyspark.sql import functions as F

from lakemart.sources.clustered import SALT, cluster, cluster_partner, look_up


@pytest.fixture
def shop(spark, tmp_path):
    """Lines of which a third belongs to one customer, a tenth to none, and some to unknown ones."""
    lines = spark.range(6000).select(
        F.concat(F.lit("SO"), F.col("id").cast("string")).alias("line"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500).cast("int").alias("customer"),
    )
    names = spark.range(400).select(F.col("id").alias("customer_id"), (F.col("id") + 1000).alias("customer_key"))
    large = cluster(lines, str(tmp_path / "lines"), "customer", "line", buckets=8)
    return lines, names, large, cluster_partner(names, str(tmp_path / "names"), "customer_id", large)


def test_look_up_moves_no_line(spark, shop):
    lines, names, large, partner = shop
    found = look_up(large, partner)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    expected = lines.join(names, lines.customer == names.customer_id, "left").select("line", "customer", "customer_key")
    assert sorted(map(tuple, found.select("line", "customer", "customer_key").collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_hot_keys_are_dealt_out(shop):
    lines, names, large, partner = shop
    hot = {r["_key"]: r["salts"] for r in large.hot().collect()}
    assert set(hot) == {7, None} and 2 <= hot[None] < hot[7] <= 8
    sizes = [r["n"] for r in large.read().groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) <= 8 and max(sizes) < 2000  # the hot customer alone has 2,000 lines
    assert partner.read().groupBy("customer_id").count().filter("count > 1").collect()[0][:] == (7, hot[7])
    assert large.read().filter(f"customer = 11 AND {SALT} <> 0").count() == 0


def test_clustering_without_rows(spark, tmp_path):
    lines = spark.createDataFrame([], "line string, customer int")
    large = cluster(lines, str(tmp_path / "none"), "customer", "line", buckets=4)
    partner = cluster_partner(spark.createDataFrame([(1, 2)], "customer_id long, customer_key long"), str(tmp_path / "keys"), "customer_id", large)
    assert look_up(large, partner).count() == 0


def test_buckets_grow_with_the_rows(spark, shop, tmp_path):
    lines, names, *_ = shop
    large = cluster(lines, str(tmp_path / "more_lines"), "customer", "line", buckets=2, bucket_rows=500)
    partner = cluster_partner(names, str(tmp_path / "more_names"), "customer_id", large)
    assert large.buckets == partner.buckets == 12
    sizes = [r["n"] for r in large.read().groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 8 and sum(sizes) == 6000 and max(sizes) < 1500
    expected = lines.join(names, lines.customer == names.customer_id, "left").select("line", "customer_key")
    assert sorted(map(tuple, look_up(large, partner).select("line", "customer_key").collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_customers_are_counted_by_more_than_one_task(spark, tmp_path, monkeypatch):
    """Only the hot keys come to one task, not the counts of all keys."""
    from pyspark.sql import DataFrame

    monkeypatch.setattr(DataFrame, "coalesce", lambda *_: pytest.fail("the counts come to one task"))
    cluster(spark.range(100).selectExpr("id AS customer", "id AS line"), str(tmp_path / "lines"), "customer", "line", buckets=2)
