"""Quality rules observed while a table is written."""

import pytest
from pyspark.sql import functions as F

from lakemart.operators.checks import KeyRule, RowRule, missing_or_negative
from lakemart.plans import pipeline
from lakemart.sources.buckets import Refresh, hash_buckets
from lakemart.sources.csv_files import default_file
from lakemart.sources.layers import LayerStore, RulesBroken
from tests.test_pipeline import FILES, D, source  # noqa: F401

SCHEMA = "id long, amount int"


@pytest.fixture
def store(spark, tmp_path):
    return LayerStore(spark, str(tmp_path / "warehouse"))


@pytest.fixture
def rules(spark):
    return {"t": [RowRule("amount_bad", missing_or_negative("amount")), RowRule("amount_large", F.col("amount") > 100), KeyRule("id_key", "id")]}


def told(store, load_id=None):
    found = store.findings("silver")
    return sorted((r["check_name"], r["violations"], r["passed"]) for r in found.collect() if load_id in (None, r["load_id"]))


def test_load_that_breaks_a_rule_is_not_committed(spark, store, rules):
    good = spark.createDataFrame([(1, 5), (2, 7)], SCHEMA)
    first = store.load("silver", {"t": good, "u": good}, rules)
    assert told(store) == [("amount_bad", 0, True), ("amount_large", 0, True), ("id_key", 0, True)]
    bad = spark.createDataFrame([(1, 5), (1, -7), (None, None), (4, 200)], SCHEMA)
    with pytest.raises(RulesBroken, match="amount_bad 2, amount_large 1, id_key 2") as error:
        store.load("silver", {"t": bad}, rules)
    assert error.value.found == {"t": {"amount_bad": 2, "amount_large": 1, "id_key": 2}}
    assert store.current_load("silver") == first and store.read("silver", "t").count() == 2
    refused = store.audit().filter("status = 'failed'").collect()
    assert len(refused) == 1 and "amount_bad 2" in refused[0]["message"] and refused[0]["table_name"] is None
    # Recorded only, the same load counts.
    kept = store.load("silver", {"t": bad}, rules, on_broken="record")
    assert store.current_load("silver") == kept
    assert told(store, kept) == [("amount_bad", 2, False), ("amount_large", 1, False), ("id_key", 2, False)]
    with pytest.raises(ValueError):
        store.load("silver", {"t": good}, rules, on_broken="ignore")


def test_rules_need_no_scan_of_their_own(spark, store, rules):
    """The input is evaluated once, whatever number of rules."""
    evaluated = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            evaluated.add(batch.num_rows)
            yield batch

    df = spark.range(500).select("id", F.lit(5).alias("amount")).mapInArrow(seen, SCHEMA)
    store.load("silver", {"t": df}, {"t": rules["t"][:2]})
    assert evaluated.value == 500


def test_rules_of_bucketed_tables(spark, store, rules):
    bucket = hash_buckets(4, "id")
    store.load("silver", {"t": Refresh(spark.createDataFrame([(i, 5) for i in range(20)], SCHEMA), bucket)}, rules)
    changed = spark.createDataFrame([(i, -1 if i == 3 else 5) for i in range(20)], SCHEMA)
    with pytest.raises(RulesBroken, match="amount_bad 1"):
        store.load("silver", {"t": Refresh(changed, bucket)}, rules)
    assert store.read("silver", "t").filter("amount < 0").count() == 0
    same = store.load("silver", {"t": Refresh(store.read("silver", "t"), bucket)}, rules)  # writes nothing
    assert told(store, same) == [("amount_bad", 0, True), ("amount_large", 0, True), ("id_key", 0, True)]


def test_silver_load_with_rules(spark, source, store):  # noqa: F811
    """Clean exports are committed; an order after its shipping can't be repaired and is refused."""
    pipeline.load_bronze(spark, str(source), store)
    first = pipeline.load_silver(store, D(2021, 1, 1), rules="refuse")
    late = FILES["crm_sales_details"] + "SO3,R1,1,20130301,20130205,20130310,5,1,5\n"
    (source / default_file("crm_sales_details")).write_text(late)
    pipeline.load_bronze(spark, str(source), store)
    with pytest.raises(RulesBroken, match="crm_sales_details: order_after_ship_or_due 1"):
        pipeline.load_silver(store, D(2021, 1, 1), rules="refuse")
    assert store.current_load("silver") == first and store.read("silver", "crm_sales_details").count() == 3
    pipeline.load_silver(store, D(2021, 1, 1), rules="record")
    assert store.read("silver", "crm_sales_details").count() == 4
    assert store.findings("silver").filter("NOT passed").select("check_name").distinct().collect()[0][0] == "order_after_ship_or_due"
