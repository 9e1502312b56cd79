"""Reports finished from states that add up, against the reports over all lines."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakemart.plans import reports
from lakemart.plans.report_states import LAYER, ReportStates
from lakemart.sources.layers import LayerStore

AS_OF = dt.date(2024, 6, 1)
FACT = "order_number string, product_key int, customer_key int, order_date date, sales_amount int, quantity int"


def lines(spark, n, seed):
    """A third of the lines have no customer; orders and members come again in later batches."""
    rng = random.Random(seed)
    day = lambda: rng.choice([None, dt.date(2021, 1, 1) + dt.timedelta(rng.randrange(1200))])
    rows = [
        (rng.choice([None, f"o{rng.randrange(60)}"]), rng.choice([None, 1, 2, 3, 9]), rng.choice([None, None, 1, 2, 3, 4]),
         day(), rng.choice([None, rng.randrange(100)]), rng.choice([None, 1, 2]))
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, FACT)


@pytest.fixture(scope="module")
def dimensions(spark):
    customers = spark.createDataFrame(
        [(i, f"c{i}", "A", "B", dt.date(1990, 1, i)) for i in range(1, 5)],
        "customer_key int, customer_number string, first_name string, last_name string, birth_date date",
    )
    products = spark.createDataFrame(
        [(i, f"p{i}", "x", "y", "z", 10) for i in range(1, 4)],
        "product_key int, product_name string, category string, sub_category string, product_line string, cost int",
    )
    return customers, products


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_batches_add_up(spark, dimensions, tmp_path):
    customers, products = dimensions
    states = ReportStates(LayerStore(spark, str(tmp_path)), buckets=3)
    batches = [lines(spark, 120, 1), lines(spark, 0, 3), lines(spark, 40, 4)]
    so_far = None
    for i, batch in enumerate(batches):
        assert states.add(batch, f"batch {i}")
        so_far = batch if so_far is None else so_far.union(batch)
        found, whole = states.report_customers(customers, AS_OF), reports.report_customers(so_far, customers, AS_OF)
        assert found.schema.simpleString() == whole.schema.simpleString()
        assert rows(found) == rows(whole)
        found, whole = states.report_products(products, AS_OF), reports.report_products(so_far, products, AS_OF)
        assert found.schema.simpleString() == whole.schema.simpleString()
        assert rows(found) == rows(whole)
    assert states.batches() == {f"batch {i}" for i in range(3)}


def test_a_batch_counts_once(spark, dimensions, tmp_path):
    states = ReportStates(LayerStore(spark, str(tmp_path)), 2, ("customer_key",))
    batch = lines(spark, 50, 5)
    assert states.add(batch, "may") and not states.add(batch, "may")
    assert rows(states.report_customers(dimensions[0], AS_OF)) == rows(reports.report_customers(batch, dimensions[0], AS_OF))


def test_a_failed_batch_leaves_the_states(spark, dimensions, tmp_path):
    states = ReportStates(LayerStore(spark, str(tmp_path)), 2, ("product_key",))
    first = lines(spark, 50, 6)
    states.add(first, "may")
    broken = lines(spark, 50, 7).withColumn("order_number", F.raise_error(F.lit("this load fails")).cast("string"))
    with pytest.raises(Exception, match="this load fails"):
        states.add(broken, "june")
    assert states.batches() == {"may"}
    assert rows(states.report_products(dimensions[1], AS_OF)) == rows(reports.report_products(first, dimensions[1], AS_OF))


def test_only_touched_buckets_are_written(spark, tmp_path):
    states = ReportStates(LayerStore(spark, str(tmp_path)), buckets=16)
    states.add(lines(spark, 200, 8), "may")
    one = spark.createDataFrame([("o1", 1, 1, dt.date(2024, 1, 1), 5, 1)], FACT)
    states.add(one, "june")
    load = states.store.current_load(LAYER)
    told = {r["table_name"]: r["message"] for r in states.store.audit().filter(F.col("load_id") == load).collect()}
    assert all(told[t].startswith("1 of ") for t in ("customer_key_sums", "customer_key_order_number", "product_key_order_number"))
