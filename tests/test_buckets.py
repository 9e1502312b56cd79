"""Loads that write only what has changed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemart.operators.history import latest_per_key
from lakemart.sources.buckets import Refresh, Upsert, hash_buckets, manifest
from lakemart.sources.files import children
from lakemart.sources.layers import LayerStore

SCHEMA = "id long, day date, name string"
BUCKET = hash_buckets(8, "id")
D = dt.date


@pytest.fixture
def store(spark, tmp_path):
    return LayerStore(spark, str(tmp_path / "warehouse"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def state(store):
    """(bucket, load that wrote it) of the current load."""
    path = store.path("silver", "t", store.current_load("silver"))
    return {label: b.load_id for label, b in manifest(store.spark, path).items()}


def test_refresh_writes_changed_buckets(spark, store):
    first = [(i, D(2020, 1, 1 + i % 5), f"n{i}") for i in range(40)] + [(None, None, None), (7, None, "twice"), (7, None, "twice")]
    one = store.load("silver", {"t": Refresh(spark.createDataFrame(first, SCHEMA), BUCKET)})
    before = state(store)
    assert rows(store.read("silver", "t")) == sorted(first, key=repr) and set(before.values()) == {one}
    # The same rows in another order and other files: nothing is written.
    same = store.load("silver", {"t": Refresh(spark.createDataFrame(first[::-1], SCHEMA).repartition(5), BUCKET)})
    assert state(store) == before and not any("=" in name for name in children(spark, store.path("silver", "t", same)))
    assert rows(store.read("silver", "t")) == sorted(first, key=repr)
    # One row changed, one copy gone, one new, one bucket empty from now on.
    changed = [r for r in first[:-1] if r[0] is not None]
    changed[3] = (3, D(2020, 1, 4), "renamed")
    two = store.load("silver", {"t": Refresh(spark.createDataFrame([*changed, (99, None, "new")], SCHEMA), BUCKET)})
    after = state(store)
    assert rows(store.read("silver", "t")) == sorted([*changed, (99, None, "new")], key=repr)
    touched = {label for label in after if after[label] == two}
    assert 1 <= len(touched) <= 3 and all(after[label] == before[label] for label in after if label not in touched)
    audit = {r["load_id"]: (r["rows"], r["message"]) for r in store.audit().filter("table_name = 't'").collect()}
    assert audit[two] == (len(changed) + 1, f"{len(touched)} of {len(after)} buckets written") and audit[same][1].startswith("0 of")


def test_null_moves_are_seen(spark, store):
    """A value that moves to another column changes the digest, though hashes skip NULLs."""
    schema = "id long, a string, b string"
    store.load("silver", {"t": Refresh(spark.createDataFrame([(1, "x", None)], schema), BUCKET)})
    store.load("silver", {"t": Refresh(spark.createDataFrame([(1, None, "x")], schema), BUCKET)})
    assert rows(store.read("silver", "t")) == [(1, None, "x")]


def test_upsert_reads_and_writes_touched_buckets(spark, store):
    first = {i: (i, D(2020, 1, 1), f"n{i}") for i in range(60)} | {None: (None, None, "no id")}
    store.load("silver", {"t": Refresh(spark.createDataFrame(list(first.values()), SCHEMA), BUCKET)})
    before = state(store)
    put = [(5, D(2021, 1, 1), "five"), (None, D(2021, 1, 1), "still no id"), (500, None, None)]
    gone = spark.createDataFrame([(8,), (77,)], "id long")
    two = store.load("silver", {"t": Upsert(spark.createDataFrame(put, SCHEMA), ("id",), BUCKET, gone=gone)})
    expected = first | {r[0]: r for r in put}
    expected.pop(8)
    assert rows(store.read("silver", "t")) == sorted(expected.values(), key=repr)
    after = state(store)
    labels = {r[0] for r in spark.createDataFrame([(5,), (None,), (500,), (8,), (77,)], "id long").select(F.concat(F.lit("b"), F.expr(BUCKET))).collect()}
    assert {label for label in after if after[label] == two} <= labels
    assert all(after[label] == before[label] for label in before if label not in labels)
    # Without changes nothing is read or written.
    store.load("silver", {"t": Upsert(spark.createDataFrame([], SCHEMA), ("id",), BUCKET)})
    assert state(store) == after and rows(store.read("silver", "t")) == sorted(expected.values(), key=repr)


def test_upsert_resolves_like_a_full_refresh(spark, store):
    """The latest record per key, kept up to date load by load, is that of all records."""
    records = [(i % 9, D(2020, 1, 1 + (i * 7) % 20) if i % 4 else None, f"v{i}") for i in range(60)]
    latest = lambda df: latest_per_key(df, "id", "day")
    for part in (records[:25], records[25:40], records[40:]):
        store.load("silver", {"t": Upsert(latest(spark.createDataFrame(part, SCHEMA)), ("id",), BUCKET, latest)})
    assert rows(store.read("silver", "t")) == rows(latest(spark.createDataFrame(records, SCHEMA)))


def test_table_may_become_empty(spark, store):
    store.load("silver", {"t": Refresh(spark.createDataFrame([(1, None, "x")], SCHEMA), BUCKET)})
    store.load("silver", {"t": Upsert(spark.createDataFrame([], SCHEMA), ("id",), BUCKET, gone=spark.createDataFrame([(1,)], "id long"))})
    empty = store.read("silver", "t")
    assert empty.columns == ["id", "day", "name"] and empty.count() == 0
    store.register("silver", ("t",))
    assert spark.sql("SELECT id, day, name FROM silver.t").count() == 0


def test_failed_load_keeps_buckets(spark, store):
    store.load("silver", {"t": Refresh(spark.createDataFrame([(1, None, "x"), (2, None, "y")], SCHEMA), BUCKET)})
    before = state(store)
    broken = spark.range(1).select(F.lit(1).cast("long").alias("id"), F.lit(None).cast("date").alias("day"), F.raise_error(F.lit("broken")).cast("string").alias("name"))
    changed = spark.createDataFrame([(1, None, "changed")], SCHEMA)
    with pytest.raises(Exception, match="broken"):
        store.load("silver", {"t": Refresh(changed, BUCKET), "u": broken})
    assert state(store) == before and rows(store.read("silver", "t")) == [(1, None, "x"), (2, None, "y")]


def test_reclaim_keeps_buckets_in_use(spark, store):
    first = [(i, None, f"n{i}") for i in range(40)]
    one = store.load("silver", {"t": Refresh(spark.createDataFrame(first, SCHEMA), BUCKET)})
    two = store.load("silver", {"t": Refresh(spark.createDataFrame([(0, None, "changed"), *first[1:]], SCHEMA), BUCKET)})
    replaced = [label for label, load in state(store).items() if load == two]
    assert store.reclaim("silver") == [f"t/{one}/_bucket={label}" for label in replaced]
    expected = sorted([(0, None, "changed"), *first[1:]], key=repr)
    assert rows(store.read("silver", "t")) == expected
    store.register("silver", ("t",))
    assert sorted(map(tuple, spark.sql("SELECT id, day, name FROM silver.t").collect()), key=repr) == expected
