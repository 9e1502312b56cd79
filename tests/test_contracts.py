"""Contracts between loads."""

import pytest
from pyspark.sql import types as T

from lakemart.sources.buckets import Upsert, hash_buckets
from lakemart.sources.contracts import Contract, ContractBroken, widens
from lakemart.sources.layers import LayerStore


def kind(text):
    return T._parse_datatype_string(text)


@pytest.mark.parametrize("old, new, fits", [
    ("int", "bigint", True), ("bigint", "int", False), ("int", "decimal(12,2)", True), ("int", "decimal(11,2)", False),
    ("bigint", "decimal(20,0)", True), ("decimal(10,2)", "decimal(12,3)", True), ("decimal(10,2)", "decimal(10,3)", False),
    ("decimal(10,2)", "bigint", False), ("float", "double", True), ("double", "float", False),
    ("date", "timestamp_ntz", True), ("timestamp_ntz", "date", False), ("string", "int", False), ("int", "string", False),
])
def test_widening(spark, old, new, fits):
    assert widens(kind(old), kind(new)) is fits


def test_breaks_are_told(spark):
    contract = Contract(3, "widen", kind("a int, b string"))
    assert contract.breaks(kind("b string, c date, a bigint")) == []
    assert contract.breaks(kind("a string")) == ["b is missing", "a was int, is string"]
    strict = Contract(1, "same", kind("a int"))
    assert strict.breaks(kind("a bigint, b int")) == ["a was int, is bigint", "b is new"]
    assert contract.following(kind("b string, a int")) is contract
    assert contract.following(kind("b string, a bigint")).version == 4


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_loads_read_as_one(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    make = spark.createDataFrame
    first = store.load("x", {"t": make([(1, 2.5)], "a int, f float")}, contracts={"t": "widen"})
    second = store.load("x", {"t": make([(2**40, 0.1, None), (5, None, "s")], "a bigint, f double, n string")})
    with pytest.raises(ContractBroken, match="a was bigint, is int"):
        store.load("x", {"t": make([(1, 0.5, "s")], "a int, f double, n string")})
    with pytest.raises(ContractBroken, match="n is missing"):
        store.load("x", {"t": make([(1, 0.5)], "a bigint, f double")})
    assert store.current_load("x") == second and store.contract("x", "t").version == 2
    both = store.read_loads("x", "t")
    assert both.schema.simpleString() == "struct<a:bigint,f:double,n:string,load_id:string>"
    assert rows(both) == sorted([(1, 2.5, None, first), (2**40, 0.1, None, second), (5, None, "s", second)], key=repr)
    with pytest.raises(LookupError):
        store.read_loads("x", "other")


def test_a_failed_load_promises_nothing(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    good = spark.createDataFrame([(1,)], "a int")
    store.load("x", {"t": good}, contracts={"t": "same"})
    wide = spark.createDataFrame([(1,)], "a bigint")
    with pytest.raises(ContractBroken):
        store.load("x", {"u": wide, "t": wide}, contracts={"u": "widen"})
    assert store.contract("x", "u") is None and store.contract("x", "t").version == 1
    with pytest.raises(ValueError, match="allows"):
        store.load("x", {"t": good}, contracts={"t": "anything"})


def test_changed_buckets_under_contract(spark, tmp_path):
    """Buckets of an earlier load are read by the wider contract without being written again."""
    store, bucket = LayerStore(spark, str(tmp_path)), hash_buckets(16, "k")
    first = store.load("x", {"t": Upsert(spark.createDataFrame([(i, i) for i in range(50)], "k int, v int"), ("k",), bucket)}, contracts={"t": "widen"})
    second = store.load("x", {"t": Upsert(spark.createDataFrame([(7, 2**40, "new")], "k int, v bigint, n string"), ("k",), bucket)})
    expected = [(i, i, None) for i in range(50) if i != 7] + [(7, 2**40, "new")]
    assert rows(store.read("x", "t")) == sorted(expected, key=repr)
    told = {r["load_id"]: r["message"] for r in store.audit().filter("table_name = 't'").collect()}
    assert told[second].startswith("1 of ")
    both = store.read_loads("x", "t")
    assert both.filter(both.load_id == first).count() == 50 and both.filter(both.load_id == second).count() == 50
