"""Surrogate keys that outlive a load."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemart.plans import pipeline
from lakemart.sources.csv_files import default_file
from lakemart.sources.files import children
from lakemart.sources.key_books import KeyBook
from lakemart.sources.layers import LayerStore
from tests.test_pipeline import FILES


@pytest.fixture
def book(spark, tmp_path):
    return KeyBook(spark, str(tmp_path / "book"), "member_key", "id long, region string", fold_after=2)


def members(spark, *rows):
    return spark.createDataFrame(rows, "id long, region string, name string")


def keys(df):
    return sorted((r["member_key"], r["id"], r["region"], r["name"]) for r in df.collect())


ORDER = ("id", "region", "name")


def test_members_keep_their_keys(spark, book):
    first = members(spark, (5, "a", "x"), (3, "a", "y"), (9, "b", "z"))
    assert keys(book.keyed(first, *ORDER)) == [(1, 3, "a", "y"), (2, 5, "a", "x"), (3, 9, "b", "z")]
    # One is renamed, one is gone, two are new and sort before the others.
    second = members(spark, (1, "a", "n"), (5, "a", "renamed"), (9, "b", "z"), (5, "b", "m"))
    assert keys(book.keyed(second, *ORDER)) == [(2, 5, "a", "renamed"), (3, 9, "b", "z"), (4, 1, "a", "n"), (5, 5, "b", "m")]
    # The one that was gone comes back with its old key.
    assert keys(book.keyed(first, *ORDER)) == [(1, 3, "a", "y"), (2, 5, "a", "x"), (3, 9, "b", "z")]


def test_nothing_new_writes_nothing(spark, book):
    rows = members(spark, (1, "a", "x"), (2, None, "y"), (None, None, "z"))
    assert book.enter(rows, *ORDER) == 3
    before = children(spark, book.path)
    assert book.enter(rows, *ORDER) == 0 and children(spark, book.path) == before
    assert book.enter(members(spark), *ORDER) == 0
    assert keys(book.look_up(members(spark, (None, None, "other")), *ORDER)) == [(1, None, None, "other")]


def test_copies_of_a_business_key(spark, book):
    rows = members(spark, (1, "a", "x"), (1, "a", "x"), (1, "a", "y"), (2, "a", "z"))
    assert [k for k, *_ in keys(book.keyed(rows, *ORDER))] == [1, 2, 3, 4]
    more = members(spark, *[(1, "a", "x")] * 5)
    assert [k for k, *_ in keys(book.keyed(more, *ORDER))] == [1, 2, 3, 5, 6]


def test_only_new_rows_are_numbered(spark, book):
    many = spark.range(2000).select(F.col("id"), F.lit("a").alias("region"), F.lit("n").alias("name"))
    book.enter(many, *ORDER)
    old = set(children(spark, book.path))
    book.enter(spark.range(1990, 2020).select("id", F.lit("a").alias("region"), F.lit("n").alias("name")), *ORDER)
    (added,) = set(children(spark, book.path)) - old
    assert spark.read.parquet(f"{book.path}/{added}").count() == 20
    assert book.entries().agg(F.count("*"), F.max("member_key"), F.count_distinct("member_key")).first()[:] == (2020, 2020, 2020)


def test_uncommitted_folders_do_not_count(spark, book):
    book.enter(members(spark, (1, "a", "x")), *ORDER)
    members(spark, (7, "a", "x")).select("id", "region", F.lit(0).alias("copy"), F.lit(99).cast("long").alias("member_key")).write.parquet(f"{book.path}/died")
    assert book.entries().count() == 1
    assert book.reclaim() == ["died"] and book.entries().count() == 1


def test_folders_are_folded(spark, book):
    for i in range(5):
        assert book.enter(members(spark, (i, "a", "x"), (i + 1, "a", "x")), *ORDER) == (2 if i == 0 else 1)
    assert len(book._last_commit()[1]) <= 4
    assert [(r["id"], r["member_key"]) for r in book.entries().orderBy("id").collect()] == [(i, i + 1) for i in range(6)]
    book.reclaim()
    assert len(children(spark, book.path)) <= 5 and book.entries().count() == 6


def test_rows_that_were_not_entered(spark, book):
    book.enter(members(spark, (1, "a", "x")), *ORDER)
    with pytest.raises(Exception, match="not entered"):
        book.look_up(members(spark, (2, "a", "x")), *ORDER).collect()


def test_gold_loads_keep_keys(spark, tmp_path):
    """Exports change between two loads: customers and products keep their keys, facts use them, dimensions get only what is there."""
    exports, day = tmp_path / "exports", dt.date(2021, 1, 1)

    def load(files, **options):
        for table, text in files.items():
            path = exports / default_file(table)
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(text)
        pipeline.load_bronze(spark, str(exports), store)
        pipeline.load_silver(store, day)
        pipeline.load_gold(store, day, **options)
        customers = {r["customer_id"]: r["customer_key"] for r in store.read("gold", "dim_customers").collect()}
        products = {r["product_number"]: r["product_key"] for r in store.read("gold", "dim_products").collect()}
        return customers, products

    store = LayerStore(spark, str(tmp_path / "warehouse"))
    assert load(FILES, keep_keys=True) == ({1: 1, 2: 2}, {"P1": 1, "R1": 2})
    changed = FILES | {
        "crm_cust_info": "cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date\n"
                         "0,AW0,New,One,M,M,2020-03-01\n2,AW2,Eve,Married,M,,2020-05-05\n",
        "crm_prd_info": FILES["crm_prd_info"] + "4,AC-HE-A0,Helmet,5,S,2001-07-01,\n",
    }
    assert load(changed, keep_keys=True) == ({0: 3, 2: 2}, {"P1": 1, "R1": 2, "A0": 3})
    lines = {(r["order_number"], r["customer_key"], r["product_key"]) for r in store.read("gold", "fact_sales").collect()}
    assert lines == {("SO1", None, 2), ("SO1", 2, 2), ("SO2", None, None)}
    assert load(FILES, keep_keys=True) == ({1: 1, 2: 2}, {"P1": 1, "R1": 2})
    assert load(changed) == ({0: 1, 2: 2}, {"A0": 1, "P1": 2, "R1": 3})
