"""What is stored, for whom, and for how long; and that no input row is lost on the way in."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemart.plans.segments import CustomerRule, ProductRule
from lakemart.plans.warehouse import Settings, Warehouse
from lakemart.sources import files
from lakemart.sources.order_tables import TABLES, crm_sales_details, erp_loc_a101


def test_settings_have_tables_of_their_own(spark, testdata, warehouse):
    early = Warehouse(spark, testdata, Settings(as_of=dt.date(1933, 1, 1), customer_rule=CustomerRule(0, 0), product_rule=ProductRule(0, 0)))
    assert early.customers.filter("birth_date > DATE'1933-01-01'").count() == 0
    assert warehouse.customers.filter("birth_date > DATE'1933-01-01'").count() > 0
    assert early.report_customers.filter("recency_months > 0").count() == 0
    assert warehouse.report_customers.filter("recency_months <= 0").count() == 0
    segments = lambda w: {r[0] for r in w.report_customers.select("customer_segments").distinct().collect()}
    assert segments(early) == {"VIP"} != segments(warehouse)
    assert {r[0] for r in early.report_products.select("product_segment").distinct().collect()} == {"High-Performer"}
    assert early.raw("crm_sales_details").inputFiles() == warehouse.raw("crm_sales_details").inputFiles()


def test_fact_is_keyed_without_storing_the_layers_of_lines(spark, testdata, tmp_path):
    """From the input, from stored raw lines and from stored clean lines: the same rows."""
    for name in TABLES:
        spark.read.parquet(f"{testdata}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    table, found = "crm_sales_details", []
    for day, store in ((1, None), (2, "raw"), (3, "clean")):  # a fact for each reporting day
        w = Warehouse(spark, str(tmp_path), Settings(as_of=dt.date(2002, 1, day)))
        if store:
            getattr(w, store)(table)
        found.append(sorted(map(tuple, w.fact.collect()), key=repr))
        stored = [w._if_stored(f"{layer}_{table}") is not None for layer in ("bronze", "silver")]
        assert stored == [store is not None, store == "clean"]
    assert found[0] == found[1] == found[2] and len(found[0]) == spark.read.parquet(f"{testdata}/lineitem.parquet").count()


def test_another_application_builds_nothing(spark, testdata, warehouse, monkeypatch):
    from lakemart.plans import warehouse as module

    warehouse.build()
    monkeypatch.setattr(module, "_found", {})  # what an application knows when it starts

    def fail(*_):
        raise AssertionError("built again")

    monkeypatch.setattr(Warehouse, "_build", fail)
    again = Warehouse(spark, testdata)
    assert again.report_products.inputFiles() == warehouse.report_products.inputFiles()
    assert again.fact.schema == warehouse.fact.schema


def test_a_build_counts_from_its_commit(spark, tmp_path, testdata, monkeypatch):
    broken = Warehouse(spark, testdata, Settings(as_of=dt.date(1999, 9, 9)))
    with pytest.raises(Exception, match="half-way"):
        broken._stored("thing", lambda: spark.range(9).select(F.raise_error(F.lit("half-way")).cast("long").alias("id")), tmp_path)
    assert broken._stored("thing", lambda: spark.range(3), tmp_path).count() == 3
    assert broken._stored("thing", lambda: spark.range(5), tmp_path).count() == 3


def test_reclaim_removes_other_states(spark, testdata, tmp_path, monkeypatch):
    monkeypatch.setattr(Warehouse, "_base", property(lambda self: str(tmp_path / "lakemart")))
    w = Warehouse(spark, testdata)
    assert w.raw("erp_px_cat_g1v2").count() > 0
    spark.range(1).write.parquet(f"{tmp_path}/lakemart/older_state/table/build")
    assert w.reclaim() == ["older_state"] and w.reclaim() == []
    assert Warehouse(spark, testdata).raw("erp_px_cat_g1v2").count() > 0


def test_scratch_is_removed(spark, testdata):
    from lakemart.session import work_dir

    def scratch():
        return set(files.children(spark, f"{work_dir(spark)}/lakemart-scratch"))

    before = scratch()
    Warehouse(spark, testdata, Settings(as_of=dt.date(2001, 7, 7))).customers.count()  # numbers its keys in a folder
    assert scratch() == before
    with files.scratch_space(spark):
        folder = files.scratch_folder(spark)
        spark.range(2).write.parquet(folder)
        assert files.children(spark, folder)
    assert files.children(spark, folder) == []


def test_no_line_or_customer_is_lost(spark, testdata, tmp_path):
    """Half of the orders and one nation are missing; every line and customer still comes through."""
    keep = {"orders": "o_orderkey % 2 = 0", "nation": "n_nationkey <> 5"}
    for name in TABLES:
        spark.read.parquet(f"{testdata}/{name}.parquet").filter(keep.get(name, "true")).write.parquet(f"{tmp_path}/{name}.parquet")
    lines, customers = (spark.read.parquet(f"{testdata}/{t}.parquet").count() for t in ("lineitem", "customer"))
    raw = crm_sales_details(spark, str(tmp_path))
    assert raw.count() == lines
    assert raw.filter("sls_ord_num IS NULL").count() == 0 and raw.filter("sls_cust_id IS NULL").count() > lines // 3
    places = erp_loc_a101(spark, str(tmp_path))
    assert places.count() == customers and places.filter("cntry IS NULL").count() > 0
    assert Warehouse(spark, str(tmp_path)).fact.count() == lines
