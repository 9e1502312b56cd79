import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from lakemart.plans import pipeline
from lakemart.sources.csv_files import default_file, read_csv
from lakemart.sources.layers import LayerStore, export
from lakemart.sources.schemas import BRONZE, GOLD, SILVER, conform, limit_text

D = dt.date

FILES = {
    "crm_cust_info": "cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date\n"
                     "1,AW1, Jon,Yang ,M,M,2020-01-01\n1,AW1,Jon,Yang,S,M,2020-02-01\n2,AW2,Eve,,S,,2020-01-05\n"
                     ",AW3,No,Body,S,F,2020-01-05\n",
    "crm_prd_info": "prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt\n"
                    "1,BI-RB-R1,Road 1,10,R ,2011-07-01,2007-12-28\n2,BI-RB-R1,Road 1,12,R ,2012-07-01,\n"
                    "3,CO-PE-P1,Pedal,,,2003-07-01,\n",
    "crm_sales_details": "sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,sls_sales,sls_quantity,sls_price\n"
                         "SO1,R1,1,20130101,20130105,20130110,24,2,12\nSO1,R1,2,0,20130105,20130110,,1,12\n"
                         "SO2,XX,9,20130201,20130205,20130210,5,1,\n",
    "erp_loc_a101": "CID,CNTRY\nAW-1,DE\nAW-2,\n",
    "erp_px_cat_g1v2": "ID,CAT,SUBCAT,MAINTENANCE\nBI_RB,Bikes,Road Bikes,Yes\n",
    "erp_cust_az12": "CID,BDATE,GEN\nNASAW1,1980-01-01,Male\nAW2,2050-01-01,F\n",
}


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "exports"
    for table, text in FILES.items():
        path = folder / default_file(table)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    return folder


@pytest.fixture
def store(spark, tmp_path):
    return LayerStore(spark, str(tmp_path / "warehouse"))


def load_all(spark, source, store):
    pipeline.load_bronze(spark, str(source), store)
    pipeline.load_silver(store, D(2021, 1, 1))
    pipeline.load_gold(store, D(2021, 1, 1))


def test_exports_to_reports(spark, source, store):
    load_all(spark, source, store)
    customers = {r["customer_id"]: r for r in store.read("gold", "dim_customers").collect()}
    assert set(customers) == {1, 2}
    assert (customers[1]["first_name"], customers[1]["marital_status"], customers[1]["country"]) == ("Jon", "Single", "Germany")
    assert (customers[2]["gender"], customers[2]["birth_date"], customers[2]["country"]) == ("Female", None, "n/a")
    products = {r["product_number"]: r for r in store.read("gold", "dim_products").collect()}
    assert {k: (r["product_key"], r["cost"], r["category"]) for k, r in products.items()} == {
        "P1": (1, 0, None), "R1": (2, 12, "Bikes")}
    fact = store.read("gold", "fact_sales")
    assert sorted((r["order_number"], r["customer_key"], r["product_key"], r["sales_amount"], r["price"]) for r in fact.collect() if r["customer_key"]) == [
        ("SO1", 1, 2, 24, 12), ("SO1", 2, 2, 12, 12)]
    report = {r["customer_key"]: r for r in store.read("gold", "report_customers").collect()}
    assert set(report) == {1, None} and report[1]["total_sales"] == 24
    for table, schema in GOLD.items():
        rows = store.read("gold", table)
        assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in schema]
    assert "dwh_create_date" in store.read("silver", "crm_cust_info").columns
    assert [f.dataType for f in store.read("silver", "crm_sales_details").schema] == [f.dataType for f in SILVER["crm_sales_details"]]


def test_audit_and_counts(spark, source, store):
    load_all(spark, source, store)
    bronze = {r["table_name"]: r["rows"] for r in store.row_counts("bronze").collect()}
    silver = {r["table_name"]: r["rows"] for r in store.row_counts("silver").collect()}
    assert bronze == {"crm_cust_info": 4, "crm_prd_info": 3, "crm_sales_details": 3, "erp_loc_a101": 2,
                      "erp_px_cat_g1v2": 1, "erp_cust_az12": 2}
    assert silver == {**bronze, "crm_cust_info": 2}
    counted = pipeline.row_counts(store.read_all("bronze", tuple(BRONZE)), "bronze")
    assert {r["table_name"]: r["rows"] for r in counted.collect()} == bronze
    assert store.audit().filter("seconds is null or started_at is null").count() == 0


def test_reload_replaces(spark, source, store):
    pipeline.load_bronze(spark, str(source), store)
    first = store.current_load("bronze")
    pipeline.load_bronze(spark, str(source), store)
    assert store.current_load("bronze") != first
    assert store.read("bronze", "crm_prd_info").count() == 3


def test_failed_load_changes_nothing(spark, source, store):
    pipeline.load_bronze(spark, str(source), store)
    before = store.current_load("bronze")
    (source / default_file("crm_cust_info")).write_text(FILES["crm_cust_info"] + "7,AW7,New,Row,S,M,2020-01-01\n")
    (source / default_file("crm_sales_details")).write_text(FILES["crm_sales_details"] + "SO9,R1,1,abc,1,1,1,1,1\n")
    with pytest.raises(Exception):
        pipeline.load_bronze(spark, str(source), store)
    assert store.current_load("bronze") == before
    assert store.read("bronze", "crm_cust_info").count() == 4
    failed = store.audit().filter("status = 'failed'").collect()
    assert [r["table_name"] for r in failed] == ["crm_sales_details"] and failed[0]["message"]


def test_unloaded_layer(store):
    with pytest.raises(LookupError):
        store.current_load("gold")


def test_catalog(spark, source, store):
    pipeline.create_layers(spark)
    load_all(spark, source, store)
    store.register("gold", pipeline.GOLD_TABLES)
    assert spark.sql("SELECT count(*) FROM gold.fact_sales").first()[0] == 3
    assert {t.name for t in spark.catalog.listTables("gold")} >= set(pipeline.GOLD_TABLES)
    listed = pipeline.columns_of(spark, {"gold": {"dim_products": spark.table("gold.dim_products")}})
    assert [tuple(r) for r in listed.collect()][0] == ("gold", "dim_products", "product_key", "bigint", "YES")


@pytest.mark.parametrize("line", ["x,y\n", "1,a,b\n", "1\n"])
def test_bad_csv_rows_fail(spark, tmp_path, line):
    path = tmp_path / "t.csv"
    path.write_text("ID,NAME\n1,a\n" + line)
    schema = "id int, name string"
    from pyspark.sql.types import StructType

    with pytest.raises(Exception):
        read_csv(spark, str(path), StructType.fromDDL(schema)).collect()


def test_csv_values(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('OTHER,NAMES\n1,""\n2,\n3," a ""b"" "\n4,\\N\n')
    from pyspark.sql.types import StructType

    rows = read_csv(spark, str(path), StructType.fromDDL("id int, name string")).collect()
    assert [tuple(r) for r in rows] == [(1, ""), (2, None), (3, ' a "b" '), (4, "\\N")]


def test_long_text_fails(spark):
    df = spark.createDataFrame([("x" * 51,), (None,)], "name string")
    with pytest.raises(Exception, match="longer than 50"):
        limit_text(df).collect()
    assert limit_text(df, 51).count() == 2


def test_blanks_beyond_the_length_are_cut(spark):
    df = spark.createDataFrame([("DE" + " " * 60,), ("x" * 50 + "  ",), (" a ",)], "name string")
    assert sorted(r[0] for r in limit_text(df).collect()) == sorted(["DE" + " " * 48, "x" * 50, " a "])


def test_faults_in_unread_columns_fail(spark, tmp_path):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("id int, a string, b string, c string")
    (tmp_path / "short.csv").write_text("ID,A,B,C\n1,x,y,z\n2,x,y\n")
    (tmp_path / "long.csv").write_text(f"ID,A,B,C\n1,x,y,{'z' * 51}\n")
    for name in ("short.csv", "long.csv"):
        with pytest.raises(Exception):
            read_csv(spark, str(tmp_path / name), schema).select("id").collect()


def test_exports_in_another_dialect(spark, tmp_path, store):
    """Semicolons, quoted line breaks and a word for NULL."""
    for table, text in FILES.items():
        path = tmp_path / "dialect" / default_file(table)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text.replace(",", ";").replace("Road Bikes", '"Road\nBikes"').replace("No;Body", "NUL;Body"))
    pipeline.load_bronze(spark, str(tmp_path / "dialect"), store, delimiter=";", multi_line=True, null_text="NUL")
    assert store.read("bronze", "erp_px_cat_g1v2").first()["subcat"] == "Road\nBikes"
    assert store.read("bronze", "crm_cust_info").filter("cst_firstname IS NULL").count() == 1
    assert store.read("bronze", "crm_sales_details").count() == 3


def test_failure_message_is_whole(spark, store):
    long = "x" * 3000
    with pytest.raises(Exception):
        store.load("silver", {"t": spark.range(1).select(F.raise_error(F.lit(long)).cast("int").alias("a"))})
    assert long in store.audit().filter("status = 'failed'").first()["message"]


def test_reclaim_keeps_the_last_load(spark, store):
    loads = [store.load("silver", {"t": spark.range(n)}) for n in (1, 2, 3)]
    with pytest.raises(Exception):
        store.load("silver", {"t": spark.range(9), "u": spark.range(1).select(F.raise_error(F.lit("no")).cast("int").alias("a"))})
    assert len(store.reclaim("silver", keep=2)) >= 2
    assert store.read("silver", "t", loads[1]).count() == 2
    assert store.reclaim("silver") == [f"t/{loads[1]}"] and store.reclaim("silver") == []
    assert store.current_load("silver") == loads[2] and store.read("silver", "t").count() == 3


def test_load_that_commits_last_is_current(spark, store):
    """A load that began first, but ended after another one."""
    inner = []

    def slow(written):
        inner.append(store.load("silver", {"t": spark.range(1)}))
        return spark.range(2)

    outer = store.load("silver", {"t": slow})
    assert inner and store.current_load("silver") == outer


def test_gold_keeps_its_contract(spark, source, store, monkeypatch):
    from lakemart.plans import gold

    pipeline.load_bronze(spark, str(source), store)
    pipeline.load_silver(store, D(2021, 1, 1))
    monkeypatch.setattr(gold, "fact_sales", lambda *tables: spark.range(1))
    with pytest.raises(ValueError, match="missing"):
        pipeline.load_gold(store, D(2021, 1, 1))


def test_conform(spark):
    df = spark.createDataFrame([(1, "a")], "id bigint, name string")
    with pytest.raises(ValueError, match="missing"):
        conform(df, BRONZE["erp_loc_a101"])


def test_export(spark, tmp_path):
    df = spark.range(3).select(F.col("id"), F.lit("x").alias("name"))
    export(df, "csv", str(tmp_path / "out"), header="true")
    export(df, "csv", str(tmp_path / "out"), header="true")
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 3
    assert list(pathlib.Path(tmp_path / "out").glob("*.csv"))
