"""A small shop, from its six exports to the analyses; every number was worked out by hand."""

import datetime as dt
from decimal import Decimal

import pytest

from lakemart.plans import explore, pipeline, reports, segments, trends
from lakemart.sources.csv_files import default_file
from lakemart.sources.layers import LayerStore

D = dt.date
TODAY = D(2024, 6, 1)

# Ann: two records, the later one counts. Bob has no gender in the CRM, Cy none anywhere. The row without id goes.
EXPORTS = {
    "crm_cust_info": """id,key,first,last,marital,gender,created
1,C1, Ann ,Ames,S,F,2020-01-01
1,C1,Ann,Ames ,M,F,2021-01-01
2,C2,Bob,Bell,M,,2021-03-01
3,C3,Cy,Cole,x,,2021-04-01
,C9,No,One,S,M,2021-05-01
""",
    # Two versions of the bike; the pedal belongs to no category; the helmet has no cost.
    "crm_prd_info": """id,key,name,cost,line,start,end
10,BI-RO-B1,Bike,400,R ,2020-01-01,2019-01-01
11,BI-RO-B1,Bike,600,R ,2022-01-01,
12,AC-HE-H1,Helmet,,M,2021-01-01,
13,CO-PE-P1,Pedal,50,,2021-01-01,
""",
    # Line 2: no sales given (2 * 100). Line 3: price missing (30 / 3). Line 5: no order date. Line 6: unknown product and customer.
    "crm_sales_details": """order,product,customer,ordered,shipped,due,sales,quantity,price
S1,B1,1,20220110,20220115,20220120,1000,1,1000
S1,H1,1,20220110,20220115,20220120,,2,100
S2,P1,2,20230305,20230307,20230310,30,3,
S3,B1,1,20240201,20240205,20240210,2000,2,1000
S4,H1,3,0,20240305,20240310,100,1,100
S5,ZZ,99,20240401,20240405,20240410,70,1,70
""",
    "erp_loc_a101": "CID,CNTRY\nC-1,DE\nC-2, USA\nC-3,\n",
    "erp_px_cat_g1v2": "ID,CAT,SUBCAT,MAINTENANCE\nBI_RO,Bikes,Road,Yes\nAC_HE,Accessories,Helmets,No\n",
    "erp_cust_az12": "CID,BDATE,GEN\nNASC1,1980-06-02,M\nC2,2000-01-01,Male\nC3,2050-01-01,\n",
}


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("shop")
    for table, text in EXPORTS.items():
        path = folder / "exports" / default_file(table)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    store = LayerStore(spark, str(folder / "warehouse"))
    pipeline.load_bronze(spark, str(folder / "exports"), store)
    pipeline.load_silver(store, TODAY)
    pipeline.load_gold(store, TODAY, segments.CustomerRule(12, 3000), segments.ProductRule(2000, 150))
    return store


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_customers(shop):
    assert rows(shop.read("gold", "dim_customers"), "customer_key", "first_name", "last_name", "country", "marital_status", "gender", "birth_date") == [
        (1, "Ann", "Ames", "Germany", "Married", "Female", D(1980, 6, 2)),
        (2, "Bob", "Bell", "United States", "Married", "Male", D(2000, 1, 1)),
        (3, "Cy", "Cole", "n/a", "n/a", "n/a", None),
    ]


def test_products(shop):
    assert rows(shop.read("gold", "dim_products"), "product_key", "product_number", "category", "cost", "product_line") == [
        (1, "H1", "Accessories", 0, "Mountain"), (2, "P1", None, 50, "n/a"), (3, "B1", "Bikes", 600, "Road")]
    assert rows(shop.read("silver", "crm_prd_info"), "prd_id", "prd_end_dt") == [
        (10, D(2021, 12, 31)), (11, None), (12, None), (13, None)]


def test_lines(shop):
    assert rows(shop.read("gold", "fact_sales"), "order_number", "product_key", "customer_key", "order_date", "sales_amount", "price") == [
        ("S1", 1, 1, D(2022, 1, 10), 200, 100), ("S1", 3, 1, D(2022, 1, 10), 1000, 1000), ("S2", 2, 2, D(2023, 3, 5), 30, 10),
        ("S3", 3, 1, D(2024, 2, 1), 2000, 1000), ("S4", 1, 3, None, 100, 100), ("S5", None, None, D(2024, 4, 1), 70, 70)]


def test_key_figures(shop):
    fact, customers, products = (shop.read("gold", t) for t in ("fact_sales", "dim_customers", "dim_products"))
    figures = {r[0]: r[1] for r in explore.key_figures(fact, customers, products).collect()}
    # 200 + 1000 + 30 + 2000 + 100 + 70; 2 + 1 + 3 + 2 + 1 + 1; (100 + 1000 + 10 + 1000 + 100 + 70) / 6
    assert {k: Decimal(str(v)) for k, v in figures.items()} == {
        "total_sales": 3400, "total_items_sold": 10, "avg_selling_price": Decimal("380.00"), "total_order_lines": 6, "total_orders": 5,
        "customers_with_orders": 3, "total_products": 3, "total_distinct_products": 3, "total_customers": 3}


def test_trends(shop):
    fact, products = shop.read("gold", "fact_sales"), shop.read("gold", "dim_products")
    assert rows(trends.sales_by_year(fact), "total_sales", "total_customers") == [(1200, 1), (2070, 1), (30, 1)]
    # Of all lines, undated ones too: bikes 3000, accessories 300, others 30 + 70, of 3400.
    shares = {r["category"]: r["percentage_of_total_sales"] for r in trends.category_shares(fact, products).collect()}
    assert shares == {"Bikes": "88.24%", "Accessories": "8.82%", None: "2.94%"}


def test_reports(shop):
    customers = {r["customer_name"]: r for r in shop.read("gold", "report_customers").collect()}
    ann, bob = customers["Ann Ames"], customers["Bob Bell"]
    # Ann is 43 until tomorrow; from 10 January 2022 to 1 February 2024 are 24 whole months.
    assert (ann["age"], ann["age_group"], ann["total_orders"], ann["total_sales"], ann["lifespan_months"]) == (43, "40-49", 2, 3200, 24)
    assert (ann["customer_segments"], ann["recency_months"], ann["avg_order_value"], ann["avg_monthly_spend"]) == ("VIP", 4, 1600, Decimal("133.33"))
    assert (bob["age_group"], bob["customer_segments"], bob["avg_monthly_spend"]) == ("20-29", "New", Decimal("30.00"))
    assert len(customers) == 3  # the third one is nobody known
    products = {r["product_name"]: r for r in shop.read("gold", "report_products").collect()}
    assert {k: (r["product_segment"], r["total_sales"], r["avg_selling_price"]) for k, r in products.items() if k} == {
        "Bike": ("High-Performer", 3000, Decimal("1000.0")), "Helmet": ("Mid-Range", 200, Decimal("100.0")),
        "Pedal": ("Low-Performer", 30, Decimal("10.0"))}
    difference = reports.reconcile(shop.read("gold", "report_products"), shop.read("gold", "fact_sales"), shop.read("gold", "dim_products"))
    assert {r["difference"] for r in difference.collect()} == {0}
