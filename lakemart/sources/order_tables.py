"""Raw warehouse tables derived from customer, nation, part, orders and lineitem.

The order-processing tables carry clean data, so the faults a raw export has
(missing keys, old copies, odd codes, unreadable dates, wrong amounts) are put
in by key arithmetic. No input row is left out: where a partner should be
missing, its key is misspelled. Ids stay 64-bit: key ranges grow with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("customer", "nation", "part", "orders", "lineitem")


def _read(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def _customer_number(key: Column, start: str) -> Column:
    return F.concat(F.lit(start), F.lpad(key.cast("string"), 12, "0"))


def _copies(extra: dict[int, Column]) -> Column:
    """Copy numbers to emit for a row: 0 always, the others where their condition holds."""
    numbers = [F.lit(0), *(F.when(condition, F.lit(n)) for n, condition in extra.items())]
    return F.explode(F.array_compact(F.array(*numbers)))


def crm_cust_info(spark: SparkSession, base: str) -> DataFrame:
    """Customers with an older copy, an undated copy, a tied copy and rows without id."""
    k = F.col("c_custkey")
    rows = _read(spark, base, "customer").select(
        "c_custkey", "c_name", "c_mktsegment",
        F.date_add(F.lit("1995-01-01").cast("date"), (k % 1000).cast("int")).alias("created"),
        _copies({1: k % 40 == 0, 2: k % 200 == 0, 3: k % 300 == 0, 4: k % 80 == 8}).alias("copy"),
    )
    copy, name = F.col("copy"), F.col("c_name")
    return rows.select(
        F.when(copy != 3, k).alias("cst_id"),
        _customer_number(k, "AW").alias("cst_key"),
        F.when(k % 90 == 13, None)
        .when(k % 7 == 0, F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("  ")))
        .otherwise(F.col("c_mktsegment")).alias("cst_firstname"),
        F.when(copy == 1, F.concat(F.lit("old "), name))
        .when(copy == 2, F.concat(F.lit("undated "), name))
        .when(copy == 4, F.concat(F.lit("tied "), name))
        .when(k % 11 == 0, F.concat(name, F.lit(" ")))
        .otherwise(name).alias("cst_lastname"),
        F.when(k % 5 == 0, "S").when(k % 5 == 1, "M").when(k % 5 == 2, " s ")
        .when(k % 5 == 3, "m").when(k % 2 == 0, "").alias("cst_marital_status"),
        F.when(k % 6 == 0, "F").when(k % 6 == 1, "M").when(k % 6 == 2, " f ")
        .when(k % 6 == 3, "m ").when(k % 6 == 5, "x").alias("cst_gndr"),
        F.when(copy == 1, F.date_sub("created", 30)).when(copy != 2, F.col("created"))
        .alias("cst_create_date"),
    )


def erp_cust_az12(spark: SparkSession, base: str) -> DataFrame:
    """Demographics: prefixed and unknown keys, future and missing birth dates, gender spellings."""
    k = F.col("c_custkey")
    key = _customer_number(k, "AW")
    return _read(spark, base, "customer").select(
        F.when(k % 211 == 0, _customer_number(k, "XX"))
        .when(k % 2 == 0, F.concat(F.lit("NAS"), key)).otherwise(key).alias("cid"),
        F.when(k % 300 == 0, F.lit("2050-06-15").cast("date"))
        .when(k % 97 != 0, F.date_add(F.lit("1930-01-01").cast("date"), (k * 17 % 22000).cast("int")))
        .alias("bdate"),
        F.when(k % 8 == 0, "F").when(k % 8 == 1, "M").when(k % 8 == 2, "Female")
        .when(k % 8 == 3, " male ").when(k % 8 == 4, "").when(k % 8 == 6, "f ")
        .when(k % 8 == 7, "MALE").alias("gen"),
    )


def erp_loc_a101(spark: SparkSession, base: str) -> DataFrame:
    """Locations: dashed and unknown keys, country codes, blanks, padded names. An unknown nation has no name."""
    k, nation, name = F.col("c_custkey"), F.col("c_nationkey"), F.col("n_name")
    rows = _read(spark, base, "customer").join(
        _read(spark, base, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return rows.select(
        F.when(k % 97 == 5, _customer_number(k, "XX-")).otherwise(_customer_number(k, "AW-")).alias("cid"),
        F.when(nation == 0, F.when(k % 2 == 0, "DE").otherwise(" DE "))
        .when(nation == 1, F.when(k % 2 == 0, "US").otherwise("USA"))
        .when(nation == 2, F.when(k % 3 == 0, "").when(k % 3 == 2, " "))
        .when(nation == 3, "de")
        .otherwise(F.when(k % 4 == 0, F.concat(F.lit(" "), name, F.lit(" "))).otherwise(name))
        .alias("cntry"),
    )


def _type_code(separator: str) -> Column:
    kind = F.col("p_type")
    return F.concat(F.substring(kind, 1, 2), F.lit(separator), F.substring(kind, 3, 2))


def erp_px_cat_g1v2(spark: SparkSession, base: str) -> DataFrame:
    """One category per part type; the one of PROMO has an id no product carries."""
    kind = F.col("p_type")
    category = F.initcap(F.lower(kind))
    return (
        _read(spark, base, "part").select("p_type").distinct().select(
            F.when(kind == "PROMO", "PR_XX").otherwise(_type_code("_")).alias("id"),
            category.alias("cat"),
            F.concat(category, F.when(kind == "LARGE", " Parts ").otherwise(" Parts")).alias("subcat"),
            F.when(F.length(kind) % 2 == 0, "Yes").otherwise("No").alias("maintenance"),
        )
    )


def crm_prd_info(spark: SparkSession, base: str) -> DataFrame:
    """One to three versions per part; the raw end date is unusable."""
    k, version = F.col("p_partkey"), F.col("version")
    rows = _read(spark, base, "part").select(
        "p_partkey", "p_name", "p_type", "p_size",
        F.explode(F.sequence(F.lit(1), (k % 3 + 1).cast("int"))).alias("version"),
    )
    start = F.date_add(
        F.lit("1995-01-01").cast("date"), ((version - 1) * 400 + k % 30).cast("int")
    )
    name = F.concat("p_name", F.lit(" "), F.floor(k / 4).cast("string"))
    return rows.select(
        (k * 10 + version).alias("prd_id"),
        F.concat(
            _type_code("-"), F.lit("-"), F.when(k % 5 == 0, "pn-").otherwise("PN-"),
            k.cast("string"),
        ).alias("prd_key"),
        F.when(k % 120 == 1, F.concat(F.lit(" "), name)).otherwise(name).alias("prd_nm"),
        F.when(k % 170 == 5, -F.col("p_size")).when(k % 150 != 3, F.col("p_size") * 25)
        .alias("prd_cost"),
        F.when(k % 6 == 0, "R ").when(k % 6 == 1, "M ").when(k % 6 == 2, "s ")
        .when(k % 6 == 3, "T").when(k % 6 == 5, "X ").alias("prd_line"),
        start.cast("timestamp_ntz").alias("prd_start_dt"),
        F.when(version < k % 3 + 1, F.when(k % 2 == 0, F.date_sub(start, 100))
               .otherwise(F.date_add(start, 399))).cast("timestamp_ntz").alias("prd_end_dt"),
    )


def _day_number(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def crm_sales_details(spark: SparkSession, base: str) -> DataFrame:
    """Order lines with their order: unknown keys, bad dates, wrong amounts.

    Every tenth part goes unsold; its lines name the next part. A line whose
    order is missing has neither customer nor order and due date.

    The only join of two large tables in the library's input. It is on the order
    key, and a hot order is split by AQE on the line side.
    """
    lines = _read(spark, base, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    orders = _read(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    order, customer = F.col("l_orderkey"), F.col("o_custkey")
    part = F.when(F.col("l_partkey") % 10 == 0, F.col("l_partkey") + 1).otherwise(F.col("l_partkey"))
    ordered = F.to_date("o_orderdate")
    quantity = F.col("l_quantity").cast("int")
    price = F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("int")
    return lines.join(orders, order == F.col("o_orderkey"), "left").select(
        F.concat(F.lit("SO"), order.cast("string")).alias("sls_ord_num"),
        F.concat(F.when(part % 500 == 9, "XX-").otherwise("PN-"), part.cast("string"))
        .alias("sls_prd_key"),
        F.when(customer % 500 == 7, -customer).otherwise(customer).alias("sls_cust_id"),
        F.when(order % 97 == 0, 0).when(order % 89 == 0, 32154).otherwise(_day_number(ordered))
        .alias("sls_order_dt"),
        F.when(order % 113 == 0, 0).otherwise(_day_number(F.to_date("l_shipdate")))
        .alias("sls_ship_dt"),
        F.when(order % 127 == 0, 20600101).otherwise(_day_number(F.date_add(ordered, 12)))
        .alias("sls_due_dt"),
        F.when(order % 61 == 0, None).when(order % 67 == 0, 0)
        .when(order % 71 == 0, quantity * price + 1).otherwise(quantity * price)
        .alias("sls_sales"),
        quantity.alias("sls_quantity"),
        F.when(order % 53 == 0, None).when(order % 59 == 0, -price).otherwise(price)
        .alias("sls_price"),
    )


RAW_TABLES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "crm_cust_info": crm_cust_info,
    "crm_prd_info": crm_prd_info,
    "crm_sales_details": crm_sales_details,
    "erp_loc_a101": erp_loc_a101,
    "erp_px_cat_g1v2": erp_px_cat_g1v2,
    "erp_cust_az12": erp_cust_az12,
}


def fingerprint(spark: SparkSession, base: str) -> str:
    """Changes when any input file is added, removed or rewritten. Reads listings, not content."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load([f"{base.rstrip('/')}/{name}.parquet" for name in TABLES])
    )
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    row = files.agg(F.count("*").alias("n"), F.sum(mark).alias("mark")).first()
    return f"{row['n']}_{row['mark']}".replace("-", "m")
