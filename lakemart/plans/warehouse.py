"""The warehouse over a folder of order tables, built as far as a query needs it.

Tables that cost a shuffle of the lines or a numbering are written once to the
shared work folder and read back by every later query of any application, with
column pruning and pushed filters. Everything else stays a plan over its input.

What is stored lies below the state of the input files and of this code; a
table that depends on the reporting day or a rule has these in its path, too.
A table counts from the moment its commit row is written, so a writer that dies
leaves nothing that is read.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cache, cached_property
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakemart.plans import gold, reports, silver, star
from lakemart.plans.segments import CustomerRule, ProductRule
from lakemart.session import work_dir
from lakemart.sources.files import children, delete, scratch_space
from lakemart.sources.order_tables import RAW_TABLES, fingerprint

COMMIT = "folder string, schema string, committed_at timestamp"

SILVER_PLANS = {
    "crm_cust_info": silver.customers,
    "crm_prd_info": silver.products,
    "crm_sales_details": silver.sales,
    "erp_loc_a101": silver.locations,
    "erp_px_cat_g1v2": silver.categories,
}

_lock = threading.RLock()
_found: dict[tuple[str, str], tuple[str, T.StructType]] = {}


@cache
def code_version() -> str:
    """Changes with any source file that may change a stored table."""
    package = Path(__file__).resolve().parents[1]
    parts = [package / "functions", package / "operators", package / "plans", package / "sources"]
    text = b"".join(f.name.encode() + f.read_bytes() for part in parts for f in sorted(part.glob("*.py")))
    return hashlib.sha256(text).hexdigest()[:16]


@dataclass(frozen=True)
class Settings:
    """Reporting day and thresholds that suit the amounts in the order tables."""

    as_of: dt.date = dt.date(2002, 1, 1)
    customer_rule: CustomerRule = field(default_factory=lambda: CustomerRule(60, 2_000_000))
    product_rule: ProductRule = field(default_factory=lambda: ProductRule(1_800_000, 1_350_000))


class Warehouse:
    def __init__(self, spark: SparkSession, base: str, settings: Settings = Settings()):
        self.spark, self.base, self.settings = spark, base, settings

    @property
    def _base(self) -> str:
        return f"{work_dir(self.spark)}/lakemart"

    @cached_property
    def _folder(self) -> str:
        """One folder per state of the input files and of the code. A warehouse lists its input once."""
        return f"{self._base}/{code_version()}_{fingerprint(self.spark, self.base)}"

    def new_folder(self) -> str:
        """A folder of its own for files a query writes, next to the stored tables."""
        return f"{self._folder}/runs/{uuid.uuid4().hex}"

    def finished(self, plan: Callable[[], DataFrame]) -> DataFrame:
        """The rows of a plan, written to a folder of their own; the scratch files it needed go."""
        path = self.new_folder()
        with scratch_space(self.spark):
            rows = plan()
            rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _stored(self, table: str, plan: Callable[[], DataFrame], *settings: object) -> DataFrame:
        """The stored table; it is built if no application has. ``settings`` are all that it depends on besides the input."""
        suffix = f"-{hashlib.sha256(repr(settings).encode()).hexdigest()[:16]}" if settings else ""
        path = f"{self._folder}/{table}{suffix}"
        key = (self.spark.sparkContext.applicationId, path)
        with _lock:
            found = _found.get(key) or self._committed(path)
            if found is None:
                self._build(path, plan)
                found = self._committed(path)
            _found[key] = found
        folder, schema = found
        return self.spark.read.schema(schema).parquet(folder)

    def _if_stored(self, table: str) -> DataFrame | None:
        """The stored table, if an application has built it; it is not built for this."""
        path = f"{self._folder}/{table}"
        found = _found.get((self.spark.sparkContext.applicationId, path)) or self._committed(path)
        return found and self.spark.read.schema(found[1]).parquet(found[0])

    def _committed(self, path: str) -> tuple[str, T.StructType] | None:
        """Folder and schema of the first build that was committed; later ones of other applications don't count."""
        try:
            commits = self.spark.read.schema(COMMIT).parquet(f"{path}/_commits")
            first = commits.orderBy("committed_at", "folder").first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return first and (f"{path}/{first['folder']}", T.StructType.fromJson(json.loads(first["schema"])))

    def _build(self, path: str, plan: Callable[[], DataFrame]) -> None:
        build = uuid.uuid4().hex
        with scratch_space(self.spark):
            rows = plan()
            rows.write.parquet(f"{path}/{build}")
        row = [(build, rows.schema.json(), dt.datetime.now(dt.UTC))]
        self.spark.createDataFrame(row, COMMIT).coalesce(1).write.mode("append").parquet(f"{path}/_commits")

    def build(self) -> None:
        """Store all tables that queries read, so that these only read."""
        for table in RAW_TABLES:
            self.raw(table)
        for table in RAW_TABLES:
            self.clean(table)
        self.customers, self.products, self.fact, self.member_sets, self.report_customers, self.report_products  # noqa: B018

    def reclaim(self) -> list[str]:
        """Remove what was stored for other states of the input files or the code; returns the folders' names.

        Not to be run while another application reads them.
        """
        current = self._folder.rsplit("/", 1)[1]
        gone = [name for name in children(self.spark, self._base) if name != current]
        for name in gone:
            delete(self.spark, f"{self._base}/{name}")
            for key in [k for k in _found if k[1].startswith(f"{self._base}/{name}/")]:
                _found.pop(key)
        return gone

    def raw(self, table: str) -> DataFrame:
        return self._stored(f"bronze_{table}", lambda: RAW_TABLES[table](self.spark, self.base))

    def raw_tables(self) -> dict[str, DataFrame]:
        return {table: self.raw(table) for table in RAW_TABLES}

    def clean(self, table: str) -> DataFrame:
        if table == "erp_cust_az12":
            day = self.settings.as_of
            return self._stored(f"silver_{table}", lambda: silver.erp_customers(self.raw(table), day), day)
        return self._stored(f"silver_{table}", lambda: SILVER_PLANS[table](self.raw(table)))

    def clean_tables(self) -> dict[str, DataFrame]:
        return {table: self.clean(table) for table in RAW_TABLES}

    @property
    def customers(self) -> DataFrame:
        return self._stored("dim_customers", lambda: gold.dim_customers(
            self.clean("crm_cust_info"), self.clean("erp_cust_az12"), self.clean("erp_loc_a101")
        ), self.settings.as_of)

    @property
    def products(self) -> DataFrame:
        return self._stored("dim_products", lambda: gold.dim_products(
            self.clean("crm_prd_info"), self.clean("erp_px_cat_g1v2")
        ))

    def _sales_to_key(self) -> DataFrame:
        """The clean lines from the nearest layer that is stored, else from the input: writing and reading the lines in
        each layer on the way takes longer than keying them."""
        table = "crm_sales_details"
        clean = self._if_stored(f"silver_{table}")
        if clean is not None:
            return clean
        raw = self._if_stored(f"bronze_{table}")
        return silver.sales(RAW_TABLES[table](self.spark, self.base) if raw is None else raw)

    @property
    def fact(self) -> DataFrame:
        return self._stored("fact_sales", lambda: gold.fact_sales(
            self._sales_to_key(), self.products, self.customers
        ), self.settings.as_of)

    @property
    def member_sets(self) -> DataFrame:
        return self._stored("member_sets", lambda: star.member_sets_by_month(self.fact, self.products), self.settings.as_of)

    @property
    def report_customers(self) -> DataFrame:
        return self._stored("report_customers", lambda: reports.report_customers(
            self.fact, self.customers, self.settings.as_of, self.settings.customer_rule
        ), self.settings.as_of, self.settings.customer_rule)

    @property
    def report_products(self) -> DataFrame:
        return self._stored("report_products", lambda: reports.report_products(
            self.fact, self.products, self.settings.as_of, self.settings.product_rule
        ), self.settings.as_of, self.settings.product_rule)
