"""Reports brought up to date by the new lines only.

What a report needs of all lines is kept as states that add up: per member the
sums, the first and the last order day, and the set of different orders (and
customers). New lines are reduced to states of their own and merged with those
of the same members, so earlier lines are never read again. The reports are then
finished from the states like from the lines.

The states are bucketed tables of one layer: a batch reads and writes the
buckets its members fall into and commits all tables at once, together with its
name, so a batch counts once however often it is brought.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.plans import reports
from lakemart.plans.segments import CustomerRule, ProductRule
from lakemart.plans.star import dated
from lakemart.sources.buckets import Upsert, hash_buckets
from lakemart.sources.layers import LayerStore

LAYER = "report_states"

#: What is counted by different values, for each report by its key.
MEMBERS = {"customer_key": ("order_number",), "product_key": ("customer_key", "order_number")}

_FIGURES = ("total_sales", "total_quantity", "latest_order", "first_order")


def _sums(lines: DataFrame, key: str) -> DataFrame:
    return lines.groupBy(key).agg(
        F.sum("sales_amount").alias("total_sales"), F.sum("quantity").alias("total_quantity"),
        F.max("order_date").alias("latest_order"), F.min("order_date").alias("first_order"),
    )


def _merged_sums(states: DataFrame) -> DataFrame:
    key = next(c for c in states.columns if c not in _FIGURES)
    return states.groupBy(key).agg(
        F.sum("total_sales").alias("total_sales"), F.sum("total_quantity").alias("total_quantity"),
        F.max("latest_order").alias("latest_order"), F.min("first_order").alias("first_order"),
    )


@dataclass(frozen=True)
class ReportStates:
    """The states of some reports (by ``keys``, the same from batch to batch) in a store, cut into ``buckets``."""

    store: LayerStore
    buckets: int = 64
    keys: tuple[str, ...] = tuple(MEMBERS)

    def batches(self) -> set[str]:
        """Names of the batches that were merged."""
        try:
            return {r["batch"] for r in self.store.read(LAYER, "batches").collect()}  # one row per load
        except LookupError:
            return set()

    def add(self, lines: DataFrame, batch: str) -> bool:
        """Merge the dated lines of a batch; False if it was merged before. Batches are brought one at a time.

        A set of different values is a table of pairs, dealt by both columns, so
        the orders of a busy customer, or of no customer, lie in many buckets.
        """
        known = self.batches()
        if batch in known:
            return False
        lines = dated(lines)
        changes = {}
        for key in self.keys:
            changes[f"{key}_sums"] = Upsert(_sums(lines, key), (key,), hash_buckets(self.buckets, key), _merged_sums)
            for member in MEMBERS[key]:
                pairs = lines.filter(F.col(member).isNotNull()).select(F.col(key).alias("of"), F.col(member).alias("member")).distinct()
                changes[f"{key}_{member}"] = Upsert(pairs, ("of", "member"), hash_buckets(self.buckets, "of", "member"))
        names = self.store.spark.createDataFrame([(name,) for name in sorted({*known, batch})], "batch string")
        self.store.load(LAYER, {**changes, "batches": names.coalesce(1)})
        return True

    def _figures(self, key: str, counts: dict[str, str]) -> DataFrame:
        """One row per member as the reports want it; pairs are different already, so they are only counted.

        Sums and counts are stacked and meet in one aggregation, in which NULL
        is a key like any other.
        """
        load = self.store.current_load(LAYER)
        sums = self.store.read(LAYER, f"{key}_sums", load)
        nothing = {name: F.lit(0).cast("bigint").alias(name) for name in counts.values()}
        parts = sums.select(key, *_FIGURES, *nothing.values())
        for member, name in counts.items():
            pairs = self.store.read(LAYER, f"{key}_{member}", load).groupBy(F.col("of").alias(key)).agg(F.count("*").alias("_n"))
            empty = [F.lit(None).cast(sums.schema[c].dataType).alias(c) for c in _FIGURES]
            others = [F.col("_n").alias(name) if other == name else zero for other, zero in nothing.items()]
            parts = parts.unionByName(pairs.select(key, *empty, *others))
        return parts.groupBy(key).agg(
            F.sum("total_sales").alias("total_sales"), F.sum("total_quantity").alias("total_quantity"),
            F.max("latest_order").alias("latest_order"), F.min("first_order").alias("first_order"),
            *(F.sum(name).alias(name) for name in counts.values()),
        )

    def report_customers(self, customers: DataFrame, as_of: dt.date, rule: CustomerRule = CustomerRule()) -> DataFrame:
        """The report per customer over all batches."""
        figures = self._figures("customer_key", {"order_number": "total_orders"})
        return reports.customers_of(figures.withColumnRenamed("first_order", "_first"), customers, as_of, rule)

    def report_products(self, products: DataFrame, as_of: dt.date, rule: ProductRule = ProductRule()) -> DataFrame:
        """The report per product over all batches."""
        figures = self._figures("product_key", {"customer_key": "total_customers", "order_number": "total_orders"})
        named = figures.withColumnsRenamed({"latest_order": "last_sale_order", "first_order": "_first"})
        return reports.products_of(named, products, as_of, rule)
