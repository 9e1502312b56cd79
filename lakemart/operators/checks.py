"""Declared data-quality rules, counted in one pass per table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import calendar_day
from lakemart.operators.measures import stack


@dataclass(frozen=True)
class RowRule:
    """A named condition that is true for bad rows."""

    name: str
    bad: Column


@dataclass(frozen=True)
class KeyRule:
    """A key that must be present and unique."""

    name: str
    key: str


Rule = RowRule | KeyRule


def untrimmed(*names: str) -> Column:
    """Any of the columns has leading or trailing blanks."""
    conditions = [F.col(n) != F.trim(n) for n in names]
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result


def missing_or_negative(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) < 0)


def ends_before_start(start: str, end: str) -> Column:
    return F.col(end) < F.col(start)


def bad_day_number(name: str, earliest: int = 19000101, latest: int = 20500101) -> Column:
    """Not a plausible ``yyyymmdd``: out of range, or no such calendar day (sign and digits included)."""
    value = F.col(name)
    no_such_day = value.isNotNull() & calendar_day(value).isNull()
    return (value > latest) | (value < earliest) | no_such_day


def ordered_too_late(ordered: str, shipped: str, due: str) -> Column:
    return (F.col(ordered) > F.col(shipped)) | (F.col(ordered) > F.col(due))


def inconsistent_amounts(sales: str, quantity: str, price: str) -> Column:
    """Sales, quantity and price must be present, positive and agree."""
    s, q, p = F.col(sales), F.col(quantity), F.col(price)
    return (
        (s != q * p) | s.isNull() | q.isNull() | p.isNull() | (s <= 0) | (q <= 0) | (p <= 0)
    )


def in_future(name: str, as_of: dt.date) -> Column:
    return F.col(name) > F.lit(as_of)


def not_among(name: str, *allowed: str) -> Column:
    return F.col(name).isNull() | ~F.col(name).isin(*allowed)


def violations(df: DataFrame, rule: Rule) -> DataFrame:
    """The bad rows, or the bad keys with their number of rows."""
    if isinstance(rule, RowRule):
        return df.filter(rule.bad)
    counted = df.groupBy(rule.key).agg(F.count("*").alias("rows"))
    return counted.filter((F.col("rows") > 1) | F.col(rule.key).isNull())


def _row(layer: str, table: str, counts: DataFrame) -> DataFrame:
    return counts.select(
        F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "check_name", "violations",
        (F.col("violations") == 0).alias("passed"),
    )


def check_table(df: DataFrame, layer: str, table: str, rules: Sequence[Rule]) -> DataFrame:
    """One result row per rule: (layer, table_name, check_name, violations, passed)."""
    row_rules = [r for r in rules if isinstance(r, RowRule)]
    results = []
    if row_rules:
        counts = df.agg(*(F.count_if(r.bad).alias(r.name) for r in row_rules))
        results.append(counts.unpivot([], [r.name for r in row_rules], "check_name", "violations"))
    for rule in rules:
        if isinstance(rule, KeyRule):
            results.append(
                violations(df, rule).agg(F.count("*").alias("violations"))
                .select(F.lit(rule.name).alias("check_name"), "violations")
            )
    return _row(layer, table, stack(*results))


def distinct_values(df: DataFrame, name: str, with_length: bool = False) -> DataFrame:
    """The values in use, optionally with their length to show hidden blanks."""
    columns = [F.col(name)]
    if with_length:
        columns.append(F.length(name).alias("value_length"))
    return df.select(*columns).distinct()
