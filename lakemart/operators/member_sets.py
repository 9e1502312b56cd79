"""Distinct counts that add up: exact sets of members as bitmaps, stored once and merged for any group.

A distinct count of a year can't be had from those of its months, but the set of
its members is the union of theirs. Members are whole numbers, best dense ones
like surrogate keys, and best such that members of one group lie together. A set
is cut into buckets of 32,768 numbers, one bitmap each, so no row grows with the
collection, and a union is one aggregation that starts on the map side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.operators.measures import stack
from lakemart.operators.spreading import spread

_BUCKET, _BITS = "bucket", "bits"


def member_sets(rows: DataFrame, by: Sequence[str], members: Mapping[str, str]) -> DataFrame:
    """(``by``, member, bucket, bits): per group the set of each member column; ``members`` names them. NULLs are none.

    Rows are cut to different members per group first, at most 32,768 of a
    bucket. These meet before any bitmap is made: a bitmap of one task's few
    members has 4 KB, and there would be nearly as many as members. ``rows``
    are counted and read once per member column, so they should be stored.
    """
    parts, count = [], rows.count()
    for name, column in members.items():
        number = F.col(column).cast("long")
        known = rows.filter(F.col(column).isNotNull()).select(*by, number.alias("_number"))
        different = spread(known, count, *by, "_number").distinct()
        placed = different.select(
            *by, F.bitmap_bucket_number("_number").alias(_BUCKET), F.bitmap_bit_position("_number").alias("_position")
        )
        sets = spread(placed, count, *by, _BUCKET).groupBy(*by, _BUCKET).agg(F.bitmap_construct_agg("_position").alias(_BITS))
        parts.append(sets.select(*by, F.lit(name).alias("member"), _BUCKET, _BITS))
    return stack(*parts)


def merged_sets(sets: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """The sets of coarser groups, or of several loads: each the union of those that fall into it."""
    return sets.groupBy(*by, "member", _BUCKET).agg(F.bitmap_or_agg(_BITS).alias(_BITS))


def distinct_counts(sets: DataFrame, by: Sequence[str | Column], counts: Mapping[str, str]) -> DataFrame:
    """Per group of ``by`` the number of members; ``counts`` names the column of each member."""
    size = F.bitmap_count(_BITS)
    merged = merged_sets(sets, by)
    names = [c for c in merged.columns if c not in ("member", _BUCKET, _BITS)]
    figures = [F.coalesce(F.sum(F.when(F.col("member") == member, size)), F.lit(0)).alias(name) for member, name in counts.items()]
    return merged.groupBy(*names).agg(*figures)
