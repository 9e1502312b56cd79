"""Tables of which a load rewrites only what has changed.

A bucketed table is cut by an expression over its rows (a hash of the key, a
month). A load writes the buckets whose rows differ from the current load and
takes the others over by name: its manifest says, for every bucket, in which
load's folder its files lie, how many rows they hold and a digest of them. The
manifest is written last and counts once the load's audit row says ``loaded``,
so a load that fails leaves the table as it was.

``Refresh`` brings the whole new state: the digests of its buckets, one
aggregation, tell what has to be written. ``Upsert`` brings changed rows only:
the buckets of their keys are read, merged and written; nothing else is read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.sources.files import children

MANIFEST = "bucket string, load_id string, rows long, digest string"
FOLDER = "_bucket"


@dataclass(frozen=True)
class Refresh:
    """All rows of the table. ``bucket`` is an SQL expression; the same in every load."""

    rows: DataFrame
    bucket: str


@dataclass(frozen=True)
class Upsert:
    """Rows that are new or changed, and keys that are ``gone``; ``bucket`` may use key columns only.

    Rows take the place of those with their key, a NULL matching a NULL. With
    ``resolve`` old and new rows of the keys are put together and it decides
    which stay, as ``latest_per_key`` does.
    """

    rows: DataFrame
    key: tuple[str, ...]
    bucket: str
    resolve: Callable[[DataFrame], DataFrame] | None = None
    gone: DataFrame | None = None


@dataclass(frozen=True)
class Bucket:
    load_id: str
    rows: int
    digest: str


def hash_buckets(n: int, *key: str) -> str:
    """An expression for ``n`` buckets by key."""
    return f"pmod(xxhash64({', '.join(f'`{k}`' for k in key)}), {n})"


def _labelled(rows: DataFrame, bucket: str) -> DataFrame:
    """The bucket as a text that may name a folder and looks like no number or date; NULL is a bucket of its own."""
    label = F.regexp_replace(F.expr(bucket).cast("string"), "[^A-Za-z0-9.-]", "_")
    return rows.withColumn(FOLDER, F.coalesce(F.concat(F.lit("b"), label), F.lit("none")))


def _digests(labelled: DataFrame) -> dict[str, tuple[int, str]]:
    """Rows and digest of every bucket: sums of two hashes of each row, which do not depend on order or files."""
    columns = [c for c in labelled.columns if c != FOLDER]
    marks = [F.sum(F.xxhash64(F.lit(salt), *columns).cast("decimal(38,0)")).cast("string") for salt in (1, 2)]
    # Two NULLs in a row hash like none, so the places of NULLs are hashed, too.
    nulls = F.sum(F.xxhash64(F.lit(3), *(F.col(c).isNull() for c in columns)).cast("decimal(38,0)")).cast("string")
    found = labelled.groupBy(FOLDER).agg(F.count("*").alias("n"), F.concat_ws("/", *marks, nulls).alias("digest")).collect()
    return {r[FOLDER]: (r["n"], r["digest"]) for r in found}


def as_sql(table_path: str, load_id: str, buckets: dict[str, Bucket], columns: list[str]) -> str:
    """A query for the rows of some buckets, one scan for every load that wrote some of them."""
    names = ", ".join(f"`{c}`" for c in columns)
    if not buckets:
        return f"SELECT {names} FROM parquet.`{table_path}/{load_id}/_schema`"
    by_load: dict[str, list[str]] = {}
    for label, bucket in sorted(buckets.items()):
        by_load.setdefault(bucket.load_id, []).append(f"'{label}'")
    return " UNION ALL ".join(
        f"SELECT {names} FROM parquet.`{table_path}/{load}` WHERE `{FOLDER}` IN ({', '.join(labels)})" for load, labels in sorted(by_load.items())
    )


def is_bucketed(spark: SparkSession, path: str) -> bool:
    return "_manifest" in children(spark, path)


def manifest(spark: SparkSession, path: str) -> dict[str, Bucket]:
    """What a load of the table consists of, by bucket."""
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/_manifest").collect()
    return {r["bucket"]: Bucket(r["load_id"], r["rows"], r["digest"]) for r in rows}


def read(spark: SparkSession, table_path: str, buckets: dict[str, Bucket], schema) -> DataFrame:
    """The rows of some buckets of a table."""
    folders = [f"{table_path}/{b.load_id}/{FOLDER}={label}" for label, b in sorted(buckets.items())]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def write(spark: SparkSession, table_path: str, load_id: str, change: Refresh | Upsert, before: dict[str, Bucket], watch: Callable[[DataFrame], DataFrame]) -> tuple[int, int, int]:
    """Write what a change touches and the manifest; returns rows of the table, buckets written and all buckets.

    ``watch`` is put over the rows that are written.
    """
    path = f"{table_path}/{load_id}"
    schema = change.rows.schema
    if isinstance(change, Refresh):
        labelled = _labelled(change.rows, change.bucket)
        state = _digests(labelled)
        written = {label: Bucket(load_id, *found) for label, found in state.items() if label not in before or (before[label].rows, before[label].digest) != found}
        kept = {label: before[label] for label in state if label not in written}
        if written:
            _store(watch(labelled.filter(F.col(FOLDER).isin(*written))), path)
    else:
        merged, touched = _merged(spark, table_path, change, before)
        if touched:
            _store(watch(merged), path)
        # Read back what was written: a bucket that lost all its rows has no folder.
        found = _digests(spark.read.schema(merged.schema).parquet(path)) if any(FOLDER in name for name in children(spark, path)) else {}
        written = {label: Bucket(load_id, *state) for label, state in found.items()}
        kept = {label: bucket for label, bucket in before.items() if label not in touched}
    whole = kept | written
    rows = [(label, b.load_id, b.rows, b.digest) for label, b in sorted(whole.items())]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{path}/_manifest")
    # The schema of a table without rows is told by its manifest's neighbour.
    spark.createDataFrame([], schema).coalesce(1).write.parquet(f"{path}/_schema")
    return sum(b.rows for b in whole.values()), len(written), len(whole)


def _merged(spark: SparkSession, table_path: str, change: Upsert, before: dict[str, Bucket]) -> tuple[DataFrame, set[str]]:
    """The new rows of all buckets that a change touches, with their labels."""
    names = list(change.key)
    keys = change.rows.select(*names)
    if change.gone is not None:
        keys = keys.unionByName(change.gone.select(*names))
    touched = {r[FOLDER] for r in _labelled(keys, change.bucket).select(FOLDER).distinct().collect()}  # a bucket's name each
    old = read(spark, table_path, {label: before[label] for label in touched if label in before}, change.rows.schema)

    def matched(rows: DataFrame, by: DataFrame, how: str) -> DataFrame:
        by = by.select(*(F.col(n).alias(f"_by_{n}") for n in names)).distinct()
        return rows.join(by, reduce(Column.__and__, (F.col(n).eqNullSafe(F.col(f"_by_{n}")) for n in names)), how)

    stays = matched(old, keys, "left_anti")
    new = change.rows
    if change.resolve:
        same = matched(old, change.rows, "left_semi")
        if change.gone is not None:
            same = matched(same, change.gone, "left_anti")
        new = change.resolve(same.unionByName(change.rows)).select(*change.rows.columns)
    return _labelled(stays.unionByName(new), change.bucket), touched


def _store(labelled: DataFrame, path: str) -> None:
    """One folder per bucket. Rows are dealt by bucket, in about equal parts: AQE cuts large buckets and joins small ones."""
    labelled.hint("rebalance", FOLDER).write.partitionBy(FOLDER).parquet(path)


def stored_schema(spark: SparkSession, path: str):
    return spark.read.parquet(f"{path}/_schema").schema
