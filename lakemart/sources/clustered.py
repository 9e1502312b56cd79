"""Tables laid out by a join key, so that later joins don't move them.

A clustered table is cut into buckets by the hash of its columns, as Spark deals
rows in a shuffle. Two tables clustered alike are joined bucket by bucket,
without an exchange on either side. Spark can't split such a join for a hot
key, so the layout does: a key that holds more rows than a bucket should is
dealt into ``salt``s, and the table it is looked up in has the key once per salt.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALT = "_salt"


@dataclass(frozen=True)
class Clustered:
    """Files below ``path`` in ``buckets`` buckets by ``key`` and salt; ``hot`` lies next to them."""

    spark: SparkSession
    path: str
    key: str
    buckets: int
    schema: T.StructType

    def read(self) -> DataFrame:
        """The rows with their salt. Spark knows the layout by an entry in this session's catalog."""
        name = f"clustered_{hashlib.sha256(self.path.encode()).hexdigest()[:20]}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY (`{self.key}`, `{SALT}`) SORTED BY (`{self.key}`, `{SALT}`) INTO {self.buckets} BUCKETS LOCATION '{self.path}/rows'"
        )
        return self.spark.table(name)

    def hot(self) -> DataFrame:
        """(key, salts) of the keys that were dealt out."""
        return self.spark.read.parquet(f"{self.path}/hot")


def _write(rows: DataFrame, path: str, key: str, buckets: int) -> Clustered:
    """Dealt as Spark deals rows to join partners, so that every bucket is one file, written by one task."""
    spark = rows.sparkSession
    name = f"clustering_{hashlib.sha256(path.encode()).hexdigest()[:20]}"
    rows.repartition(buckets, key, SALT).write.format("parquet").bucketBy(buckets, key, SALT).sortBy(key, SALT).option("path", f"{path}/rows").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return Clustered(spark, path, key, buckets, T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields]))


def cluster(rows: DataFrame, path: str, key: str, spread_by: str, buckets: int, most: float = 0.25, bucket_rows: int = 500_000) -> Clustered:
    """Lay ``rows`` out by ``key``. The one time that they are moved.

    There are ``buckets``, and more where these would hold over ``bucket_rows``
    rows on average: a bucket is sorted by one task here and in every join.
    A key (or NULL) that has more than ``most`` of an average bucket's rows is
    dealt by the hash of ``spread_by`` into as many salts as its rows need;
    there are fewer than ``buckets / most`` such keys.
    """
    counts = rows.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    number = rows.count()
    buckets = max(buckets, -(-number // bucket_rows))
    size = F.lit(max(1.0, number / buckets * most))
    hot = counts.filter(F.col("_n") > size).select("_key", F.least(F.ceil(F.col("_n") / size), F.lit(buckets)).cast("int").alias("salts"))
    hot.repartition(1).write.parquet(f"{path}/hot")
    hot = rows.sparkSession.read.parquet(f"{path}/hot")
    salts = F.broadcast(hot)  # fewer rows than buckets / most
    salted = rows.join(salts, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn(
        SALT, F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(spread_by), F.col("salts"))).cast("int")
    )
    return _write(salted.select(*rows.columns, SALT), path, key, buckets)


def cluster_partner(rows: DataFrame, path: str, key: str, large: Clustered) -> Clustered:
    """Lay out rows that are looked up from ``large``: as many buckets, hot keys once per salt."""
    salts = F.broadcast(large.hot())
    times = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    spread = rows.join(salts, F.col(key) == F.col("_key"), "left").withColumn(SALT, F.explode(times))
    kind = large.schema[large.key].dataType
    return _write(spread.withColumn(key, F.col(key).cast(kind)).select(*rows.columns, SALT), path, key, large.buckets)


def look_up(large: Clustered, partner: Clustered) -> DataFrame:
    """Left join of the two by key, without an exchange. The partner's key column is dropped."""
    lines, found = large.read(), partner.read().withColumnsRenamed({partner.key: "_found", SALT: "_found_salt"})
    on: Column = (F.col(large.key) == F.col("_found")) & (F.col(SALT) == F.col("_found_salt"))
    return lines.join(found.hint("merge"), on, "left").drop("_found", "_found_salt", SALT)
