"""A training corpus from raw documents: five stages, each stored before the next one reads it.

Run it on a folder of tables with ``run(spark, sf_dir)``. A stage takes
(spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakemart.llm import decontaminate, language, mixing, sharding, simhash
from lakemart.llm.common import stored, table
from lakemart.llm.queries import SHARDS


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told. Labels are learned from the documents themselves."""
    return language.with_known_language(docs)


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of every group of near-duplicates."""
    return simhash.one_per_group(docs, shingle=3, radius=2)


def no_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage stands."""
    return decontaminate.without_passages(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard, and the shard they get when one more is added."""
    return sharding.sharded(docs, [1.0] * SHARDS)


STAGES = [
    ("language", known_language),
    ("near_duplicates", no_near_duplicates),
    ("decontamination", no_benchmark_passages),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: Language models and fingerprints can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
