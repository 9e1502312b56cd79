"""The registered queries of this subpackage, with SQL where SQL can express them.

A module is listed with its query; every query reads its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakemart.llm import chat, decontaminate, language, licenses, mixing, packing, quality, runs, sharding, simhash, substrings, tokens, trie
from lakemart.llm.common import table
from lakemart.llm.oracles import ORACLES as ORACLES

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: How the public byte-level vocabularies part a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHARDS = 8


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(table(spark, sf_dir, "documents"), window=20, with_text=False).drop("n_factors")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predicted_languages(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), [1.0] * SHARDS)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokens.read_ranks(VOCABULARY))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"), rebuild=True)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(table(spark, sf_dir, "documents"), rewrite=True, with_runs=False)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(TOKENIZER, encoding="utf-8") as file:
        encoder = packing.Encoder(file.read(), {entry: i for i, entry in enumerate(tokens.read_ranks(VOCABULARY))}, PATTERN)
    return packing.pack(table(spark, sf_dir, "documents"), encoder, size=1024, with_ids=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: query for name, query in list(globals().items()) if name.startswith("op") and callable(query)
}
