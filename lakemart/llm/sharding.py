"""Operator 9: shards by rendezvous hashing.

Every shard draws a number for a record key; the record goes to the shard with
the largest draw. A draw depends on key and shard only, so another shard takes
over just the records for which its own draw is the largest, and no record
moves between two old shards. With weights w the draw is -w / ln(u), u uniform
in (0, 1): a shard wins in proportion to its weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import free_name, places

#: Hexadecimal digits of a digest that make up a draw: 52 bits, exact in a double.
DIGITS = 13


def draw(key: Column, shard: int) -> Column:
    """Uniform in (0, 1), from the key and the number of the shard. A NULL key draws like any other."""
    text = F.concat(F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("n")), F.lit(f"#{shard}"))
    number = F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double")
    return (number + 0.5) / float(16**DIGITS)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The number of the shard for ``key``; equal draws (never seen) go to the smaller number."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")
    scores = [F.struct((-w / F.ln(draw(key, i))).alias("score"), F.lit(-i).alias("shard")) for i, w in enumerate(weights)]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return (-best["shard"]).cast("int")


def assign_shards(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", shard: str = "shard",
                  grown: str | None = "grown_shard") -> DataFrame:
    """``docs`` with the shard of each row and, if wanted, the one it has with one more shard of weight 1.

    A projection: no shuffle, any number of rows, and equal keys (NULL is one)
    share a shard. Texts don't matter. An empty table stays empty. A column of
    ``docs`` with the name of a new one is replaced.
    """
    named = {shard: rendezvous(F.col(key), weights)}
    if grown:
        named[grown] = rendezvous(F.col(key), [*weights, 1.0])
    return docs.withColumns(named)


def number_shards(rows: DataFrame, name: str = "slot", buckets: int = 1024) -> DataFrame:
    """Number the rows of every shard 0, 1, 2, … in an order given by digests of their keys."""
    digest = F.md5(F.concat(F.lit("slot#"), F.coalesce(F.col("doc_id").cast("string"), F.lit("n"))))
    digested = rows.withColumn("_digest", digest).withColumn(
        "_bucket", F.conv(F.substring("_digest", 1, 8), 16, 10).cast("long") % buckets
    )
    numbered = places(digested, "shard", "_bucket", ["_digest", "text_crc32", "size"], "_digest", name)
    return numbered.drop("_digest", "_bucket")


def shard_documents(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the number of UTF-8 bytes of the text plus 1, so 1 for an empty
    or missing text; ``text_crc32`` is that of the bytes, 0 for none. ``slot``
    numbers the rows of a shard. NULL keys all go to one shard; repeated rows
    share a shard and get a slot each. An empty table gives an empty result.
    Other columns of ``docs`` aren't read.
    """
    plain = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    rows = assign_shards(
        plain.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        ),
        weights, "doc_id",
    )
    numbered = number_shards(rows)
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def sharded(docs: DataFrame, weights: Sequence[float], key: str = "doc_id") -> DataFrame:
    """The documents with all their columns and their shard, for writing one folder per shard."""
    return assign_shards(docs, weights, key, free_name(docs, "shard"), free_name(docs, "grown_shard"))
