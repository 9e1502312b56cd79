"""Operator 2: collapse logged snapshots of conversations and render what is left.

A chat service logs the whole conversation after every turn, so a logged
conversation may be a prefix of a longer one. Every turn gets a rolling hash of
the turns up to it; a conversation whose last hash is that of an inner turn of
another one is dropped by an anti-join. Nothing is compared pair by pair, and
texts move only once, to be rendered.

Defined results: a repeated row (same conversation, turn, role and text) counts
once; turns are ordered by number, role and digest of the text, NULL last, so a
repeated number gives two turns; rows without ``conv_id`` form one conversation
(NULL); a missing role is rendered as ``unknown``, a missing text as empty, but
neither equals the empty string; of equal conversations the smallest
``conv_id`` stays; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import apart

END = "<|end|>"


def _with_key(turns: DataFrame) -> DataFrame:
    """A key that is never NULL, so that joins and groups share one shuffle."""
    return turns.select(
        F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n")).alias("key"),
        "conv_id", "turn", "role", "text",
    )


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """Per turn: key, conv_id, place from 0, n (turns of the conversation), rolling hashes h1 and h2.

    The rolling hash is the exclusive-or over the turns so far of a hash of
    place, role and text, 128 bits in all. Only digests are shuffled and sorted.
    """
    rows = _with_key(turns).select("key", "conv_id", "turn", "role", F.md5("text").alias("digest")).distinct()
    whole = Window.partitionBy("key")
    order = whole.orderBy(*(F.col(c).asc_nulls_last() for c in ("turn", "role", "digest")))
    placed = rows.withColumn("place", F.row_number().over(order) - 1)
    so_far = whole.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def rolling(salt: int):
        parts = (F.lit(salt), F.col("place"), F.col("role").isNull(), F.col("role"), F.col("digest").isNull(), F.col("digest"))
        return F.bit_xor(F.xxhash64(*parts)).over(so_far)

    return placed.select("key", "conv_id", "place", F.count("*").over(whole).alias("n"), rolling(1).alias("h1"), rolling(2).alias("h2"))


def maximal(turns: DataFrame) -> DataFrame:
    """key, n_turns and n_copies of the conversations that aren't a prefix of a longer one."""
    hashes = prefix_hashes(turns)
    ends = hashes.filter("place = n - 1")
    # Conversations often begin alike: one row per inner prefix is enough.
    inner = hashes.filter("place < n - 1").select("place", "h1", "h2").distinct()
    inner = inner.select(F.col("place").alias("p"), apart("h1").alias("g1"), F.col("h2").alias("g2"))
    longest = ends.join(inner, (F.col("place") == F.col("p")) & (apart("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")), "left_anti")
    return longest.groupBy("n", "h1", "h2").agg(
        F.min(F.struct(F.col("conv_id").isNull(), "conv_id", "key")).alias("first"), F.count("*").alias("n_copies")
    ).select(F.col("first.key").alias("key"), F.col("n").alias("n_turns"), "n_copies")


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies and the rendered text of every maximal conversation.

    A conversation becomes one text, so its turns meet in one row; other than
    that no group is collected.
    """
    kept = maximal(turns).withColumnRenamed("key", "kept")
    texts = _with_key(turns).join(kept, F.col("key") == F.col("kept"))
    turn = F.struct(
        F.col("turn").isNull(), "turn", F.col("role").isNull(), "role", F.col("text").isNull(), F.md5("text"), "text"
    )
    grouped = texts.groupBy("key").agg(
        F.first("conv_id").alias("conv_id"), F.first("n_turns").alias("n_turns"),
        F.first("n_copies").alias("n_copies"), F.array_sort(F.collect_set(turn)).alias("turns"),
    )
    rendered = F.transform(
        "turns",
        lambda t: F.concat(
            F.lit("<|"), F.coalesce(t["role"], F.lit("unknown")), F.lit("|>\n"), F.coalesce(t["text"], F.lit("")), F.lit(END)
        ),
    )
    return grouped.select("conv_id", "n_turns", "n_copies", F.array_join(rendered, "\n").alias("rendered"))


ORACLE_SQL = """
WITH rows_ AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, md5(text) NULLS LAST) AS place
  FROM rows_
),
line AS (
  SELECT *, coalesce('r' || md5(role), 'n') || coalesce('t' || md5(text), 'n') AS piece,
    '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' AS shown
  FROM placed
),
prefixes AS (
  SELECT conv_id, place, md5(string_agg(piece, '/') OVER (PARTITION BY conv_id ORDER BY place)) AS prefix,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM line
),
ends AS (
  SELECT * FROM prefixes e
  WHERE place = n AND NOT EXISTS (SELECT 1 FROM prefixes p WHERE p.place < p.n AND p.place = e.place AND p.prefix = e.prefix)
),
kept AS (SELECT n, prefix, min(conv_id) AS conv_id, count(*) AS n_copies FROM ends GROUP BY n, prefix)
SELECT k.conv_id, any_value(k.n) AS n_turns, any_value(k.n_copies) AS n_copies,
  string_agg(l.shown, chr(10) ORDER BY l.place) AS rendered
FROM kept k JOIN line l ON l.conv_id IS NOT DISTINCT FROM k.conv_id
GROUP BY k.conv_id
"""
