"""Connected components of a large sparse graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import apart, discard, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) reaches.

    Alternates two steps until nothing changes. In the first every node points
    its larger neighbours to its smallest one, in the second its smaller ones
    and itself. Each is one aggregation (smallest neighbour, combined before
    the shuffle) and one join; edges never multiply, and a node with very many
    neighbours is an ordinary skewed join key. Needs about log^2 n rounds at
    most; every round is stored, so a lost executor costs one round, and takes
    the place of the one before.
    Self loops are ignored. NULL is not a node.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    pairs = stored(pairs, "edges")
    state = _state(pairs)
    while True:
        before, pairs = pairs, stored(_step(_step(pairs, large=True), large=False), "edges")
        discard(before)
        after = _state(pairs)
        if after == state:
            break
        state = after
    # Now every edge leads from a node to its root.
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("root"))
    ).distinct()


def _step(pairs: DataFrame, large: bool) -> DataFrame:
    """Edges (a > b) after all neighbours on one side of every node were moved to its smallest one."""
    if large:  # a node sees all neighbours and moves the larger ones
        seen = pairs.select(F.col("a").alias("n"), F.col("b").alias("m")).union(pairs.select(F.col("b").alias("n"), F.col("a").alias("m")))
        moved = seen.filter("m > n").join(_least(pairs), apart("n") == F.col("of"), "left").select(
            F.col("m").alias("a"), F.coalesce("least", "n").alias("b")
        )
    else:  # a node moves its smaller neighbours and itself
        least = _least(pairs)
        joined = pairs.join(least, apart("a") == F.col("of"))
        moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            least.select(apart("of").alias("a"), F.col("least").alias("b"))
        )
    return moved.filter("a <> b").distinct()


def _least(pairs: DataFrame) -> DataFrame:
    """The smallest smaller neighbour of every node that has one; the node as its complement."""
    return pairs.groupBy("a").agg(F.min("b").alias("least")).select(apart("a").alias("of"), "least")


def _state(pairs: DataFrame) -> tuple:
    """Equal before and after a round only if the round changed nothing."""
    digest = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(pairs.agg(F.count("*"), F.sum(digest)).first())
