"""Operator 6: a mix of sources by systematic sampling.

Every source has a target, in words. A document of a source with rate
r = target / size of the source is expected r times in the mix. The expected
copies are prefix-summed over the documents of the source, one random offset
is added, and a document is emitted once for every whole number that the sum
crosses at it. Of a few offsets drawn, the one that meets the target best is
used: a single very long document would else decide a small source. So a document comes floor(r) or ceil(r) times, and any run of
documents nearly r times its length: in an order by size, short and long
documents are hit evenly and the words taken come near the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import free_name, n_words, ordered_places, stored, with_row_key

#: Fraction bits of a rate; positions times a rate stay exact in 64 bits up to 2^38 documents a source.
BITS = 24
ONE = 1 << BITS
#: No source is taken more often than this.
MOST = 3
#: Offsets tried per source, evenly spaced from a random one; the one that takes the number of words nearest to the target is used.
DRAWS = 1 << 12


def targets(sizes: DataFrame, weights: Sequence[float] = (1.0, 2.0, 3.0)) -> DataFrame:
    """(source, source_size, n_docs) with weight and target in words.

    Sources by code point, NULL last, take the weights in turn. They share the
    whole size by weight, but a source stops at MOST times its own size and the
    rest is shared again. That ends at one level: target = min(cap, level *
    weight). Sorted by cap / weight the capped sources come first, and the
    level follows from prefix sums. One row per source is ordered here, no more.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.row_number().over(named) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn % len(weights) + 1).cast("int"))
    capped = sizes.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * MOST).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    levels = capped.withColumn("level", left / F.sum("weight").over(after))
    # From the first source that the level doesn't fill, the level is final.
    fits = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)
    return levels.select(
        "source", "source_size", "n_docs", "weight",
        F.least("cap", F.coalesce(fits["level"] * F.col("weight"), F.col("cap"))).alias("target"),
    )


def by_size(rows: DataFrame) -> DataFrame:
    """Rows (source, size, digest, …) with their place, 0, 1, 2, …, in their source by size.

    A source is ordered in parts: a sixteenth of a doubling of the size, and 64
    parts of that by digest. So documents next to each other have nearly equal
    sizes, and a part stays small also where a source holds most documents.
    """
    # The number of doublings, and the four bits after the first of the size.
    sixteenth = F.expr("(length(bin(size + 1)) - 1) * 16 + (shiftright((size + 1) * 16, length(bin(size + 1)) - 1) & 15)").cast("long")
    parts = rows.withColumn("_part", sixteenth * 64 + F.conv(F.substring("digest", 1, 4), 16, 10).cast("long") % 64)
    return ordered_places(parts, "source", "_part", ["size", "digest"], "digest", "place").drop("_part")


def _div(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a, F.lit(b) if isinstance(b, int) else b)


def _whole_and_part(rate: Column) -> tuple[Column, Column]:
    """A rate as its whole part and the rest in units of 1 / ONE."""
    whole = F.floor(rate)
    return whole, F.floor((rate - whole) * ONE + 0.5).cast("long")


def turned(place: Column, n: Column, part: Column) -> Column:
    """The place in the order of the prefix sum.

    The places are cut into strata in which one copy is expected, and every
    other stratum is turned round: what one takes too much of long documents,
    the next takes too little. Whole numbers only, so reruns agree.
    """
    safe = F.greatest(part, F.lit(1))
    stratum = _div(place * part, ONE)
    first = _div(stratum * ONE + safe - 1, safe)
    last = F.least(_div((stratum + 1) * ONE + safe - 1, safe), n) - 1
    return F.when(stratum % 2 == 1, first + last - place).otherwise(place)


def copies(place: Column, n: Column, rate: Column, offset: Column) -> Column:
    """How often the document at ``place`` of ``n`` is emitted: the whole numbers that the prefix sum crosses at it."""
    whole, part = _whole_and_part(rate)
    before = turned(place, n, part) * part + offset
    return (whole + _div(before + part, ONE) - _div(before, ONE)).cast("long")


def best_offsets(placed: DataFrame) -> DataFrame:
    """(drawn_for, settled): for each source the offset whose words taken are nearest to the target.

    A document is crossed by the offsets of one interval, cyclically. So per
    document two or three changes of the words taken are summed by offset, and
    the running sum tells what each offset takes: no document is tried twice.
    """
    whole, part = _whole_and_part(F.col("rate"))
    step = ONE // DRAWS
    at = turned(F.col("place"), F.col("n_docs"), part) * part + F.col("offset")
    start = F.pmod(F.lit(ONE) - part - at, F.lit(ONE))
    first, end = _div(start + step - 1, step), _div(start + part + step - 1, step)
    wraps = (end > DRAWS) & (first < DRAWS)
    change = lambda draw, words: F.struct(draw.cast("long").alias("draw"), words.cast("long").alias("words"))
    size = F.col("size")
    changes = F.array(
        change(F.lit(0), whole * size + F.when(wraps, size).otherwise(0)),
        change(F.when(first < DRAWS, first).otherwise(0), size),
        change(F.when(first < DRAWS, F.when(wraps, end - DRAWS).otherwise(end)).otherwise(end - DRAWS), -size),
    )
    summed = placed.select("source", "target", "offset", F.explode(changes).alias("c")).groupBy(
        "source", "target", "offset", F.col("c.draw").alias("draw")
    ).agg(F.sum("c.words").alias("words")).filter(F.col("draw") < DRAWS)
    so_far = Window.partitionBy("source").orderBy("draw").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    taken = summed.withColumn("taken", F.sum("words").over(so_far))
    nearest = F.min(F.struct(F.abs(F.col("taken") - F.col("target")), "draw", "offset"))
    return taken.groupBy(F.col("source").alias("drawn_for")).agg(nearest.alias("best")).select(
        "drawn_for", F.pmod(F.col("best.offset") + F.col("best.draw") * step, F.lit(ONE)).alias("settled")
    )


def plan_mix(docs: DataFrame, keep: Sequence[str], weights: Sequence[float] = (1.0, 2.0, 3.0), seed: int = 42,
             source: str = "source", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: the columns ``keep``, size, source_size, target, n_copies, taken.

    ``docs`` are read once; all later steps move a few numbers per document.
    Ties in size are ordered by a digest of the id; rows equal in that are
    interchangeable, however many they are and however the files are cut. An
    empty or missing text has size 0, a source of such
    texts only has target 0 and is not taken.
    """
    key = F.md5(F.concat(F.lit(f"{seed}#"), F.coalesce(F.col(doc_id).cast("string"), F.lit("none"))))
    kept = F.struct(*(F.col(c) for c in keep))
    sized = docs.select(kept.alias("kept"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"), key.alias("digest"))
    placed = stored(by_size(sized), "by_size")
    totals = placed.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rates = targets(totals, weights).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    ).withColumn("offset", _random_offset(seed)).withColumnRenamed("source", "_of_source")
    joined = placed.join(rates, F.col("source").eqNullSafe(F.col("_of_source")))

    settled = rates.join(best_offsets(joined), F.col("_of_source").eqNullSafe(F.col("drawn_for")))
    final = placed.join(settled, F.col("source").eqNullSafe(F.col("_of_source")))
    emitted = copies(F.col("place"), F.col("n_docs"), F.col("rate"), F.col("settled"))
    return final.select(
        "kept.*", "size", F.col("source_size").cast("long").alias("source_size"), "target", emitted.alias("n_copies")
    ).withColumn("taken", F.col("n_copies") * F.col("size"))


def _random_offset(seed: int) -> Column:
    """A random number below ONE per source, the same in every run with this seed."""
    digest = F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce("source", F.lit("none"))))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(ONE))


def mix(docs: DataFrame, weights: Sequence[float] = (1.0, 2.0, 3.0), seed: int = 42) -> DataFrame:
    """The mixed documents: every row of ``docs`` as often as the mix takes it, with all its columns.

    Texts move once, in the join by the row's key. A copy is a row of its own.
    """
    row, planned, times, copy = (free_name(docs, name) for name in ("_mix_row", "_plan_row", "_times", "_copy"))
    keyed = with_row_key(docs, row)
    plan = plan_mix(keyed, [row], weights, seed).filter("n_copies > 0")
    plan = plan.select(F.col(row).alias(planned), F.col("n_copies").cast("int").alias(times))
    chosen = keyed.join(plan, F.col(row) == F.col(planned))
    return chosen.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(times))).alias(copy)).drop(copy)


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (1.0, 2.0, 3.0), seed: int = 42) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    return plan_mix(docs, ["doc_id"], weights, seed).select(
        "doc_id", "size", "source_size", "target", "taken", F.col("n_copies").cast("int").alias("n_copies")
    )
