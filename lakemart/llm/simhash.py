"""Operator 4: near-duplicates by SimHash, compared exactly in tiles.

A document's fingerprint has 64 bits; two fingerprints link if they differ in
few bits. Only distinct fingerprints are compared, in tiles: sorted by
population count, all of one tile against all of another by exclusive-or and
bit counts; tile pairs whose population counts differ by more than the radius
are skipped, as such fingerprints can't link.

Comparing every tile pair of a whole collection grows with its square, so the
fingerprints are first dealt into blocks that no link can leave: of r + 2
segments, two fingerprints within r bits agree on two segments at least, and
they meet in the block of any two segments on which they agree. The tiles of
a block are compared as above. The result is exact: no candidate is dropped.
Of the links found in a tile pair only as many are kept as join the same
fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm import arrays
from lakemart.llm.common import apart, free_name, ship, stored, with_row_key
from lakemart.llm.components import components

SEED = 42
#: Fingerprints per tile. A tile pair is compared in memory: 8 MB of differences.
TILE = 1024


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of one text: a bit is set if it is in over half the shingle hashes."""
    hashes = _shingle_hashes(text, shingle)
    if not len(hashes):
        return 0
    bits = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(hashes), 1 << 14):
        part = hashes[lo : lo + (1 << 14)]
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of every run of ``shingle`` words, lower-cased in ASCII, joined by one space."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = (digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends.tolist(), strict=True))
    return np.fromiter(hashes, dtype=np.uint64, count=len(starts))


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """``docs`` without its text, with the fingerprint as the signed long ``fp``.

    A text without words (also NULL) has fingerprint 0; one with fewer words
    than a shingle is one shingle. No shuffle; whole texts, one at a time.
    """
    ship(docs.sparkSession)
    kept = docs.drop(text)
    schema = kept.withColumn("fp", F.lit(0).cast("long")).schema

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = arrays.texts(batch.column(0))
            out = np.empty(batch.num_rows, dtype=np.uint64)
            for i in range(batch.num_rows):
                out[i] = fingerprint(data[offsets[i] : offsets[i + 1]].tobytes(), shingle)
            columns = [*batch.columns[1:], pa.array(out.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(text, *kept.columns).mapInArrow(compute, schema)


def _segments(count: int) -> list[tuple[int, int]]:
    """(first bit, bits) of ``count`` segments that make up 64 bits."""
    cuts = [64 * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _blocks(fp: Column, radius: int) -> Column:
    """The blocks of a fingerprint: for every two segments, the number of the pair and the bits of both."""
    parts = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << n) - 1)) if n < 64 else fp for a, n in _segments(radius + 2)]
    pairs = combinations(range(len(parts)), 2)
    return F.array(*(F.struct(F.lit(i).alias("pair"), parts[a].alias("left"), parts[b].alias("right")) for i, (a, b) in enumerate(pairs)))


def _reached(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows and columns of a link matrix the smallest row they reach; the number of rows if none."""
    none = len(near)
    rows, columns = np.where(near.any(axis=1), np.arange(none), none), np.full(near.shape[1], none)
    while True:
        new_columns = np.minimum(columns, np.where(near, rows[:, None], none).min(axis=0))
        new_rows = np.minimum(rows, np.where(near, new_columns[None, :], none).min(axis=1))
        if (new_rows == rows).all() and (new_columns == columns).all():
            return rows, columns
        rows, columns = new_rows, new_columns


def forest(fps: np.ndarray, radius: int, tile: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that join just the distinct fingerprints that links within ``radius`` bits join.

    Per tile pair there are at most as many as fingerprints in it, not as links.
    """
    order = np.argsort(np.bitwise_count(fps), kind="stable")
    ordered = fps[order]
    ones = np.bitwise_count(ordered).astype(np.int64)
    left, right = [], []
    for lo in range(0, len(fps), tile):
        mine = ordered[lo : lo + tile]
        for at in range(lo, len(fps), tile):
            if ones[at] - ones[lo + len(mine) - 1] > radius:
                break  # this tile and all after it: the population counts are too far apart
            near = np.bitwise_count(mine[:, None] ^ ordered[None, at : at + tile]) <= radius
            if at == lo:
                np.fill_diagonal(near, False)
            if near.any():
                for side, start in zip(_reached(near), (lo, at), strict=True):
                    linked = np.flatnonzero(side < len(mine))
                    left.append(order[start + linked])
                    right.append(order[lo + side[linked]])
    if not left:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    return a[a != b], b[a != b]


def links(fps: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that join just those within reach of each other.

    Blocks of one fingerprint are left out. A block of up to ``tile`` is one
    unit of work; a larger one is cut into tiles by population count and a
    digest, and every pair of tiles whose counts are near enough is a unit. So
    no task holds more than two tiles at a time, however large a block is.
    """
    ship(fps.sparkSession)
    key = ["pair", "left", "right"]
    blocked = fps.select("fp", F.bit_count("fp").alias("ones"), F.explode(_blocks(F.col("fp"), radius)).alias("block")).select("fp", "ones", "block.*")
    sizes = blocked.groupBy(*key).agg(F.count("*").alias("size")).filter("size > 1")
    sizes = sizes.select(F.col("pair").alias("p"), apart("left").alias("l"), F.col("right").alias("r"), "size")
    same = (F.col("pair") == F.col("p")) & (apart("left") == F.col("l")) & (F.col("right") == F.col("r"))
    blocked = stored(blocked.join(sizes, same).drop("p", "l", "r"), "blocks")
    # Large blocks: tiles within a population count, and their pairs.
    crowded = blocked.filter(F.col("size") > tile)
    counted = crowded.groupBy(*key, "ones").agg(F.count("*").alias("n"))
    tiles = stored(counted.select(*key, "ones", F.ceil(F.col("n") / tile).cast("int").alias("tiles")), "tiles")
    mine = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    placed = crowded.join(tiles, [*key, "ones"]).withColumn("tile", mine)
    other = tiles.select(*key, F.col("ones").alias("ones2"), F.col("tiles").alias("tiles2"))
    near = tiles.join(other, key).filter((F.col("ones2") - F.col("ones")).between(0, radius))
    pairs = near.select(*key, "ones", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), "ones2", "tiles2").select(
        *key, "ones", "tile", "ones2", F.explode(F.sequence(F.lit(0), F.col("tiles2") - 1)).alias("tile2")
    ).filter("ones < ones2 OR tile <= tile2").withColumn("unit", F.xxhash64(*key, "ones", "tile", "ones2", "tile2"))
    sides = pairs.select(*key, "ones", "tile", "unit").union(pairs.select(*key, "ones2", "tile2", "unit")).distinct()
    large = placed.join(sides, [*key, "ones", "tile"]).select("fp", "unit")
    small = blocked.filter(F.col("size") <= tile).select("fp", F.xxhash64(*key).alias("unit"))
    units = small.union(large)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by unit; a unit that a batch cuts is kept for the next one."""
        held = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            unit = np.concatenate([held[0], batch.column(1).to_numpy()])
            fp = np.concatenate([held[1], batch.column(0).to_numpy()])
            done = int(np.searchsorted(unit, unit[-1])) if len(unit) else 0
            held = unit[done:], fp[done:]
            yield from _compared(unit[:done], fp[:done], radius, tile)
        yield from _compared(*held, radius, tile)

    work = units.repartition("unit").sortWithinPartitions("unit")
    return work.mapInArrow(compare, "a long, b long")


def _compared(unit: np.ndarray, fp: np.ndarray, radius: int, tile: int) -> Iterator[pa.RecordBatch]:
    """The links of whole units. The many units of two fingerprints are compared all at once."""
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(unit)) + 1, [len(unit)]])
    sizes = np.diff(cuts)
    pair = cuts[:-1][sizes == 2]
    pair = pair[np.bitwise_count(fp.view(np.uint64)[pair] ^ fp.view(np.uint64)[pair + 1]) <= radius]
    left, right = [fp[pair]], [fp[pair + 1]]
    for lo, hi in zip(cuts[:-1][sizes > 2].tolist(), cuts[1:][sizes > 2].tolist(), strict=True):
        own = np.unique(fp[lo:hi])
        a, b = forest(own.view(np.uint64), radius, tile)
        left.append(own[a])
        right.append(own[b])
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])


def classes(prints: DataFrame, radius: int) -> DataFrame:
    """(node, root): the component of every distinct fingerprint that links to another one; the node as its complement."""
    found = components(links(prints.select("fp").distinct(), radius))
    return found.select(apart("node").alias("node"), "root")


def with_class(prints: DataFrame, radius: int) -> DataFrame:
    """``prints`` with ``root``, a fingerprint that stands for the component. Copies may be very many of one."""
    roots = classes(prints, radius)
    return prints.join(roots, apart("fp") == F.col("node"), "left").select(*prints.columns, F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest doc_id that can be reached over links,
    NULL only if all ids of the component are NULL. Repeated rows and texts
    share a fingerprint and so a component, however many they are; they are
    never paired. Columns other than doc_id and text aren't read. An empty
    table gives an empty result.
    """
    prints = stored(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), shingle), "prints")
    rooted = with_class(prints, radius)
    first = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")).select(apart("root").alias("of"), "component_id")
    return rooted.join(first, apart("root") == F.col("of")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_per_group(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest doc_id, NULL last.

    Of repeated rows one stays. All columns are kept; only the fingerprints and
    the identities of rows move before the final join, in which a text moves once.
    """
    row, kept_row = free_name(docs, "_near_row"), free_name(docs, "_kept_row")
    keyed = with_row_key(docs, row)
    slim = keyed.select("doc_id", "text", F.col(row).alias("row"))
    prints = stored(fingerprints(slim, shingle), "prints")
    rooted = with_class(prints, radius)
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    kept = rooted.groupBy("root").agg(best.alias("best")).select(F.col("best.row").alias(kept_row))
    return keyed.join(kept, F.col(row) == F.col(kept_row), "left_semi").select(*docs.columns)
