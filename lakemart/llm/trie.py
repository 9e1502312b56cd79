"""Operator 11: the trie of conversation prefixes, by sorted shards and a skeleton of splitters.

A conversation is the path of its turns' digests. Sorted by path, the members of
a trie node stand side by side, so splitters that part the order into ranges
cut few nodes: just those that are a prefix of a splitter's path. These make up
the skeleton, a trie that is small whatever the collection holds, and that every
shard gets. A shard is one range, sorted: all its nodes that aren't in the
skeleton lie in it as a whole and are finished there. For skeleton nodes it
gives partial sums, which are combined by reduction and then rolled up along
the skeleton. The order goes on with the id where paths are equal, so that even
a conversation that is copied very often is cut into ranges.

Defined results: rows without ``conv_id`` name no conversation and are left
out; NULL roles and texts are empty; turns are ordered by number (NULL first),
then role and text, and repeated rows count as often as they stand there; an
empty table has no root and gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import ship, stored

#: Bytes of a turn's digest in a path.
STEP = 16
#: Turns per shard, wanted; and bytes of all splitters' paths, at most: a longer path makes for fewer splitters.
TURNS = 5_000
SPLITTERS = 64 << 20
#: Paths looked at for each splitter.
SAMPLES = 16
#: Ids of members, as text, in one row on their way to a digest.
CHUNK = 1 << 20

RESULT = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
#: What a shard gives: finished nodes (node is NULL), partial sums of a skeleton node, or ids of its members.
_SHARD = RESULT + ", node int, parent int, points long, shard int, nth int, ids string"


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, digests, points): per conversation its turns' digests and code points in order. Texts don't move."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The length of the role keeps role and text apart.
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.length(text).alias("points"))
    rows = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"), role.alias("r"), F.md5(text).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("t.turn").isNotNull().alias("known"), F.col("t.turn").alias("turn"), "r", "x", F.col("t.digest").alias("digest"), F.col("t.points").alias("points"))))
    return rows.groupBy("conv_id").agg(ordered.alias("own")).select("conv_id", F.transform("own", lambda t: F.struct(t["digest"], t["points"])).alias("own"))


def rebuilt(conversations: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """``paths`` with the first h turns of every conversation taken from the first one of its block.

    h is a checksum of the id modulo ``most``. Only the first turns of the
    first conversations are joined.
    """
    first = F.col("conv_id") - F.col("conv_id") % block
    heads = conversations.filter(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("of"), F.slice("own", 1, most - 1).alias("head"))
    own = conversations.withColumn("first", first).withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % most).cast("int"))
    none = F.expr("cast(array() as array<struct<digest: string, points: int>>)")

    def after(column: str) -> Column:
        return F.when(F.size(column) > F.col("h"), F.slice(column, F.col("h") + 1, F.size(column))).otherwise(none)

    joined = own.join(heads, F.col("first") == F.col("of"), "left").withColumn("head", F.coalesce("head", none))
    taken = F.when(F.col("h") > 0, F.slice("head", F.lit(1), F.greatest("h", F.lit(1)))).otherwise(none)
    return joined.select("conv_id", F.concat(taken, after("own")).alias("own"))


def as_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, points): the path is the digests one after another, in bytes that sort like the turns."""
    return conversations.select(
        "conv_id", F.unhex(F.array_join(F.transform("own", lambda t: t["digest"]), "")).alias("path"),
        F.transform("own", lambda t: t["points"].cast("int")).alias("points"),
    )


def as_digests(path: bytes) -> np.ndarray:
    """A path as rows of two numbers, one row a turn."""
    return np.frombuffer(path, dtype=np.uint64).reshape(-1, STEP // 8)


@dataclass
class Skeleton:
    """Splitters in order, and the trie of their paths: node 0 is the root."""

    splitters: list[tuple[bytes, int]]
    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])

    def __post_init__(self):
        self.nodes: list[np.ndarray] = []  # per splitter, its nodes by depth
        before, way = b"", [0]
        for path, _ in self.splitters:
            depth = 0
            while depth < len(way) - 1 and path[depth * STEP : (depth + 1) * STEP] == before[depth * STEP : (depth + 1) * STEP] != b"":
                depth += 1
            way = way[: depth + 1]
            for d in range(depth, len(path) // STEP):
                self.parent.append(way[-1])
                self.depth.append(d + 1)
                way.append(len(self.parent) - 1)
            self.nodes.append(np.array(way, dtype=np.int64))
            before = path

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))

    def around(self, shard: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(digests, nodes) of the splitters below and above a shard: of all skeleton nodes only theirs have members there."""
        return [
            (as_digests(self.splitters[k][0]), self.nodes[k])
            for k in (shard - 1, shard) if 0 <= k < len(self.splitters)
        ]


def skeleton(rows: DataFrame, turns: int = TURNS, most: int = SPLITTERS) -> Skeleton:
    """Splitters at even distances in a sample of the paths, chosen by a hash of the id.

    There is one splitter for so many turns, but all paths that come to the
    driver are ``most`` bytes at the longest, as many as that may be.
    """
    n, total, longest = rows.agg(F.count("*"), F.coalesce(F.sum(F.size("points") + 1), F.lit(0)), F.coalesce(F.max(F.size("points")), F.lit(0))).first()
    wanted = min(total // turns, most // (STEP * (longest + 1)) // SAMPLES)
    if wanted < 1 or n < 2:
        return Skeleton([])
    bound = min(2**63 - 1, -(2**63) + 2**64 * wanted * SAMPLES // n)
    sample = rows.filter(F.xxhash64("conv_id") <= bound).select("path", "conv_id").collect()
    ordered = sorted((bytes(r["path"]), r["conv_id"]) for r in sample)
    cuts = range(SAMPLES // 2, len(ordered), SAMPLES)
    return Skeleton(sorted({ordered[k] for k in cuts}))


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def shard_nodes(conv: np.ndarray, path: np.ndarray, depth: np.ndarray, points: np.ndarray, shard: int, bones: Skeleton) -> pa.Table:
    """All a sorted range tells: its finished nodes, and its part in skeleton nodes.

    ``path`` and ``points`` hold the turns of all conversations, ``depth`` their
    numbers of turns. A (conversation, turn) is a place; a place makes a new node
    unless the conversation before has the same path down to there.
    """
    n, total = len(conv), len(path)
    begin = np.concatenate([[0], np.cumsum(depth)])
    row = np.repeat(np.arange(n), depth)
    level = np.arange(total) - begin[row]  # depth less one
    # Places that repeat the conversation before.
    before = begin[np.maximum(row, 1) - 1] + level
    can = (row > 0) & (level < np.concatenate([[0], depth])[row])
    equal = np.zeros(total, dtype=bool)
    equal[can] = (path[can] == path[before[can]]).all(axis=1)
    shared = _prefix(equal, begin, row, level, depth)  # turns in common with the conversation before
    # Turns in common with the splitters on both sides, and the skeleton nodes they are.
    bone = np.full(total, -1, dtype=np.int64)
    for digests, nodes in bones.around(shard):
        inside = level < len(digests)
        equal = np.zeros(total, dtype=bool)
        equal[inside] = (path[inside] == digests[level[inside]]).all(axis=1)
        common = level < _prefix(equal, begin, row, level, depth)[row]
        bone[common] = nodes[level[common] + 1]
    new = level >= shared[row]
    # By depth the places of a node stand side by side; the first is the new one.
    order = np.argsort(level, kind="stable")
    starts = np.flatnonzero(new[order])
    count = np.diff(np.concatenate([starts, [total]]))
    least = np.minimum.reduceat(conv[row[order]], starts) if len(starts) else np.zeros(0, dtype=np.int64)
    of = np.empty(total, dtype=np.int64)  # the node of every place
    of[order] = np.cumsum(new[order]) - 1
    first = order[starts]  # the place that makes a node
    deep = level[first] + 1
    top = deep == 1
    parent = np.where(top, -1, of[first - 1])
    children = np.bincount(parent[~top], minlength=len(first)) if len(first) else np.zeros(0, dtype=np.int64)
    node_bone = bone[first]
    # In the order of places (a node before those below it), a subtree is a stretch of new places.
    seen = np.concatenate([[0], np.cumsum(new)])
    rank = seen[first]
    below = seen[begin[np.minimum(row[first] + count, n)]]
    preorder = np.argsort(rank)
    leaf = (children == 0).astype(np.int64)
    saving = (count - 1) * points[first].astype(np.int64)
    leaves = np.concatenate([[0], np.cumsum(leaf[preorder])])
    savings = np.concatenate([[0], np.cumsum(saving[preorder])])
    n_leaves, saved = leaves[below] - leaves[rank], savings[below] - savings[rank]
    # Members that end at each node: they come sorted by id.
    whole = np.flatnonzero(depth > 0)
    last = of[begin[whole + 1] - 1]
    by_node = np.argsort(last, kind="stable")
    ends, bounds = conv[whole][by_node], np.searchsorted(last[by_node], np.arange(len(first) + 1))
    out: dict[str, list] = {name: [] for name in _names(_SHARD)}

    def add(**values) -> None:
        size = len(next(iter(values.values())))
        for name, rows in out.items():
            rows.append(pa.array(values[name]) if name in values else pa.nulls(size))

    def text(k: int) -> str:
        return ",".join(map(str, ends[bounds[k] : bounds[k + 1]].tolist()))

    done = np.flatnonzero(node_bone < 0)
    high = parent[done]  # -1: the root
    to_bone = np.where(high < 0, 0, node_bone[high])
    local = to_bone < 0
    add(
        conv_id=least[done], depth=deep[done], n_convs=count[done], n_children=children[done], n_leaves=n_leaves[done], saved_tokens=saved[done],
        ends_sha256=[hashlib.sha256(text(k).encode()).hexdigest() for k in done.tolist()],
        parent_conv_id=pa.array(least[high], mask=~local) if len(least) else np.zeros(0, dtype=np.int64), parent=pa.array(to_bone.astype(np.int32), mask=local),
    )
    # The skeleton's share: own members, and what the finished nodes just below give.
    held = np.flatnonzero(node_bone >= 0)
    number = np.concatenate([[0], node_bone[held]])
    place = np.full(len(bones.parent), -1, dtype=np.int64)
    place[number] = np.arange(len(number))
    sums = {name: np.zeros(len(number), dtype=np.int64) for name in ("n_children", "n_leaves", "saved_tokens")}
    tops = np.flatnonzero(~local)
    for name, values in (("n_children", np.ones(len(done), dtype=np.int64)), ("n_leaves", n_leaves[done]), ("saved_tokens", saved[done])):
        np.add.at(sums[name], place[to_bone[tops]], values[tops])
    add(
        node=number.astype(np.int32), conv_id=np.concatenate([[conv.min()], least[held]]), n_convs=np.concatenate([[n], count[held]]),
        points=np.concatenate([[0], points[first[held]]]).astype(np.int64), **sums,
    )
    # Ids of members of skeleton nodes, in pieces.
    for k, ids in [(0, conv[depth == 0]), *((int(node_bone[k]), ends[bounds[k] : bounds[k + 1]]) for k in held.tolist())]:
        pieces = [",".join(map(str, ids[i : i + CHUNK // 20].tolist())) for i in range(0, len(ids), CHUNK // 20)]
        if pieces:
            add(node=np.full(len(pieces), k, dtype=np.int32), shard=np.full(len(pieces), shard, dtype=np.int32), nth=np.arange(len(pieces), dtype=np.int32), ids=pieces)
    kinds = {"ends_sha256": pa.string(), "ids": pa.string(), "node": pa.int32(), "parent": pa.int32(), "shard": pa.int32(), "nth": pa.int32()}
    return pa.table({name: pa.chunked_array([c.cast(kinds.get(name, pa.int64())) for c in columns]) for name, columns in out.items()})


def _prefix(equal: np.ndarray, begin: np.ndarray, row: np.ndarray, level: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Per conversation, how many of its places are equal before the first that isn't."""
    out = depth.copy()
    np.minimum.at(out, row[~equal], level[~equal])
    return out


def nodes_of_shards(rows: DataFrame, bones: Skeleton) -> DataFrame:
    """``_SHARD`` rows of every range; one shuffle, by the shard."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(bones)

    def place(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for path, conv in columns:
            yield pa.array([shared.value.shard(p, c) for p, c in zip(path.to_pylist(), conv.to_pylist(), strict=True)], pa.int32())

    def table(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(batches).combine_chunks()
        column = whole["path"].cast(pa.large_binary()).combine_chunks()
        ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        held = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[ends[0] : ends[-1]]
        path = as_digests(held.tobytes())
        points = whole["points"].combine_chunks().flatten().to_numpy()
        yield from shard_nodes(
            whole["conv_id"].to_numpy(), path, np.diff(ends) // STEP, points, whole["shard"][0].as_py(), shared.value
        ).to_batches(max_chunksize=10_000)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard; a shard is held until the next one begins."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            shard = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if hi > lo:
                    if held and held[-1].column(0)[0].as_py() != shard[lo]:
                        yield from table(held)
                        held = []
                    held.append(batch.slice(lo, hi - lo))
        if held:
            yield from table(held)

    def shard_of() -> Column:
        return F.arrow_udf(place, "int")("path", "conv_id")

    dealt = rows.select(shard_of().alias("shard"), "conv_id", "path", "points") if bones.splitters else rows.select(F.lit(0).alias("shard"), "conv_id", "path", "points")
    return dealt.repartition("shard").sortWithinPartitions("shard", "path", "conv_id").mapInArrow(finish, _SHARD)


def _digests(chunks: DataFrame) -> DataFrame:
    """(node, sha256) of the members' ids, comma-joined; a digest is one chain, so a node's ids stream through one task."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, chain = None, None
        for batch in batches:
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != node:
                    if chain is not None:
                        yield _pair(node, chain)
                    node, chain = k, hashlib.sha256(ids.encode())
                else:
                    chain.update(b"," + ids.encode())
        if chain is not None:
            yield _pair(node, chain)

    def _pair(node, chain) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.int32()), pa.array([chain.hexdigest()])], names=["of", "ends"])

    ordered = chunks.repartition("node").sortWithinPartitions("node", "shard", "nth")
    return ordered.select("node", "ids").mapInArrow(digest, "of int, ends string")


def _rolled_up(parts: DataFrame, bones: Skeleton) -> DataFrame:
    """The skeleton's rows from the shards' sums: one task, for as many rows as the skeleton has nodes."""
    shared = parts.sparkSession.sparkContext.broadcast(bones)
    names = ["node", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "points"]
    summed = parts.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in names[2:6]), F.max("points").alias("points")
    )

    def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bones = shared.value
        held = list(batches)
        if not held:
            return
        whole = pa.Table.from_batches(held)
        node, conv, n_convs, children, leaves, saved, points = (whole[c].to_numpy().copy() for c in names)
        parent, depth = np.array(bones.parent)[node], np.array(bones.depth)[node]
        at = np.full(len(bones.parent), -1, dtype=np.int64)
        at[node] = np.arange(len(node))
        saved += (n_convs - 1) * points
        np.add.at(children, at[parent[parent >= 0]], 1)
        leaves += children == 0
        for d in range(int(depth.max()), 0, -1):  # from below, a level at a time
            mine = np.flatnonzero(depth == d)
            np.add.at(leaves, at[parent[mine]], leaves[mine])
            np.add.at(saved, at[parent[mine]], saved[mine])
        above = pa.array(conv[at[parent]], mask=parent < 0)
        columns = [node.astype(np.int32), conv, depth, above, n_convs, children, leaves, saved]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", *_names(RESULT)[:7]])

    one = summed.select(*names).repartition(1)
    return one.mapInArrow(roll, "node int, " + RESULT.removesuffix(", ends_sha256 string"))


def prefix_trie(turns: DataFrame, rebuild: bool = False, per_shard: int = TURNS) -> DataFrame:
    """One row per node, ``RESULT``: the smallest member, depth, the parent's smallest member (root: NULL), members,
    children, leaves below, code points saved if every shared prefix were stored once, and a digest of the ids of the
    members that end there.

    A node is a different sequence of first turns (role and text), the root the
    empty one. With ``rebuild`` conversations are first given common beginnings
    (``rebuilt``). A conversation is one row of 20 bytes a turn, so a very long
    one needs that much in a task; texts of any length are only hashed.
    Columns other than conv_id, turn, role and text aren't read.
    """
    ship(turns.sparkSession)
    conversations = paths(turns)
    rows = stored(as_paths(rebuilt(conversations) if rebuild else conversations), "paths")
    bones = skeleton(rows, per_shard)
    out = stored(nodes_of_shards(rows, bones), "nodes")
    names = _names(RESULT)
    bone = stored(_rolled_up(out.filter("node IS NOT NULL AND ids IS NULL"), bones), "skeleton")
    ends = _digests(out.filter("ids IS NOT NULL"))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    high = bone.join(ends, F.col("node") == F.col("of"), "left").withColumn("ends_sha256", F.coalesce("ends", empty)).select(*names)
    above = bone.select(F.bitwise_not("node").alias("above"), F.col("conv_id").alias("above_conv"))
    low = out.filter("node IS NULL").join(above, F.bitwise_not("parent") == F.col("above"), "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "above_conv")
    ).select(*names)
    return low.union(high)
