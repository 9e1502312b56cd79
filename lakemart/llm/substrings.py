"""Operator 1: remove passages that stand earlier in the collection, by hashes of blocks and windows.

This stands in place of a relative Lempel-Ziv parse: no factor is extended along
a reference, as that would need the reference's text in the task. The reference,
the collection itself up to the place in question, is held as blocks that are
indexed by content, not by place:

* A block is made around an anchor, the run of ``GRAM`` words with the smallest
  hash in a window of ``window`` words; a block holds all words of the windows
  with this anchor. Equal windows have equal anchors in equal places, so a
  repeated window lies in blocks with the same anchor. There is a block for
  about every eight words.
* Anchors that occur once are dropped: nothing in their blocks is repeated.
* For the others the earliest place of each block content is the index, one
  aggregation. A block that stands earlier is matched as a whole; neighbouring
  matched blocks with the same distance to their earlier place count as a factor.
* At the boundaries of factors a block is new as a whole, though some of its
  windows may stand earlier, in another block with that anchor. Only these
  windows are hashed one by one and looked up in an index of windows.

Nothing is ever compared pair by pair, a passage that is in a third of all
documents costs a row per occurrence, and what a task holds is a text. Blocks
and windows are compared by 128 bits of hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm import arrays
from lakemart.llm.common import apart, ship, stored

GRAM = 6
#: Base of a second hash of windows.
_OTHER = 0xD1342543DE82EF95
#: A place is the first word of a block's first window, times this or more (``packed``), plus the number of its windows.
PLACE = 64

BLOCKS = "anchor long, content long, ord long, text_hash long, place long"
WINDOWS = "hash1 long, hash2 long, ord long, text_hash long, start int"
#: A document whose id is NULL stands after all others.
LAST = (1 << 63) - 1


def packed(window: int) -> int:
    """The factor of a place: a block holds fewer windows than a window has words."""
    return max(PLACE, window + 1)


def _keyed(docs: DataFrame) -> DataFrame:
    """Order and identity of a document; rows equal in id and text are one document."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("ord"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        F.col("doc_id").cast("long").alias("doc_id"), "text",
    )


def blocks_of(data: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(row, anchor hash, content hash, first window's word in the row, windows) of every block of some texts."""
    starts, ends, row = arrays.words(data, bounds)
    hashes = arrays.word_hashes(data, starts, ends)
    n = len(hashes)
    none = np.zeros(0, dtype=np.int64)
    if n < window:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    firsts = np.searchsorted(row, np.arange(len(bounds)))  # first word of each row
    row_end = firsts[row + 1]
    grams = arrays.run_hashes(hashes, np.arange(n - GRAM + 1), np.arange(GRAM, n + 1))
    at = np.arange(n - window + 1)
    valid = at + window <= row_end[at]
    width = window - GRAM + 1
    least = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1)
    at, anchor = at[valid], (at + least)[valid]
    if not len(at):
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    new = np.concatenate([[0], np.flatnonzero((np.diff(anchor) != 0) | (np.diff(row[at]) != 0)) + 1])
    count = np.diff(np.concatenate([new, [len(at)]]))
    first, anchor = at[new], anchor[new]
    content = arrays.run_hashes(hashes, first, first + count + window - 1) ^ arrays.mix((anchor - first).astype(np.uint64))
    return row[first], grams[anchor], content, first - firsts[row[first]], count


def _blocks(docs: DataFrame, window: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order, identity = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, _, data, bounds in arrays.pieces(batch.column(2)):
                row, anchor, content, first, count = blocks_of(data, bounds, window)
                columns = [anchor.view(np.int64), content.view(np.int64), order[lo + row], identity[lo + row], first * packed(window) + count]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=BLOCKS.replace(" long", "").split(", "))

    return docs.select("ord", "text_hash", "text").mapInArrow(cut, BLOCKS)


def _windows(docs: DataFrame, window: int) -> DataFrame:
    """The windows of the blocks ``places`` of each row of (ord, text_hash, text, places)."""
    names = ["hash1", "hash2", "ord", "text_hash", "start"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                for _, _, data, bounds in arrays.pieces(batch.column(2).slice(i, 1)):
                    starts, ends, _ = arrays.words(data, bounds)
                    hashes = arrays.word_hashes(data, starts, ends)
                    places = np.unique(batch.column(3)[i].values.to_numpy())
                    counts = places % packed(window)
                    at = np.repeat(places // packed(window), counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                    columns = [
                        arrays.run_hashes(hashes, at, at + window).view(np.int64),
                        arrays.run_hashes(hashes, at, at + window, _OTHER).view(np.int64),
                    ]
                    same = [pa.array(np.full(len(at), batch.column(c)[i].as_py(), dtype=np.int64)) for c in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), *same, pa.array(at.astype(np.int32))], names=names)

    return docs.mapInArrow(look, WINDOWS)


def repeated_blocks(docs: DataFrame, window: int) -> DataFrame:
    """The blocks of (ord, text_hash, text) whose anchor occurs at least twice, stored."""
    blocks = _blocks(docs, window)
    counts = blocks.select("anchor").groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
    return stored(blocks.join(counts.select(apart("anchor").alias("often")), apart("anchor") == F.col("often"), "left_semi"), "repeated")


def matches(docs: DataFrame, window: int = 20) -> DataFrame:
    """Per document (ord, text_hash) an array ``found`` of (start, windows, ref, ref_start).

    Each entry says that ``windows`` windows from the word ``start`` on stand
    earlier; ref and ref_start name the earliest place of the block, NULL for
    single windows at the boundary of factors.
    """
    keyed, factor = _keyed(docs), packed(window)
    texts = keyed.select("ord", "text_hash", "text")
    blocks = repeated_blocks(texts, window)
    where = F.struct("ord", "place")
    contents = blocks.groupBy("anchor", "content").agg(F.min(where).alias("first"), F.count("*").alias("n"))
    # Contents that occur once need no index: such a block is new.
    index = contents.filter("n > 1").select(apart("anchor").alias("a"), F.col("content").alias("c"), "first")
    # Contents differ under one anchor: only there can a new block hold an old window.
    mixed = contents.groupBy("anchor").agg(F.count("*").alias("contents")).filter("contents > 1").select(apart("anchor").alias("m"))
    parsed = blocks.join(index, (apart("anchor") == F.col("a")) & (F.col("content") == F.col("c")), "left")
    old = parsed.filter(F.col("first") < where).select(
        "ord", "text_hash", F.expr(f"cast(place div {factor} as int)").alias("start"), (F.col("place") % factor).cast("int").alias("windows"),
        F.col("first.ord").alias("ref"), F.expr(f"cast(first.place div {factor} as int)").alias("ref_start"),
    )
    new = parsed.filter(F.col("first").isNull() | (F.col("first") == where)).join(mixed, apart("anchor") == F.col("m"), "left_semi")
    border = new.groupBy(F.col("ord").alias("o"), F.col("text_hash").alias("t")).agg(F.collect_set("place").alias("places"))
    searched = texts.join(border, (F.col("ord") == F.col("o")) & (F.col("text_hash") == F.col("t")))
    windows = stored(_windows(searched.select("ord", "text_hash", "text", "places"), window), "windows")
    at = F.struct("ord", "start")
    twice = windows.groupBy("hash1", "hash2").agg(F.min(at).alias("first"), F.count("*").alias("n")).filter("n > 1")
    earliest = twice.select(apart("hash1").alias("h1"), F.col("hash2").alias("h2"), "first")
    single = windows.join(earliest, (apart("hash1") == F.col("h1")) & (F.col("hash2") == F.col("h2"))).filter(F.col("first") < at)
    single = single.select(
        "ord", "text_hash", "start", F.lit(1).alias("windows"),
        F.lit(None).cast("long").alias("ref"), F.lit(None).cast("int").alias("ref_start"),
    )
    return old.union(single).groupBy("ord", "text_hash").agg(
        F.collect_set(F.struct("start", "windows", "ref", "ref_start")).alias("found")
    )


def factors(start: np.ndarray, windows: np.ndarray, ref: np.ndarray, ref_start: np.ndarray, window: int) -> int:
    """Number of factors: from the left, a block goes on with the last one if both lie at one distance in one document."""
    whole = ref_start >= 0
    order = np.argsort(start[whole], kind="stable")
    s, e = start[whole][order], (start + windows + window - 1)[whole][order]
    r, shift = ref[whole][order], (ref_start - start)[whole][order]
    if not len(s):
        return 0
    return 1 + int(((r[1:] != r[:-1]) | (shift[1:] != shift[:-1]) | (s[1:] > e[:-1])).sum())


def deduplicate(docs: DataFrame, window: int = 20, with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, n_factors and, if wanted, kept.

    Every word in a window of ``window`` words that also starts earlier (in a
    document with a smaller id, or before in the same one) is removed. Windows
    are judged on the input. A NULL id stands last. Rows with one id are
    versions of one document: a window at the same start of another version
    isn't earlier, so repeated rows don't remove each other. Texts without or
    with few words (also NULL) stay whole. An empty table gives an empty
    result. Columns other than doc_id and text aren't read. ``kept`` holds the
    words left, joined by one space.
    """
    ship(docs.sparkSession)
    found = matches(docs, window).select(F.col("ord").alias("o"), F.col("text_hash").alias("t"), "found")
    joined = _keyed(docs).join(found, (F.col("ord") == F.col("o")) & (F.col("text_hash") == F.col("t")), "left").select(
        "doc_id", "text",
        F.transform("found", lambda x: x["start"]).alias("start"), F.transform("found", lambda x: x["windows"]).alias("windows"),
        F.transform("found", lambda x: F.coalesce(x["ref"], F.lit(0))).alias("ref"),
        F.transform("found", lambda x: F.coalesce(x["ref_start"], F.lit(-1))).alias("ref_start"),
    )
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, n_factors int" + ", kept string" * with_text

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = 0
            out: list[tuple] = []
            offsets, data = arrays.texts(batch.column(1))
            for i in range(batch.num_rows):
                words = data[offsets[i] : offsets[i + 1]].tobytes().split()
                n_factors, kept = 0, words
                if batch.column(2)[i].is_valid:
                    start, windows, ref, ref_start = (batch.column(c)[i].values.to_numpy().astype(np.int64) for c in range(2, 6))
                    n_factors = factors(start, windows, ref, ref_start, window)
                    cover = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(cover, start, 1)
                    np.add.at(cover, start + windows + window - 1, -1)
                    kept = [words[k] for k in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()]
                left = b" ".join(kept)
                out.append((batch.column(0)[i].as_py(), len(words), len(words) - len(kept), hashlib.sha256(left).hexdigest(), n_factors, left.decode() if with_text else ""))
                size += len(left) * with_text
                if size > 8 * arrays.PIECE:
                    yield _rows(out)
                    size, out = 0, []
            if out:
                yield _rows(out)

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "n_factors", "kept"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string()]
        columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
        wanted = 5 + with_text
        return pa.RecordBatch.from_arrays(columns[:wanted], names=names[:wanted])

    return joined.mapInArrow(remove, schema)
