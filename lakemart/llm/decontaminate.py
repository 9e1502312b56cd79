"""Operator 3: find benchmark passages in documents by the q-gram lemma.

If a passage of m characters stands in a text with at most k edits, the text
there shares at least m - q + 1 - k q of its q-grams, on diagonals (place in
the text minus place in the passage) that are at most k apart. So the shared
q-grams of a text and each passage are counted in overlapping bands of
diagonals, 2 (k + 1) wide and k + 1 apart; a band below the bound cannot hold the
passage. What is left is verified by an alignment limited to the band.

The passages are the query set: they are read in blocks of bounded size, and
all documents are searched for each block, in one pass without a shuffle, one
block after another.
Texts are compared in lower case with every run of blanks as one space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm import arrays
from lakemart.llm.common import free_name, ship, stored, with_row_key

Q = 8
#: Edits allowed per character of a passage.
BUDGET = 0.1
#: Bytes of passages in a block: what a task holds besides a text is about 40 times that.
BLOCK = 4 << 20

_FILTER_BITS = 22
#: Shared q-grams that are counted at a time.
_AT_ONCE = 1 << 20
_BLANKS = re.compile(r"[ \t-\r]+")


def normalise(text: str) -> str:
    return _BLANKS.sub(" ", text.lower()).strip(" ")


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def _grams(points: np.ndarray) -> np.ndarray:
    """Hash of the q-gram that begins at each character; of blocks of a text, as many as fit."""
    n = len(points) - Q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    wide = points.astype(np.uint64)
    for k in range(Q):
        total = total * np.uint64(0x9E3779B97F4A7C15 | 1) + wide[k : k + n]
    return arrays.mix(total)


def edits_allowed(m: int, budget: float) -> int:
    """Edit budget of a passage of m characters, so that the lemma demands at least one shared q-gram."""
    return max(0, min(int(m * budget), (m - Q) // Q))


@dataclass
class Index:
    """The q-grams of a block of passages, sorted by hash, and a bitmap that most other q-grams fail."""

    items: list
    points: list[np.ndarray]
    texts: list[str]
    grams: np.ndarray
    item: np.ndarray
    place: np.ndarray
    known: np.ndarray
    short: list[int]
    own: list[np.ndarray]  # the q-grams of each passage, by place
    lengths: np.ndarray
    allowed: np.ndarray  # edits
    need: np.ndarray  # q-grams that a text must share

    @classmethod
    def of(cls, passages: list[tuple], budget: float) -> Index:
        texts = [normalise(text) for _, text in passages]
        points = [_points(t) for t in texts]
        grams = [_grams(p) for p in points]
        all_grams = np.concatenate([*grams, np.zeros(0, dtype=np.uint64)])
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([*(np.arange(len(g)) for g in grams), np.zeros(0, dtype=np.int64)])
        order = np.argsort(all_grams, kind="stable")
        known = np.zeros(1 << _FILTER_BITS, dtype=bool)
        known[all_grams >> np.uint64(64 - _FILTER_BITS)] = True
        short = [i for i, p in enumerate(points) if 0 < len(p) < Q]
        lengths = np.array([len(p) for p in points], dtype=np.int64)
        allowed = np.array([edits_allowed(m, budget) for m in lengths.tolist()], dtype=np.int64)
        return cls(
            [i for i, _ in passages], points, texts, all_grams[order], item[order], place[order], known, short, grams,
            lengths, allowed, lengths - Q + 1 - allowed * Q,
        )

    def candidates(self, text: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(passage, first diagonal, diagonal after the last) of every band that reaches the bound of the lemma."""
        grams = _grams(text)
        at = np.flatnonzero(self.known[grams >> np.uint64(64 - _FILTER_BITS)])
        first = np.searchsorted(self.grams, grams[at], side="left")
        count = np.searchsorted(self.grams, grams[at], side="right") - first
        total = int(count.sum())
        if not total:
            return
        # Shared q-grams are counted per passage and band, some at a time: a text may repeat itself very often.
        bands, shared = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        keys, sums, waiting = [bands], [shared], 0
        reached = np.cumsum(count)
        begin = 0
        while begin < len(at):
            done = max(begin + 1, int(np.searchsorted(reached, (reached[begin - 1] if begin else 0) + _AT_ONCE, side="right")))
            some, n = slice(begin, done), count[begin:done]
            hit = np.repeat(first[some], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            item = self.item[hit]
            band = np.floor_divide(np.repeat(at[some], n) - self.place[hit], self.allowed[item] + 1)
            own, times = np.unique((item << 40) + band + (1 << 39), return_counts=True)
            # Bands overlap by half: a diagonal counts for its own and the one before.
            keys += [own, own - 1]
            sums += [times, times]
            waiting += 2 * len(own)
            begin = done
            if waiting > len(bands) or begin == len(at):  # what is held grows with the bands, not with the shared q-grams
                bands, where = np.unique(np.concatenate(keys), return_inverse=True)
                shared = np.bincount(where, weights=np.concatenate(sums)).astype(np.int64)
                keys, sums, waiting = [bands], [shared], 0
        bands = bands[shared >= self.need[bands >> 40]]
        item, band = bands >> 40, (bands & ((1 << 40) - 1)) - (1 << 39)
        width = self.allowed[item] + 1
        lo, hi = band * width, (band + 2) * width
        # Where a text repeats itself its bands touch the same characters: the first of equal ones tells for all.
        start, stop = np.maximum(lo, 0), np.clip(hi + self.lengths[item] - 1, 0, len(text))
        same = np.stack([item, start - lo, hi - stop, arrays.run_hashes(arrays.mix(text.astype(np.uint64) + np.uint64(1)), start, stop).view(np.int64)]) if len(lo) else None
        for j in np.sort(np.unique(same, axis=1, return_index=True)[1]).tolist() if len(lo) else ():
            i = int(item[j])
            # A text that repeats itself fills bands: what counts is how many q-grams of the passage are there.
            there = grams[start[j] : max(0, hi[j] + int(self.lengths[i]))]
            if np.isin(self.own[i], there).sum() >= self.need[i]:
                yield i, int(lo[j]), int(hi[j])

    def occurrences(self, text: str) -> Iterator[tuple[int, tuple[int, int]]]:
        """(passage, (edits, start)) of passages that stand in a normalised text, the best of a band each."""
        points = _points(text)
        if self.short:  # too short for a q-gram: as words, exactly
            padded = f" {text} "
            for i in self.short:
                at = padded.find(f" {self.texts[i]} ")
                if at >= 0:
                    yield i, (0, at)
        for i, lo, hi in self.candidates(points):
            allowed = int(self.allowed[i])
            found = align(self.points[i], points, lo, hi, allowed)
            if found[0] <= allowed:
                yield i, found

    def stands(self, text: str) -> bool:
        """Whether any passage stands in a normalised text."""
        return next(self.occurrences(text), None) is not None

    def search(self, text: str) -> list[tuple]:
        """(item, start, edits) of the best occurrence of every passage that stands in a normalised text."""
        best: dict[int, tuple[int, int]] = {}
        for i, found in self.occurrences(text):
            best[i] = min(found, best.get(i, found))
        return [(self.items[i], start, edits) for i, (edits, start) in sorted(best.items())]


def align(passage: np.ndarray, text: np.ndarray, lo: int, hi: int, most: int) -> tuple[int, int]:
    """(edits, start) of the passage in the text, along paths on the diagonals lo … hi - 1; given up beyond ``most`` edits.

    Start and end in the text are free. Row i of the table holds the cost of
    the first i characters at text place i + diagonal.
    """
    m, n, width = len(passage), len(text), hi - lo
    for d in range(max(lo, 0), min(hi, n - m + 1)):  # most are exact
        if text[d] == passage[0] and text[d + m - 1] == passage[-1] and np.array_equal(text[d : d + m], passage):
            return 0, d
    far = m + n + 1
    diagonal, steps = np.arange(lo, hi), np.arange(width)
    # The part of the text that the band touches, with a character that no text has beyond its ends.
    near = np.full(m + width, 0xFFFFFFFF, dtype=np.uint32)
    first, last = max(lo, 0), min(hi + m - 1, n)
    if first < last:
        near[first - lo : last - lo] = text[first:last]
    cost = np.full(width + 1, far)  # a column more, that is never reached
    cost[:width][(diagonal >= 0) & (diagonal <= n)] = 0
    start = np.append(diagonal, 0)
    for i in range(1, m + 1):
        new = cost[:width] + (near[i - 1 : i - 1 + width] != passage[i - 1])
        # A character of the passage is missing in the text: from the diagonal above.
        skip = cost[1:] + 1
        better = skip < new
        origin = np.where(better, start[1:], start[:width])
        new = np.where(better, skip, new)
        if i + lo < 1 or i + hi - 1 > n:  # places outside of the text
            new[(diagonal + i < 0) | (diagonal + i > n)] = far
        # The text has further characters: from the left in this row, one edit a step.
        run = np.minimum.accumulate((new - steps) * width + steps)
        source = run % width
        cost[:width] = new[source] + steps - source
        start[:width] = origin[source]
        if i + hi - 1 > n:
            cost[:width][diagonal + i > n] = far
        if cost.min() > most:
            return far, lo
    end = int(np.argmin(cost))
    return int(cost[end]), int(start[end])


def _passages(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """The different passages; NULL and blank ones are left out."""
    return benchmark.select(F.col(item).cast("long").alias("item_id"), F.col(text).alias("text")).filter("trim(text) <> ''").distinct()


def n_blocks(benchmark: DataFrame, item: str, text: str, block: int | None = None) -> int:
    """Number of blocks that a benchmark makes; one at least."""
    size = _passages(benchmark, item, text).agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    return max(1, -(-size // (block or BLOCK)))


def passages_in_blocks(benchmark: DataFrame, item: str, text: str, block: int | None = None) -> Iterator[list[tuple]]:
    """The passages in parts of about ``block`` bytes: one at a time on the driver."""
    rows, parts = _passages(benchmark, item, text), n_blocks(benchmark, item, text, block)
    for part in range(parts):
        chosen = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        yield sorted(((r["item_id"], r["text"]) for r in chosen), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def find_passages(docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET, item: str = "item_id") -> DataFrame:
    """One row per document and passage that stands in it: doc_id, item_id, start, edits.

    ``start`` counts characters of the normalised text; the occurrence with the
    fewest edits, then the first, is told. Documents without a passage have no
    row; NULL and empty texts have none. Repeated documents have rows each;
    passages with NULL ids are searched, too. A very long text is searched as
    a whole: memory grows with it and with the bands that it fills. An empty
    table of either kind gives an empty result; other columns aren't read.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _searched(slim, "doc_id", "long", benchmark, budget, item)


def _searched(docs: DataFrame, key: str, kind: str, benchmark: DataFrame, budget: float, item: str) -> DataFrame:
    """(``key``, item_id, start, edits) for ``docs`` of (key, text).

    A benchmark of more than one block is searched block after block, each in a
    job of its own whose rows are stored, so neither driver nor executors ever
    hold more than one index.
    """
    spark = docs.sparkSession
    ship(spark)
    schema = f"{key} {kind}, item_id long, start long, edits int"
    names = [key, "item_id", "start", "edits"]
    parts, blocks = [], n_blocks(benchmark, item, "text")
    for passages in passages_in_blocks(benchmark, item, "text"):
        shared = spark.sparkContext.broadcast(Index.of(passages, budget))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                rows, found = [], []
                for row, text in enumerate(_texts(batch.column(1))):
                    for what in index.search(normalise(text)):
                        rows.append(row)
                        found.append(what)
                columns = zip(*found, strict=True) if found else [[]] * 3
                columns = [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int32()), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *columns], names=names)

        part = docs.select(key, "text").mapInArrow(search, schema)
        if blocks > 1:
            part = stored(part, "passages")
            shared.destroy()
        parts.append(part)
    return reduce(DataFrame.union, parts)


def _texts(column: pa.Array) -> Iterator[str]:
    return ((x.as_py() or "") for x in column)


def without_passages(docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET, item: str = "item_id") -> DataFrame:
    """``docs`` without those in which a passage stands; all columns, clashing names too.

    One block of passages needs no shuffle: texts go to Python and a flag comes
    back. With more, the rows found block by block are stored and taken off by
    an anti-join. NULL and empty texts stay, repeated rows are judged alike.
    """
    spark = docs.sparkSession
    ship(spark)
    if n_blocks(benchmark, item, "text") > 1:
        row, found = free_name(docs, "_row"), free_name(docs, "_found_row")
        keyed = with_row_key(docs, row)
        slim = keyed.select(F.col(row).alias("row"), "text")
        dirty = _searched(slim, "row", slim.schema["row"].dataType.simpleString(), benchmark, budget, item).select(F.col("row").alias(found)).distinct()
        return keyed.join(dirty, F.col(row) == F.col(found), "left_anti").select(*docs.columns)
    shared = spark.sparkContext.broadcast(Index.of(next(passages_in_blocks(benchmark, item, "text")), budget))

    def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = shared.value
        for column in texts:
            yield pa.array([not index.stands(normalise(text)) for text in _texts(column)], pa.bool_())

    return docs.filter(F.arrow_udf(clean, "boolean")("text"))
