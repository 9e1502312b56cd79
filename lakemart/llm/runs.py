"""Operator 12: find periodic runs by a dictionary of basic factors.

For every power of two the factors of that many words are numbered (equal
factors get equal numbers); those of the next power are pairs of numbers. Where
a factor occurs again soon, its successor is at most twice its length away, and
the distances from a factor to its successor tell the period of the run it
stands in: within a run of period q and at least four periods, all factors of
length L, q <= L < 2 q, have their successor just q words on, as a nearer one
would give the run a smaller period. So they form arithmetic progressions, one
from each of q consecutive words, and such a stretch of words, extended by
L + q words, is the run. Every period is looked for at one length only, and every
run is found once.

Only places whose factor occurs twice in its text go on to the next length,
which in ordinary text are soon few.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm import arrays
from lakemart.llm.common import ship

#: A run has at least so many words and so many periods.
LEAST, PERIODS = 6, 4

RESULT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def runs_of(names: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs in texts that stand one after another.

    ``names`` are numbers of words, different in different texts; ``ends`` tells
    for every word where its text ends. Runs are sorted by start, then period.
    """
    none = np.zeros(0, dtype=np.int64)
    found = [(none, none, none)]
    place = np.arange(len(names))
    number = np.unique(names, return_inverse=True)[1].astype(np.int64)
    size = 1
    while len(place):
        # Equal factors side by side, in order of their places.
        order = np.argsort(number, kind="stable")
        sorted_number, sorted_place = number[order], place[order]
        same = sorted_number[1:] == sorted_number[:-1]
        gap = np.zeros(len(place), dtype=np.int64)
        gap[:-1][same] = (sorted_place[1:] - sorted_place[:-1])[same]
        twice = np.zeros(len(place), dtype=bool)
        twice[:-1] |= same
        twice[1:] |= same
        near = (gap > size // 2) & (gap <= size)  # periods that belong to this length
        at = np.argsort(sorted_place[near])
        first, period = sorted_place[near][at], gap[near][at]
        if len(first):
            # Consecutive places with one distance: progressions that share their difference.
            new = np.concatenate([[0], np.flatnonzero((np.diff(first) != 1) | (np.diff(period) != 0)) + 1])
            last = np.concatenate([new[1:], [len(first)]]) - 1
            start, q = first[new], period[new]
            length = first[last] + size + q - start
            long = length >= np.maximum(LEAST, PERIODS * q)
            found.append((start[long], length[long], q[long]))
        # The next length, from places whose halves both occur twice and whose text goes on far enough.
        kept, kept_number = sorted_place[twice], sorted_number[twice]
        back = np.argsort(kept)
        kept, kept_number = kept[back], kept_number[back]
        half = np.searchsorted(kept, kept + size)
        half[half == len(kept)] = 0
        pair = (kept[half] == kept + size) & (kept + 2 * size <= ends[kept]) if len(kept) else np.zeros(0, dtype=bool)
        place = kept[pair]
        both = kept_number[pair] * (int(number.max()) + 1) + kept_number[half[pair]]
        number = np.unique(both, return_inverse=True)[1].astype(np.int64)
        size *= 2
    start, length, period = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def rewritten(doc_id: int | None, n: int) -> np.ndarray | None:
    """For one document in ten the words that its words become, by a checksum of the id; None for the others."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def _best(start: np.ndarray, length: np.ndarray, period: np.ndarray) -> int:
    """The run with the greatest exponent, then smallest start, then smallest period; runs come in that order."""
    ratio = length / period
    top = np.flatnonzero(ratio >= ratio.max() * (1 - 1e-12))  # all that may be greatest: the rest is exact
    exact = [Fraction(int(length[i]), int(period[i])) for i in top]
    return int(top[exact.index(max(exact))])


def _judged(doc_ids: list, data: np.ndarray, bounds: np.ndarray, rewrite: bool) -> Iterator[tuple]:
    """A row of the result, the runs and the kept words for every text of a piece."""
    starts, stops, row = arrays.words(data, bounds)
    firsts = np.searchsorted(row, np.arange(len(bounds)))
    at = np.arange(len(starts))  # the word of the text that stands at each place
    for i, doc_id in enumerate(doc_ids):
        lo, hi = firsts[i], firsts[i + 1]
        index = rewritten(doc_id, int(hi - lo)) if rewrite else None
        if index is not None:
            at[lo:hi] = lo + index
    hashes = arrays.word_hashes(data, starts, stops)[at]
    # Numbers of words differ between texts.
    names = arrays.mix(hashes + arrays.mix(row.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(1)))
    start, length, period = runs_of(names, firsts[row + 1])
    cover = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    kept = np.cumsum(cover[:-1]) == 0
    cuts = np.searchsorted(start, firsts)
    raw = data.tobytes()
    for i, doc_id in enumerate(doc_ids):
        lo, hi = int(firsts[i]), int(firsts[i + 1])
        own = slice(cuts[i], cuts[i + 1])
        s, n, q = start[own] - lo, length[own], period[own]
        words = at[lo:hi][kept[lo:hi]]
        left = b" ".join([raw[a:b] for a, b in zip(starts[words].tolist(), stops[words].tolist(), strict=True)])
        text = "".join(f"{a},{b},{c}\n" for a, b, c in zip(s.tolist(), n.tolist(), q.tolist(), strict=True))
        best = (None,) * 4
        if len(s):
            k = _best(s, n, q)
            best = int(s[k]), int(n[k]), int(q[k]), 1000 * int(n[k]) // int(q[k])
        yield (doc_id, len(s), *best, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(left).hexdigest()), (s, n, q), left


def periodic_runs(docs: DataFrame, rewrite: bool = False, with_runs: bool = True) -> DataFrame:
    """One row per document: ``RESULT`` and, if wanted, the ``runs`` and the text ``collapsed``.

    A run is a stretch of words with smallest period q, at least ``LEAST`` words
    and ``PERIODS`` periods long, that can't be extended. Of a run the first q
    words stay, unless another run drops them. start, length, period and
    exponent_milli describe the run with the greatest exponent, the first of
    equal ones, and are NULL without a run. ``rewrite`` plants runs in one
    document of ten, chosen by its id.

    NULL, empty and blank texts have no run and collapse to nothing; a NULL id
    is never chosen for planted runs; repeated ids and rows are documents
    each. A text is held as a whole, with about 100 bytes for each of its
    words. No shuffle; columns other than doc_id and text aren't read. An empty
    table gives an empty result.
    """
    ship(docs.sparkSession)
    schema = RESULT + ", runs array<struct<start: long, length: long, period: long>>, collapsed string" * with_runs
    names = [c.split()[0] for c in RESULT.split(", ")]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, hi, data, bounds in arrays.pieces(batch.column(1)):
                rows, runs, texts = zip(*_judged(ids[lo:hi], data, bounds, rewrite), strict=True)
                kinds = [*[pa.int64()] * 6, pa.string(), pa.string()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                if with_runs:
                    ends = np.cumsum([0, *(len(r[0]) for r in runs)])
                    fields = [pa.array(np.concatenate(c)) for c in zip(*runs, strict=True)]
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, names=["start", "length", "period"])))
                    columns.append(pa.array([t.decode() for t in texts], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *["runs", "collapsed"][: 2 * with_runs]])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(find, schema)
