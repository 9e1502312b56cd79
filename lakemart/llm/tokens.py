"""Operator 10: token counts by a longest-match automaton.

Word pieces are taken greedily: from the left, always the longest entry of the
vocabulary. Instead of starting over after each piece, an automaton reads every
byte once. Its nodes are the prefixes of entries. Where a node has no child for
the next byte, some pieces are certain: their number was computed beforehand
(``popped``), and the failure link leads to the node of the rest. Counting needs
these numbers only, the pieces are never built.

Words are runs of non-blank characters, each read as a blank and its bytes, as
byte-level vocabularies spell the start of a word. Every single byte must be an
entry, so every word can be split.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm import arrays
from lakemart.llm.common import ship

RESULT = "doc_id long, n_words long, n_tokens long"


def read_ranks(path: str) -> list[bytes]:
    """The entries of a vocabulary file with a base64 entry and a rank per line."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


@dataclass
class Automaton:
    """Nodes in breadth-first order: the children of a node follow each other, from ``first``, by byte."""

    children: np.ndarray  # 4 x 64 bits per node: the bytes that have a child
    before: np.ndarray  # children before each of the four groups of bytes
    first: np.ndarray
    fail: np.ndarray  # where to go on if there is no child
    popped: np.ndarray  # pieces that are certain then
    finish: np.ndarray  # pieces if the word ends here

    def child(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The child for a byte, -1 if there is none."""
        group, bit = byte >> 6, (byte & 63).astype(np.uint64)
        have = self.children[node, group]
        below = np.bitwise_count(have & ((np.uint64(1) << bit) - np.uint64(1)))
        found = self.first[node] + self.before[node, group] + below
        return np.where((have >> bit) & np.uint64(1) > 0, found, -1)

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of pieces of every word data[start:end], all words side by side, byte by byte."""
        order = np.argsort(starts - ends, kind="stable")
        starts, lengths = starts[order], (ends - starts)[order]
        root_blank = self.child(np.zeros(1, dtype=np.int64), np.array([0x20]))[0]
        node = np.full(len(starts), root_blank, dtype=np.int64)
        total = np.zeros(len(starts), dtype=np.int64)
        left = len(starts)
        for place in range(int(lengths[0]) if len(lengths) else 0):
            left = int(np.searchsorted(-lengths, -place, side="left"))  # words longer than place
            byte = data[starts[:left] + place].astype(np.int64)
            found = self.child(node[:left], byte)
            stuck = np.flatnonzero(found < 0)
            while len(stuck):
                total[stuck] += self.popped[node[stuck]]
                node[stuck] = self.fail[node[stuck]]
                found[stuck] = self.child(node[stuck], byte[stuck])
                stuck = stuck[found[stuck] < 0]
            node[:left] = found
        out = np.empty(len(starts), dtype=np.int64)
        out[order] = total + self.finish[node]
        return out


def build(entries: list[bytes]) -> Automaton:
    """The automaton of a vocabulary that holds every single byte."""
    vocabulary = {e for e in entries if e}
    if any(bytes([b]) not in vocabulary for b in range(256)):
        raise ValueError("the vocabulary must hold every single byte")
    prefixes = {e[:n] for e in vocabulary for n in range(len(e) + 1)}
    order = sorted(prefixes, key=lambda p: (len(p), p))
    number = {p: i for i, p in enumerate(order)}
    n = len(order)
    children = np.zeros((n, 4), dtype=np.uint64)
    first = np.zeros(n, dtype=np.int64)
    fail, popped, finish = (np.zeros(n, dtype=np.int64) for _ in range(3))
    for i in range(n - 1, 0, -1):
        parent, byte = number[order[i][:-1]], order[i][-1]
        children[parent, byte >> 6] |= np.uint64(1 << (byte & 63))
        first[parent] = i
    counts = np.bitwise_count(children).astype(np.int64)
    before = np.zeros((n, 4), dtype=np.int64)
    before[:, 1:] = np.cumsum(counts[:, :3], axis=1)
    for i in range(1, n):
        prefix = order[i]
        if prefix in vocabulary:  # the node itself is a piece, nothing is left
            fail[i], popped[i], finish[i] = 0, 1, 1
            continue
        # Follow the failure links of the parent until the last byte can be read.
        at, pops = number[prefix[:-1]], 0
        while True:
            pops += popped[at]
            at = fail[at]
            down = number.get(order[at] + prefix[-1:])
            if down is not None:
                break
        fail[i], popped[i], finish[i] = down, pops, pops + finish[down]
    return Automaton(children, before, first, fail, popped, finish)


def token_counts(docs: DataFrame, entries: list[bytes]) -> DataFrame:
    """doc_id, n_words and n_tokens of every whole text. No shuffle.

    An empty, missing or blank text has no words and no tokens; repeated rows
    and NULL ids keep a row each; other columns aren't read. The automaton is
    broadcast: its size depends on the vocabulary (9 MB for 50,000 entries).
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(build(entries))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            rows = batch.num_rows
            n_words, n_tokens = np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=np.int64)
            for lo, hi, data, bounds in arrays.pieces(batch.column(1)):
                starts, ends, row = arrays.words(data, bounds)
                n_words[lo:hi] = np.bincount(row, minlength=hi - lo)
                pieces = automaton.count(data, starts, ends)
                n_tokens[lo:hi] = np.bincount(row, weights=pieces, minlength=hi - lo).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words), pa.array(n_tokens)], names=["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, RESULT)
