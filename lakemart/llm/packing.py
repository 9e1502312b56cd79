"""Operator 13: pack token sequences by first-fit decreasing with a tournament tree.

A document is its token ids and an end mark. Whole sequences of ``size`` ids are
cut off it and need no packing. The rests are dealt into random groups of about
``GROUP`` documents, and each group is packed on its own: the longest rest goes
first, always into the first sequence with room, which a tournament tree over
the room of all sequences finds in a logarithm of their number. What first-fit
leaves open is closed by cutting: the emptiest sequences of the group are taken
apart to fill the others, so one sequence of a group is not full. A sequence is
padded to ``size`` unless its length is a power of two, so that one is cut into
lengths that are.

No global order is needed: a group is bounded whatever the table holds, and
only rests (less than ``size`` ids a document) are moved.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import free_name, ship, stored, with_row_key

#: Documents per group, on average: a group is some megabytes of ids.
GROUP = 4096
END = 0

_PIECES = "doc_id long, group long, start long, length long, doc_tokens long, ids_crc32 long, ids binary"
_NAMES = [c.split()[0] for c in _PIECES.split(", ")]


class Encoder:
    """Token ids as the tokenizer file says, without adding special tokens.

    With ``ranks`` (entry and id of each token) and the ``pattern`` that parts
    a text before merging, a faster reader of the same vocabulary gives the
    same ids. Texts that hold an added token's string, which has an id of its
    own, are left to the tokenizer itself.
    """

    def __init__(self, tokenizer: str, ranks: dict[bytes, int] | None = None, pattern: str | None = None):
        self.tokenizer, self.ranks, self.pattern = tokenizer, ranks, pattern

    def __getstate__(self):  # the readers are built where they are used
        return {"tokenizer": self.tokenizer, "ranks": self.ranks, "pattern": self.pattern}

    @cached_property
    def _whole(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.tokenizer)

    @cached_property
    def _added(self) -> list[str]:
        return [token.content for token in self._whole.get_added_tokens_decoder().values()]

    @cached_property
    def _fast(self):
        import tiktoken

        # A special token, as the reader looks for one; no text with it comes here.
        special = {self._added[0]: len(self.ranks)} if self._added else {}
        return tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        if self.ranks and not any(token in text for token in self._added):
            return self._fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self._whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def first_fit_decreasing(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Items of every bin, in the order of packing. ``lengths`` are sorted, the longest first; none is above ``size``."""
    n = len(lengths)
    leaves = 1 << max(0, n - 1).bit_length()
    room = [size] * (2 * leaves)  # of every bin, and the most below every inner node
    bins: list[list[int]] = []
    for i, length in enumerate(lengths.tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        if node - leaves == len(bins):
            bins.append([])
        bins[node - leaves].append(i)
        room[node] -= length
        node //= 2
        while node:
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
            node //= 2
    return bins


def fill_gaps(bins: list[list[tuple[int, int, int]]], size: int) -> list[list[tuple[int, int, int]]]:
    """Bins of (item, start, length): the emptiest are taken apart to fill the others, the last is cut into powers of two."""
    bins = sorted(bins, key=lambda b: -sum(p[2] for p in b))
    room = [size - sum(p[2] for p in b) for b in bins]
    to, last = 0, len(bins) - 1
    while to < last:
        if not room[to]:
            to += 1
        elif not bins[last]:
            last -= 1
        else:
            item, start, length = bins[last].pop()
            taken = min(room[to], length)
            if taken < length:
                bins[last].append((item, start, length - taken))
            bins[to].append((item, start + length - taken, taken))
            room[to] -= taken
            room[last] += taken
    bins = bins[: last + 1]
    if bins and not bins[-1]:
        bins.pop()
    if bins and sum(p[2] for p in bins[-1]) < size:
        rest = bins.pop()
        total = sum(p[2] for p in rest)
        while total:
            bins.append(own := [])
            left = 1 << total.bit_length() - 1
            total -= left
            while left:
                item, start, length = rest.pop(0)
                taken = min(left, length)
                own.append((item, start, taken))
                left -= taken
                if taken < length:
                    rest.insert(0, (item, start + taken, length - taken))
    return bins


def pieces(docs: DataFrame, encoder: Encoder, size: int, groups: int, with_ids: bool) -> DataFrame:
    """Whole sequences and rests of (doc_id, group, text), with ids where they are still needed. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(encoder)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = shared.value.ids
        for batch in batches:
            rows, held = [], 0
            for doc_id, group, text in zip(*(c.to_pylist() for c in batch.columns[:2]), batch.column(2), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END)).astype("<u4")
                for start in range(0, len(ids), size):
                    own = ids[start : start + size].tobytes()
                    whole = len(own) == 4 * size
                    rows.append((doc_id, group, start, len(own) // 4, len(ids), zlib.crc32(own) if whole else None, None if whole and not with_ids else own))
                    held += len(own) + 64
                    if held > 16 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
            if rows:
                yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [*[pa.int64()] * 6, pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=_NAMES)

    return docs.mapInArrow(cut, _PIECES)


def packed_group(rests: pa.Table, size: int) -> pa.Table:
    """The pieces of one group with their sequence and place in it; rests come in any order."""
    rows = sorted(rests.select(["doc_id", "start", "length", "doc_tokens", "ids"]).to_pylist(), key=lambda r: (-r["length"], r["doc_id"] is None, r["doc_id"] or 0, r["start"], r["ids"]))
    bins = first_fit_decreasing(np.array([r["length"] for r in rows]), size)
    out = []
    group = rests["group"][0].as_py()
    for nth, own in enumerate(fill_gaps([[(i, 0, rows[i]["length"]) for i in b] for b in bins], size)):
        offset = 0
        for i, start, length in own:
            r, ids = rows[i], rows[i]["ids"][4 * start : 4 * (start + length)]
            out.append((r["doc_id"], r["start"] + start, length, zlib.crc32(ids), r["doc_tokens"], 2 * ((group << 32) + nth), offset, ids))
            offset += length
    kinds = [*[pa.int64()] * 7, pa.binary()]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def pack(docs: DataFrame, encoder: Encoder, size: int = 1024, group: int = GROUP, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if wanted, ids.

    ``start`` counts the document's ids before the piece, ``doc_tokens`` all of
    them with the end mark, ``offset`` the ids before it in its sequence;
    ``ids`` are little-endian unsigned 32-bit numbers, ``ids_crc32`` is their
    checksum. A NULL or empty text is the end mark alone. NULL and repeated
    ids are documents like any other, and so are repeated rows: groups are
    drawn by a row's place in its file, so no key gathers in one. A very long
    text is encoded as a whole and cut; its whole sequences are never moved.
    Columns other than doc_id and text aren't read. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    row, dealt = free_name(docs, "_row"), free_name(docs, "_group")
    keyed = with_row_key(docs, row)
    groups = max(1, round(docs.count() / group))
    slim = keyed.select(F.col("doc_id").cast("long").alias("doc_id"), F.pmod(F.xxhash64(row), F.lit(groups)).alias(dealt), "text")
    cut = stored(pieces(slim, encoder, size, groups, with_ids), "pieces")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"][: 7 + with_ids]
    number = 2 * F.monotonically_increasing_id() + 1  # packed sequences have the even numbers
    whole = cut.filter(F.col("length") == size).withColumn("sequence_id", number).withColumn("offset", F.lit(0).cast("long"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"

    def pack_group(rests: pa.Table) -> pa.Table:
        return packed_group(rests, size)

    rests = cut.filter(F.col("length") < size).groupBy("group").applyInArrow(pack_group, schema)
    return whole.select(*names).union(rests.select(*names))
