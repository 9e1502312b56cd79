"""Texts of an Arrow batch as numpy arrays: words, hashes of words and of runs of words.

Used inside tasks. A batch is cut into pieces of whole texts of about a
megabyte, so memory does not depend on the batch; only a longer text makes a
larger piece. All hashes are 64 bits, the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = 0x9E3779B97F4A7C15 | 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: A random-looking number for each byte.
BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_to(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 … n-1 of ``base`` and of its inverse, modulo 2^64."""
    known = _powers.get(base)
    if known is None or len(known[0]) < n:
        size = max(n, 1 << 18)

        def powers(b):
            out = np.full(size, b, dtype=np.uint64)
            out[0] = 1
            return np.cumprod(out, dtype=np.uint64)

        known = powers(base), powers(pow(base, -1, 1 << 64))
        if size <= 4 << 20:
            _powers[base] = known
    return known


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Hash of values[start:end] for each pair; depends on the values only, not on where they stand."""
    up, down = _powers_to(len(values) + 1, base)
    prefix = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=prefix[1:])
    lengths = (ends - starts).astype(np.uint64)
    return mix((prefix[ends] - prefix[starts]) * down[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return ends, (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8))


def pieces(column: pa.Array | pa.ChunkedArray, size: int = PIECE, most: int = 4096) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, bounds) of pieces of up to ``most`` whole texts.

    Row i of a piece is bytes[bounds[i]:bounds[i + 1]].
    """
    offsets, data = texts(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        last = min(last, first + most)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, bounds: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; a word ends with its text."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    inside = ~space[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[bounds] = True
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    stops[:-1] &= ~inside[1:] | cut[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(bounds, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every word, taken in stretches so that a long text doesn't need much memory."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + PIECE, side="right")))
        lo = starts[first]
        out[first:last] = run_hashes(BYTES[data[lo : ends[last - 1]]], starts[first:last] - lo, ends[first:last] - lo)
        first = last
    return out
