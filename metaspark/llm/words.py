"""Words of Arrow text columns as numpy arrays, a bounded slice of the column at a time.

A word is a maximal run of bytes other than space and 0x09-0x0D; A-Z count as a-z.  Null is
an empty text.  Work arrays are a few times the slice, however long the column is; only a
single text longer than a slice makes a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
SPAN_BYTES = 1 << 17
U64 = np.uint64
BASE = int(0x9E3779B97F4A7C15)

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CODE = LOWER.astype(U64) + U64(1)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of the rows in them)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    buffer = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, end, buffer[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end
    pa.default_memory_pool().release_unused()


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; a word never crosses rows."""
    inside = ~SEPARATOR[data]
    begins, stops = inside.copy(), inside.copy()
    np.greater(inside[1:], inside[:-1], out=begins[1:])
    np.greater(inside[:-1], inside[1:], out=stops[:-1])
    first = offsets[:-1]
    first = first[first < len(data)]
    begins[first] = inside[first]
    last = offsets[1:]
    last = last[last > 0] - 1
    stops[last] = inside[last]
    starts = np.flatnonzero(begins)
    per_row = np.diff(np.searchsorted(starts, offsets))
    return starts, np.flatnonzero(stops) + 1, np.repeat(np.arange(len(per_row)), per_row)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_TABLES: dict[str, np.ndarray] = {}


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_TABLES.get("up", ())) < size:
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            table = np.full(size, base, dtype=U64)
            table[0] = 1
            _TABLES[name] = np.cumprod(table, dtype=U64)
    return _TABLES["up"], _TABLES["down"]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every lower-cased word: differences of prefix sums of a polynomial."""
    out = np.empty(len(starts), dtype=U64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(ends, base + SPAN_BYTES, side="right")))
        span = int(ends[stop - 1]) - base
        up, down = _powers(max(span + 1, SPAN_BYTES + 1))
        codes = CODE[data[base : base + span]]
        codes *= up[:span]
        sums = np.zeros(span + 1, dtype=U64)
        np.cumsum(codes, out=sums[1:])
        s, e = starts[at:stop] - base, ends[at:stop] - base
        out[at:stop] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(U64))
        at = stop
    return out


SHINGLE = [U64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0x9FB21C651E98DF25)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct shingle hashes of every row, one after another, and the rows' ends.

    A row with fewer words than ``size`` has one shingle, its whole word sequence; a row
    without words has none.
    """
    rows = len(offsets) - 1
    starts, ends, row = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends)
    words = np.bincount(row, minlength=rows)
    first = np.cumsum(words) - words
    shingles = np.minimum(words, 1) + np.maximum(words - size, 0)
    total = np.cumsum(shingles)
    flat = np.empty(int(total[-1]) if rows else 0, dtype=U64)
    owner = np.repeat(np.arange(rows), shingles)
    position = np.arange(len(flat)) - np.repeat(total - shingles, shingles) + first[owner]
    length = np.minimum(words, size)[owner]
    padded = np.concatenate((hashes, np.zeros(size, dtype=U64)))
    flat[:] = length.astype(U64)
    for j in range(size):
        flat += np.where(length > j, padded[position + j] * SHINGLE[j % 5] + U64(j), U64(0))
    flat = mixed(flat)
    begin = 0
    for end in total:
        if end - begin > 1:
            flat[begin:end].sort()
        begin = end
    fresh = np.ones(len(flat), dtype=bool)
    fresh[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
    return flat[fresh], np.cumsum(np.bincount(owner[fresh], minlength=rows))


def ids_or_null(values: pa.Array) -> np.ndarray:
    """A numpy view of a column of whole numbers (null: 0), for grouping inside a task."""
    return pc.fill_null(values.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
