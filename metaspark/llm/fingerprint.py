"""Document fingerprints: a quartile digest of hashed byte triplets, and its difference score.

Every triplet of bytes at three sets of distances goes to a bucket by hash; the distances
are wide, so that a language's common syllables weigh less than the text's own words.  Where
a triplet passes the text's end, the distance past it stands for the byte, so every byte of
any text begins one triplet of each set.  A bucket's count is coded by the quartile of all buckets' counts it lies in (two bits), and the text's length by
its logarithm, so digests of one size describe texts of any size.  Two digests differ by the
steps between their codes, up to a bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import text_slices

BUCKETS = 256
OFFSETS = ((0, 5, 9), (0, 6, 13), (0, 7, 17))
WORST = 1.0
LENGTH_BASE = 1.1
ROWS_PER_RANGE = 2000
RANGES = 4096
SLICE_BYTES = 1 << 20


def _bucket(first: np.ndarray, second: np.ndarray, third: np.ndarray, salt: int) -> np.ndarray:
    h = first * np.uint32(0x9E3779B1) + second * np.uint32(0x85EBCA77)
    h += third * np.uint32(0xC2B2AE3D) + np.uint32(salt * 0x27D4EB2F & 0xFFFFFFFF)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h >>= np.uint32(24)
    return h


def bucket_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed triplets, one row of ``BUCKETS`` per text."""
    rows = len(offsets) - 1
    row = np.repeat(np.arange(rows, dtype=np.int32), np.diff(offsets))
    wide = data.astype(np.uint32)
    counts = np.zeros(rows * BUCKETS, dtype=np.int64)
    left = offsets[1:].astype(np.int64)[row] - np.arange(len(data))  # bytes from here to the text's end
    last = np.flatnonzero(left <= OFFSETS[-1][2])
    padded = np.concatenate((wide, np.zeros(OFFSETS[-1][2], dtype=np.uint32)))
    for salt, (a, b, c) in enumerate(OFFSETS, 1):
        n = len(data) - c
        if n > 0:
            h = _bucket(wide[a : a + n], wide[b : b + n], wide[c:], salt)
            inside = row[:n] == row[c:]
            place = row[:n].astype(np.int64) * BUCKETS + h
            counts += np.bincount(place[inside], minlength=len(counts))
        edge = last[left[last] <= c]
        rest = left[edge]
        beyond = lambda by: np.where(by < rest, padded[edge + by], 256 + by - rest).astype(np.uint32)
        place = row[edge].astype(np.int64) * BUCKETS + _bucket(wide[edge], beyond(b), beyond(c), salt)
        counts += np.bincount(place, minlength=len(counts))
    return counts.reshape(rows, BUCKETS)


def digests(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Hex digests: the length's code (one byte), then four buckets a byte."""
    counts = bucket_counts(data, offsets)
    lengths = np.diff(offsets)
    ordered = np.sort(counts, axis=1)
    quartiles = ordered[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = sum((counts > quartiles[:, [j]]).astype(np.uint8) for j in range(3))
    packed = codes[:, 0::4] << 6 | codes[:, 1::4] << 4 | codes[:, 2::4] << 2 | codes[:, 3::4]
    sizes = np.minimum(255, np.ceil(np.log1p(lengths) / np.log(LENGTH_BASE))).astype(np.uint8)
    return [bytes((int(s), *p)).hex() for s, p in zip(sizes, packed)]


def _unpacked(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex("".join(texts)), dtype=np.uint8).reshape(len(texts), 1 + BUCKETS // 4)
    body = raw[:, 1:]
    return raw[:, 0].astype(np.int16), np.stack([body >> 6, body >> 4 & 3, body >> 2 & 3, body & 3], axis=2).reshape(
        len(texts), BUCKETS
    ).astype(np.int16)


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """1 minus the bounded difference: steps between the codes (a whole range counts double) and between lengths."""
    if not left:
        return np.zeros(0)
    (la, a), (lb, b) = _unpacked(left), _unpacked(right)
    step = np.abs(a - b)
    step[step == 3] = 6
    length = np.minimum(np.abs(la - lb), 24) / 24
    unlike = step.sum(axis=1) / (BUCKETS * 1.5) + 0.15 * length
    return 1.0 - np.minimum(unlike, WORST)


def fingerprints(texts: pa.Array) -> list[str]:
    out: list[str] = []
    for _, _, data, offsets in text_slices(texts, SLICE_BYTES):
        out += digests(data, offsets)
    return out


def fingerprint(text: Column) -> Column:
    """The digest of a text column; null counts as empty."""

    @F.pandas_udf("string")
    def of(values: pd.Series) -> pd.Series:
        return pd.Series(fingerprints(pa.array(values, type=pa.string())))

    return of(text)


def edited(text: str, following: str) -> str:
    """The last quarter (rounded down) of the code points replaced by the first as many of ``following``."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def _deal(bounds: list[int], guards: dict[int, int]):
    edges = np.array(bounds, dtype=np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            low = np.iinfo(np.int64).min
            keys = np.array([low if i is None else i for i in ids], dtype=np.int64)
            own = np.searchsorted(edges, keys, side="right")
            copies = [j for j, key in enumerate(keys.tolist()) if key in guards]
            take = pa.array([*range(len(ids)), *copies])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*own.tolist(), *(guards[int(keys[j])] for j in copies)], type=pa.int32()),
                    pa.array([False] * len(ids) + [True] * len(copies)),
                    batch.column(0).take(take),
                    batch.column(1).take(take),
                ],
                ["_range", "_guard", "doc_id", "text"],
            )

    return deal


def beside_next(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` dealt into ranges of ids (``_range``), with a copy of the first
    document of the next range (of the whole table, after the last) as a guard at each end.

    Null ids come first.  Only ids are read to find the ranges; texts are shuffled once.
    """
    low = -(1 << 63)
    ids = docs.select(F.coalesce("doc_id", F.lit(low)).cast("long").alias("id"))
    ranges = max(1, min(RANGES, ids.count() // ROWS_PER_RANGE))
    bounds: list[int] = []
    if ranges > 1:
        cuts = [i / ranges for i in range(1, ranges)]
        bounds = sorted(set(ids.agg(F.percentile_approx("id", cuts, 10 * ranges)).first()[0]))
    edges = np.array(bounds, dtype=np.int64)

    @F.pandas_udf("int")
    def range_of(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, values.to_numpy(), side="right"))

    firsts = sorted((r["r"], r["f"]) for r in ids.groupBy(range_of("id").alias("r")).agg(F.min("id").alias("f")).collect())
    guards = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = dealt.mapInArrow(_deal(bounds, guards), "_range int, _guard boolean, doc_id long, text string")
    return dealt.repartition("_range").sortWithinPartitions("_range", "_guard", "doc_id", "text")


def with_next(docs: DataFrame, columns: str, make) -> DataFrame:
    """``make(ids, texts, next texts)`` over all documents, each beside the next by id.

    ``make`` takes lists of some documents and returns Arrow arrays of ``columns``.  Texts
    are held a slice at a time; null counts as empty.  Rows with one id follow each other by
    text.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in columns.split(",")]
        held: tuple | None = None  # the last document, until the next is seen
        for batch in batches:
            places = batch.column(0).to_pylist()
            guards, ids = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            texts = batch.column(3)
            ready: list[tuple] = []
            size = 0
            for j, place in enumerate(places):
                text = texts[j].as_py() or ""
                if held is not None and held[0] == place:
                    ready.append((held[1], held[2], text))
                    size += len(held[2])
                    if size > SLICE_BYTES:
                        yield pa.RecordBatch.from_arrays(make(*map(list, zip(*ready))), names)
                        ready, size = [], 0
                held = None if guards[j] else (place, ids[j], text)
            if ready:
                yield pa.RecordBatch.from_arrays(make(*map(list, zip(*ready))), names)

    return beside_next(docs).mapInArrow(work, columns)
