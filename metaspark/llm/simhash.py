"""Near duplicates by SimHash: fuzzy keys from the binary Golay code, joined and verified.

A fingerprint has 64 bits, the majority of its shingles' hashes in each place.  It is cut
into three segments.  Fingerprints with at most two differing bits agree in one whole
segment (pigeonhole) and differ in at most two bits of the next one.  The Golay code of
length 23 is perfect: every vector has one nearest codeword.  Two segments that differ in
two bits have a vector between them, one bit from both; so the codewords nearest to a
segment and to its one-bit changes (one to six of them) have one in common with those of
the other.  The exact segment and each such codeword's index make a bucket.

Buckets of two are verified as a pair, those up to ``LIGHT`` inside the bucket, which gives
at most one link for each member but the first.  The members of larger ones are joined on
their one-bit changes instead: two of them share one exactly if they are linked, and no
change has more than 65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaspark.session import scratch_path

from .components import components
from .words import LOWER, U64, text_slices, word_spans

WORDS = 3
SEED = 42
BITS = 2
SHINGLES_AT_ONCE = 1 << 15
LIGHT = 512
#: First bit and width of the segments.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
#: Fixed value: generator polynomial of the (23, 12) Golay code.
GENERATOR = 0b110001110101


def syndromes(vectors: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit vectors by the code's generator."""
    left = vectors.astype(np.int64)
    for bit in range(22, 10, -1):
        left = left ^ np.where(left >> bit & 1, GENERATOR << (bit - 11), 0)
    return left


def error_patterns() -> np.ndarray:
    """The one vector of at most three bits with each of the 2048 remainders."""
    ones = [1 << b for b in range(23)]
    patterns = [0, *ones]
    patterns += [a | b for j, a in enumerate(ones) for b in ones[:j]]
    patterns += [a | b | c for j, a in enumerate(ones) for k, b in enumerate(ones[:j]) for c in ones[:k]]
    table = np.zeros(1 << 11, dtype=np.int64)
    table[syndromes(np.array(patterns))] = patterns
    return table


ERRORS = error_patterns()


def codewords(vectors: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each 23-bit vector."""
    return (vectors ^ ERRORS[syndromes(vectors)]) >> 11


def nearby(vectors: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, codeword index): the distinct codewords nearest to each vector and to its
    one-bit changes in the lowest ``width`` bits."""
    changes = np.array([0, *(1 << b for b in range(width))], dtype=np.int64)
    found = np.sort(codewords(vectors[:, None] ^ changes[None, :]), axis=1)
    new = np.ones(found.shape, dtype=bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    row, at = np.nonzero(new)
    return row, found[row, at]


def buckets(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of fingerprints: the exact segment, and each codeword near the next one."""
    out_bucket, out_row = [], []
    for slot, (first, width) in enumerate(SEGMENTS):
        then, span = SEGMENTS[(slot + 1) % len(SEGMENTS)]
        exact = (fingerprints >> U64(first)) & U64((1 << width) - 1)
        other = ((fingerprints >> U64(then)) & U64((1 << span) - 1)).astype(np.int64)
        row, word = nearby(other, span)
        out_bucket.append(((exact[row] << U64(12)) | word.astype(U64)) << U64(2) | U64(slot))
        out_row.append(row)
    return np.concatenate(out_bucket), np.concatenate(out_row)


def _shingles(row: np.ndarray, rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of every shingle, from the row of every word."""
    words = np.bincount(row, minlength=rows)
    first = np.cumsum(words) - words
    counts = np.minimum(words, 1) + np.maximum(words - size, 0)
    owner = np.repeat(np.arange(rows), counts)
    start = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return start, start + np.minimum(words, size)[owner] - 1


def fingerprints(data: np.ndarray, offsets: np.ndarray, size: int = WORDS, seed: int = SEED) -> np.ndarray:
    """SimHash of every row of a slice; 0 for a row without words."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    rows = len(offsets) - 1
    starts, ends, row = word_spans(data, offsets)
    begin, last = _shingles(row, rows, size)
    ones = np.zeros((rows, 64), dtype=np.int64)
    total = np.zeros(rows, dtype=np.int64)
    for at in range(0, len(begin), SHINGLES_AT_ONCE):
        b, e = begin[at : at + SHINGLES_AT_ONCE], last[at : at + SHINGLES_AT_ONCE]
        low, high = int(b[0]), int(e.max()) + 1
        length = ends[low:high] - starts[low:high] + 1
        place = np.cumsum(length) - length
        take = np.arange(int(length.sum())) + np.repeat(starts[low:high] - place, length)
        joined = LOWER[data[np.minimum(take, len(data) - 1)]]
        joined[place + length - 1] = 32
        text = joined.tobytes()
        cuts = zip(place[b - low].tolist(), (place[e - low] + length[e - low] - 1).tolist())
        hashes = np.array([digest(text[x:y], seed) for x, y in cuts], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        owner = row[b]
        head = np.flatnonzero(np.diff(owner, prepend=-1))
        ones[owner[head]] += np.add.reduceat(bits, head, axis=0, dtype=np.int64)
        total += np.bincount(owner, minlength=rows)
    packed = np.packbits((ones * 2 > total[:, None]).astype(np.uint8), axis=1, bitorder="little")
    return packed.view("<u8").reshape(-1)


def _printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in text_slices(batch.column(1)):
            found = fingerprints(data, offsets).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(found)], ["doc_id", "print"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = batch.column(0).to_numpy(zero_copy_only=False)
        bucket, row = buckets(own.view(U64))
        yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), pa.array(own[row])], ["bucket", "print"])


def spanning(prints: np.ndarray, bits: int = BITS) -> list[tuple[int, int]]:
    """Links that connect what fingerprints of at most ``bits`` differing bits connect, one less than each part has."""
    left, out = prints, []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            own = todo.pop()
            near = np.bitwise_count(left ^ own) <= bits
            if near.any():
                met = left[near]
                out += [(int(own), int(x)) for x in met]
                todo.extend(met)
                left = left[~near]
    return out


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each bucket; the rows of a bucket come together and are few."""

    def linked(parts: list[np.ndarray]) -> list[tuple[int, int]]:
        return spanning(np.concatenate(parts).view(U64))

    at, parts, links = None, [], []
    for batch in batches:
        bucket, own = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        heads = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] - 1)) if len(bucket) else []
        for a, b in zip(heads, [*heads[1:], len(bucket)]):
            if bucket[a] != at and parts:
                links += linked(parts)
                parts = []
            at = bucket[a]
            parts.append(own[a:b])
        yield _as_links(links)
        links = []
    if parts:
        yield _as_links(linked(parts))


def _as_links(links: list[tuple[int, int]]) -> pa.RecordBatch:
    pair = np.array(links, dtype=U64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["a", "b"])


def links(prints: DataFrame, light: int = LIGHT) -> DataFrame:
    """``a``, ``b``: links that connect the distinct fingerprints (column ``print``) exactly as
    all pairs of at most two differing bits do."""
    keyed = prints.mapInArrow(_keys, "bucket long, print long")
    shared = keyed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("print").alias("a"), F.max("print").alias("b"))
    path = scratch_path(prints.sparkSession, "buckets")
    shared.filter("n > 1").write.parquet(path)
    shared = prints.sparkSession.read.parquet(path)
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= BITS
    pairs = shared.filter("n = 2").select("a", "b").filter(close)
    some = keyed.join(shared.filter(f"n BETWEEN 3 AND {light}").select("bucket"), "bucket")
    inside = some.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_inside, "a long, b long")
    many = keyed.join(shared.filter(f"n > {light}").select("bucket"), "bucket", "left_semi").select("print").distinct()
    changed = F.expr("concat(array(print), transform(sequence(0, 63), k -> print ^ shiftleft(1L, k)))")
    met = many.select("print", F.explode(changed).alias("between"))
    met = met.groupBy("between").agg(F.min("print").alias("a"), F.collect_list("print").alias("all")).filter("size(all) > 1")
    crowded = met.select("a", F.explode("all").alias("b")).filter("a <> b")
    return pairs.union(inside).union(crowded).distinct()


def near_duplicates(docs: DataFrame, light: int = LIGHT) -> DataFrame:
    """``doc_id``, ``print`` (the 64 bits as a long) and ``component_id`` of every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most two differing bits.
    A null, empty or wordless text has fingerprint 0 and is linked like any other.  Repeated
    rows stay, rows with a null ``doc_id`` link others and take the smallest id they reach
    (null where there is none).  Long texts are hashed some thousand shingles at a time.
    Columns other than ``doc_id`` and ``text`` are not looked at; an empty table stays empty.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "prints")
    docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _printed, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, print long"
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    kept = scratch_path(spark, "distinct-prints")
    rows.groupBy("print").agg(F.min("doc_id").alias("least")).write.parquet(kept)
    one = spark.read.parquet(kept)
    labels = components(links(one.select("print"), light))
    labelled = one.join(labels.withColumnRenamed("node", "print"), "print")
    smallest = labelled.groupBy("label").agg(F.min("least").alias("reached"))
    reached = labelled.join(smallest, "label").select("print", "reached")
    own = one.join(reached, "print", "left").select("print", F.coalesce("reached", "least").alias("component_id"))
    return rows.join(own, "print").select("doc_id", "print", "component_id")
