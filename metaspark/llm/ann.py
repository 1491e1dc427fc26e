"""Nearest neighbours by randomly rotated one-bit codes with error bounds.

Vectors are normalised, rotated at random and cut to the signs of their components; two
scalars a vector turn the inner product of a query with the signs into an unbiased estimate
of the cosine and a bound of its error.  Estimates choose which vectors are reranked with
their exact cosine: the best few, then all whose bound reaches the best exact ones.
Queries meet all vectors in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metaspark.session import cut_lineage

SEED = 11
BLOCK_VECTORS = 8192
BLOCK_QUERIES = 4096
STEP_QUERIES = 128
CONFIDENCE = 2.5
FIRST = 32


def rotation(dimensions: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same wherever it is made."""
    draws = np.random.Generator(np.random.PCG64(seed)).standard_normal((dimensions, dimensions))
    q, r = np.linalg.qr(draws)
    return q * np.sign(np.diag(r))


def codes(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits of the rotated unit vectors, and each one's inner product with its code."""
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    turned = unit @ turn.T
    bits = turned >= 0
    inner = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(bits, axis=1), inner


def estimates(queries: np.ndarray, packed: np.ndarray, inner: np.ndarray, turn: np.ndarray, confidence: float = CONFIDENCE):
    """Estimated cosines (queries x vectors) and the error bound of every vector."""
    size = queries.shape[1]
    unit = queries / np.sqrt((queries * queries).sum(axis=1, keepdims=True))
    signs = np.unpackbits(packed, axis=1, count=size).astype(np.float32) * 2 - 1
    estimate = (unit @ turn.T).astype(np.float32) @ signs.T / np.float32(np.sqrt(size)) / inner.astype(np.float32)
    error = confidence * np.sqrt(np.maximum(1 - inner**2, 0)) / inner / np.sqrt(max(size - 1, 1))
    return estimate, error + 1e-5


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines in double precision, each from its two vectors alone."""
    norms = np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((query * query).sum())
    return (vectors * query).sum(axis=1) / norms


def nearest(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
    packed: np.ndarray, inner: np.ndarray, turn: np.ndarray, k: int, confidence: float = CONFIDENCE,
) -> Iterator[tuple[int, int, float]]:
    """(query, vector, cosine) of each query's ``k`` best in the block, by the codes and exact reranking."""
    first = min(FIRST + k, len(ids))
    for at in range(0, len(query_ids), STEP_QUERIES):
        some = queries[at : at + STEP_QUERIES]
        estimate, error = estimates(some, packed, inner, turn, confidence)
        upper = estimate + error
        for j, query in enumerate(query_ids[at : at + STEP_QUERIES].tolist()):
            chosen = np.argpartition(-estimate[j], first - 1)[:first]
            own = ids[chosen] == query
            exact = cosines(some[j], vectors[chosen])
            kept = np.sort(exact[~own])[::-1]
            if len(kept) >= k:
                more = upper[j] >= kept[k - 1]
                more[chosen] = True
                chosen = np.flatnonzero(more)
            else:
                chosen = np.arange(len(ids))
            chosen = chosen[ids[chosen] != query]
            exact = cosines(some[j], vectors[chosen])
            for p in np.lexsort((ids[chosen], -exact))[:k]:
                yield query, int(ids[chosen[p]]), float(exact[p])


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id`` and ``vector`` (doubles) of rows that can be searched."""
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter("vec_id IS NOT NULL AND vector IS NOT NULL").filter(
        finite & F.exists("vector", lambda x: x != 0.0)
    )


def search(embeddings: DataFrame, queries: DataFrame, k: int = 5, confidence: float = CONFIDENCE) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: each query's ``k`` nearest other vectors by cosine.

    Both frames have ``vec_id`` and ``embedding``; vectors that are null, zero or hold null
    or non-finite components take no part, and vectors are compared with those of their own
    length.  Ties go to the smaller ``vec_id``; repeated rows of one id count once.  The
    codes of a block of vectors are made once and go to the blocks of queries, whose number
    grows with the queries.
    """
    facts = cut_lineage(usable(embeddings).dropDuplicates(["vec_id"]).withColumn("size", F.size("vector")))
    asked = usable(queries).dropDuplicates(["vec_id"]).withColumn("size", F.size("vector"))
    count, wanted = facts.count(), asked.count()
    blocks, groups = max(1, -(-count // BLOCK_VECTORS)), max(1, -(-wanted // BLOCK_QUERIES))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            size_of = batch.column(2).to_numpy()
            for size in np.unique(size_of).tolist():
                part = batch.filter(pa.array(size_of == size))
                if size not in turns:
                    turns[size] = rotation(size)
                packed, inner = codes(_matrix(part.column(1), size), turns[size])
                columns = [*part.columns, pa.array([p.tobytes() for p in packed], type=pa.binary()), pa.array(inner)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "vector", "size", "code", "inner"])

    schema = "vec_id long, vector array<double>, size int, code binary, inner double"
    index = facts.mapInArrow(coded, schema).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    index = index.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("side", F.lit(0))
    asked = asked.withColumn("group", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)).cast("int"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    asked = asked.select(
        "vec_id", "vector", "size", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("double").alias("inner"),
        "block", "group", F.lit(1).alias("side"),
    )
    together = index.unionByName(asked).select("block", "group", "size", "side", "vec_id", "vector", "code", "inner")
    together = together.repartition("block", "group", "size").sortWithinPartitions("block", "group", "size", "side")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}

        def found(parts: list[pa.RecordBatch], size: int) -> pa.RecordBatch | None:
            whole = pa.Table.from_batches(parts).combine_chunks()
            side = whole.column(3).to_numpy()
            left, right = whole.filter(pa.array(side == 0)), whole.filter(pa.array(side == 1))
            if not left.num_rows or not right.num_rows:
                return None
            if size not in turns:
                turns[size] = rotation(size)
            packed = np.frombuffer(b"".join(left.column(6).to_pylist()), dtype=np.uint8).reshape(left.num_rows, -1)
            matrix = lambda t: _matrix(t.column(5).combine_chunks(), size)
            rows = nearest(
                right.column(4).to_numpy(), matrix(right), left.column(4).to_numpy(), matrix(left),
                packed, left.column(7).to_numpy(), turns[size], k, confidence,
            )
            columns = list(zip(*rows)) or [[], [], []]
            kinds = (pa.int64(), pa.int64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds)], ["query_id", "vec_id", "score"])

        at, parts = None, []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                key = tuple(keys[a].tolist())
                if key != at and parts:
                    if (rows := found(parts, at[2])) is not None:
                        yield rows
                    parts = []
                at = key
                parts.append(batch.slice(a, b - a))
        if parts and (rows := found(parts, at[2])) is not None:
            yield rows

    best = together.mapInArrow(meet, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
