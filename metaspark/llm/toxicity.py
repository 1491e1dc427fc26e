"""Toxic passages as maximal-scoring segments of token log-odds.

Training counts the toxic and clean labelled texts that hold a word (once each, as a word
often comes again in its text) and turns the counts into log-odds with a Dirichlet prior; words and word beginnings that are significantly toxic score their
log-odds, every other token costs a little.  A linear-time scan finds all maximal segments
of a text; extreme-value statistics of the clean training texts say how often chance gives
one as good, and the evidence of the significant ones, calibrated, is the text's score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaspark.session import cut_lineage

from .frames import extended, lean, small_batches

TOKEN = re.compile(r"[^\W\d_]+")
STEMS = (5, 4)
PRIOR = 0.5
BACKGROUND = 500.0
LEAST_Z = 3.0
LEAST_LOG_ODDS = 2.0
GAP = 0.2
TRAINING_ROWS = 1 << 16
SIGNIFICANT = 0.05
MEMO = 1 << 17
COUNTER_WORDS = 1 << 17


class Segment(NamedTuple):
    """Tokens ``start`` to ``end`` (exclusive), their score and the expected number as good by chance."""

    start: int
    end: int
    score: float
    expected: float


class Model(NamedTuple):
    words: dict[str, float]
    stems: dict[str, float]
    rate: float  # K of the extreme-value law, per token
    slope: float
    intercept: float


def maximal_segments(positions: list[int], scores: list[float], gap: float = GAP) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments of a sequence of which the positive scores are given.

    Every other token scores ``-gap``.  One pass; each segment on the stack knows the last
    one below it with a lower left sum, so no segment is looked at twice without leaving.
    """
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, left sum, right sum, lower one
    total, reached = 0.0, 0
    for at, score in zip(positions, scores):
        total -= gap * (at - reached)
        start, left = at, total
        total += score
        reached = at + 1
        below = len(stack) - 1
        while True:
            while below >= 0 and stack[below][2] >= left:
                below = stack[below][4]
            if below < 0 or stack[below][3] >= total:
                break
            start, left, lower = stack[below][0], stack[below][2], stack[below][4]
            del stack[below:]
            below = lower
        stack.append((start, reached, left, total, below))
    return [(s, e, r - left) for s, e, left, r, _ in stack]


class Scorer:
    """Looks up tokens of one task; words already seen are remembered, up to a bound."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems, self.memo = words, stems, {}

    def weight(self, word: str) -> float:
        found = self.words.get(word)
        if found is None:
            for size in STEMS:
                if len(word) > size and (found := self.stems.get(word[:size])) is not None:
                    break
        if len(self.memo) >= MEMO:
            self.memo.clear()
        self.memo[word] = found = found or 0.0
        return found

    def segments(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of tokens, and the maximal segments as (start, end, score)."""
        tokens = TOKEN.findall(text.lower())
        weights = list(map(self.memo.get, tokens))
        hits, scores = [], []
        for at, weight in enumerate(weights):
            if weight is None:
                weight = self.weight(tokens[at])
            if weight:
                hits.append(at)
                scores.append(weight)
        return len(tokens), maximal_segments(hits, scores)


def evidence(tokens: int, segments: list[tuple[int, int, float]], rate: float) -> tuple[float, list[Segment]]:
    """Summed -ln of the expected numbers below 1, and the significant segments."""
    total, passages = 0.0, []
    for start, end, score in segments:
        expected = rate * max(tokens, 1) * math.exp(-score)
        if expected < 1.0:
            total -= math.log(max(expected, 1e-300))
        if expected < SIGNIFICANT:
            passages.append(Segment(start, end, score, expected))
    return total, passages


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> DataFrame:
    """``doc_id``, ``same`` (hash of the text), ``label`` to learn from: one row per distinct labelled text.

    ``labels`` has ``doc_id`` and ``label`` (0 or 1; others are left out, 1 wins over 0).
    Beyond about ``most`` labelled ids, a hash of the id chooses that many, and beyond as many
    texts a hash of the text, which bounds what is broadcast.
    """
    marked = labels.filter("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    share = lambda rows, key, count: rows.filter(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < int(most / count * (1 << 40)))
    if (count := marked.count()) > most:
        marked = share(marked, "doc_id", count)
    texts = docs.filter("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("same"))
    found = texts.join(F.broadcast(marked), "doc_id").groupBy("same", "label").agg(F.min("doc_id").alias("doc_id"))
    found = cut_lineage(found.select("doc_id", "same", "label"))
    return share(found, "same", count) if (count := found.count()) > most else found


def lexicon(texts: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Log-odds of significantly toxic words, and of word beginnings, from ``text``, ``label``.

    The prior of a word is ``PRIOR`` plus its share of ``BACKGROUND`` words of the whole
    training text.  The significant words of the training rows, of which there is a bounded
    number, go to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = (Counter(), Counter())

        def rows() -> pa.RecordBatch:
            names = list(sums[0].keys() | sums[1].keys())
            columns = [pa.array(names, type=pa.string())]
            columns += [pa.array([s[w] for w in names], type=pa.int64()) for s in sums]
            for s in sums:
                s.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "clean", "toxic"])

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                sums[label].update(set(TOKEN.findall(text.as_py().lower())))
                if len(sums[0]) + len(sums[1]) > COUNTER_WORDS:
                    yield rows()
        yield rows()

    words = (
        texts.select("text", "label").mapInArrow(lean(count), "word string, clean long, toxic long")
        .groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    features = words.select(F.explode(F.array(
        F.struct(F.lit(0).alias("stem"), F.col("word").alias("key")),
        *[F.struct(F.lit(n).alias("stem"), F.when(F.length("word") > n, F.substring("word", 1, n)).alias("key")) for n in STEMS],
    )).alias("f"), "clean", "toxic").filter("f.key IS NOT NULL")
    counted = features.groupBy("f.stem", "f.key").agg(F.sum("clean").alias("y0"), F.sum("toxic").alias("y1"))
    n0, n1 = (x or 0 for x in words.agg(F.sum("clean"), F.sum("toxic")).first())
    if not n0 or not n1:
        return {}, {}
    prior = PRIOR + BACKGROUND * (F.col("y0") + F.col("y1")) / float(n0 + n1)
    odds = lambda y, n: F.log((y + prior) / (float(n) + BACKGROUND - y))
    delta = odds(F.col("y1"), n1) - odds(F.col("y0"), n0)
    z = delta / F.sqrt(1 / (F.col("y1") + prior) + 1 / (F.col("y0") + prior))
    best = counted.filter("y1 > 1").select("stem", "key", delta.alias("delta"), z.alias("z"))
    best = best.filter((F.col("z") >= LEAST_Z) & (F.col("delta") >= LEAST_LOG_ODDS))
    found = best.collect()
    return {r.key: r.delta for r in found if r.stem == 0}, {r.key: r.delta for r in found if r.stem}


def train(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> Model:
    """Learn from the labelled documents (``training_rows``).  Without both labels no word is toxic."""
    small_batches(docs.sparkSession)
    chosen = training_rows(docs, labels, most)
    own = docs.select("doc_id", F.xxhash64("text").alias("same"), "text")
    texts = own.join(F.broadcast(chosen), ["doc_id", "same"]).dropDuplicates(["same", "label"]).select("text", "label")
    words, stems = lexicon(texts)
    known = docs.sparkSession.sparkContext.broadcast((words, stems))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*known.value)
        for batch in batches:
            sizes, segments = [], []
            for text in batch.column(0):
                n, found = scorer.segments(text.as_py())
                sizes.append(n)
                segments.append([s for _, _, s in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(sizes, type=pa.int32()), pa.array(segments, type=pa.list_(pa.float64()))],
                ["label", "n", "scores"],
            )

    rows = texts.mapInArrow(lean(best), "label int, n int, scores array<double>").collect()  # at most the training rows
    clean = [r for r in rows if r.label == 0]
    chance = sum(max(r.n, 1) * math.exp(-max(r.scores, default=0.0)) for r in clean)
    rate = len(clean) / chance if clean else 1.0
    x = np.array([evidence(r.n, [(0, 0, s) for s in r.scores], rate)[0] for r in rows])
    y = np.array([float(r.label) for r in rows])
    slope, intercept = _calibrated(x, y)
    return Model(words, stems, rate, slope, intercept)


def _calibrated(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton steps with a weak pull to (0.5, -3)."""
    start = np.array([0.5, -3.0])
    w = start.copy()
    pull = np.array([1.0, 1.0])
    design = np.stack([np.minimum(x, 50.0), np.ones_like(x)], axis=1) if len(x) else np.zeros((0, 2))
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ w, -40, 40)))
        gradient = design.T @ (y - p) - pull * (w - start)
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + np.diag(pull), gradient)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``tox_score`` (0 to 1) and ``tox_passages`` (replaced if there).

    A passage is a significant segment: its token range, score and expected number by
    chance.  A null or empty text has no tokens and gets the score of no evidence.  Only
    ``text`` is looked at; other columns stay, and equal texts score alike.
    """
    known = docs.sparkSession.sparkContext.broadcast(tuple(model))
    kept = docs.drop("tox_score", "tox_passages")
    passage = "array<struct<start:int,end:int,score:double,expected:double>>"
    schema = extended(kept, f"tox_score double, tox_passages {passage}")
    place = kept.columns.index("text")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, stems, rate, slope, intercept = known.value
        scorer = Scorer(words, stems)
        for batch in batches:
            values, passages = [], []
            for text in batch.column(place):
                n, found = scorer.segments(text.as_py() or "")
                total, significant = evidence(n, found, rate)
                logit = slope * min(total, 50.0) + intercept
                values.append(1.0 / (1.0 + math.exp(-max(min(logit, 40.0), -40.0))))
                passages.append([s._asdict() for s in significant])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, type=pa.float64()), pa.array(passages, type=kind)],
                [*batch.schema.names, "tox_score", "tox_passages"],
            )

    return kept.mapInArrow(lean(work), schema)
