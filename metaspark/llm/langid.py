"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of n-grams per language are summed over every labelled training text; the matrix of
log probabilities (languages x buckets, a fixed number of buckets) goes to the executors,
which score texts as sparse rows against it in numpy.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import extended, lean, small_batches
from .words import mixed, text_slices

BITS = 15
ORDERS = (2, 3)
LANGUAGES = 1024
SMOOTHING = 0.5
SLICE_BYTES = 1 << 17
UNKNOWN = "und"


class Model(NamedTuple):
    """Learned ``languages`` in order, their log priors, and log probabilities as buckets x languages."""

    languages: list[str]
    prior: np.ndarray
    table: np.ndarray


def grams(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every n-gram of the lower-cased texts; a text's edges count as spaces.

    Runs of white space, digits and ASCII marks count as one space.
    """
    text = data.tobytes().decode("utf-8", "replace")
    points = _lower(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32))
    lead = (data & 0xC0) != 0x80
    ends = np.concatenate(([0], np.cumsum(lead)))[offsets]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(ends))
    mark = (points < 128) & ~((points >= 97) & (points <= 122))
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = ~(mark[1:] & mark[:-1] & (row[1:] == row[:-1]))
    points, row, mark = points[keep], row[keep], mark[keep]
    points = np.where(mark, 32, points).astype(np.uint64)
    buckets, rows = [], []
    for n in ORDERS:
        count = len(points) - n + 1
        if count <= 0:
            continue
        h = np.full(count, n, dtype=np.uint64)
        for j in range(n):
            h = h * np.uint64(0x100000001B3) + points[j : j + count]
        inside = row[:count] == row[n - 1 :]
        buckets.append((mixed(h[inside]) >> np.uint64(64 - bits)).astype(np.int32))
        rows.append(row[:count][inside])
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(buckets), np.concatenate(rows)


def _lower(points: np.ndarray) -> np.ndarray:
    """Code points of Latin letters in lower case, one for one."""
    upper = (points >= 65) & (points <= 90) | (points >= 0xC0) & (points <= 0xDE) & (points != 0xD7)
    return np.where(upper, points + 32, points)


def train(texts: DataFrame, smoothing: float = SMOOTHING, bits: int = BITS, most_languages: int = LANGUAGES) -> Model:
    """Learn from all rows of ``text``, ``lang`` (rows with a null are no use and are left out).

    A task adds up its rows' counts and emits one row per language; the driver gets one row
    of ``2**bits`` counts per language.  Learning fails on more than ``most_languages``
    values of ``lang``, which bounds the matrix.
    """
    small_batches(texts.sparkSession)
    rows = texts.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}
        for batch in batches:
            names = batch.column(1).dictionary_encode()
            codes, values = names.indices.to_numpy(zero_copy_only=False), names.dictionary.to_pylist()
            for value, n in zip(values, np.bincount(codes, minlength=len(values)).tolist()):
                seen[value] = seen.get(value, 0) + n
            for first, end, data, offsets in text_slices(batch.column(0), SLICE_BYTES):
                bucket, row = grams(data, offsets, bits)
                found = codes[first:end][row]
                for code in np.unique(found).tolist():
                    own = np.bincount(bucket[found == code], minlength=size)
                    value = values[code]
                    sums[value] = sums[value] + own if value in sums else own
        names = sorted(seen)
        empty = np.zeros(size, dtype=np.int64)
        for value in names:
            counts = sums.get(value, empty)
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([value] * (len(used) + 1), type=pa.string()),
                    pa.array([-1, *used.tolist()], type=pa.int32()),
                    pa.array([seen[value], *counts[used].tolist()], type=pa.int64()),
                ],
                ["lang", "bucket", "n"],
            )

    sums = rows.mapInArrow(lean(count), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    per_language = sums.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))
    learned = sorted(per_language.limit(most_languages + 1).collect(), key=lambda r: r["lang"])
    if len(learned) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    table = np.zeros((size, len(learned)), dtype=np.float64)
    documents = np.zeros(len(learned))
    for j, row in enumerate(learned):
        for bucket, n in row["counts"]:
            if bucket < 0:
                documents[j] = n
            else:
                table[bucket, j] = n
    table = np.log(table + smoothing) - np.log(table.sum(axis=0) + smoothing * size)
    prior = np.log(documents + 1.0) - math.log(documents.sum() + len(learned)) if learned else documents
    return Model([r["lang"] for r in learned], prior, table.astype(np.float32))


def scores(model: Model, column: pa.Array, bits: int = BITS) -> np.ndarray:
    """Log joint probability of every text with every language."""
    out = np.empty((len(column), len(model.languages)))
    step = 1 << 16
    for first, end, data, offsets in text_slices(column, SLICE_BYTES):
        bucket, row = grams(data, offsets, bits)
        # one row of counts per text over the buckets in use: sparse rows as (row, bucket, count)
        totals = np.zeros((end - first, len(model.languages)))
        for at in range(0, len(bucket), step):
            b, r = bucket[at : at + step], row[at : at + step]
            for j in range(len(model.languages)):
                totals[:, j] += np.bincount(r, weights=model.table[b, j], minlength=end - first)
        out[first:end] = model.prior + totals
    return out


def identify(docs: DataFrame, model: Model, bits: int = BITS) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score`` (replaced if there).

    The score is the prediction's posterior probability.  A null text or one without a
    letter gets ``und`` and 0, as does every text if nothing was learned.  Ties go to the
    language first by code point.  Only ``text`` is looked at; other columns stay.
    """
    known = docs.sparkSession.sparkContext.broadcast(tuple(model))
    kept = docs.drop("lang_pred", "lang_score")
    schema = extended(kept, "lang_pred string, lang_score double")
    place = kept.columns.index("text")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*known.value)
        for batch in batches:
            column = batch.column(place)
            lettered = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            names = np.full(batch.num_rows, UNKNOWN, dtype=object)
            score = np.zeros(batch.num_rows)
            if model.languages and batch.num_rows:
                joint = scores(model, column, bits)
                best = joint.argmax(axis=1)
                posterior = 1.0 / np.exp(joint - joint.max(axis=1, keepdims=True)).sum(axis=1)
                names = np.where(lettered, np.array(model.languages, dtype=object)[best], UNKNOWN)
                score = np.where(lettered, posterior, 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names.tolist(), type=pa.string()), pa.array(score)],
                [*batch.schema.names, "lang_pred", "lang_score"],
            )

    return kept.mapInArrow(lean(predict), schema)
