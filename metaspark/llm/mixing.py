"""Mixing sources to target weights by whole copies and one Bernoulli copy.

``source_targets`` sums words per source and shares the corpus by weight; ``mix`` adds to
every document the copies the mix takes; ``expand`` emits them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaspark.session import cut_lineage

from .order import numbered

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3
BROADCAST_SOURCES = 50_000
SALTS = 16
SEED = "mix-1"
WORK = ("_size", "_source_size", "_target", "_rate", "_copies", "_copy", "_source", "_salt", "_salt2")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, seed: str) -> Column:
    """A reproducible number in [0, 1) from the first 52 bits of a digest."""
    digest = F.md5(F.concat(F.lit(seed + ":"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_targets(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``weight``, ``target``, ``rate``.

    Sources by code point (null last, a source like any other) take the weights in turn.
    The words of all sources are shared out; what exceeds ``most`` times a source's own
    words goes to the others by weight, again and again until no source is above.  A
    source without words has target and rate 0.
    """
    sizes = docs.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("source_size"))
    ranked = numbered(sizes, [F.col("source").asc_nulls_last()], "_rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    sources = cut_lineage(ranked.select("source", "source_size", weight.alias("weight")))
    cap = F.col("source_size") * float(most)
    level, held = None, -1
    while True:
        full = F.lit(False) if level is None else F.col("weight") * level >= cap
        total, capped, free, count = sources.agg(
            F.sum("source_size"),
            F.sum(F.when(full, cap).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
            F.sum(full.cast("int")),
        ).first()
        if not total or count == held or not free:
            break
        level, held = (total - capped) / free, count
    level = level or 0.0
    target = F.least(F.col("weight") * level, cap)
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return sources.select("source", "source_size", "weight", target.alias("target"), rate.alias("rate"))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST_REPEATS,
    seed: str = SEED,
    broadcast_sources: int = BROADCAST_SOURCES,
) -> DataFrame:
    """``docs`` with ``_size``, ``_source_size``, ``_target`` and ``_copies``.

    A document is taken floor(rate) times, and once more if its draw, seeded by its id (by
    its text where the id is null), is below the rate's fraction.  A null text has size 0;
    repeated rows get the same draw; an empty table gives no rows.  Other columns stay, but
    those named as in ``WORK`` are replaced or left out.
    Sources are broadcast up to ``broadcast_sources`` of them; beyond, each source is
    repeated per salt and joined, so that no task gets a hot source whole.
    """
    docs = docs.drop(*WORK)
    stats = source_targets(docs, weights, most).select(
        F.col("source").alias("_source"),
        F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"),
        F.col("rate").alias("_rate"),
    )
    sized = docs.withColumn("_size", word_count(F.col("text")))
    same = F.col("source").eqNullSafe(F.col("_source"))
    if stats.count() <= broadcast_sources:
        joined = sized.join(F.broadcast(stats), same)
    else:
        stats = stats.withColumn("_salt2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        sized = sized.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "text"), F.lit(SALTS)).cast("int"))
        joined = sized.join(stats, same & (F.col("_salt") == F.col("_salt2"))).drop("_salt", "_salt2")
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.md5("text")), F.lit("none"))
    whole = F.floor("_rate")
    extra = (draw(key, seed) < F.col("_rate") - whole).cast("int")
    return joined.withColumn("_copies", (whole + extra).cast("int")).drop("_source", "_rate")


def expand(mixed: DataFrame) -> DataFrame:
    """Every document as often as the mix takes it, with its own columns only."""
    own = [c for c in mixed.columns if c not in ("_size", "_source_size", "_target", "_copies")]
    taken = mixed.filter("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return taken.select(*own)
