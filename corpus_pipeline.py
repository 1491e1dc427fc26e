"""From raw documents to tokens: toxicity, language, near duplicates, mixing, tokens.

Every stage takes (spark, documents so far, folder of the tables), works on all of them and
returns a frame; ``run`` writes each stage's result as Parquet in the shared folder and
reads it again for the next.  All stages but the last keep the columns of the documents;
null texts and null ids are allowed, repeated rows count as copies, an empty table stays
empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaspark.llm import bpe, jaccard, langid, mixing, toxicity
from metaspark.llm.queries import RANKS, fold, toxicity_model
from metaspark.llm.registry import query, table
from metaspark.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC_FROM = 0.5
SURE_FROM = 0.5
BROADCAST_IDS = 500_000


def packed(docs: DataFrame) -> DataFrame:
    """Columns beyond those of the documents in one struct, where no name of an operator's can clash with theirs."""
    extra = [c for c in docs.columns if c not in COLUMNS]
    if not extra:
        return docs
    return docs.select(*[c for c in docs.columns if c in COLUMNS], F.struct(*[F.col(f"`{c}`") for c in extra]).alias("extra_columns"))


def as_before(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of ``df`` with the columns of ``docs``, taken out of the struct again."""
    return df.select(*[F.col(c) if c in COLUMNS else F.col(f"extra_columns.`{c}`").alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity, learned from the labels, is below 0.5."""
    scored = toxicity.score(packed(docs), toxicity_model(docs, table(spark, sf_dir, "labels")))
    return as_before(scored.filter(F.col("tox_score") < TOXIC_FROM), docs)


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language, learned from ``lang``, is at least as likely as not."""
    named = langid.identify(packed(docs), langid.train(docs.filter(fold(4) != 2)))
    sure = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("lang_score") >= SURE_FROM)
    return as_before(named.filter(sure), docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id, once.

    Rows are told apart by id and text.  A document without an id counts after all with one;
    of several texts with the smallest id the one with the smallest set id stays.  Documents
    without words are like no other: of equal ones with one id one stays, those without an
    id all stay.
    """
    rows = packed(docs)
    path = scratch_path(spark, "groups")
    found = jaccard.groups(rows).filter("n_shingles > 0 OR doc_id IS NOT NULL")
    found.select("doc_id", "row_key", "set_id", F.when(F.col("n_shingles") > 0, F.col("label")).alias("label")).write.parquet(path)
    groups = spark.read.parquet(path)
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "set_id", "row_key")
    first = groups.filter("label IS NOT NULL").groupBy("label").agg(F.min(place).getField("row_key").alias("first"))
    gone = groups.join(first, "label").filter("row_key <> first").select("row_key").distinct()
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    kept = rows.withColumn("row_key", jaccard.row_key(F.col("doc_id"), F.col("text"))).join(gone, "row_key", "left_anti")
    again = groups.groupBy("row_key").count().filter("count > 1").select("row_key")
    if (repeated := again.count()) > 0:
        if repeated <= BROADCAST_IDS:
            again = F.broadcast(again)
        once = kept.join(again, "row_key", "left_semi").dropDuplicates(["row_key"])
        kept = kept.join(again, "row_key", "left_anti").unionByName(once)
    return as_before(kept.select(*rows.columns), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources at their target weights takes it."""
    return as_before(mixing.expand(mixing.mix(packed(docs))), docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with their digests."""
    coded = bpe.encode(docs.select("doc_id", "source", "text"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return coded.select("doc_id", "source", "n_tokens", "token_ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unidentified),
    ("near_duplicates", keep_one_of_each),
    ("mix", mix_sources),
    ("tokens", to_tokens),
]

# Learned models, components over shingles and BPE have no SQL form.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
