"""The operators applied to their whole tables, one query each."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprint as fp
from . import align, ann, bpe, jaccard, langid, mixing, quotes, recurrent, repair, sharding, simhash, toxicity
from .registry import query, table

MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM s),
r AS (SELECT *, coalesce(sum(3.0 * source_size) OVER o, 0)::DOUBLE AS capped,
             sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS free, sum(source_size) OVER () AS total,
             3.0 * source_size / weight AS ratio
      FROM w WINDOW o AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT max((total - capped) / free) FILTER (WHERE (total - capped) / free <= ratio) AS share FROM r),
t AS (SELECT source, source_size, CASE WHEN source_size = 0 THEN 0.0 ELSE least(weight * share, 3.0 * source_size) END::DOUBLE AS target
      FROM r, level),
u AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
             ('0x' || md5('mix-1:' || doc_id::VARCHAR)[1:13])::BIGINT / 4503599627370496.0 AS draw
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM u
"""


@query("op1_mix_sources", MIX_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that a mix of all sources at weights 5, 2, 1 takes."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).cast("long").alias("taken"),
    )


SHARDS = 24


@query("op2_shard_tree")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of each document in a tree of 24 shards, and its shard in one of 25."""
    docs = table(spark, sf_dir, "documents")
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "utf-8")
    narrow = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = sharding.shard(narrow, sharding.even_tree(SHARDS), sharding.even_tree(SHARDS + 1)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        F.col("_place.shard").alias("shard"),
        F.col("_place.region").alias("region"),
        F.col("_place.rack").alias("rack"),
        F.col("_grown.shard").alias("grown_shard"),
    )
    return sharding.slotted(placed, "shard", ["doc_id", "text_crc32", "size"], docs.count())


@query("op7_quartile_fingerprint")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likeness."""

    def make(ids: list, texts: list[str], following: list[str]) -> list[pa.Array]:
        rows = len(ids)
        changed = [fp.edited(a, b) for a, b in zip(texts, following)]
        alone = [j for j in range(rows) if j + 1 == rows or following[j] is not texts[j + 1]]
        prints = fp.fingerprints(pa.array([*texts, *changed, *(following[j] for j in alone)], type=pa.large_string()))
        own, other, rest = prints[:rows], prints[rows : 2 * rows], prints[2 * rows :]
        after = [*own[1:], ""]
        for j, text in zip(alone, rest):
            after[j] = text
        return [
            pa.array(ids, type=pa.int64()),
            pa.array([len(t) for t in texts], type=pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
            pa.array(own),
            pa.array(other),
            pa.array(fp.likeness(own, other)),
            pa.array(fp.likeness(own, after)),
        ]

    columns = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return fp.with_next(table(spark, sf_dir, "documents"), columns, make)


def fold(parts: int):
    """CRC-32 of ``doc_id`` as text, modulo ``parts`` (null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % parts


@query("op3_language_bayes")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of each document, learned outside fold 2 of 4."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(fold(4) != 2))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    marked = labels.select("doc_id", F.col("toxic").cast("int").alias("label")).filter(fold(5) != 0)
    return toxicity.train(docs, marked)


@query("op4_toxic_segments")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document, learned outside fold 0 of 5, with its significant passages."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        (fold(5) == 0).alias("held_out"),
        F.col("tox_score").alias("score"),
        (F.col("tox_score") >= 0.5).cast("int").alias("predicted"),
        F.size("tox_passages").alias("n_passages"),
    )


@query("op5_partenum_jaccard")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and near-duplicate component of each document."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


RANKS = "byte_bpe_50k.tiktoken"


@query("op6_byte_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes decoded from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, with_ids=False)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op9_onebit_neighbours")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every vector whose id is divisible by 50, against all vectors."""
    embeddings = table(spark, sf_dir, "embeddings")
    return ann.search(embeddings, embeddings.filter(F.col("vec_id") % 50 == 0))


@query("op10_recurrent_lm")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of each document, learned outside fold 0 of 10."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = recurrent.score(docs, docs.filter(fold(10) != 0))
    return scored.withColumn("held_out", fold(10) == 0)


QUOTE_SQL = r"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, text, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS plain FROM conversations),
source AS (
  SELECT conv_id, turn, plain AS s FROM m
  UNION SELECT conv_id, turn, trim(regexp_replace(lower(p), '\s+', ' ', 'g'))
  FROM (SELECT conv_id, turn, unnest(string_split(trim(text), chr(10))) AS p FROM m)),
origin AS (SELECT conv_id, s, min(turn) AS origin FROM source WHERE s <> '' GROUP BY ALL),
q AS (
  SELECT conv_id, turn, role, text, lag(turn) OVER w AS before, lag(plain) OVER w AS q1, lag(plain, 2) OVER w AS q2
  FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
r AS (
  SELECT q.conv_id, q.turn, role, text, (coalesce(q1, '') <> '')::INTEGER + (coalesce(q2, '') <> '')::INTEGER AS quotes,
         coalesce((a.origin < q.turn)::BIGINT, 0) + coalesce((b.origin < q.turn)::BIGINT, 0) AS linked,
         CASE WHEN a.origin < q.turn THEN a.origin WHEN b.origin < q.turn THEN b.origin ELSE before END AS reply_turn
  FROM q LEFT JOIN origin a ON a.conv_id = q.conv_id AND a.s = q1 LEFT JOIN origin b ON b.conv_id = q.conv_id AND b.s = q2),
up AS (
  SELECT conv_id, turn, turn AS root_turn, 0 AS reply_depth FROM r WHERE reply_turn IS NULL
  UNION ALL
  SELECT r.conv_id, r.turn, up.root_turn, up.reply_depth + 1 FROM r JOIN up ON r.conv_id = up.conv_id AND r.reply_turn = up.turn)
SELECT conv_id, turn, role, reply_turn, quotes, linked, root_turn, reply_depth,
       row_number() OVER (PARTITION BY conv_id ORDER BY root_turn, turn) - 1 AS position, trim(text) AS text
FROM r JOIN up USING (conv_id, turn)
"""


@query("op8_quote_links", QUOTE_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reply links of all conversations.

    The table's turns hold no quotes, so Spark first writes them as mails that quote the two
    turns before; the operator takes these apart again.
    """
    mails = quotes.quoting(table(spark, sf_dir, "conversations"))
    return quotes.link(mails).select(
        "conv_id", "turn", "role", "reply_turn", "quotes", "linked", "root_turn", "reply_depth", "position", "text"
    )


@query("op12_golay_simhash")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash and component of each document over links of at most two differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


@query("op11_token_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens in each document, counted over all documents."""
    docs = table(spark, sf_dir, "documents")
    files = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return align.align(docs, *files, public_tokenizers.PATTERN)


@query("op13_grammar_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after made damage."""
    rows = table(spark, sf_dir, "conversations")
    return repair.repair(repair.damaged(rows), rows)
