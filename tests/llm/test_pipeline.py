"""The corpus pipeline: every stage on strange rows, and the whole against the operators' brute-force results."""

import hashlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_strange_rows(spark, name, stage):
    base = " ".join(f"wort{i}" for i in range(30))
    rows = [
        (1, base, "de", "a", 1), (2, base, "de", None, 1), (2, base, "de", None, 1), (3, None, None, None, None),
        (None, "", "fr", "b", 0), (4, "Ünder " * 5000, "de", "b", 1), (None, base + " x", "de", "a", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = ("score", "label", "set_id", "weight", "target", "_size", "_copies", "tox_score", "lang_pred", "n_tokens", "a.b")
    df = df.withColumns({c: F.lit("own") for c in names})
    out = stage(spark, df, SF)
    if name != "tokens":
        assert out.columns == df.columns
        assert {r["_size"] + r.tox_score + r["lang_pred"] for r in out.collect()} <= {"ownownown"}
    assert out.count() <= 3 * len(rows)
    assert stage(spark, df.limit(0), SF).count() == 0


def test_duplicates_leave_one(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text), (3, text + " end"), (9, text.upper()), (7, "other words"), (7, "other words"), (1, None), (2, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.keep_one_of_each(spark, df, SF)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 7]


def test_duplicates_by_id_and_text(spark):
    text = lambda w, n=40: " ".join(f"{w}{i}" for i in range(n))
    rows = [
        (None, text("a")), (None, text("a") + " end"), (None, text("a")),  # copies without ids
        (4, text("b")), (None, text("b") + " end"),  # one of two has an id
        (6, text("own")), (6, text("c")), (5, text("c") + " end"),  # two texts with one id: a clean one and a copy
        (7, text("d")), (7, text("e")), (8, text("e") + " end"),  # two texts with one id, one of them the group's first
        (9, text("f")), (9, text("f")), (9, text("f") + " end"),
        (None, ""), (None, None), (10, ""), (10, ""), (10, None), (None, "alone without id"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row_key", F.lit("own")).repartition(5)
    out = corpus_pipeline.keep_one_of_each(spark, df, SF)
    assert out.columns == df.columns and {r.row_key for r in out.collect()} == {"own"}
    kept = [(r.doc_id, "-" if r.text is None else r.text.split(" ")[0]) for r in out.collect()]
    want = [
        (None, "a0"), (4, "b0"), (6, "own0"), (5, "c0"), (7, "d0"), (7, "e0"), (9, "f0"),
        (None, ""), (None, "-"), (10, ""), (10, "-"), (None, "alone"),
    ]
    assert sorted(kept, key=repr) == sorted(want, key=repr)


def test_whole_pipeline(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert out and all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in out)
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
    assert len({r.doc_id for r in out} & toxic) <= len(toxic) // 2
    assert "pipeline" in entry_module.queries()


def test_one_query_per_operator():
    names = [n for n in entry_module.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
