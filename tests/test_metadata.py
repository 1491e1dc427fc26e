"""Nested documents -> key/value rows."""

import json

from pyspark.sql import functions as F

from conftest import rows
from metaspark.operators import metadata_kv as kv
from metaspark.sources import dumps


def docs(spark, *documents):
    df = spark.createDataFrame([(f"e{i}", json.dumps(d)) for i, d in enumerate(documents)], "entity_rn string, value string")
    return df.select("entity_rn", F.parse_json("value").alias("doc"))


def flat(spark, document, **options):
    return {r.key_path: r.value for r in kv.flatten_metadata(docs(spark, document), **options).collect()}


def plainly(value, excluded, prefix=None):
    """The same flattening, written as a recursion over one document."""
    out = {}
    for k, v in value.items():
        raw = k if prefix is None else f"{prefix}::{k}"
        if raw in excluded:
            continue
        if isinstance(v, dict) and v:
            out.update({f"{k}.{p}": x for p, x in plainly(v, excluded, raw).items()})
        else:
            out[k] = v
    return out


NESTED = {"a": 1, "b": {"c": "x", "d": {"e": None, "f": True}, "empty": {}}, "l": [1, {"q": 2}], "z": 2.5, "skip": 1}


def test_against_recursion(spark):
    excluded = ["skip", "b::c", "l"]
    got = flat(spark, NESTED, excluded=excluded, snake=False)
    expected = plainly(NESTED, excluded)
    assert set(got) == set(expected)
    assert got["b.d.f"] == "true" and got["b.d.e"] is None and got["z"] == "2.5" and got["b.empty"] == "{}"


def test_lists_stay_text_or_are_opened(spark):
    assert flat(spark, NESTED)["l"] == '[1,{"q":2}]'
    opened = flat(spark, NESTED, lists=True)
    assert opened["l.0"] == "1" and opened["l.1.q"] == "2" and "l" not in opened
    # a list step adds nothing to the path the exclusions are tested with
    assert "l.1.q" not in flat(spark, NESTED, lists=True, excluded=["l::q"])


def test_keys_are_snake_cased_per_level(spark):
    assert flat(spark, {"SerDeInfo": {"KmsKeyId": "k"}}) == {"ser_de_info.kms_key_id": "k"}
    assert flat(spark, {"SerDeInfo": {"KmsKeyId": "k"}}, snake=False, delimiter="/") == {"SerDeInfo/KmsKeyId": "k"}


def test_unprefixed_exclusion_hits_nested_keys(spark):
    document = {"StreamName": "s", "Shards": {"StreamName": "x", "n": 1}}
    assert flat(spark, document, snake=False, prefixed=False, excluded=["StreamName"]) == {"Shards.n": "1"}
    assert flat(spark, document, snake=False, excluded=["StreamName"]) == {"Shards.StreamName": "x", "Shards.n": "1"}


def test_json_text_is_decoded(spark):
    assert flat(spark, {"Parameters": {"exclusions": '{"a": {"b": 1}}'}}) == {"parameters.exclusions.a.b": "1"}
    assert flat(spark, {"Parameters": {"exclusions": '["x"]'}}) == {"parameters.exclusions": '["x"]'}
    assert flat(spark, {"Parameters": {"exclusions": "not json"}}) == {"parameters.exclusions": "not json"}


def test_every_level_is_opened(spark):
    nine = {"k9": 1}
    for level in range(8, 0, -1):
        nine = {f"k{level}": nine}
    assert flat(spark, nine) == {".".join(f"k{i}" for i in range(1, 10)): "1"}
    assert flat(spark, {"a": {}, "b": [], "c": {"d": {}}}) == {"a": "{}", "b": "[]", "c.d": "{}"}
    assert flat(spark, {"t": '{"not": "opened"}'}) == {"t": '{"not": "opened"}'}


def test_flattening_needs_no_shuffle(spark):
    plan = kv.flatten_metadata(docs(spark, NESTED))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_kinds(spark):
    frame = docs(spark, {"Name": "n", "TableType": "t", "Columns": [], "Other": 1})
    got = kv.metadata_of(frame, "athena_table", "https://schemas.example/").first()
    assert (got.key_path, got.value) == ("other", "1")
    assert got.schema_url == "https://schemas.example/athena.json#/definitions/AthenaDataSetExtension"
    assert kv.metadata_of(frame, "stream").first().schema_url is None


def test_pages_and_rejects(spark):
    pages = ['{"TableList":[{"Name":"a"},{"Name":"b"}]}', '{"TableList":[]}', '{"Other":1}', "broken"]
    lines = spark.createDataFrame([(p,) for p in pages], "value string")
    items, broken = dumps.open_pages(lines, "glue_table")
    ok, rejects = dumps.parse_docs(items, "glue_table")
    assert rows(ok.select("d.Name")) == [("a",), ("b",)] and rejects.count() == 0
    assert rows(broken.select("key")) == [("broken",), ('{"Other":1}',)]
    bad = spark.createDataFrame([('{"Name":"a"}',), ("nonsense",), ('{"CreateTime":{}}',), (None,)], "value string")
    ok, rejects = dumps.parse_docs(bad, "glue_table")
    assert rows(ok.select("d.Name")) == [("a",)]
    assert rejects.count() == 3 and {r.job for r in rejects.collect()} == {"glue_table"}


def test_documents_only_one_reader_accepts_are_rejected(spark):
    lines = spark.createDataFrame([('{"Name":"a","Name":"b"}',), ("{'Name':'a'}",), ('{"Name":"c"}',)], "value string")
    ok, rejects = dumps.parse_docs(lines, "glue_table")
    assert rows(ok.select("d.Name", F.col("doc").cast("string"))) == [("c", '{"Name":"c"}')] and rejects.count() == 2


PLAIN = [
    ('{"SourceArn":"a","SourceType":"b","DestinationArn":"c","DestinationType":"d"}', ("a", "b", "c", "d")),
    (' { "DestinationType" : "d" , "SourceArn" : "a" } ', ("a", None, None, "d")),
    ('{"SourceArn":"SourceType","SourceType":"x"}', ("SourceType", "x", None, None)),
    ('{"SourceType":"SourceArn"}', (None, "SourceArn", None, None)),
    ('{"SourceType":"SourceArn","SourceArn":"x"}', ("x", "SourceArn", None, None)),
    ('{"Other":"x","SourceArn":"a"}', ("a", None, None, None)),
    ('{"SourceArn":"","SourceType":"\u00e9\U0001f600, }:{"}', ("", "\u00e9\U0001f600, }:{", None, None)),
    ('{"SourceArn":"a\\"b\\u0041"}', ('a"bA', None, None, None)),
    ('{"SourceArn":1.5,"SourceType":null}', ("1.5", None, None, None)),
    ("{}", (None, None, None, None)),
    ('{"SourceArn":"' + "x" * 40000 + '"}', ("x" * 40000, None, None, None)),
]
BROKEN = [
    '{"SourceArn":"a","SourceArn":"b"}', '{"SourceArn":"a","Other":"b","Other":"c"}', '{"SourceArn":"a\tb"}', '{"SourceArn":"a"',
    '{"SourceArn":"a",}', '{"SourceArn":"a" "SourceType":"b"}', '{"SourceArn","a":"SourceType","b"}', '{"SourceArn":"a",,"SourceType":"b"}',
    "{'SourceArn':'a'}", '{"SourceArn"::"a"}', '"SourceArn":"a"}', "", None,
]


def test_plain_documents_read_as_the_parser_reads_them(spark):
    """A line of texts only is cut at its quotes: what it holds, and which lines are rejected, is the same."""
    lines = spark.createDataFrame([(line,) for line, _ in PLAIN] + [(line,) for line in BROKEN], "value string")
    ok, rejects = dumps.parse_docs(lines, "association")
    got = ok.select("d.SourceArn", "d.SourceType", "d.DestinationArn", "d.DestinationType")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(fields) for _, fields in PLAIN)
    assert sorted(str(r.key) for r in rejects.collect()) == sorted(map(str, BROKEN))


def test_times_of_plain_documents(spark):
    times = {"2020-05-05T01:02:03+02:00": "2020-05-04 23:02:03", "2020-05-05": "2020-05-05 00:00:00"}
    lines = [f'{{"ExperimentName":"{t}","CreationTime":"{t}"}}' for t in [*times, "soon", ""]] + ['{"ExperimentName":"none"}']
    ok, rejects = dumps.parse_docs(spark.createDataFrame([(x,) for x in lines], "value string"), "experiment")
    read = {tuple(r) for r in ok.select("d.ExperimentName", F.col("d.CreationTime").cast("string")).collect()}
    assert read == {*times.items(), ("none", None)} and rejects.count() == 2
