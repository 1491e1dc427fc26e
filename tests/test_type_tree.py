"""Type texts of every dialect -> field trees."""

import pytest
from pyspark.sql import functions as F

from metaspark.operators.type_tree import field_rows


def flatten(spark, pairs):
    df = spark.createDataFrame([(f"e{i}", d, t) for i, (d, t) in enumerate(pairs)], "entity_rn string, dialect string, type_string string")
    columns = df.select(
        "entity_rn", F.concat("entity_rn", F.lit("/c")).alias("column_rn"), F.lit(0).alias("position"),
        F.lit("c").alias("column_name"), "dialect", "type_string", F.lit(True).alias("is_nullable"),
        F.lit("note").alias("description"),
    )
    return field_rows(columns)


CASES = [
    ("arrow", "int64", ["c:INTEGER:int64"]),
    ("arrow", "timestamp[us]", ["c:DATETIME:timestamp[us]"]),
    ("arrow", "timestamp[us, tz=UTC]", ["c:DATETIME:timestamp[us, tz=UTC]"]),
    ("arrow", "decimal128(10, 2)", ["c:NUMBER:decimal128(10, 2)"]),
    ("arrow", "date32[day]", ["c:DATETIME:date32[day]"]),
    ("arrow", "list<item: int64>", ["c:LIST:list", "c/values/int64:INTEGER:int64:value"]),
    ("arrow", "list<element: float>", ["c:LIST:list", "c/values/float:NUMBER:float:value"]),
    ("arrow", "struct<a: int64, b: list<item: string>>", [
        "c:STRUCT:struct", "c/subcolumns/a:INTEGER:int64", "c/subcolumns/b:LIST:list",
        "c/subcolumns/b/values/string:STRING:string:value"]),
    ("arrow", "map<string, double>", [
        "c:MAP:map", "c/keys/string:STRING:string:key", "c/values/double:NUMBER:double:value"]),
    ("arrow", "dictionary<values=string, indices=int32, ordered=0>", ["c:STRUCT:dictionary"]),
    ("arrow", "fixed_size_list<item: float>[3]", ["c:LIST:list", "c/values/float:NUMBER:float:value"]),
    ("arrow", "struct<", ["c:UNKNOWN:struct<"]),
    ("arrow", "mystery", ["c:UNKNOWN:mystery"]),
    ("arrow", "struct<x0: mystery>", ["c:UNKNOWN:struct<x0: mystery>"]),
    ("glue", "bigint", ["c:NUMBER:bigint"]),
    ("glue", "timestamp", ["c:INTEGER:timestamp"]),
    ("glue", "varchar(20)", ["c:STRING:varchar(20)"]),
    ("glue", "decimal(10,2)", ["c:NUMBER:decimal(10, 2)"]),
    ("glue", "DECIMAL(10 , 2)", ["c:NUMBER:decimal(10, 2)"]),
    ("glue", "char(5)", ["c:CHAR:char(5)"]),
    ("glue", "array<struct<x:int,y:string>>", [
        "c:LIST:list", "c/subcolumns/struct:STRUCT:struct", "c/subcolumns/struct/subcolumns/x:INTEGER:int",
        "c/subcolumns/struct/subcolumns/y:STRING:string"]),
    ("glue", "map<string,array<int>>", [
        "c:MAP:map", "c/keys/string:STRING:string:key", "c/values/list:LIST:list:value",
        "c/values/list/subcolumns/int:INTEGER:int"]),
    ("glue", "struct<a-b.0_c:struct<>>", ["c:STRUCT:struct", "c/subcolumns/a-b.0_c:STRUCT:struct"]),
    ("athena", "decimal(10,2)", ["c:NUMBER:decimal(10, 2)"]),
    ("athena", "union<int,string>", ["c:UNION:union", "c/subcolumns/int:INTEGER:int", "c/subcolumns/string:STRING:string"]),
    ("delta", '"timestamp"', ["c:TIME:timestamp"]),
    ("delta", "timestamp", ["c:TIME:timestamp"]),
    ("delta", "decimal(10,2)", ["c:NUMBER:decimal(10, 2)"]),
    ("delta", '{"type":"array","elementType":"integer","containsNull":true}', [
        "c:LIST:list", "c/values/integer:INTEGER:integer:value"]),
    ("delta", '{"type":"map","keyType":"string","valueType":{"type":"struct","fields":'
              '[{"name":"x","type":"long","nullable":false,"metadata":{}}]},"valueContainsNull":true}', [
        "c:MAP:map", "c/keys/string:STRING:string:key", "c/values/struct:STRUCT:struct:value",
        "c/values/struct/subcolumns/x:INTEGER:long"]),
]


@pytest.fixture(scope="module")
def flattened(spark):
    fields, rejects = flatten(spark, [(d, t) for d, t, _ in CASES])
    by_case = {}
    for r in fields.orderBy("entity_rn", "ordinal").collect():
        by_case.setdefault(int(r.entity_rn[1:]), []).append(r)
    return by_case, rejects.collect()


@pytest.mark.parametrize("i", range(len(CASES)), ids=[f"{d}:{t[:30]}" for d, t, _ in CASES])
def test_tree(flattened, i):
    rows, _ = flattened
    got = [
        ":".join([r.field_rn.split("/", 1)[1], r.type, r.logical_type] + ["key"] * r.is_key + ["value"] * r.is_value)
        for r in rows[i]
    ]
    assert got == CASES[i][2]


def test_tree_is_consistent(flattened):
    rows, rejects = flattened
    assert rejects == []
    for fields in rows.values():
        names = [f.field_rn for f in fields]
        assert len(set(names)) == len(names)
        assert [f.ordinal for f in fields] == list(range(len(fields)))
        for f in fields:
            assert (f.parent_field_rn is None) == (f.depth == 0)
            assert f.depth == 0 or f.parent_field_rn in names
            assert (f.description == "note") == (f.depth == 0)


def test_log_nullability_is_the_schema_s_own(flattened):
    rows, _ = flattened
    x = [f for f in rows[len(CASES) - 1] if f.name == "x"]
    assert [f.is_nullable for f in x] == [False]


def test_unreadable_types_are_rejected_not_lost(spark):
    pairs = [("athena", "uniontype<int,string>"), ("glue", "geometry"), ("glue", "struct<a:int"), ("delta", '{"type":"x"}'),
             ("glue", "map<int>"), ("glue", "array<int>x")]
    fields, rejects = flatten(spark, pairs)
    assert fields.count() == 0
    assert sorted(r.key for r in rejects.collect()) == [f"e{i}/c" for i in range(len(pairs))]


def test_flat_types_stay_in_the_jvm(spark):
    fields, _ = flatten(spark, [("glue", "int")])
    plan = fields._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_missing_type_text_is_rejected(spark):
    columns = [("e", f"e/columns/{i}", i, f"c{i}", d, t, True, None) for i, (d, t) in enumerate([("glue", None), ("glue", "int"), ("arrow", None)])]
    df = spark.createDataFrame(
        columns,
        "entity_rn string, column_rn string, position int, column_name string, dialect string, type_string string, "
        "is_nullable boolean, description string",
    )
    fields, rejects = field_rows(df)
    assert [r.name for r in fields.collect()] == ["c1"]
    assert sorted(r.key for r in rejects.collect()) == ["e/columns/0", "e/columns/2"]


def test_executors_need_no_package(tmp_path):
    """A session in another folder, whose workers cannot import the package, reads nested types."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from metaspark.operators.type_tree import flatten_types
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
df = spark.createDataFrame([("glue", "array<struct<a:int>>")], "dialect string, type_string string")
print("fields", flatten_types(df).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "fields 3" in done.stdout, done.stderr[-2000:]
