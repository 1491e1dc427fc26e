"""Least common types of columns."""

import itertools
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from metaspark.operators.type_lattice import bound, conflicts, merge_types, text_of, tree_of
from metaspark.plans.folder_report import folder_report

TEXTS = [
    "int8", "int32", "int64", "uint16", "uint64", "float", "double", "decimal128(10, 2)", "decimal128(38, 0)", "string", "large_string",
    "bool", "date32[day]", "timestamp[us]", "timestamp[ns]", "timestamp[us, tz=UTC]", "null", "list<element: int32>", "list<element: string>",
    "struct<a: int32, b: string>", "struct<b: large_string, c: list<element: int8>>", "map<string, int32>", "map<string, double>", "binary",
]


def common(*texts):
    tree = {}
    for t in texts:
        tree = bound(tree, tree_of(t))
    return tree


@pytest.mark.parametrize(
    "a, b, want",
    [
        ("int8", "int64", "int64"), ("uint32", "int32", "int64"), ("uint64", "int8", "decimal128(20, 0)"), ("int64", "float", "double"),
        ("decimal128(10, 2)", "decimal128(8, 4)", "decimal128(12, 4)"), ("decimal128(10, 2)", "int64", "decimal128(21, 2)"),
        ("date32[day]", "timestamp[us]", "timestamp[us]"), ("timestamp[ms]", "timestamp[ns]", "timestamp[ns]"), ("null", "bool", "bool"),
        ("list<element: int32>", "list<item: int64>", "list<element: int64>"), ("map<string, int32>", "map<string, double>", "map<string, double>"),
        ("struct<a: int32, b: string>", "struct<b: string, c: bool>", "struct<a: int32, b: string, c: bool>"),
        ("bool", "string", "unknown"), ("timestamp[us]", "timestamp[us, tz=UTC]", "unknown"),
    ],
)
def test_pairs(a, b, want):
    assert text_of(common(a, b)) == text_of(common(b, a)) == want


def test_bound_is_associative_commutative_idempotent():
    rnd = random.Random(1)
    for _ in range(1500):
        texts = rnd.choices(TEXTS, k=4)
        trees = [tree_of(t) for t in texts]
        whole = common(*texts)
        assert all(common(*p) == whole for p in itertools.permutations(texts))
        assert bound(bound(trees[0], trees[1]), bound(trees[2], trees[3])) == whole
        assert bound(whole, whole) == whole and bound(whole, trees[0]) == whole


def test_conflicts_inside_a_struct_are_named():
    assert conflicts(common("struct<a: int32, b: list<element: bool>>", "struct<a: string, b: list<element: string>>")) == [
        "/a: int32, string", "/b/list: bool, string",
    ]


def write(folder, name, **columns):
    folder.mkdir(exist_ok=True, parents=True)
    pq.write_table(pa.table(columns), folder / f"{name}.parquet")


@pytest.mark.parametrize("order", [("p", "q", "r"), ("r", "q", "p")])
def test_folder_of_unlike_files(spark, tmp_path, order):
    first, second, third = order
    write(tmp_path / "t", first, a=pa.array([1], pa.int32()), b=pa.array(["x"]), s=pa.array([{"k": 1}], pa.struct([("k", pa.int32())])))
    write(tmp_path / "t", second, b=pa.array(["x"]), a=pa.array(["1"]), s=pa.array([{"z": 1.5}], pa.struct([("z", pa.float64())])))
    write(tmp_path / "t", third, b=pa.array(["y"], pa.large_string()), c=pa.array([True]), s=pa.array([{"k": 1}], pa.struct([("k", pa.int64())])))
    fields, rejects = folder_report(spark, str(tmp_path))
    got = {r.field_rn: (r.type, r.logical_type) for r in fields.collect()}
    assert fields.count() == len(got)
    assert got == {
        "t/columns/a": ("UNKNOWN", "unknown"), "t/columns/b": ("STRING", "large_string"), "t/columns/c": ("BOOLEAN", "bool"),
        "t/columns/s": ("STRUCT", "struct"), "t/columns/s/subcolumns/k": ("INTEGER", "int64"), "t/columns/s/subcolumns/z": ("NUMBER", "double"),
    }
    assert [tuple(r) for r in rejects.collect()] == [("fields", "t/columns/a", "types without a common one: int32, string")]


def test_many_types_of_one_column(spark):
    rows = [("t", "c", 3, f"struct<m{j}: int32>") for j in range(200)] + [("t", "d", 1, "int8")] * 50
    merged = {r.column_name: r for r in merge_types(spark.createDataFrame(rows, "entity_rn string, column_name string, position int, type_string string")).collect()}
    assert merged["c"].type_string.count("int32") == 200 and merged["c"].position == 3 and merged["c"].conflicts == []
    assert merged["d"].type_string == "int8" and merged["d"].conflicts is None
