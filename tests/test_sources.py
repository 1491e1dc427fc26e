"""Listings, footers, folders as datasets, folder trees."""

import gzip
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from conftest import rows
from metaspark.operators.inventory import (
    exclude_listed, exclude_names, filter_files, folder_members, folders, keep_names,
)
from metaspark.plans.folder_report import folder_fields
from metaspark.sources.objects import describe_objects, list_objects, scan_schemas, walk_objects
from metaspark.sources.partitioned import folder_fields as dataset_fields
from metaspark.sources.partitioned import read_folder


@pytest.fixture
def lake(tmp_path):
    os.makedirs(tmp_path / "x" / "y")
    nested = pa.schema([("id", pa.int64()), ("l", pa.list_(pa.struct([("a", pa.string())])))])
    pq.write_table(pa.Table.from_pylist([{"id": 1, "l": []}], schema=nested), tmp_path / "x" / "part.snappy.parquet")
    (tmp_path / "x" / "a.csv").write_text("n,when,who\n1,2020-01-01,bob\n2,2020-01-02,eve\n")
    (tmp_path / "x" / "y" / "b.tsv").write_text("n\twho\n1.5\tbob\n")
    with gzip.open(tmp_path / "x" / "y" / "c.csv.gz", "wt") as out:
        out.write("flag\ntrue\n")
    (tmp_path / "x" / "broken.parquet").write_text("not a parquet file")
    (tmp_path / "x" / "noext").write_text("?")
    return str(tmp_path)


def test_both_listings_agree(spark, lake):
    def files(df):
        return sorted(r.path.split(lake)[-1] for r in df.select("path").collect())

    walked = walk_objects(spark, lake)
    assert files(list_objects(spark, lake)) == files(walked.filter("is_file"))
    assert files(walked.filter("not is_file")) == ["/x", "/x/y"]
    sizes = {r.path.split(lake)[-1]: r.length for r in walked.filter("is_file").collect()}
    assert sizes["/x/noext"] == 1


def test_file_contents_are_pruned_from_the_listing(spark, lake):
    plan = list_objects(spark, lake)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_schema_scan(spark, lake):
    scanned = scan_schemas(describe_objects(list_objects(spark, lake))).collect()
    got = {}
    for r in scanned:
        got.setdefault(os.path.basename(r.path), []).append((r.format, r.column_name, r.type_string))
    assert got["part.snappy.parquet"] == [
        ("parquet", "id", "int64"), ("parquet", "l", "list<element: struct<a: string>>")]
    assert got["a.csv"] == [("csv", "n", "int64"), ("csv", "when", "date32[day]"), ("csv", "who", "string")]
    assert got["b.tsv"] == [("tsv", "n", "double"), ("tsv", "who", "string")]
    assert got["c.csv.gz"] == [("csv", "flag", "bool")]
    # unreadable files stay in the result
    assert got["broken.parquet"] == [("unknown", None, None)] and got["noext"] == [("unknown", None, None)]
    assert all(r.error for r in scanned if r.format == "unknown")


def test_filter_runs_before_the_scan(spark, lake):
    kept = filter_files(describe_objects(list_objects(spark, lake)), include=[r".*\.csv"], exclude=["^c"])
    assert {os.path.basename(r.path) for r in scan_schemas(kept).collect()} == {"a.csv"}


def test_folder_report_merges_the_files_of_a_table(spark, tmp_path):
    for i in range(3):
        os.makedirs(tmp_path / "t.parquet", exist_ok=True)
        pq.write_table(pa.table({"a": [i], "b": ["x"]}), tmp_path / "t.parquet" / f"part-{i}.parquet")
    pq.write_table(pa.table({"c": [1.0]}), tmp_path / "u.parquet")
    got = rows(folder_fields(spark, str(tmp_path)).select("field_rn", "type"))
    assert got == [("t/columns/a", "INTEGER"), ("t/columns/b", "STRING"), ("u/columns/c", "NUMBER")]


def test_hive_folder(spark, tmp_path):
    path = str(tmp_path / "h")
    spark.range(10).selectExpr("id", "id % 2 as p", "'k' as q").write.partitionBy("p", "q").parquet(path)
    data = read_folder(spark, path, "parquet")
    assert data.filter("p = 1").count() == 5
    assert [r.column_name for r in dataset_fields(data).orderBy("position").collect()] == ["id", "p", "q"]
    plan = data.filter("p = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def test_directory_folder(spark, tmp_path):
    for year, month in [("2020", "01"), ("2020", "02"), ("2021", "01")]:
        os.makedirs(tmp_path / "d" / year / month)
        (tmp_path / "d" / year / month / "f.csv").write_text(f"v\n{year}{month}\n")
    (tmp_path / "d" / "top.csv").write_text("v\n0\n")
    data = read_folder(spark, str(tmp_path / "d"), "csv", "directory", ["year", "month"])
    assert rows(data) == [("0", None, None), ("202001", "2020", "01"), ("202002", "2020", "02"), ("202101", "2021", "01")]
    with pytest.raises(ValueError):
        read_folder(spark, str(tmp_path / "d"), "csv", "directory")


def test_folder_tree_against_plain_loops(spark):
    listed = ["b/x/1", "b/x/2", "b/y/z/3", "b/4", "c/x/1"]
    expected = set()
    for path in listed:
        steps = path.split("/")
        for i in range(1, len(steps)):
            kind = "FILE" if i == len(steps) - 1 else "FOLDER"
            expected.add(("/".join(steps[:i]), "/".join(steps[: i + 1]), kind))
    df = spark.createDataFrame([(p,) for p in listed], "path string")
    assert set(rows(folder_members(df))) == expected
    assert {(r.path, r.is_bucket) for r in folders(df).collect()} == {
        ("b", True), ("b/x", False), ("b/y", False), ("b/y/z", False), ("c", True), ("c/x", False)}


def test_name_lists(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    assert rows(exclude_names(df, ["b", "x"])) == [("a",), ("c",)]
    assert rows(exclude_names(df, [])) == [("a",), ("b",), ("c",)]
    assert rows(exclude_listed(df, spark.createDataFrame([("b",), ("b",)], "name string"))) == [("a",), ("c",)]
    assert rows(keep_names(df, ["c"])) == [("c",)]
    assert keep_names(df, []).count() == 3 and keep_names(df, None).count() == 3
