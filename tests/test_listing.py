"""Listings by name ranges, as frames and as a data source."""

import os
import random
import time

from pyspark.sql import functions as F

from metaspark.plans.folder_report import folder_fields
from metaspark.sources import listing
from metaspark.sources.listing import ObjectListing, name_bounds, walk_objects


def fill(folder, names):
    os.makedirs(folder, exist_ok=True)
    for name in names:
        with open(os.path.join(folder, name), "w") as out:
            out.write(name)


def test_bounds_cut_evenly_in_bounded_memory():
    names = [f"{random.Random(j).random():.9f}" for j in range(50_000)]
    bounds = name_bounds(iter(names), 5_000)
    assert bounds == sorted(set(bounds)) and len(bounds) == 9
    cuts = [None, *bounds, None]
    sizes = [sum(listing.within(n, a, b) for n in names) for a, b in zip(cuts, cuts[1:])]
    assert sum(sizes) == len(names) and max(sizes) < 7_000
    assert name_bounds(iter(["same"] * 9000), 1000) == ["same"]
    assert name_bounds(iter([]), 10) == []


def test_flat_folder_is_listed_by_many_tasks_in_pages(spark, tmp_path, monkeypatch):
    names = [f"f{j:06d}.csv" for j in range(30_000)]
    fill(tmp_path / "flat", names)
    walked = walk_objects(spark, str(tmp_path), range_names=2_000, page=500)
    files = walked.filter("is_file")
    per_task = [r["n"] for r in files.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(per_task) == len(names) and len(per_task) >= 6 and max(per_task) < len(names) / 3
    got = sorted(r["path"].rsplit("/", 1)[1] for r in files.select("path").collect())
    assert got == names
    assert [r["path"].rsplit("/", 1)[1] for r in walked.filter("not is_file").collect()] == ["flat"]
    pages = list(listing._pages(listing.list_range(str(tmp_path / "flat"), "f01"), 500))
    assert max(p.num_rows for p in pages) == 500 and sum(p.num_rows for p in pages) == 20_000
    assert files.select("length").distinct().collect()[0].length == len(names[0])


def test_ranges_and_whole_folders_agree(spark, tmp_path):
    for folder in ("a", "a/b", "a/b/.hidden", "_log"):
        fill(tmp_path / folder, [f"{folder[-1]}{j}" for j in range(25)] + ["ünïcode é", "sp ace"])
    few = walk_objects(spark, str(tmp_path), range_names=3, page=2)
    whole = walk_objects(spark, str(tmp_path))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, whole.collect()))
    assert whole.filter("is_file").count() == 4 * 27


def test_data_source_reads_the_tree(spark, tmp_path):
    fill(tmp_path, [f"t{j}" for j in range(40)])
    fill(tmp_path / "deep" / "er", ["x", "y"])
    spark.dataSource.register(ObjectListing)
    read = spark.read.format("objects").option("rangeNames", 10).load(str(tmp_path))
    assert read.rdd.getNumPartitions() >= 4
    assert {r.path for r in read.collect()} == {r.path for r in walk_objects(spark, str(tmp_path)).filter("is_file").collect()}
    assert read.count() == 42


def test_stream_delivers_each_object_once_over_restarts(spark, tmp_path):
    spark.dataSource.register(ObjectListing)
    lake, out, offsets = (str(tmp_path / n) for n in ("lake", "out", "offsets"))
    fill(lake, ["a", "b"])
    fill(f"{lake}/sub", ["c"])

    def run():
        time.sleep(1.2)
        stream = spark.readStream.format("objects").option("settle", 1).option("rangeNames", 2).load(lake)
        written = stream.select("path").writeStream.format("parquet").option("path", out).option("checkpointLocation", offsets)
        written.trigger(availableNow=True).start().awaitTermination()
        return sorted(r.path.rsplit("/", 1)[1] for r in spark.read.schema("path string").parquet(out).collect())

    assert run() == ["a", "b", "c"]
    fill(f"{lake}/sub/new", ["d"])
    fill(lake, ["e"])
    assert run() == ["a", "b", "c", "d", "e"]
    assert run() == ["a", "b", "c", "d", "e"]


def test_folder_report_leaves_hidden_files_out(spark, tmp_path):
    fill(tmp_path / "t", [])
    (tmp_path / "t" / "x.csv").write_text("n\n1\n")
    (tmp_path / "t" / "_SUCCESS").write_text("")
    fill(tmp_path / "t" / "_delta_log", ["0.csv"])
    assert [r.field_rn for r in folder_fields(spark, str(tmp_path)).collect()] == ["t/columns/n"]
