"""Changes between snapshots by digest trees."""

import random

import pytest
from pyspark.sql import functions as F

from metaspark.operators.digest_tree import changed_leaves, changes, write_snapshot

SCHEMA = "entity_rn string, name string, rows_number long"


def snapshot(spark, folder, rows, **more):
    write_snapshot(spark.createDataFrame(rows, SCHEMA).repartition(3), folder, ["entity_rn"], **more)
    return folder


def difference(before, after):
    old, new = ({r[0]: r for r in rows} for rows in (before, after))
    out = [("added", *new[k]) for k in new.keys() - old.keys()] + [("removed", *old[k]) for k in old.keys() - new.keys()]
    return sorted([*out, *[("changed", *new[k]) for k in old.keys() & new.keys() if old[k] != new[k]]], key=repr)


@pytest.mark.parametrize("depth", [1, 2])
def test_added_changed_removed(spark, tmp_path, depth):
    rnd = random.Random(depth)
    before = [(f"//e/{j}", rnd.choice(["a", None]), rnd.choice([None, j])) for j in range(3000)] + [(None, "no key", 1)]
    after = [r for r in before if r[0] not in ("//e/5", "//e/77")]
    after = [(k, n, (v or 0) + 1) if k in ("//e/9", None) else (k, None if n else "b", v) if k == "//e/10" else (k, n, v) for k, n, v in after]
    after += [("//e/new", None, None)]
    folders = [snapshot(spark, str(tmp_path / n), rows, depth=depth) for n, rows in (("old", before), ("new", after))]
    found = changes(spark, *folders, ["entity_rn"], depth)
    assert sorted(map(tuple, found.collect()), key=repr) == difference(before, after)
    assert found.columns == ["change", "entity_rn", "name", "rows_number"]
    assert len(changed_leaves(spark, *folders, depth)) <= 6
    assert changes(spark, folders[0], folders[0], ["entity_rn"], depth).collect() == []


def test_a_value_that_moves_between_columns_or_keys_is_a_change(spark, tmp_path):
    before = [("a", "x", None), ("b", "y", 1)]
    after = [("a", None, None), ("b", "x", 1)]
    folders = [snapshot(spark, str(tmp_path / n), rows) for n, rows in (("old", before), ("new", after))]
    assert sorted(map(tuple, changes(spark, *folders, ["entity_rn"]).collect()), key=repr) == difference(before, after)


def test_only_differing_leaves_are_read(spark, tmp_path):
    before = [(f"//e/{j}", "n", j) for j in range(4000)]
    after = [(k, n, -1 if k == "//e/1234" else v) for k, n, v in before]
    folders = [snapshot(spark, str(tmp_path / n), rows) for n, rows in (("old", before), ("new", after))]
    found = changes(spark, *folders, ["entity_rn"])
    assert [tuple(r) for r in found.collect()] == [("changed", "//e/1234", "n", -1)]
    leaves = changed_leaves(spark, *folders)
    assert len(leaves) == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_leaf" in plan and "PartitionFilters: []" not in plan
    read = spark.read.schema("_leaf string").parquet(f"{folders[1]}/rows").filter(F.col("_leaf").isin(leaves)).count()
    assert 0 < read < 60


def test_empty_snapshots(spark, tmp_path):
    folders = [snapshot(spark, str(tmp_path / n), rows) for n, rows in (("none", []), ("one", [("a", "b", 1)]))]
    assert [r.change for r in changes(spark, *folders, ["entity_rn"]).collect()] == ["added"]
    assert [r.change for r in changes(spark, *folders[::-1], ["entity_rn"]).collect()] == ["removed"]
    assert changes(spark, folders[0], folders[0], ["entity_rn"]).collect() == []
