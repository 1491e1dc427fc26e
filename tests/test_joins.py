"""Sides that grow with the input meet by key: nothing of them is sent through the driver."""

import pytest

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["selection_rules", "task_inputs"])
def test_tables_and_rules_meet_by_key(spark, name):
    plan = plan_of(entry_module.queries()[name](spark, SF))
    assert "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SortMergeJoin" in plan


@pytest.mark.parametrize(
    "name",
    ["experiment_tree", "artifact_entities", "artifact_dedup", "component_edges", "experiment_list", "job_entities",
     "log_table_entities", "task_endpoints", "datasource_dispatch"],
)
def test_entities_and_their_parts_meet_by_key(spark, name):
    plan = plan_of(entry_module.queries()[name](spark, SF))
    assert "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_links_are_one_row_for_each_artifact_before_artifacts_are_joined(spark):
    plan = plan_of(entry_module.queries()["artifact_dedup"](spark, SF))
    join, least = plan.index("SortMergeJoin"), [i for i in range(len(plan)) if plan.startswith("partial_min(component_arn", i)]
    assert any(i > join for i in least)


def test_first_links_and_then_artifacts_give_the_same_artifacts(spark):
    from pyspark.sql import functions as F

    from metaspark.operators import experiments as ex

    arn = "arn:aws:sm:eu:1:artifact/"
    links = spark.createDataFrame(
        [("c2", "input", "Image", arn + "a"), ("c1", "input", "Image", arn + "b"), ("c3", "output", "Model", arn + "m"),
         ("c0", "input", "Model", arn + "m"), ("c9", "input", "Image", arn + "unknown")],
        "component_arn string, direction string, artifact_type string, artifact_arn string",
    )
    artifacts = spark.createDataFrame(
        [(arn + "a", "r/i:1"), (arn + "b", "r/i:1"), (arn + "m", "s3://b/m")], "artifact_arn string, uri string"
    )
    joined = ex.unique_artifacts(ex.with_artifacts(links, artifacts, F.lit("//s")))
    first = ex.unique_artifacts(ex.with_artifacts(ex.first_links(links), artifacts, F.lit("//s")))
    assert sorted(joined.collect()) == sorted(first.collect())
    assert {r.component_arn for r in first.collect()} == {"c0", "c1"}


def test_a_folder_all_roots_share_is_met_in_parts(spark):
    """Without any limit on skew the rows of the folder ``lake`` are in many partitions, and a table above all still counts."""
    from pyspark.sql import functions as F

    from metaspark.sources import txlog

    paths = spark.range(3000).select(F.format_string("lake/t%05d/_delta_log/00000000000000000000.json", "id").alias("path"))
    alone = txlog.discover_tables(paths, start="lake")
    assert alone.count() == 3000
    joins = [line for line in plan_of(alone).splitlines() if "SortMergeJoin" in line or "HashJoin" in line]
    assert any("folder" in j and "part" in j for j in joins) and not any("BroadcastHashJoin" in j for j in joins)
    top = spark.createDataFrame([("lake/_delta_log/00000000000000000000.json",)], "path string")
    assert [r.root for r in txlog.discover_tables(paths.union(top), start="lake").collect()] == ["lake"]


@pytest.mark.parametrize("name", ["component_edges", "artifact_entities"])
def test_arns_are_sorted_by_their_hash_first(spark, name):
    plan = plan_of(entry_module.queries()[name](spark, SF))
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line and "_arn" in line]
    assert len(joins) == 2 and all("SortMergeJoin [_hash" in j for j in joins)


def test_rows_met_by_key_are_those_of_a_plain_join(spark):
    from metaspark.operators.joins import met_by_key

    left = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3), ("", 4)], "k string, x int")
    right = spark.createDataFrame([("a", 5), ("a", 6), (None, 7), ("", 8), ("c", 9)], "k string, y int")
    for how in ("inner", "left_semi", "left_anti", "left"):
        met, plain = met_by_key(left, right, "k", how), left.join(right, "k", how)
        assert met.columns == plain.columns
        assert sorted(map(repr, met.collect())) == sorted(map(repr, plain.collect()))


@pytest.mark.parametrize("name", ["entity_union", "component_edges", "artifact_entities"])
def test_documents_are_made_once_and_tested_after_they_are_dealt_out(spark, name):
    """No test of a document reaches the scan, where the document would be made a second time by few tasks."""
    plan = plan_of(entry_module.queries()[name](spark, SF))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and not any("arseJson" in line or "StructsToJson" in line for line in scans)
