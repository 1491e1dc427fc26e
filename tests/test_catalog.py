"""Entity mappers, joins, sink and streaming refresh."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from metaspark.operators import experiments as ex
from metaspark.operators import lineage as ln
from metaspark.operators.latest import first_per_key, latest_per_key
from metaspark.operators.runs import job_runs
from metaspark.plans import entities as en
from metaspark.plans.catalog import read_catalog, union_all, write_catalog
from metaspark.sources import dumps
from metaspark.streaming.refresh import compact, current_state, refresh

SCOPE = en.Scope("1", "eu")


def parsed(spark, kind, *documents):
    lines = spark.createDataFrame([(json.dumps(d),) for d in documents], "value string")
    docs, rejects = dumps.parse_docs(lines, kind)
    assert rejects.count() == 0
    return docs


def test_every_kind_parses_an_empty_document(spark):
    for kind in dumps.SCHEMAS:
        assert parsed(spark, kind, {}).count() == 1


def test_view_has_its_own_level(spark):
    docs = parsed(spark, "athena_table", {"Catalog": "c", "Database": "d", "Name": "v", "TableType": "VIRTUAL_VIEW",
                                          "CreateTime": "2020-01-01T00:00:00Z", "Columns": [{"Name": "a", "Type": "int"}]})
    e = en.athena_entities(docs, SCOPE).first()
    assert (e.entity_rn, e.entity_type, e.rows_number) == (
        "//athena/cloud/aws/account/1/region/eu/catalogs/c/databases/d/views/v", "VIEW", 0)
    assert en.athena_columns(docs, SCOPE).first().column_rn == e.entity_rn + "/columns/a"


def test_queue_tolerates_missing_policy(spark):
    docs = parsed(spark, "queue", {"QueueUrl": "https://q/1/name", "Attributes": {"CreatedTimestamp": "60", "LastModifiedTimestamp": "120", "X": "y"}})
    e = en.queue_entities(docs, SCOPE).select("name", F.unix_seconds("created_at"), F.unix_seconds("updated_at")).first()
    assert tuple(e) == ("name", 60, 120)
    assert docs.select(en.queue_attributes(F.col("d.Attributes"), "1")).first()[0] == {"X": "y", "AccountID": "1"}


def test_unfinished_run_and_reason(spark):
    jobs = spark.createDataFrame([("j", "rn/j", "me")], "job_name string, job_rn string, owner_rn string")
    runs = spark.createDataFrame(
        [("j", "1", "RUNNING", None, None, "msg"), ("j", "2", "ERROR", None, None, "msg"), ("gone", "3", "ERROR", None, None, "m")],
        "job_name string, run_id string, state string, started_at timestamp, completed_at timestamp, message string")
    got = rows(job_runs(jobs, runs).select("run_rn", "owner_rn", "status", "status_reason", "end_time"))
    assert got == [("rn/j/runs/1", "me", "UNKNOWN", None, None), ("rn/j/runs/2", "me", "FAILED", "msg", None)]


def test_endpoint_names(spark):
    endpoints = spark.createDataFrame(
        [("sqlserver", "h", "d", None, None), ("mariadb", "h", "d", None, None), ("mongodb", "h", "d", None, None),
         ("s3", None, None, "b", "f"), ("oracle", "h", "d", None, None)],
        "engine_name string, server_name string, database_name string, bucket_name string, bucket_folder string")
    named = ln.endpoint_sources(endpoints.withColumn("endpoint_arn", F.col("engine_name")))
    rn = ln.endpoint_table_name(F.col("database_rn"), F.col("engine_name"), F.lit("s"), F.lit("t"))
    got = dict(rows(named.select("engine_name", rn)))
    assert got == {
        "sqlserver": "//mssql/host/h/databases/d/schemas/s/tables/t",
        "mariadb": "//mysql/host/h/databases/d/schemas/s/tables/t",
        "mongodb": "//mongodb/host/h/databases/d/schemas/s/collections/t",
        "s3": "//s3/cloud/aws/buckets/b/keys/f\\s\\t",
        "oracle": None,
    }


def test_missing_endpoint_keeps_the_task(spark):
    tasks = spark.createDataFrame([("t", "a", "nowhere")], "task_id string, source_endpoint_arn string, target_endpoint_arn string")
    endpoints = spark.createDataFrame([("a", "mysql")], "endpoint_arn string, engine_name string")
    got = ln.tasks_with_endpoints(tasks, endpoints).first()
    assert (got.source_engine_name, got.target_engine_name) == ("mysql", None)


def test_artifacts(spark):
    arn = "arn:aws:sm:eu:1:"
    associations = spark.createDataFrame(
        [(arn + "artifact/i1", "Image", "c2", "Job"), (arn + "artifact/i2", "Image", "c1", "Job"),
         ("c1", "Job", arn + "artifact/m", "Model"), (arn + "artifact/d", "DataSet", "c1", "Job"),
         (arn + "artifact/bad", "DataSet", "c1", "Job"), (arn + "context/x", "Image", "c1", "Job"),
         (arn + "artifact/l", "Log", "c1", "Job"), (arn + "artifact/m", "Model", arn + "artifact/d", "DataSet")],
        "source_arn string, source_type string, destination_arn string, destination_type string")
    artifacts = spark.createDataFrame(
        [(arn + "artifact/i1", "reg/img:1"), (arn + "artifact/i2", "reg/img:1"), (arn + "artifact/m", "s3://m/x"),
         (arn + "artifact/d", "s3://b/k.csv"), (arn + "artifact/bad", "no url"), (arn + "artifact/l", "x")],
        "artifact_arn string, uri string")
    links = ex.artifact_links(associations, artifacts, SCOPE.source("sagemaker"))
    assert links.count() == 5
    # two image artifacts with one URI are one entity, first component wins
    unique = {r.artifact_key: r.component_arn for r in ex.unique_artifacts(links).collect()}
    assert unique["reg/img:1"] == "c1" and len(unique) == 4
    tree = spark.createDataFrame([("c1", "n1", "t", "e"), ("c2", "n2", "t", "e")], "component_arn string, component_name string, trial_name string, experiment_name string")
    base = "//sagemaker/cloud/aws/account/1/region/eu"
    job = f"{base}/experiments/e/trials/t/jobs/"
    assert set(rows(en.component_edges(tree, links, SCOPE))) == {
        (job + "n2", f"{base}/artifacts/img:1", "input"), (job + "n1", f"{base}/artifacts/img:1", "input"),
        (f"{base}/artifacts/img:1", job + "n1", "output"), (f"{base}/artifacts/img:1", job + "n2", "output"),
        (job + "n1", f"{base}/artifacts/model:m", "output"), (f"{base}/artifacts/model:m", job + "n1", "consume"),
        (job + "n1", "//s3/cloud/aws/buckets/b/keys/k.csv", "input"),
    }
    assert {(r.name, r.entity_type) for r in en.artifact_entities(links, SCOPE).collect()} == {
        ("img:1", "MICROSERVICE"), ("model", "ML_MODEL_TRAINING")}
    assert {r.component_arn for r in ex.links_of_tree(links, tree.filter("component_arn = 'c2'")).collect()} == {"c2"}


def test_experiment_name_list(spark):
    experiments = spark.createDataFrame([("a",), ("b",)], "experiment_name string")
    trials = spark.createDataFrame([("t1", "a"), ("t2", "b")], "trial_name string, experiment_name string")
    components = spark.createDataFrame([("c1", "t1"), ("c2", "t2"), ("c3", "none")], "component_arn string, trial_name string")
    assert ex.experiment_tree(experiments, trials, components).count() == 2
    assert [r.component_arn for r in ex.experiment_tree(experiments, trials, components, ["b"]).collect()] == ["c2"]


def test_parameters_and_metrics(spark):
    docs = parsed(spark, "trial_component", {
        "TrialComponentArn": "c", "Parameters": {"n": {"NumberValue": 2.0, "StringValue": "no"}, "s": {"StringValue": "yes"}},
        "Metrics": [{"MetricName": "loss", "Max": 2.0, "Min": 1.0, "Count": 3}]})
    rows_of = docs.select(F.col("d.TrialComponentArn").alias("component_arn"), F.col("d.Parameters").alias("parameters"))
    assert dict((r.key_path, r.value) for r in ex.parameter_rows(rows_of).collect()) == {"n": "2.0", "s": "yes"}
    snake = {"MetricName": "metric_name", "SourceArn": "source_arn", "TimeStamp": "time_stamp", "StdDev": "std_dev"}
    metrics = docs.select(F.col("d.TrialComponentArn").alias("component_arn"), F.explode("d.Metrics").alias("m")).select("component_arn", "m.*")
    for old in metrics.columns:
        metrics = metrics.withColumnRenamed(old, snake.get(old, old.lower()))
    got = {r.key_path: r.value for r in ex.metric_rows(metrics, ["component_arn"]).collect()}
    assert len(got) == 9 and got["Metric.loss.max"] == "2.0" and got["Metric.loss.avg"] is None


def test_latest_and_first(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("b", 2, "z")], "k string, v int, w string")
    assert rows(latest_per_key(df, ["k"], [F.col("v")])) == [("a", 3, None), ("b", 2, "z")]
    assert rows(first_per_key(df, ["k"], [F.col("v")])) == [("a", 1, "x"), ("b", 2, "z")]


def test_sink_replaces_only_the_sources_it_is_given(spark, tmp_path):
    path = str(tmp_path / "catalog")

    def write(*pairs):
        write_catalog(spark.createDataFrame(pairs, "source_rn string, name string"), path)

    write(("//a/x", "1"), ("//a/x", "2"), ("//b/y", "1"))
    write(("//a/x", "3"))
    assert rows(read_catalog(spark, path).select("source_rn", "name")) == [("//a/x", "3"), ("//b/y", "1")]


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "y")], "x int, y string")
    assert rows(union_all(a, b)) == [(1, None), (2, "y")]


@pytest.mark.parametrize("files", [1, 3])
def test_refresh(spark, tmp_path, files):
    landing, target, offsets = (str(tmp_path / n) for n in ("landing", "state", "offsets"))
    schema = "id string, v int, seq long"
    order = [F.col("seq")]

    def land(*changes):
        spark.createDataFrame(changes, schema).repartition(files).write.mode("append").parquet(landing)

    def run():
        stream = spark.readStream.schema(schema).parquet(landing)
        refresh(stream, target, offsets, ["id"], order).awaitTermination()
        return rows(current_state(spark, target, ["id"], order).select("id", "v"))

    land(("a", 1, 1), ("a", 2, 2), ("b", 5, 1))
    assert run() == [("a", 2), ("b", 5)]
    land(("a", 9, 1), ("b", 6, 7), ("c", 0, 1))
    # an older change that arrives late does not win
    assert run() == [("a", 2), ("b", 6), ("c", 0)]
    assert run() == [("a", 2), ("b", 6), ("c", 0)]
    assert sorted(os.listdir(target)) == ["batch_id=0", "batch_id=1"]
    compact(spark, target, str(tmp_path / "compacted"), ["id"], order)
    assert rows(current_state(spark, str(tmp_path / "compacted"), ["id"], order).select("id", "v")) == [("a", 2), ("b", 6), ("c", 0)]


def test_reported_statistics_of_glue_columns(spark):
    """Newest report of a column, columns over several documents, documents that name no table."""
    import json

    from bindings.registry import SCOPE
    from metaspark.plans import entities as en

    def doc(column, low, at=None, **more):
        data = {"Type": "LONG", "LongColumnStatisticsData": {"MinimumValue": low, "MaximumValue": 9, "NumberOfNulls": 1, "NumberOfDistinctValues": 2}}
        return json.dumps({"DatabaseName": "d", "TableName": "t", "ColumnStatisticsList": [{"ColumnName": column, "AnalyzedTime": at, "StatisticsData": data}], **more})

    lines = [doc("a", 1), doc("a", 2, "2021-01-01T00:00:00Z"), doc("a", 3, "2020-01-01T00:00:00Z"), doc("b", 4), doc("a", 5, TableName=None), "{", None]
    stats, rejects = en.glue_statistics(spark.createDataFrame([(v,) for v in lines], "value string"), SCOPE)
    assert sorted((r.column_name, r.low_value) for r in stats.collect()) == [("a", "2"), ("b", "4")]
    assert [r.reason for r in rejects.collect()] == ["no table named"] * 3
