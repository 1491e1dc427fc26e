"""Metadata of further kinds, rejected documents, replication lineage end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from metaspark.functions.text import iso_text
from metaspark.operators import experiments as ex
from metaspark.operators import lineage as ln
from metaspark.operators import metadata_kv as kv
from metaspark.operators import selection as sel
from metaspark.operators.descent import descend
from metaspark.operators.joins import by_key
from metaspark.plans import entities as en
from metaspark.plans.catalog import union_all
from metaspark.session import cut_lineage
from metaspark.sources import dumps

from . import consumers, jobs
from .registry import SCOPE, aws, doc_lines, landed_docs, query, table, text

_GLUE, _BI, _ML = aws("glue"), aws("quicksight"), aws("sagemaker")


@query(
    "metadata_kinds",
    f"""
SELECT 'glue_job' AS kind, '{_GLUE}/jobs/' || c_name AS entity_rn, key_path, value FROM (
  SELECT c_name, 'owner' AS key_path, 'team-' || c_nationkey AS value FROM customer WHERE c_custkey % 4 <> 0
  UNION ALL SELECT c_name, 'created_on', '2020-05-05T00:00:00' FROM customer
  UNION ALL SELECT c_name, 'last_modified_on', '2020-06-06T00:00:00' FROM customer)
UNION ALL SELECT 'glue_run', 'run-' || o_orderkey, 'job_name', 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') FROM orders
UNION ALL SELECT 'bi_dataset', 'ds-' || p_partkey, key_path, value FROM (
  SELECT p_partkey, 'data_set_id' AS key_path, 'ds-' || p_partkey AS value FROM part
  UNION ALL SELECT p_partkey, 'physical_table_map.pt.relational_table.data_source_arn', 'arn:aws:bi:eu:1:datasource/src-' || p_partkey // 20 FROM part
  UNION ALL SELECT p_partkey, 'physical_table_map.pt.relational_table.catalog', p_type FROM part
  UNION ALL SELECT p_partkey, 'physical_table_map.pt.relational_table.schema', p_brand FROM part
  UNION ALL SELECT p_partkey, 'physical_table_map.pt.relational_table.name', p_name FROM part)
UNION ALL SELECT 'bi_dashboard', 'dash ' || doc_id, 'dashboard_id', 'id-' || doc_id FROM documents
UNION ALL SELECT 'bi_analysis', 'an-' || doc_id, 'analysis_id', 'an-' || doc_id FROM documents
UNION ALL SELECT 'experiment', 'exp-' || c_custkey, key_path, value FROM (
  SELECT c_custkey, 'ExperimentArn' AS key_path, 'arn:aws:sm:eu:1:experiment/' || c_custkey AS value FROM customer
  UNION ALL SELECT c_custkey, 'CreationTime', '2021-01-01T00:00:00' FROM customer
  UNION ALL SELECT c_custkey, 'LastModifiedTime', '2021-01-02T00:00:00' FROM customer)
UNION ALL SELECT 'trial', 'trial-' || o_orderkey, 'TrialArn', 'arn:aws:sm:eu:1:experiment-trial/' || o_orderkey FROM orders""",
)
def metadata_kinds(spark, sf_dir):
    """Metadata rows of jobs, runs, BI kinds, experiments and trials, by each kind's rules."""

    def rows(kind, docs, name, keys=None):
        found = kv.metadata_of(docs.select(name.alias("entity_rn"), "doc"), kind)
        if keys:
            found = found.filter(F.col("key_path").isin(keys))
        return found.select(F.lit(kind).alias("kind"), "entity_rn", "key_path", "value")

    bi = {
        "bi_dataset": (consumers._dataset_docs, "d.DataSetId", None),
        "bi_dashboard": (consumers._dashboard_docs, "d.Name", ["dashboard_id"]),
        "bi_analysis": (consumers._analysis_docs, "d.AnalysisId", ["analysis_id"]),
    }
    return union_all(
        rows("glue_job", jobs._job_docs(spark, sf_dir), en.job_rn(SCOPE, F.col("d.Name"))),
        rows("glue_run", jobs._run_docs(spark, sf_dir), F.col("d.Id")),
        *[rows(kind, docs(spark, sf_dir), F.col(name), keys) for kind, (docs, name, keys) in bi.items()],
        rows("experiment", consumers._experiment_docs(spark, sf_dir), F.col("d.ExperimentName"),
             ["ExperimentArn", "CreationTime", "LastModifiedTime"]),
        rows("trial", consumers._trial_docs(spark, sf_dir), F.col("d.TrialName"), ["TrialArn"]),
    )


@query(
    "document_rejects",
    """
WITH k AS (SELECT c_custkey, c_custkey % 5 AS t, 'c' || c_custkey AS name FROM customer)
SELECT 'glue_table' AS job, key, reason FROM (
  SELECT 'not json ' || c_custkey AS key, 'no page with TableList' AS reason FROM k WHERE t = 1
  UNION ALL SELECT '{"Other":[' || c_custkey || ']}', 'no page with TableList' FROM k WHERE t = 2
  UNION ALL SELECT '{"CreateTime":{},"Name":"' || name || '"}', 'not a document of this kind' FROM k WHERE t = 3)""",
)
def document_rejects(spark, sf_dir):
    """Pages of table documents, of which three fifths are broken in three ways."""
    key, name = F.col("c_custkey"), text("c", F.col("c_custkey"))
    kind = key % 5
    page = (
        F.when(kind == 1, text("not json ", key))
        .when(kind == 2, text('{"Other":[', key, "]}"))
        .when(kind == 3, text('{"TableList":[{"CreateTime":{},"Name":"', name, '"}]}'))
        .otherwise(text('{"TableList":[{"Name":"', name, '"}]}'))
    )
    items, pages = dumps.open_pages(table(spark, sf_dir, "customer").select(page.alias("value")), "glue_table")
    _, documents = dumps.parse_docs(items, "glue_table")
    return pages.unionByName(documents)


def _replication(spark, sf_dir):
    """Tasks with both endpoints: sources are servers of two engines, targets buckets."""
    key = F.col("s_suppkey")
    server = F.struct(text("h", key).alias("ServerName"), text("d", key).alias("DatabaseName"))
    docs = landed_docs(
        table(spark, sf_dir, "supplier").select("s_suppkey"),
        "endpoint",
        EndpointArn=text("arn:db:", key),
        EngineName=F.when(key % 2 == 0, F.lit("postgres")).otherwise(F.lit("mysql")),
        PostgreSQLSettings=F.when(key % 2 == 0, server),
        MySQLSettings=F.when(key % 2 == 1, server),
    )
    known = F.coalesce("d.PostgreSQLSettings", "d.MySQLSettings")
    servers = ln.endpoint_sources(docs.select(
        F.col("d.EndpointArn").alias("endpoint_arn"), F.col("d.EngineName").alias("engine_name"),
        known["ServerName"].alias("server_name"), known["DatabaseName"].alias("database_name"),
        F.lit(None).cast("string").alias("bucket_name"), F.lit(None).cast("string").alias("bucket_folder"),
    ))
    buckets = jobs._endpoints(spark, sf_dir).filter(F.col("engine_name") == "s3")
    documents = jobs._replication_tasks(spark, sf_dir)
    tasks = documents.select(
        F.col("d.ReplicationTaskIdentifier").alias("task_id"),
        F.col("d.SourceEndpointArn").alias("source_endpoint_arn"),
        F.regexp_replace("d.SourceEndpointArn", "arn:db:", "arn:dst:").alias("target_endpoint_arn"),
        F.col("d.TableMappings").alias("table_mappings"),
    )
    return ln.tasks_with_endpoints(tasks, servers.unionByName(buckets))


_SOURCE = (
    "CASE s_suppkey % 2 WHEN 0 THEN '//postgresql' ELSE '//mysql' END || '/host/h' || s_suppkey || '/databases/d' || s_suppkey"
)


@query(
    "task_lineage",
    jobs._SELECTION
    + f"""
SELECT '{aws("dms")}/tasks/task-' || s_suppkey AS via_rn,
       {_SOURCE} || '/schemas/' || schema_name || '/tables/' || table_name AS other_rn, 'input' AS role FROM chosen
UNION ALL
SELECT '{aws("dms")}/tasks/task-' || s_suppkey,
       '//s3/cloud/aws/buckets/b' || s_nationkey || '/keys/f' || s_suppkey || chr(92) || schema_name || chr(92) || table_name, 'output'
FROM chosen JOIN supplier USING (s_suppkey)""",
)
def task_lineage(spark, sf_dir):
    """Task -> endpoint -> tables below its database -> selection rules -> inputs and outputs."""
    joined = cut_lineage(_replication(spark, sf_dir))  # read five times below
    tasks, _ = sel.parse_rules(joined.withColumn("database_rn", F.col("source_database_rn")))
    parts = table(spark, sf_dir, "part").select(
        text("arn:db:", F.floor(F.col("p_partkey") / 20)).alias("source_endpoint_arn"),
        F.col("p_brand").alias("schema_name"), F.col("p_name").alias("table_name"),
    ).distinct()
    placed = parts.join(by_key(joined.select("source_endpoint_arn", "source_database_rn").distinct()), "source_endpoint_arn")
    schema_rn = F.concat_ws("/", "source_database_rn", F.lit("schemas"), "schema_name")
    placed = placed.withColumn("schema_rn", schema_rn).withColumn("table_rn", F.concat_ws("/", "schema_rn", F.lit("tables"), "table_name"))
    members = union_all(
        placed.select(F.col("source_database_rn").alias("group_rn"), F.col("schema_rn").alias("member_rn"),
                      F.lit("DATABASE_SERVICE").alias("member_type")).distinct(),
        placed.select(F.col("schema_rn").alias("group_rn"), F.col("table_rn").alias("member_rn"), F.lit("TABLE").alias("member_type")),
    )
    below, _ = descend(members, tasks.select(F.col("database_rn").alias("group_rn")))
    found = below.join(by_key(placed.select("table_rn", "schema_name", "table_name")), "table_rn")
    tables = found.select(F.col("root_rn").alias("database_rn"), "schema_name", "table_name")
    chosen = sel.select_tables(tasks.select("task_id", "database_rn", "rules"), tables)
    ends = ["source_engine_name", "target_engine_name", "target_database_rn"]
    chosen = chosen.join(by_key(joined.select("task_id", *ends)), "task_id")
    task = F.concat_ws("/", SCOPE.source("dms"), F.lit("tasks"), "task_id")
    names = F.col("schema_name"), F.col("table_name")
    source = ln.endpoint_table_name(F.col("database_rn"), F.col("source_engine_name"), *names)
    target = ln.endpoint_table_name(F.col("target_database_rn"), F.col("target_engine_name"), *names)
    return ln.edges(chosen, task, source, "input").unionByName(ln.edges(chosen, task, target, "output"))


@query(
    "component_metrics",
    """
SELECT 'c' || o_orderkey AS component, 'Metric.total.' || a AS key_path, v AS value FROM (
  SELECT o_orderkey, 'metric_name' AS a, 'total' AS v FROM orders
  UNION ALL SELECT o_orderkey, 'source_arn', 'arn:' || o_custkey FROM orders
  UNION ALL SELECT o_orderkey, 'time_stamp', '2022-01-01 00:00:00' FROM orders
  UNION ALL SELECT o_orderkey, 'count', CAST(o_custkey AS DOUBLE)::VARCHAR FROM orders
  UNION ALL SELECT o_orderkey, unnest(['max', 'min', 'last', 'avg', 'std_dev']), NULL FROM orders)""",
)
def component_metrics(spark, sf_dir):
    """The metrics that component documents themselves hold."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    metric = F.struct(
        F.lit("total").alias("MetricName"), text("arn:", F.col("o_custkey")).alias("SourceArn"),
        F.lit("2022-01-01T00:00:00").alias("TimeStamp"), F.col("o_custkey").alias("Count"),
    )
    docs, _ = dumps.parse_docs(
        doc_lines(rows, TrialComponentName=text("c", F.col("o_orderkey")), Metrics=F.array(metric)), "trial_component"
    )
    opened = docs.select(F.col("d.TrialComponentName").alias("component"), F.explode("d.Metrics").alias("m"))
    names = ["MetricName", "SourceArn", "TimeStamp", "Max", "Min", "Last", "Count", "Avg", "StdDev"]
    labels = ["metric_name", "source_arn", "time_stamp", "max", "min", "last", "count", "avg", "std_dev"]
    return ex.metric_rows(opened.select("component", *[F.col(f"m.{n}").alias(a) for n, a in zip(names, labels)]), ["component"])


_CHOSEN = ["exp-1", "exp-2", "exp-5", "no such experiment"]


@query(
    "experiment_list",
    f"""
SELECT DISTINCT 'exp-' || o_custkey AS experiment_name, 'trial-' || o_orderkey AS trial_name,
       'arn:aws:sm:eu:1:experiment-trial-component/' || l_orderkey || '-' || l_linenumber AS component_arn
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
WHERE 'exp-' || o_custkey IN ({", ".join(repr(n) for n in _CHOSEN)})""",
)
def experiment_list(spark, sf_dir):
    """Components of the experiments on a name list."""
    name = F.col("d.ExperimentName")
    experiments = consumers._experiment_docs(spark, sf_dir).select(name.alias("experiment_name"))
    trials = consumers._trial_docs(spark, sf_dir).select(F.col("d.TrialName").alias("trial_name"), name.alias("experiment_name"))
    components = consumers._component_docs(spark, sf_dir).select(
        F.col("d.TrialComponentArn").alias("component_arn"), F.col("d.TrialName").alias("trial_name")
    )
    return ex.experiment_tree(experiments, trials, components, _CHOSEN).distinct()


@query(
    "iso_times",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS at FROM events",
)
def iso_times(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", iso_text(F.col("ts")).alias("at"))


@query(
    "task_metadata",
    """
WITH t AS (SELECT s_suppkey, '//task/' || s_suppkey AS entity_rn FROM supplier)
SELECT entity_rn, 'dms.json#/definitions/DMS' AS schema_url, key_path, value FROM (
  SELECT entity_rn, 'MigrationType' AS key_path, CASE s_suppkey % 2 WHEN 0 THEN 'cdc' ELSE 'full-load' END AS value FROM t
  UNION ALL SELECT entity_rn, 'TableMappings', '{"rules":[' || s_suppkey || ']}' FROM t
  UNION ALL SELECT entity_rn, 'Status', 'stopped' FROM t
  UNION ALL SELECT entity_rn, 'StopReason', 'Stop Reason ' || s_suppkey FROM t WHERE s_suppkey % 3 = 0
  UNION ALL SELECT entity_rn, 'ReplicationTaskCreationDate', '2022-09-24T00:00:00' FROM t
  UNION ALL SELECT entity_rn, 'ReplicationTaskStartDate', '2022-09-25T00:00:00' FROM t)""",
)
def task_metadata(spark, sf_dir):
    """Documents of replication tasks: of their nine keys the six that are kept, as far as a task has them."""
    key = F.col("s_suppkey")
    docs = table(spark, sf_dir, "supplier").select(
        text("//task/", key).alias("entity_rn"),
        F.parse_json(F.to_json(F.struct(
            F.when(key % 2 == 0, F.lit("cdc")).otherwise(F.lit("full-load")).alias("MigrationType"),
            text('{"rules":[', key, "]}").alias("TableMappings"),
            F.lit("stopped").alias("Status"),
            F.when(key % 3 == 0, text("Stop Reason ", key)).alias("StopReason"),
            F.lit("2022-09-24T00:00:00").alias("ReplicationTaskCreationDate"),
            F.lit("2022-09-25T00:00:00").alias("ReplicationTaskStartDate"),
            text("arn:task:", key).alias("ReplicationTaskArn"),
            F.struct(F.lit(7).alias("TablesLoaded"), F.lit("nested").alias("Status")).alias("ReplicationTaskStats"),
            F.lit("i-1").alias("ReplicationInstanceArn"),
        ))).alias("doc"),
    )
    return kv.metadata_of(docs, "task")
