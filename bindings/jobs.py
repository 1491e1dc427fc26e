"""Jobs, runs, replication tasks, selection rules and group hierarchies."""

from __future__ import annotations

from pyspark.sql import functions as F

from metaspark.functions.status import task_status as task_status_of
from metaspark.functions.text import job_name
from metaspark.operators import lineage as ln
from metaspark.operators import selection as sel
from metaspark.operators.descent import descend, reach, update
from metaspark.operators.runs import job_runs as join_runs
from metaspark.plans import entities as en
from metaspark.plans.catalog import union_all
from metaspark.sources import dumps

from .registry import SCOPE, aws, dealt_out, doc_lines, entity_sql, query, table, text, landed_docs, wall_clock

# --- jobs and runs ----------------------------------------------------------------------


def _job_docs(spark, sf_dir):
    key = F.col("c_custkey")
    return landed_docs(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
        "glue_job",
        Name=F.col("c_name"),
        Owner=F.when(key % 4 != 0, text("team-", F.col("c_nationkey"))),
        Description=F.col("c_mktsegment"),
        CreatedOn=F.lit("2020-05-05T00:00:00"),
        LastModifiedOn=F.lit("2020-06-06T00:00:00"),
        Command=F.struct(text("s3://code/", key, ".py").alias("ScriptLocation")),
    )


def _run_docs(spark, sf_dir):
    status = F.col("o_orderstatus")
    state = F.when(status == "F", F.lit("SUCCEEDED")).when(status == "P", F.lit("TIMEOUT")).otherwise(F.lit("RUNNING"))
    start = F.col("o_orderdate")
    return landed_docs(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"),
        "glue_run",
        JobName=F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")),
        Id=text("run-", F.col("o_orderkey")),
        JobRunState=state,
        StartedOn=start,
        CompletedOn=F.when(state != "RUNNING", start),
        ErrorMessage=F.col("o_orderpriority"),
    )


def _runs(spark, sf_dir):
    name = F.col("d.Name")
    jobs = _job_docs(spark, sf_dir).select(
        name.alias("job_name"), en.job_rn(SCOPE, name).alias("job_rn"), F.col("d.Owner").alias("owner_rn")
    )
    runs = _run_docs(spark, sf_dir).select(
        F.col("d.JobName").alias("job_name"),
        F.col("d.Id").alias("run_id"),
        F.col("d.JobRunState").alias("state"),
        F.col("d.StartedOn").alias("started_at"),
        F.col("d.CompletedOn").alias("completed_at"),
        F.col("d.ErrorMessage").alias("message"),
    )
    return join_runs(jobs, runs)


_RUNS = f"""
WITH r AS (
  SELECT '{aws("glue")}/jobs/' || c_name AS job_rn, o_orderkey, o_orderstatus, o_orderpriority, o_orderdate,
         CASE WHEN c_custkey % 4 <> 0 THEN 'team-' || c_nationkey END AS owner_rn
  FROM orders JOIN customer ON o_custkey = c_custkey)
"""


@query(
    "job_runs",
    _RUNS
    + """
SELECT job_rn || '/runs/run-' || o_orderkey AS run_rn, 'run-' || o_orderkey AS run_id, job_rn, owner_rn,
       CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'P' THEN 'FAILED' ELSE 'UNKNOWN' END AS status,
       CASE o_orderstatus WHEN 'P' THEN o_orderpriority END AS status_reason, o_orderdate AS start_time,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS end_time
FROM r""",
)
def job_runs(spark, sf_dir):
    return wall_clock(_runs(spark, sf_dir))


@query(
    "job_entities",
    _RUNS.replace("WITH r AS", "WITH j AS (SELECT *, '" + aws("glue") + "/jobs/' || c_name AS rn FROM customer), r AS")
    + entity_sql(
        "FROM j",
        entity_rn="rn",
        source_rn=f"'{aws('glue')}'",
        name="c_name",
        entity_type="'JOB'",
        description="c_mktsegment",
        created_at="TIMESTAMP '2020-05-05'",
        updated_at="TIMESTAMP '2020-06-06'",
        source_code_url="'s3://code/' || c_custkey || '.py'",
    )
    + " UNION ALL "
    + entity_sql(
        "FROM r",
        entity_rn="job_rn || '/runs/run-' || o_orderkey",
        source_rn=f"'{aws('glue')}'",
        name="'run-' || o_orderkey",
        entity_type="'JOB_RUN'",
        owner_rn="owner_rn",
    ),
)
def job_entities(spark, sf_dir):
    jobs = en.job_entities(_job_docs(spark, sf_dir), SCOPE)
    return wall_clock(union_all(jobs, en.run_entities(_runs(spark, sf_dir), SCOPE)))


@query(
    "job_name_parse",
    r"""
WITH n AS (
  SELECT p_partkey, CASE p_partkey % 3
    WHEN 0 THEN 'abc-' || p_partkey || 'a-' || replace(p_name, ' ', '-') || '-2022-aws-training-job'
    WHEN 1 THEN 'pipelines-' || p_partkey || '-' || p_type || '-x-aws-processing-job'
    ELSE replace(p_name, ' ', '-') END AS component FROM part)
SELECT p_partkey, component,
       CASE WHEN regexp_matches(component, '^([a-z]*-[a-z|0-9]*-+)(.*)(-.*-aws-(training|processing)-job)$')
            THEN regexp_extract(component, '^([a-z]*-[a-z|0-9]*-+)(.*)(-.*-aws-(training|processing)-job)$', 2)
            ELSE component END AS name
FROM n""",
)
def job_name_parse(spark, sf_dir):
    key, dashed = F.col("p_partkey"), F.replace("p_name", F.lit(" "), F.lit("-"))
    component = (
        F.when(key % 3 == 0, text("abc-", key, "a-", dashed, "-2022-aws-training-job"))
        .when(key % 3 == 1, text("pipelines-", key, "-", F.col("p_type"), "-x-aws-processing-job"))
        .otherwise(dashed)
    )
    named = table(spark, sf_dir, "part").select("p_partkey", component.alias("component"))
    return named.withColumn("name", job_name(F.col("component")))


# --- replication tasks -------------------------------------------------------------------

_STATES = ["running", "stopped", "failed", "failed-move", "ready", "testing"]


@query(
    "task_status",
    """
SELECT event_id,
       CASE (list_value('running', 'stopped', 'failed', 'failed-move', 'ready', 'testing'))[event_id % 6 + 1]
         WHEN 'running' THEN 'RUNNING' WHEN 'stopped' THEN 'ABORTED' WHEN 'failed' THEN 'FAILED'
         WHEN 'failed-move' THEN 'BROKEN' ELSE 'UNKNOWN' END AS status
FROM events""",
)
def task_status(spark, sf_dir):
    state = F.element_at(F.array(*[F.lit(s) for s in _STATES]), (F.col("event_id") % 6).cast("int") + 1)
    return table(spark, sf_dir, "events").select("event_id", task_status_of(state).alias("status"))


_ENGINE_OF_TYPE = {
    "STANDARD": "sqlserver", "PROMO": "mysql", "SMALL": "postgres", "LARGE": "mariadb", "ECONOMY": "mongodb",
    "MEDIUM": "oracle",
}


def _endpoints(spark, sf_dir):
    """Parts are server endpoints (one kind of engine is unknown), suppliers are buckets."""
    engine = F.col("p_type")
    settings = {
        key: F.when(
            F.col("engine") == name,
            F.struct(text("h", F.col("p_size")).alias("ServerName"), F.col("p_brand").alias("DatabaseName")),
        )
        for name, key in [
            ("sqlserver", "MicrosoftSQLServerSettings"), ("postgres", "PostgreSQLSettings"), ("mongodb", "MongoDbSettings"),
        ]
    }
    settings["MySQLSettings"] = F.when(
        F.col("engine").isin("mysql", "mariadb"),
        F.struct(text("h", F.col("p_size")).alias("ServerName"), F.col("p_brand").alias("DatabaseName")),
    )
    names_of = F.create_map(*[F.lit(x) for kv in _ENGINE_OF_TYPE.items() for x in kv])
    servers = dealt_out(table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_brand")).withColumn("engine", F.element_at(names_of, engine))
    server_lines = doc_lines(
        servers, EndpointArn=text("arn:src:", F.col("p_partkey")), EngineName=F.col("engine"), **settings
    )
    bucket_lines = doc_lines(
        dealt_out(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")),
        EndpointArn=text("arn:dst:", F.col("s_suppkey")),
        EngineName=F.lit("s3"),
        S3Settings=F.struct(
            text("b", F.col("s_nationkey")).alias("BucketName"), text("f", F.col("s_suppkey")).alias("BucketFolder")
        ),
    )
    docs, _ = dumps.parse_docs(server_lines.unionByName(bucket_lines), "endpoint")
    server = F.coalesce(
        "d.MicrosoftSQLServerSettings", "d.MySQLSettings", "d.PostgreSQLSettings", "d.MongoDbSettings"
    )
    return ln.endpoint_sources(
        docs.select(
            F.col("d.EndpointArn").alias("endpoint_arn"),
            F.col("d.EngineName").alias("engine_name"),
            server["ServerName"].alias("server_name"),
            server["DatabaseName"].alias("database_name"),
            F.col("d.S3Settings.BucketName").alias("bucket_name"),
            F.col("d.S3Settings.BucketFolder").alias("bucket_folder"),
        )
    )


@query(
    "task_endpoints",
    """
WITH t AS (
  SELECT l_orderkey || '-' || l_linenumber AS task_id, l_partkey + CASE WHEN l_partkey % 10 = 0 THEN 100000000 ELSE 0 END AS src,
         l_suppkey AS dst FROM lineitem),
p AS (
  SELECT *, CASE p_type WHEN 'STANDARD' THEN 'sqlserver' WHEN 'PROMO' THEN 'mysql' WHEN 'SMALL' THEN 'postgres'
                        WHEN 'LARGE' THEN 'mariadb' WHEN 'ECONOMY' THEN 'mongodb' ELSE 'oracle' END AS engine FROM part)
SELECT task_id, engine AS source_engine, CASE WHEN s_suppkey IS NOT NULL THEN 's3' END AS target_engine,
       CASE engine WHEN 'sqlserver' THEN '//mssql' WHEN 'mysql' THEN '//mysql' WHEN 'mariadb' THEN '//mysql'
            WHEN 'postgres' THEN '//postgresql' WHEN 'mongodb' THEN '//mongodb' END || '/host/h' || p_size || '/databases/' || p_brand
         || '/schemas/A/' || CASE engine WHEN 'mongodb' THEN 'collections' ELSE 'tables' END || '/t' AS input_rn,
       '//s3/cloud/aws/buckets/b' || s_nationkey || '/keys/f' || s_suppkey || '\\A\\t' AS output_rn
FROM t LEFT JOIN p ON src = p_partkey LEFT JOIN supplier ON dst = s_suppkey""".replace("\\\\", "\\"),
)
def task_endpoints(spark, sf_dir):
    """Every line item is a task between a part's server and a supplier's bucket; a tenth
    of the tasks name an endpoint that does not exist."""
    missing = F.when(F.col("l_partkey") % 10 == 0, F.lit(100000000)).otherwise(F.lit(0))
    tasks = table(spark, sf_dir, "lineitem").select(
        text(F.col("l_orderkey"), "-", F.col("l_linenumber")).alias("task_id"),
        text("arn:src:", F.col("l_partkey") + missing).alias("source_endpoint_arn"),
        text("arn:dst:", F.col("l_suppkey")).alias("target_endpoint_arn"),
    )
    joined = ln.tasks_with_endpoints(tasks, _endpoints(spark, sf_dir))

    def table_rn(side):
        return ln.endpoint_table_name(
            F.col(f"{side}_database_rn"), F.col(f"{side}_engine_name"), F.lit("A"), F.lit("t")
        )

    return joined.select(
        "task_id",
        F.col("source_engine_name").alias("source_engine"),
        F.col("target_engine_name").alias("target_engine"),
        table_rn("source").alias("input_rn"),
        table_rn("target").alias("output_rn"),
    )


def _rule(kind, schema, name, action):
    locator = F.struct(schema.alias("schema-name"), name.alias("table-name"))
    return F.struct(
        F.lit(kind).alias("rule-type"), F.lit("1").alias("rule-id"), F.lit("n").alias("rule-name"),
        locator.alias("object-locator"), F.lit(action).alias("rule-action"),
    )


def _replication_tasks(spark, sf_dir):
    """One task per supplier, eight different rule sets; its database holds twenty parts."""
    key = F.col("s_suppkey")
    brand, other = text("Brand#", key % 25 + 1), text("Brand#", (key + 7) % 25 + 1)
    any_, ring = F.lit("%"), F.lit("red widget")
    sets = [
        [("selection", any_, any_, "include"), ("selection", brand, any_, "exclude"), ("selection", any_, ring, "exclude")],
        [("selection", brand, any_, "include"), ("selection", brand, ring, "include"), ("selection", other, any_, "include")],
        [("selection", any_, ring, "include"), ("selection", other, F.lit("blue bolt"), "include")],
        [("selection", any_, ring, "exclude")],
        [("selection", F.lit("Z"), F.lit("z"), "include")],
        [("selection", brand, any_, "include"), ("selection", brand, any_, "exclude")],
        [("selection", F.lit("1%"), F.lit("2"), "exclude"), ("selection", any_, any_, "explicit")],
        [("transformation", any_, any_, "rename")],
    ]
    rules = None
    for i, members in enumerate(sets):
        document = F.to_json(F.struct(F.array(*[_rule(*m) for m in members]).alias("rules")))
        rules = (F if rules is None else rules).when(key % 8 == i, document)
    return landed_docs(
        table(spark, sf_dir, "supplier").select("s_suppkey"),
        "task",
        ReplicationTaskIdentifier=text("task-", key),
        SourceEndpointArn=text("arn:db:", key),
        TableMappings=rules,
        Status=F.lit("running"),
        MigrationType=F.lit("full-load"),
        ReplicationTaskCreationDate=F.lit("2022-09-24T00:00:00"),
    )


_SELECTION = """
WITH tabs AS (
  SELECT DISTINCT p_partkey // 20 AS db, p_brand AS schema_name, p_name AS table_name FROM part),
rules(shape, schema_kind, table_kind, include) AS (VALUES
  (0, '%', '%', TRUE), (0, 'brand', '%', FALSE), (0, '%', 'red widget', FALSE),
  (1, 'brand', '%', TRUE), (1, 'brand', 'red widget', TRUE), (1, 'other', '%', TRUE),
  (2, '%', 'red widget', TRUE), (2, 'other', 'blue bolt', TRUE),
  (3, '%', 'red widget', FALSE), (4, 'Z', 'z', TRUE), (5, 'brand', '%', TRUE), (5, 'brand', '%', FALSE),
  (6, '1%', '2', FALSE), (6, '%', '%', TRUE)),
task_rules AS (
  SELECT s_suppkey, include,
         CASE schema_kind WHEN 'brand' THEN 'Brand#' || (s_suppkey % 25 + 1)
              WHEN 'other' THEN 'Brand#' || ((s_suppkey + 7) % 25 + 1) ELSE schema_kind END AS s, table_kind AS t
  FROM supplier JOIN rules ON s_suppkey % 8 = shape),
matched AS (
  SELECT DISTINCT s_suppkey, include, schema_name, table_name
  FROM task_rules JOIN tabs ON db = s_suppkey AND (s = '%' OR s = schema_name) AND (t = '%' OR t = table_name)),
chosen AS (
  SELECT s_suppkey, schema_name, table_name FROM supplier JOIN tabs ON db = s_suppkey
  WHERE (s_suppkey NOT IN (SELECT s_suppkey FROM matched WHERE include)
         OR (s_suppkey, schema_name, table_name) IN (SELECT s_suppkey, schema_name, table_name FROM matched WHERE include))
    AND (s_suppkey, schema_name, table_name) NOT IN (SELECT s_suppkey, schema_name, table_name FROM matched WHERE NOT include))
"""


def _selected(spark, sf_dir):
    docs = _replication_tasks(spark, sf_dir)
    database = F.split_part("d.SourceEndpointArn", F.lit(":"), F.lit(3))
    tasks, _ = sel.parse_rules(
        docs.select(
            F.col("d.ReplicationTaskIdentifier").alias("task_id"),
            text("db-", database).alias("database_rn"),
            F.col("d.TableMappings").alias("table_mappings"),
        )
    )
    tasks = tasks.drop("table_mappings")
    tables = (
        table(spark, sf_dir, "part")
        .select(
            text("db-", F.floor(F.col("p_partkey") / 20)).alias("database_rn"),
            F.col("p_brand").alias("schema_name"),
            F.col("p_name").alias("table_name"),
        )
        .distinct()
    )
    return sel.select_tables(tasks, tables)


@query(
    "selection_rules",
    _SELECTION
    + "SELECT 'task-' || s_suppkey AS task_id, 'db-' || s_suppkey AS database_rn, schema_name, table_name FROM chosen",
)
def selection_rules(spark, sf_dir):
    return _selected(spark, sf_dir)


@query(
    "task_inputs",
    _SELECTION
    + f"""
SELECT '{aws("dms")}/tasks/task-' || s_suppkey AS via_rn,
       'db-' || s_suppkey || '/schemas/' || schema_name || '/tables/' || table_name AS other_rn, 'input' AS role
FROM chosen""",
)
def task_inputs(spark, sf_dir):
    """Input edges of the replication tasks: the selected tables by their full name."""
    selected = _selected(spark, sf_dir)
    task = F.concat_ws("/", SCOPE.source("dms"), F.lit("tasks"), "task_id")
    name = ln.endpoint_table_name(
        F.col("database_rn"), F.lit("postgres"), F.col("schema_name"), F.col("table_name")
    )
    return ln.edges(selected, task, name, "input")


@query(
    "task_entities",
    entity_sql(
        "FROM supplier",
        entity_rn=f"'{aws('dms')}/tasks/task-' || s_suppkey",
        source_rn=f"'{aws('dms')}'",
        name="'task-' || s_suppkey",
        entity_type="'JOB'",
        created_at="TIMESTAMP '2022-09-24'",
    ),
)
def task_entities(spark, sf_dir):
    return wall_clock(en.task_entities(_replication_tasks(spark, sf_dir), SCOPE))


# --- group hierarchy ------------------------------------------------------------------------


def _members(spark, sf_dir):
    """world -> region -> nation -> customer; one nation points back at its region (a
    cycle) and every nation has a view, which is no table."""

    def edges(source, parent, child, kind):
        return source.select(parent.alias("group_rn"), child.alias("member_rn"), F.lit(kind).alias("member_type"))

    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    region_of = text("region/", F.col("n_regionkey"))
    nation_of = text("nation/", F.col("n_nationkey"))
    return union_all(
        edges(table(spark, sf_dir, "region"), F.lit("world"), text("region/", F.col("r_regionkey")), "DATABASE_SERVICE"),
        edges(nation, region_of, nation_of, "DATABASE_SERVICE"),
        edges(nation.filter(F.col("n_name") == "NATION_0"), nation_of, region_of, "DATABASE_SERVICE"),
        edges(nation, nation_of, text("view/", F.col("n_nationkey")), "VIEW"),
        edges(customer, text("nation/", F.col("c_nationkey")), text("customer/", F.col("c_custkey")), "TABLE"),
    )


def _roots(spark, sf_dir):
    """The descent starts from the regions."""
    return table(spark, sf_dir, "region").select(text("region/", F.col("r_regionkey")).alias("group_rn"))


_MEMBERS = """
WITH RECURSIVE m AS (
  SELECT 'world' AS g, 'region/' || r_regionkey AS c, 'G' AS k FROM region
  UNION ALL SELECT 'region/' || n_regionkey, 'nation/' || n_nationkey, 'G' FROM nation
  UNION ALL SELECT 'nation/' || n_nationkey, 'region/' || n_regionkey, 'G' FROM nation WHERE n_name = 'NATION_0'
  UNION ALL SELECT 'nation/' || c_nationkey, 'customer/' || c_custkey, 'T' FROM customer
  UNION ALL SELECT 'nation/' || n_nationkey, 'view/' || n_nationkey, 'V' FROM nation),
d AS (
  SELECT g AS root, c, k, 1 AS depth, [g] AS seen FROM m WHERE starts_with(g, 'region/')
  UNION ALL SELECT root, m.c, m.k, depth + 1, list_append(seen, m.g) FROM d JOIN m ON d.c = m.g
  WHERE d.k = 'G' AND NOT list_contains(seen, d.c))
"""


@query(
    "group_descent",
    _MEMBERS
    + "SELECT root AS root_rn, c AS table_rn, CAST(min(depth) AS INTEGER) AS depth FROM d WHERE k = 'T' GROUP BY ALL",
)
def group_descent(spark, sf_dir):
    tables, _ = descend(_members(spark, sf_dir), _roots(spark, sf_dir))
    return tables


@query(
    "group_rejects",
    _MEMBERS + "SELECT DISTINCT 'descent' AS job, c AS \"key\", 'not a table or group: VIEW' AS reason FROM d WHERE k = 'V'",
)
def group_rejects(spark, sf_dir):
    _, rejects = descend(_members(spark, sf_dir), _roots(spark, sf_dir))
    return rejects


@query(
    "group_descent_update",
    _MEMBERS.replace("FROM m WHERE starts_with(g, 'region/')", "FROM m")
    + "SELECT root AS root_rn, c AS table_rn, CAST(min(depth) AS INTEGER) AS depth FROM d WHERE k = 'T' GROUP BY ALL",
)
def group_descent_update(spark, sf_dir):
    """Tables below every group, kept current: the customers of three nations come after the first descent."""
    after = _members(spark, sf_dir)
    late = F.col("group_rn").isin("nation/3", "nation/8", "nation/21") & F.col("member_rn").startswith("customer/")
    before = after.filter(~late)
    tables, _, groups = reach(before)
    tables, _, _ = update(tables, groups, before, after)
    return tables
