"""BI datasets, dashboards, experiments and lineage edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from metaspark.operators import experiments as ex
from metaspark.operators import lineage as ln
from metaspark.plans import entities as en
from metaspark.plans.catalog import union_all
from metaspark.sources import dumps

from .registry import SCOPE, aws, dealt_out, doc_lines, entity_sql, query, table, text, landed_docs, wall_clock

# --- BI --------------------------------------------------------------------------------------

_SOURCE_TYPES = ["S3", "ATHENA", "POSTGRESQL", "MYSQL", "SNOWFLAKE", "TWITTER"]


def _dataset_docs(spark, sf_dir):
    key = F.col("p_partkey")
    relational = F.struct(
        text("arn:aws:bi:eu:1:datasource/src-", F.floor(key / 20)).alias("DataSourceArn"),
        F.col("p_type").alias("Catalog"),
        F.col("p_brand").alias("Schema"),
        F.col("p_name").alias("Name"),
    )
    kinds = F.array(*[F.lit(t) for t in ("INTEGER", "DECIMAL", "STRING", "DATETIME")])
    return landed_docs(
        table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type"),
        "bi_dataset",
        DataSetId=text("ds-", key),
        Name=F.col("p_name"),
        CreatedTime=F.lit("2022-01-01T00:00:00"),
        LastUpdatedTime=F.lit("2022-02-02T00:00:00"),
        OutputColumns=F.array(
            F.struct(
                F.col("p_brand").alias("Name"), F.element_at(kinds, (key % 4).cast("int") + 1).alias("Type"),
                F.col("p_type").alias("Description"),
            )
        ),
        PhysicalTableMap=F.create_map(F.lit("pt"), F.create_map(F.lit("RelationalTable"), relational)),
    )


def _source_docs(spark, sf_dir):
    """Suppliers are data sources of six types, the last of which is not traced."""
    key = F.col("s_suppkey")
    host = text("h", F.col("s_nationkey"), ".example")
    database = text("d", key)
    server = F.struct(host.alias("Host"), F.lit(5432).alias("Port"), database.alias("Database"))
    kind = F.element_at(F.array(*[F.lit(t) for t in _SOURCE_TYPES]), (key % 6).cast("int") + 1)
    return landed_docs(
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"),
        "bi_source",
        DataSourceId=text("src-", key),
        Type=kind,
        DataSourceParameters=F.struct(
            F.when(
                kind == "S3",
                F.struct(F.struct(text("b", key).alias("Bucket"), F.lit("m.json").alias("Key")).alias("ManifestFileLocation")),
            ).alias("S3Parameters"),
            F.when(kind == "POSTGRESQL", server).alias("PostgreSqlParameters"),
            F.when(kind == "MYSQL", server).alias("MySqlParameters"),
            F.when(
                kind == "SNOWFLAKE",
                F.struct(host.alias("Host"), database.alias("Database"), F.lit("w").alias("Warehouse")),
            ).alias("SnowflakeParameters"),
        ),
    )


_UPSTREAM = f"""
WITH u AS (
  SELECT p_partkey, s_suppkey, CASE s_suppkey % 6
    WHEN 0 THEN '//s3/cloud/aws/account/000000000000/region/eu-x/bucket/b' || s_suppkey || '/key/m.json'
    WHEN 1 THEN '{aws("athena")}/catalogs/' || p_type || '/databases/' || p_brand || '/tables/' || p_name
    WHEN 2 THEN '//postgresql/host/h' || s_nationkey || '.example:5432/databases/d' || s_suppkey
    WHEN 3 THEN '//mysql/host/h' || s_nationkey || '.example:5432/databases/d' || s_suppkey
    WHEN 4 THEN '//snowflake/host/h' || s_nationkey || '.example/warehouses/w/databases/d' || s_suppkey
    ELSE '' END AS upstream_rn
  FROM part JOIN supplier ON s_suppkey = p_partkey // 20)
"""


@query(
    "datasource_dispatch",
    _UPSTREAM + "SELECT 'ds-' || p_partkey AS dataset_id, 'src-' || s_suppkey AS source_id, upstream_rn FROM u",
)
def datasource_dispatch(spark, sf_dir):
    datasets = _dataset_docs(spark, sf_dir).select(
        F.col("d.DataSetId").alias("dataset_id"), F.col("d.PhysicalTableMap").alias("physical_tables")
    )
    return ln.dataset_upstreams(datasets, en.bi_sources(_source_docs(spark, sf_dir)), SCOPE.account, SCOPE.region)


@query(
    "bi_dataset_inputs",
    _UPSTREAM
    + f"""
SELECT DISTINCT '{aws("quicksight")}/datasets/ds-' || p_partkey AS via_rn, upstream_rn AS other_rn, 'input' AS role
FROM u WHERE upstream_rn <> ''""",
)
def bi_dataset_inputs(spark, sf_dir):
    return en.bi_dataset_inputs(_dataset_docs(spark, sf_dir), _source_docs(spark, sf_dir), SCOPE)


@query(
    "bi_dataset_fields",
    f"""
SELECT '{aws("quicksight")}/datasets/ds-' || p_partkey || '/columns/' || p_brand AS field_rn, p_brand AS name,
       (list_value('INTEGER', 'NUMBER', 'STRING', 'DATETIME'))[p_partkey % 4 + 1] AS type,
       (list_value('INTEGER', 'DECIMAL', 'STRING', 'DATETIME'))[p_partkey % 4 + 1] AS logical_type,
       TRUE AS is_nullable, p_type AS description
FROM part""",
)
def bi_dataset_fields(spark, sf_dir):
    fields = en.bi_dataset_fields(_dataset_docs(spark, sf_dir), SCOPE)
    return fields.select("field_rn", "name", "type", "logical_type", "is_nullable", "description")


def _report_rows(spark, sf_dir):
    key = F.col("doc_id")
    arns = F.array(
        *[text("arn:aws:bi:eu:1:dataset/ds-", (key * m + a) % 1000) for m, a in ((1, 0), (7, 3), (1, 0))]
    )
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), arns


def _dashboard_docs(spark, sf_dir):
    rows, arns = _report_rows(spark, sf_dir)
    return landed_docs(
        rows,
        "bi_dashboard",
        DashboardId=text("id-", F.col("doc_id")),
        Name=text("dash ", F.col("doc_id")),
        CreatedTime=F.lit("2022-03-03T00:00:00"),
        LastPublishedTime=F.lit("2022-04-04T00:00:00"),
        Version=F.struct(arns.alias("DataSetArns")),
    )


def _analysis_docs(spark, sf_dir):
    rows, arns = _report_rows(spark, sf_dir)
    return landed_docs(
        rows,
        "bi_analysis",
        AnalysisId=text("an-", F.col("doc_id")),
        Name=text("analysis ", F.col("lang")),
        CreatedTime=F.lit("2022-05-05T00:00:00"),
        LastUpdatedTime=F.lit("2022-06-06T00:00:00"),
        DataSetArns=arns,
    )


@query(
    "dashboard_inputs",
    f"""
WITH c AS (
  SELECT '{aws("quicksight")}/dashboards/dash ' || doc_id AS via_rn, doc_id FROM documents
  UNION ALL SELECT '{aws("quicksight")}/analyses/an-' || doc_id, doc_id FROM documents)
SELECT DISTINCT via_rn, '{aws("quicksight")}/datasets/ds-' || d AS other_rn, 'consume' AS role
FROM (SELECT via_rn, unnest(list_value(doc_id % 1000, (doc_id * 7 + 3) % 1000)) AS d FROM c)""",
)
def dashboard_inputs(spark, sf_dir):
    return union_all(
        en.dashboard_inputs(_dashboard_docs(spark, sf_dir), SCOPE), en.analysis_inputs(_analysis_docs(spark, sf_dir), SCOPE)
    )


def _bi_sql(source, level, key, name, kind, created, updated, rows="CAST(NULL AS BIGINT)"):
    return entity_sql(
        f"FROM {source}",
        entity_rn=f"'{aws('quicksight')}/{level}/' || {key}",
        source_rn=f"'{aws('quicksight')}'",
        name=name,
        entity_type=f"'{kind}'",
        created_at=f"TIMESTAMP '{created}'",
        updated_at=f"TIMESTAMP '{updated}'",
        rows_number=rows,
    )


@query(
    "bi_entities",
    " UNION ALL ".join(
        [
            _bi_sql("part", "datasets", "'ds-' || p_partkey", "p_name", "TABLE", "2022-01-01", "2022-02-02", "CAST(0 AS BIGINT)"),
            _bi_sql("documents", "dashboards", "'dash ' || doc_id", "'dash ' || doc_id", "DASHBOARD", "2022-03-03", "2022-04-04"),
            _bi_sql("documents", "analyses", "'an-' || doc_id", "'analysis ' || lang", "UNKNOWN", "2022-05-05", "2022-06-06"),
        ]
    ),
)
def bi_entities(spark, sf_dir):
    return wall_clock(
        union_all(
            en.bi_dataset_entities(_dataset_docs(spark, sf_dir), SCOPE),
            en.dashboard_entities(_dashboard_docs(spark, sf_dir), SCOPE),
            en.analysis_entities(_analysis_docs(spark, sf_dir), SCOPE),
        )
    )


# --- lineage of jobs ----------------------------------------------------------------------------


@query(
    "lineage_edges",
    """
SELECT DISTINCT 'order/' || l_orderkey AS via_rn, 'part/' || l_partkey AS other_rn, 'input' AS role FROM lineitem
UNION ALL
SELECT DISTINCT 'order/' || l_orderkey, 'supplier/' || l_suppkey, 'output' FROM lineitem""",
)
def lineage_edges(spark, sf_dir):
    """Unique inputs (parts) and outputs (suppliers) of every order, in one pass."""
    via = text("order/", F.col("l_orderkey"))
    ends = F.array(
        F.struct(text("part/", F.col("l_partkey")).alias("rn"), F.lit("input").alias("role")),
        F.struct(text("supplier/", F.col("l_suppkey")).alias("rn"), F.lit("output").alias("role")),
    )
    return (
        table(spark, sf_dir, "lineitem")
        .select(via.alias("via_rn"), F.explode(ends).alias("e"))
        .select("via_rn", F.col("e.rn").alias("other_rn"), "e.role")
        .distinct()
    )


# --- experiments ---------------------------------------------------------------------------------


def _experiment_docs(spark, sf_dir):
    """Customers are experiments, their orders the trials, line items the components."""
    return landed_docs(
        table(spark, sf_dir, "customer").select("c_custkey"),
        "experiment",
        ExperimentArn=text("arn:aws:sm:eu:1:experiment/", F.col("c_custkey")),
        ExperimentName=text("exp-", F.col("c_custkey")),
        CreationTime=F.lit("2021-01-01T00:00:00"),
        LastModifiedTime=F.lit("2021-01-02T00:00:00"),
    )


def _trial_docs(spark, sf_dir):
    return landed_docs(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"),
        "trial",
        TrialArn=text("arn:aws:sm:eu:1:experiment-trial/", F.col("o_orderkey")),
        TrialName=text("trial-", F.col("o_orderkey")),
        ExperimentName=text("exp-", F.col("o_custkey")),
        CreationTime=F.col("o_orderdate"),
    )


def _component_arn():
    return text("arn:aws:sm:eu:1:experiment-trial-component/", F.col("l_orderkey"), "-", F.col("l_linenumber"))


def _component_docs(spark, sf_dir):
    quantity = F.col("l_quantity")
    return landed_docs(
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"),
        "trial_component",
        TrialComponentArn=_component_arn(),
        TrialComponentName=text("abc-", F.col("l_orderkey"), "-step-", F.col("l_linenumber"), "-2022-aws-training-job"),
        TrialName=text("trial-", F.col("l_orderkey")),
        CreationTime=F.col("l_shipdate"),
        LastModifiedTime=F.lit("2023-01-01 00:00:00"),
        Parameters=F.create_map(
            F.lit("quantity"), F.struct(quantity.alias("NumberValue"), F.lit("unused").alias("StringValue")),
            F.lit("flag"), F.struct(F.lit(None).cast("double").alias("NumberValue"), F.col("l_returnflag").alias("StringValue")),
        ),
    )


def _tree(spark, sf_dir):
    experiments = _experiment_docs(spark, sf_dir).select(F.col("d.ExperimentName").alias("experiment_name"))
    trials = _trial_docs(spark, sf_dir).select(
        F.col("d.TrialName").alias("trial_name"), F.col("d.ExperimentName").alias("experiment_name")
    )
    components = _component_docs(spark, sf_dir).select(
        F.col("d.TrialComponentArn").alias("component_arn"),
        F.col("d.TrialComponentName").alias("component_name"),
        F.col("d.TrialName").alias("trial_name"),
        F.col("d.CreationTime").alias("created_at"),
        F.col("d.LastModifiedTime").alias("updated_at"),
    )
    return ex.experiment_tree(experiments, trials, components)


_COMPONENT_SQL = f"""
WITH c AS (
  SELECT l.*, c_custkey, 'abc-' || l_orderkey || '-step-' || l_linenumber || '-2022-aws-training-job' AS component,
         '{aws("sagemaker")}/experiments/exp-' || c_custkey || '/trials/trial-' || o_orderkey AS trial_rn
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
"""


@query(
    "experiment_tree",
    _COMPONENT_SQL
    + entity_sql(
        "FROM (SELECT trial_rn, component, l_linenumber, min(l_shipdate) AS l_shipdate FROM c GROUP BY ALL)",
        entity_rn="trial_rn || '/jobs/' || component",
        source_rn=f"'{aws('sagemaker')}'",
        name="'step-' || l_linenumber",
        entity_type="'JOB'",
        created_at="l_shipdate",
        updated_at="TIMESTAMP '2023-01-01'",
    ),
)
def experiment_tree(spark, sf_dir):
    """Every component under its trial and experiment, named by its job."""
    return wall_clock(en.component_entities(_tree(spark, sf_dir), SCOPE))


@query(
    "experiment_groups",
    f"""
SELECT '{aws("sagemaker")}/experiments/exp-' || o_custkey AS group_rn,
       '{aws("sagemaker")}/experiments/exp-' || o_custkey || '/trials/trial-' || o_orderkey AS member_rn FROM orders""",
)
def experiment_groups(spark, sf_dir):
    return en.trial_members(_trial_docs(spark, sf_dir), SCOPE)


@query(
    "experiment_entities",
    entity_sql(
        "FROM customer",
        entity_rn=f"'{aws('sagemaker')}/experiments/exp-' || c_custkey",
        source_rn=f"'{aws('sagemaker')}'",
        name="'exp-' || c_custkey",
        entity_type="'ML_EXPERIMENT'",
    )
    + " UNION ALL "
    + entity_sql(
        "FROM orders",
        entity_rn=f"'{aws('sagemaker')}/experiments/exp-' || o_custkey || '/trials/trial-' || o_orderkey",
        source_rn=f"'{aws('sagemaker')}'",
        name="'trial-' || o_orderkey",
        entity_type="'ML_EXPERIMENT'",
    ),
)
def experiment_entities(spark, sf_dir):
    return wall_clock(
        union_all(
            en.experiment_entities(_experiment_docs(spark, sf_dir), SCOPE),
            en.trial_entities(_trial_docs(spark, sf_dir), SCOPE),
        )
    )


def _associations(spark, sf_dir):
    """Each line item reads an image (by supplier) and a dataset (by part) and writes a
    model (by part); links to contexts and of other types are dropped."""
    arn = "arn:aws:sm:eu:1:"
    kind, component = F.col("kind"), _component_arn()
    types = F.create_map(
        *[F.lit(x) for kv in {"img": "Image", "data": "DataSet", "model": "Model", "log": "Log"}.items() for x in kv]
    )
    narrow = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    linked = (
        dealt_out(narrow)
        .select(
            component.alias("component"), "l_partkey", "l_suppkey",
            F.explode(F.array(*[F.lit(k) for k in ("img", "data", "model", "log", "context")])).alias("kind"),
        )
        .select(
            "component",
            F.concat(
                F.when(kind == "context", F.lit(arn + "context/")).otherwise(F.concat(F.lit(arn + "artifact/"), kind, F.lit("-"))),
                F.when(kind == "img", F.col("l_suppkey")).otherwise(F.col("l_partkey")).cast("string"),
            ).alias("other"),
            F.coalesce(types[kind], F.lit("Model")).alias("other_type"),
            (kind == "model").alias("is_output"),
        )
    )
    is_output, job = F.col("is_output"), F.lit("TrainingJob")
    lines = doc_lines(
        linked,
        SourceArn=F.when(is_output, F.col("component")).otherwise(F.col("other")),
        SourceType=F.when(is_output, job).otherwise(F.col("other_type")),
        DestinationArn=F.when(is_output, F.col("other")).otherwise(F.col("component")),
        DestinationType=F.when(is_output, F.col("other_type")).otherwise(job),
    )
    docs, _ = dumps.parse_docs(lines, "association")
    return docs.select(
        F.col("d.SourceArn").alias("source_arn"),
        F.col("d.SourceType").alias("source_type"),
        F.col("d.DestinationArn").alias("destination_arn"),
        F.col("d.DestinationType").alias("destination_type"),
    )


def _artifacts(spark, sf_dir):
    arn = "arn:aws:sm:eu:1:artifact/"

    def artifact_lines(rows, name, uri):
        return doc_lines(rows, ArtifactArn=text(arn, name), Source=F.struct(uri.alias("SourceUri")))

    parts = table(spark, sf_dir, "part").select("p_partkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey")
    p, s = F.col("p_partkey"), F.col("s_suppkey")
    artifact_docs, _ = dumps.parse_docs(
        union_all(
            # several image artifacts share one URI
            artifact_lines(suppliers, text("img-", s), text("registry/team/img:", s % 40)),
            artifact_lines(parts, text("data-", p), text("s3://sets/", p, "/train.csv")),
            artifact_lines(parts, text("model-", p), text("s3://models/", p, "/model.tar.gz")),
            artifact_lines(parts, text("log-", p), text("s3://logs/", p)),
        ),
        "artifact",
    )
    return artifact_docs.select(
        F.col("d.ArtifactArn").alias("artifact_arn"), F.col("d.Source.SourceUri").alias("uri")
    )


def _links(spark, sf_dir):
    return ex.artifact_links(_associations(spark, sf_dir), _artifacts(spark, sf_dir), SCOPE.source("sagemaker"))


def _first_of(links, spark, sf_dir):
    """The first link of each artifact, with the artifact."""
    return ex.with_artifacts(ex.first_links(links), _artifacts(spark, sf_dir), SCOPE.source("sagemaker"))


@query(
    "artifact_dedup",
    """
WITH c AS (
  SELECT *, 'arn:aws:sm:eu:1:experiment-trial-component/' || l_orderkey || '-' || l_linenumber AS component FROM lineitem),
k AS (
  SELECT 'registry/team/img:' || l_suppkey % 40 AS artifact_key, 'Image' AS artifact_type, component FROM c
  UNION ALL SELECT 'arn:aws:sm:eu:1:artifact/data-' || l_partkey, 'DataSet', component FROM c
  UNION ALL SELECT 'arn:aws:sm:eu:1:artifact/model-' || l_partkey, 'Model', component FROM c)
SELECT artifact_key, artifact_type, min(component) AS component_arn FROM k GROUP BY ALL""",
)
def artifact_dedup(spark, sf_dir):
    links = ex.kept_links(_associations(spark, sf_dir))
    return ex.unique_artifacts(_first_of(links, spark, sf_dir)).select("artifact_key", "artifact_type", "component_arn")


@query(
    "artifact_entities",
    "WITH i AS (SELECT DISTINCT l_suppkey % 40 AS k FROM lineitem), m AS (SELECT DISTINCT l_partkey AS k FROM lineitem)\n"
    + entity_sql(
        "FROM i",
        entity_rn=f"'{aws('sagemaker')}/artifacts/img:' || k",
        source_rn=f"'{aws('sagemaker')}'",
        name="'img:' || k",
        entity_type="'MICROSERVICE'",
    )
    + " UNION ALL "
    + entity_sql(
        "FROM m",
        entity_rn=f"'{aws('sagemaker')}/artifacts/model:model-' || k",
        source_rn=f"'{aws('sagemaker')}'",
        name="'model'",
        entity_type="'ML_MODEL_TRAINING'",
    ),
)
def artifact_entities(spark, sf_dir):
    links = ex.links_of_tree(ex.kept_links(_associations(spark, sf_dir)), _tree(spark, sf_dir))
    return wall_clock(en.artifact_entities(_first_of(links, spark, sf_dir), SCOPE))


@query(
    "component_edges",
    _COMPONENT_SQL
    + f"""
, e AS (SELECT trial_rn || '/jobs/' || component AS rn, '{aws("sagemaker")}/artifacts/img:' || l_suppkey % 40 AS image,
               '//s3/cloud/aws/buckets/sets/keys/' || l_partkey || '/train.csv' AS data,
               '{aws("sagemaker")}/artifacts/model:model-' || l_partkey AS model FROM c)
SELECT DISTINCT * FROM (
  SELECT rn AS via_rn, image AS other_rn, 'input' AS role FROM e
  UNION ALL SELECT rn, data, 'input' FROM e
  UNION ALL SELECT rn, model, 'output' FROM e
  UNION ALL SELECT image, rn, 'output' FROM e
  UNION ALL SELECT model, rn, 'consume' FROM e)""",
)
def component_edges(spark, sf_dir):
    return en.component_edges(_tree(spark, sf_dir), _links(spark, sf_dir), SCOPE)


@query(
    "component_parameters",
    """
SELECT 'arn:aws:sm:eu:1:experiment-trial-component/' || l_orderkey || '-' || l_linenumber AS component_arn, key_path, value
FROM (
  SELECT l_orderkey, l_linenumber, 'quantity' AS key_path, CAST(l_quantity AS VARCHAR) AS value FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'flag', l_returnflag FROM lineitem)""",
)
def component_parameters(spark, sf_dir):
    docs = _component_docs(spark, sf_dir)
    return ex.parameter_rows(
        docs.select(F.col("d.TrialComponentArn").alias("component_arn"), F.col("d.Parameters").alias("parameters"))
    )


@query(
    "metric_unpivot",
    """
WITH m AS (
  SELECT user_id, event_type, max(value) AS mx, min(value) AS mn, arg_max(value, event_id) AS last, count(*) AS n,
         avg(value) AS av, stddev_samp(value) AS sd, max(ts) AS ts, arg_max(event_id, event_id) AS eid
  FROM events GROUP BY ALL)
SELECT user_id, 'Metric.' || event_type || '.' || a AS key_path, v AS value FROM (
  SELECT user_id, event_type, 'metric_name' AS a, event_type AS v FROM m
  UNION ALL SELECT user_id, event_type, 'source_arn', 'arn:' || eid FROM m
  UNION ALL SELECT user_id, event_type, 'time_stamp', strftime(ts, '%Y-%m-%d %H:%M:%S') FROM m
  UNION ALL SELECT user_id, event_type, 'max', CAST(CAST(round(mx * 100) AS BIGINT) AS VARCHAR) FROM m
  UNION ALL SELECT user_id, event_type, 'min', CAST(CAST(round(mn * 100) AS BIGINT) AS VARCHAR) FROM m
  UNION ALL SELECT user_id, event_type, 'last', CAST(CAST(round(last * 100) AS BIGINT) AS VARCHAR) FROM m
  UNION ALL SELECT user_id, event_type, 'count', CAST(n AS VARCHAR) FROM m
  UNION ALL SELECT user_id, event_type, 'avg', CAST(CAST(round(av * 1000) AS BIGINT) AS VARCHAR) FROM m
  UNION ALL SELECT user_id, event_type, 'std_dev', CAST(CAST(round(sd * 1000) AS BIGINT) AS VARCHAR) FROM m)""",
)
def metric_unpivot(spark, sf_dir):
    """Metrics per user and event type; values in whole hundredths or thousandths."""

    def units(value, scale):
        return F.round(value * scale).cast("bigint")

    metrics = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.col("event_type").alias("metric_name"))
        .agg(
            text("arn:", F.max("event_id")).alias("source_arn"),
            F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("time_stamp"),
            units(F.max("value"), 100).alias("max"),
            units(F.min("value"), 100).alias("min"),
            units(F.max_by("value", "event_id"), 100).alias("last"),
            F.count("*").alias("count"),
            units(F.avg("value"), 1000).alias("avg"),
            units(F.stddev_samp("value"), 1000).alias("std_dev"),
        )
    )
    return ex.metric_rows(metrics, ["user_id"])
