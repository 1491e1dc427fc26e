"""Catalog entities per kind of landed document or object.

Every mapper takes typed rows and returns frames with the common entity columns; fields,
members, lineage, runs and metadata are separate tables keyed by the entity name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..functions.paths import url_bucket, url_key
from ..functions.status import table_kind
from ..functions.text import job_name, last_segment
from ..functions.types import normalised_type
from ..operators import experiments as ex
from ..operators import lineage as ln
from ..operators.inventory import folders
from ..operators.joins import met_by_key
from ..operators.latest import latest_per_key
from ..operators.profile import REPORTED, join_stats, reported_stats
from ..operators.type_tree import field_rows

ENTITY = [
    ("entity_rn", "string"),
    ("source_rn", "string"),
    ("name", "string"),
    ("entity_type", "string"),
    ("owner_rn", "string"),
    ("description", "string"),
    ("created_at", "timestamp"),
    ("updated_at", "timestamp"),
    ("rows_number", "bigint"),
    ("source_code_url", "string"),
]
FIELD_INPUT = [
    "entity_rn", "column_rn", "position", "column_name", "dialect", "type_string", "is_nullable", "description",
]


@dataclass(frozen=True)
class Scope:
    """Where the described services live."""

    account: str
    region: str

    def source(self, system: str) -> Column:
        return names.account_source(system, self.account, self.region)


def entity(rows: DataFrame, **columns: Column) -> DataFrame:
    """Select the common entity columns; those not given are null."""
    return rows.select(
        *[(columns[n] if n in columns else F.lit(None)).cast(t).alias(n) for n, t in ENTITY]
    )


def _simple_fields(
    rows: DataFrame, entity_rn: Column, items: str, level: str, dialect: str, name: str, kind: str, nullable: bool,
    description: str | None = None,
) -> DataFrame:
    """Field rows of flat column lists (no nested types in these dialects)."""
    item = F.col("item")
    return (
        rows.select(entity_rn.alias("entity_rn"), F.posexplode(items).alias("position", "item"))
        .select(
            "entity_rn",
            F.concat_ws("/", "entity_rn", F.lit(level), item[name]).alias("field_rn"),
            F.lit(None).cast("string").alias("parent_field_rn"),
            "position",
            F.lit(0).alias("ordinal"),
            F.lit(0).alias("depth"),
            item[name].alias("name"),
            normalised_type(dialect, item[kind]).alias("type"),
            item[kind].alias("logical_type"),
            F.lit(nullable).alias("is_nullable"),
            F.lit(False).alias("is_key"),
            F.lit(False).alias("is_value"),
            (item[description] if description else F.lit(None).cast("string")).alias("description"),
        )
    )


def _typed_columns(rows: DataFrame, entity_rn: Column, items: str, dialect: str) -> DataFrame:
    """Column definitions for the type flattening."""
    item = F.col("item")
    return rows.select(entity_rn.alias("entity_rn"), F.posexplode(items).alias("position", "item")).select(
        "entity_rn",
        F.concat_ws("/", "entity_rn", F.lit("columns"), item["Name"]).alias("column_rn"),
        "position",
        item["Name"].alias("column_name"),
        F.lit(dialect).alias("dialect"),
        item["Type"].alias("type_string"),
        F.lit(True).alias("is_nullable"),
        item["Comment"].alias("description"),
    )


# --- objects ------------------------------------------------------------------------


def _path_name(path: Column) -> Column:
    """Name of a bucket/key path; a bare bucket is the bucket itself."""
    key = F.substring(path, F.instr(path, "/") + 1, F.length(path))
    bucket = F.substring_index(path, "/", 1)
    return F.when(F.contains(path, F.lit("/")), names.object_key_name(bucket, key)).otherwise(names.bucket_name(bucket))


def file_entities(objects: DataFrame) -> DataFrame:
    """Files; ``objects`` needs path (bucket first) and base_name."""
    path = F.col("path")
    return entity(
        objects,
        entity_rn=_path_name(path),
        source_rn=names.bucket_name(F.substring_index(path, "/", 1)),
        name=F.col("base_name"),
        entity_type=F.lit("FILE"),
    )


def folder_entities(objects: DataFrame) -> DataFrame:
    """Folders and buckets as groups."""
    path = F.col("path")
    return entity(
        folders(objects),
        entity_rn=_path_name(path),
        source_rn=names.bucket_name(F.substring_index(path, "/", 1)),
        name=path,
        entity_type=F.lit("DAG"),
    )


def log_table_entities(tables: DataFrame) -> DataFrame:
    """Transaction-log tables; ``tables`` as from ``log_replay.log_tables``, root a URL."""
    root = F.col("root")
    return entity(
        tables,
        entity_rn=names.object_key_name(url_bucket(root), url_key(root)),
        source_rn=names.bucket_name(url_bucket(root)),
        name=url_key(root),
        entity_type=F.lit("TABLE"),
        created_at=F.col("created_at"),
        updated_at=F.col("modified_at"),
        rows_number=F.col("num_records"),
    )


# --- table catalogs -----------------------------------------------------------------


def athena_rn(scope: Scope) -> Column:
    base = names.path_of(scope.source("athena"), catalogs=F.col("d.Catalog"), databases=F.col("d.Database"))
    is_view = table_kind(F.col("d.TableType")) == "VIEW"
    return F.when(is_view, names.path_of(base, views=F.col("d.Name"))).otherwise(
        names.path_of(base, tables=F.col("d.Name"))
    )


def athena_entities(docs: DataFrame, scope: Scope) -> DataFrame:
    return entity(
        docs,
        entity_rn=athena_rn(scope),
        source_rn=scope.source("athena"),
        name=F.col("d.Name"),
        entity_type=table_kind(F.col("d.TableType")),
        created_at=F.col("d.CreateTime"),
        rows_number=F.lit(0),
    )


def athena_columns(docs: DataFrame, scope: Scope) -> DataFrame:
    return _typed_columns(docs, athena_rn(scope), "d.Columns", "athena")


def glue_rn(scope: Scope) -> Column:
    return names.path_of(scope.source("glue"), databases=F.col("d.DatabaseName"), tables=F.col("d.Name"))


def glue_entities(docs: DataFrame, scope: Scope) -> DataFrame:
    owner = F.when(
        F.col("d.Owner").isNotNull(), names.path_of(scope.source("glue"), owners=F.col("d.Owner"))
    )
    return entity(
        docs,
        entity_rn=glue_rn(scope),
        source_rn=scope.source("glue"),
        name=F.col("d.Name"),
        entity_type=F.lit("TABLE"),
        owner_rn=owner,
        description=F.col("d.Description"),
        created_at=F.col("d.CreateTime"),
        updated_at=F.col("d.UpdateTime"),
        rows_number=F.lit(0),
    )


def glue_columns(docs: DataFrame, scope: Scope) -> DataFrame:
    return _typed_columns(docs, glue_rn(scope), "d.StorageDescriptor.Columns", "glue")


STATISTICS = (
    f"struct<DatabaseName:string,TableName:string,ColumnStatisticsList:array<struct<ColumnName:string,AnalyzedTime:timestamp,StatisticsData:{REPORTED}>>>"
)


def glue_statistics(lines: DataFrame, scope: Scope) -> tuple[DataFrame, DataFrame]:
    """(statistics by ``entity_rn`` and ``column_name``, rejects) of landed column-statistics documents (``value``).

    A table's columns may be spread over documents; of several reports on a column the one
    analysed last counts (one without a time before all others).
    """
    read = lines.select("value", F.from_json("value", STATISTICS).alias("d"))
    usable = F.col("d.DatabaseName").isNotNull() & F.col("d.TableName").isNotNull()
    rejects = read.filter(~F.coalesce(usable, F.lit(False))).select(
        F.lit("glue_statistics").alias("job"), F.md5(F.coalesce("value", F.lit(""))).alias("key"), F.lit("no table named").alias("reason")
    )
    rn = names.path_of(scope.source("glue"), databases=F.col("d.DatabaseName"), tables=F.col("d.TableName"))
    columns = read.filter(usable).select(rn.alias("entity_rn"), F.explode("d.ColumnStatisticsList").alias("c"))
    reports = columns.select("entity_rn", F.col("c.ColumnName").alias("column_name"), F.col("c.AnalyzedTime").alias("at"), F.col("c.StatisticsData").alias("report"))
    newest = latest_per_key(reports.filter("column_name IS NOT NULL"), ["entity_rn", "column_name"], [F.col("at").isNotNull(), F.col("at")])
    return reported_stats(newest.drop("at")), rejects


def glue_field_stats(docs: DataFrame, statistics: DataFrame, scope: Scope) -> DataFrame:
    """Fields of the tables with what their catalog reports of the columns; fields without a report keep nulls."""
    fields, _ = field_rows(glue_columns(docs, scope))
    return join_stats(fields, statistics)


def job_rn(scope: Scope, name: Column) -> Column:
    return names.path_of(scope.source("glue"), jobs=name)


def job_entities(docs: DataFrame, scope: Scope) -> DataFrame:
    return entity(
        docs,
        entity_rn=job_rn(scope, F.col("d.Name")),
        source_rn=scope.source("glue"),
        name=F.col("d.Name"),
        entity_type=F.lit("JOB"),
        description=F.col("d.Description"),
        created_at=F.col("d.CreatedOn"),
        updated_at=F.col("d.LastModifiedOn"),
        source_code_url=F.col("d.Command.ScriptLocation"),
    )


def run_entities(runs: DataFrame, scope: Scope) -> DataFrame:
    """Runs as entities; ``runs`` as from ``operators.runs.job_runs``."""
    return entity(
        runs,
        entity_rn=F.col("run_rn"),
        source_rn=scope.source("glue"),
        name=F.col("run_id"),
        entity_type=F.lit("JOB_RUN"),
        owner_rn=F.col("owner_rn"),
    )


# --- replication, key-value tables, streams, queues -----------------------------------


def task_rn(scope: Scope) -> Column:
    return names.path_of(scope.source("dms"), tasks=F.col("d.ReplicationTaskIdentifier"))


def task_entities(docs: DataFrame, scope: Scope) -> DataFrame:
    return entity(
        docs,
        entity_rn=task_rn(scope),
        source_rn=scope.source("dms"),
        name=F.col("d.ReplicationTaskIdentifier"),
        entity_type=F.lit("JOB"),
        created_at=F.col("d.ReplicationTaskCreationDate"),
    )


def kv_rn(scope: Scope) -> Column:
    return names.path_of(scope.source("dynamodb"), tables=F.col("d.TableName"))


def kv_entities(docs: DataFrame, scope: Scope) -> DataFrame:
    return entity(
        docs,
        entity_rn=kv_rn(scope),
        source_rn=scope.source("dynamodb"),
        name=F.col("d.TableName"),
        entity_type=F.lit("TABLE"),
        created_at=F.col("d.CreationDateTime"),
        updated_at=F.col("d.CreationDateTime"),
        rows_number=F.col("d.ItemCount"),
    )


def kv_fields(docs: DataFrame, scope: Scope) -> DataFrame:
    return _simple_fields(
        docs, kv_rn(scope), "d.AttributeDefinitions", "columns", "kv", "AttributeName", "AttributeType", False
    )


def stream_entities(docs: DataFrame, scope: Scope) -> DataFrame:
    return entity(
        docs,
        entity_rn=names.path_of(scope.source("kinesis"), streams=F.col("d.StreamName")),
        source_rn=scope.source("kinesis"),
        name=F.col("d.StreamName"),
        entity_type=F.lit("KAFKA_TOPIC"),
    )


def queue_rn(scope: Scope) -> Column:
    return names.path_of(scope.source("sqs"), queue=last_segment(F.col("d.QueueUrl")))


def queue_entities(docs: DataFrame, scope: Scope) -> DataFrame:
    return entity(
        docs,
        entity_rn=queue_rn(scope),
        source_rn=scope.source("sqs"),
        name=last_segment(F.col("d.QueueUrl")),
        entity_type=F.lit("KAFKA_TOPIC"),
        created_at=F.timestamp_seconds(F.col("d.Attributes")["CreatedTimestamp"].cast("bigint")),
        updated_at=F.timestamp_seconds(F.col("d.Attributes")["LastModifiedTimestamp"].cast("bigint")),
    )


# Queue attributes that are not metadata, and the one that is added.
QUEUE_DROPPED = ["CreatedTimestamp", "LastModifiedTimestamp", "Policy"]
QUEUE_ACCOUNT = "AccountID"


def queue_attributes(attributes: Column, account: Column | str) -> Column:
    """Attributes without the dropped keys, with the account id added; a missing key is fine."""
    value = F.lit(account) if isinstance(account, str) else account
    dropped = [*QUEUE_DROPPED, QUEUE_ACCOUNT]
    kept = F.map_filter(attributes, lambda k, v: ~k.isin(dropped))
    return F.map_concat(kept, F.create_map(F.lit(QUEUE_ACCOUNT), value))


# --- BI -----------------------------------------------------------------------------


def bi_rn(scope: Scope, level: str, key: Column) -> Column:
    return names.path_of(scope.source("quicksight"), **{level: key})


def bi_dataset_entities(docs: DataFrame, scope: Scope) -> DataFrame:
    return entity(
        docs,
        entity_rn=bi_rn(scope, "datasets", F.col("d.DataSetId")),
        source_rn=scope.source("quicksight"),
        name=F.col("d.Name"),
        entity_type=F.lit("TABLE"),
        created_at=F.col("d.CreatedTime"),
        updated_at=F.col("d.LastUpdatedTime"),
        rows_number=F.lit(0),
    )


def bi_dataset_fields(docs: DataFrame, scope: Scope) -> DataFrame:
    rn = bi_rn(scope, "datasets", F.col("d.DataSetId"))
    return _simple_fields(docs, rn, "d.OutputColumns", "columns", "bi", "Name", "Type", True, "Description")


def bi_sources(docs: DataFrame) -> DataFrame:
    """(source_id, source_type, params) of data-source documents; host, port and the rest
    live under a key named after the type."""
    # Where each source type keeps its parameters.
    section = {
        "POSTGRESQL": "PostgreSqlParameters",
        "MYSQL": "MySqlParameters",
        "SNOWFLAKE": "SnowflakeParameters",
    }
    p = F.col("d.DataSourceParameters")

    def param(name: str, kind: str = "string") -> Column:
        values = [F.try_variant_get(p, f"$.{s}.{name}", kind) for s in section.values()]
        return F.coalesce(*values).alias(name.lower())

    manifest = "$.S3Parameters.ManifestFileLocation"
    params = F.struct(
        F.try_variant_get(p, f"{manifest}.Bucket", "string").alias("bucket"),
        F.try_variant_get(p, f"{manifest}.Key", "string").alias("key"),
        param("Host"),
        param("Port", "bigint"),
        param("Database"),
        param("Warehouse"),
    )
    return docs.select(
        F.col("d.DataSourceId").alias("source_id"), F.col("d.Type").alias("source_type"), params.alias("params")
    )


def bi_dataset_inputs(docs: DataFrame, source_docs: DataFrame, scope: Scope) -> DataFrame:
    """Input edges of BI datasets from their physical tables."""
    datasets = docs.select(
        F.col("d.DataSetId").alias("dataset_id"), F.col("d.PhysicalTableMap").alias("physical_tables")
    )
    up = ln.dataset_upstreams(datasets, bi_sources(source_docs), scope.account, scope.region)
    return ln.edges(up, bi_rn(scope, "datasets", F.col("dataset_id")), F.col("upstream_rn"), "input")


def dashboard_entities(docs: DataFrame, scope: Scope) -> DataFrame:
    return entity(
        docs,
        entity_rn=bi_rn(scope, "dashboards", F.col("d.Name")),
        source_rn=scope.source("quicksight"),
        name=F.col("d.Name"),
        entity_type=F.lit("DASHBOARD"),
        created_at=F.col("d.CreatedTime"),
        updated_at=F.col("d.LastPublishedTime"),
    )


def analysis_entities(docs: DataFrame, scope: Scope) -> DataFrame:
    return entity(
        docs,
        entity_rn=bi_rn(scope, "analyses", F.col("d.AnalysisId")),
        source_rn=scope.source("quicksight"),
        name=F.col("d.Name"),
        entity_type=F.lit("UNKNOWN"),
        created_at=F.col("d.CreatedTime"),
        updated_at=F.col("d.LastUpdatedTime"),
    )


def _consumed(rows: DataFrame, scope: Scope) -> DataFrame:
    inputs = ln.consumer_inputs(rows)
    return ln.edges(inputs, F.col("via"), bi_rn(scope, "datasets", F.col("dataset_id")), "consume")


def dashboard_inputs(docs: DataFrame, scope: Scope) -> DataFrame:
    rows = docs.select(
        bi_rn(scope, "dashboards", F.col("d.Name")).alias("via"), F.col("d.Version.DataSetArns").alias("dataset_arns")
    )
    return _consumed(rows, scope)


def analysis_inputs(docs: DataFrame, scope: Scope) -> DataFrame:
    rows = docs.select(
        bi_rn(scope, "analyses", F.col("d.AnalysisId")).alias("via"), F.col("d.DataSetArns").alias("dataset_arns")
    )
    return _consumed(rows, scope)


# --- experiments and features ---------------------------------------------------------


def experiment_rn(scope: Scope, experiment: Column) -> Column:
    return names.path_of(scope.source("sagemaker"), experiments=experiment)


def trial_rn(scope: Scope, experiment: Column, trial: Column) -> Column:
    return names.path_of(experiment_rn(scope, experiment), trials=trial)


def component_rn(scope: Scope, experiment: Column, trial: Column, component: Column) -> Column:
    return names.path_of(trial_rn(scope, experiment, trial), jobs=component)


def experiment_entities(docs: DataFrame, scope: Scope) -> DataFrame:
    return entity(
        docs,
        entity_rn=experiment_rn(scope, F.col("d.ExperimentName")),
        source_rn=scope.source("sagemaker"),
        name=F.col("d.ExperimentName"),
        entity_type=F.lit("ML_EXPERIMENT"),
    )


def trial_entities(docs: DataFrame, scope: Scope) -> DataFrame:
    return entity(
        docs,
        entity_rn=trial_rn(scope, F.col("d.ExperimentName"), F.col("d.TrialName")),
        source_rn=scope.source("sagemaker"),
        name=F.col("d.TrialName"),
        entity_type=F.lit("ML_EXPERIMENT"),
    )


def trial_members(docs: DataFrame, scope: Scope) -> DataFrame:
    """Experiment -> trial membership; trials themselves have no members."""
    return docs.select(
        experiment_rn(scope, F.col("d.ExperimentName")).alias("group_rn"),
        trial_rn(scope, F.col("d.ExperimentName"), F.col("d.TrialName")).alias("member_rn"),
    ).distinct()


def component_entities(tree: DataFrame, scope: Scope) -> DataFrame:
    """Components; ``tree`` as from ``experiments.experiment_tree`` with created_at and updated_at.

    A component listed more than once in a trial is one entity, from its first creation to
    its last update.
    """
    once = tree.groupBy("experiment_name", "trial_name", "component_name").agg(
        F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at")
    )
    return entity(
        once,
        entity_rn=component_rn(scope, F.col("experiment_name"), F.col("trial_name"), F.col("component_name")),
        source_rn=scope.source("sagemaker"),
        name=job_name(F.col("component_name")),
        entity_type=F.lit("JOB"),
        created_at=F.col("created_at"),
        updated_at=F.col("updated_at"),
    )


def artifact_entities(links: DataFrame, scope: Scope) -> DataFrame:
    """Images and models, one per key; dataset artifacts are only ends of edges."""
    unique = ex.unique_artifacts(links).filter(F.col("artifact_type").isin("Image", "Model"))
    kind = F.col("artifact_type")
    return entity(
        unique,
        entity_rn=ex.artifact_name(kind, F.col("artifact_arn"), F.col("uri"), scope.source("sagemaker")),
        source_rn=scope.source("sagemaker"),
        name=ex.artifact_label(kind, F.col("uri")),
        entity_type=F.when(kind == "Image", F.lit("MICROSERVICE")).otherwise(F.lit("ML_MODEL_TRAINING")),
    )


def component_edges(tree: DataFrame, links: DataFrame, scope: Scope) -> DataFrame:
    """Unique inputs and outputs of components, images' outputs and models' consumers.

    Both sides are made unique on their short keys; long names come last.
    """
    rn = component_rn(scope, F.col("experiment_name"), F.col("trial_name"), F.col("component_name"))
    kind = F.col("artifact_type")
    kept = links.filter(F.col("artifact_rn").isNotNull())
    kept = kept.select("component_arn", "direction", "artifact_type", "artifact_rn").distinct()
    components = tree.select("component_arn", "experiment_name", "trial_name", "component_name").distinct()
    linked = met_by_key(kept, components, "component_arn").withColumn("component_rn", rn)
    component_side = F.struct(
        F.col("component_rn").alias("via_rn"), F.col("artifact_rn").alias("other_rn"), F.col("direction").alias("role")
    )
    artifact_role = F.when((kind == "Image") & (F.col("direction") == "input"), F.lit("output")).when(
        (kind == "Model") & (F.col("direction") == "output"), F.lit("consume")
    )
    artifact_side = F.struct(
        F.col("artifact_rn").alias("via_rn"), F.col("component_rn").alias("other_rn"), artifact_role.alias("role")
    )
    return linked.select(F.inline(F.array(component_side, artifact_side))).filter(F.col("role").isNotNull())


def feature_rn(scope: Scope) -> Column:
    return names.path_of(
        names.feature_source(scope.account, scope.region), feature_groups=F.col("d.FeatureGroupName")
    )


def feature_group_entities(docs: DataFrame, scope: Scope) -> DataFrame:
    return entity(
        docs,
        entity_rn=feature_rn(scope),
        source_rn=names.feature_source(scope.account, scope.region),
        name=F.col("d.FeatureGroupName"),
        entity_type=F.lit("FEATURE_GROUP"),
        created_at=F.col("d.CreationTime"),
    )


def feature_fields(docs: DataFrame, scope: Scope) -> DataFrame:
    return _simple_fields(
        docs, feature_rn(scope), "d.FeatureDefinitions", "features", "feature", "FeatureName", "FeatureType", False
    )


