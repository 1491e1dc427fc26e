"""Nested JSON documents -> flat key/value rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import snake_case
from ..session import cut_lineage

# Raw key paths that are not metadata, per kind of document.
EXCLUDED_PATHS: dict[str, list[str]] = {
    "glue_table": [
        "Name", "UpdateTime", "Owner", "StorageDescriptor::Columns", "ViewOriginalText", "ViewExpandedText",
    ],
    "glue_job": ["Name", "Description", "Command::ScriptLocation"],
    "glue_run": ["Id", "StartedOn", "CompletedOn", "JobRunState", "ErrorMessage"],
    "athena_table": ["Name", "CreateTime", "TableType", "Columns"],
    "kv_table": ["TableName", "CreationDateTime", "ItemCount", "AttributeDefinitions"],
    "stream": ["StreamName"],
    "bi_dataset": ["Name", "CreatedTime", "OutputColumns", "LastUpdatedTime", "Arn"],
    "bi_dashboard": ["Name", "CreatedTime", "LastPublishedTime"],
    "bi_analysis": ["Name", "CreatedTime", "LastUpdatedTime"],
    "feature_group": ["FeatureGroupName", "FeatureDefinitions", "CreationTime"],
}
# Fixed value: a key whose text is itself JSON.
JSON_TEXT_PATH = "Parameters::exclusions"
# The keys kept of a replication task document.
TASK_KEYS = [
    "MigrationType",
    "TableMappings",
    "Status",
    "StopReason",
    "ReplicationTaskCreationDate",
    "ReplicationTaskStartDate",
]
# Extension document and definition per kind.
SCHEMA_REFS = {
    "file": "s3.json#/definitions/S3DataSetExtension",
    "glue_table": "glue.json#/definitions/GlueDataSetExtension",
    "glue_job": "glue.json#/definitions/GlueDataTransformerExtension",
    "glue_run": "glue.json#/definitions/GlueDataTransformerRunExtension",
    "athena_table": "athena.json#/definitions/AthenaDataSetExtension",
    "kv_table": "dynamodb.json#/definitions/DynamoDBDataSetExtension",
    "queue": "sqs.json#/definitions/SQSDataSetExtension",
    "task": "dms.json#/definitions/DMS",
    "bi_dataset": "quicksight.json#/definitions/QuickSightDataSetExtension",
    "bi_dashboard": "quicksight.json#/definitions/QuickSightDashboardExtension",
    "bi_analysis": "quicksight.json#/definitions/QuickSightAnalysisExtension",
    "feature_group": "sagemaker_featurestore.json#/definitions/SagemakerFeaturestoreExtension",
    "experiment": "sagemaker.json#/definitions/Trial",
    "trial": "sagemaker.json#/definitions/Trial",
    "trial_component": "sagemaker.json#/definitions/TrialComponent",
}


def schema_url(kind: str, prefix: str = "") -> Column:
    """Extension reference of a kind; ``prefix`` is where the caller publishes them."""
    ref = SCHEMA_REFS.get(kind)
    return F.lit(None).cast("string") if ref is None else F.lit(prefix + ref)


def flatten_metadata(
    docs: DataFrame,
    doc: str = "doc",
    excluded: list[str] | None = None,
    snake: bool = True,
    prefixed: bool = True,
    lists: bool = False,
    delimiter: str = ".",
    json_text_path: str | None = JSON_TEXT_PATH,
    only: list[str] | None = None,
) -> DataFrame:
    """(other columns..., key_path, value) rows of a VARIANT column.

    ``excluded`` holds raw paths joined with ``::``; with ``prefixed=False`` a nested key
    is tested by its own name.  ``only`` keeps these top-level keys and what is below them.  Lists stay JSON text unless ``lists`` is set, which
    descends into them with the position in the path.

    Each level opens the containers of the level before and is written to the shared
    folder; it goes on until no open container is left, however deep the documents are.
    """
    keep = [c for c in docs.columns if c != doc]
    open_ = docs.select(*keys_of(keep), F.lit("").alias("_raw"), F.lit("").alias("_path"), F.col(doc).alias("_v"))
    spark = docs.sparkSession
    leaves = []
    while True:
        opened = open_.lateralJoin(spark.tvf.variant_explode_outer(F.col("_v").outer()))
        key = F.coalesce("key", F.col("pos").cast("string"))
        raw = F.when(F.col("_raw") == "", key).otherwise(F.concat_ws("::", "_raw", key)) if prefixed else key
        label = snake_case(key) if snake else key
        path = F.when(F.col("_path") == "", label).otherwise(F.concat_ws(delimiter, "_path", label))
        # a list step keeps the raw path of the list itself
        raw = F.when(F.col("key").isNull(), F.col("_raw")).otherwise(raw)
        rows = opened.filter(F.col("pos").isNotNull()).select(
            *keys_of(keep), raw.alias("_raw"), path.alias("_path"), F.col("value").alias("_v")
        )
        if only:
            rows = rows.filter(F.substring_index("_raw", "::", 1).isin(only))
        if excluded:
            rows = rows.filter(~F.col("_raw").isin(excluded))
        if json_text_path:
            decoded = F.try_parse_json(F.col("_v").cast("string"))
            is_text = F.col("_raw") == json_text_path
            rows = rows.withColumn("_v", F.when(is_text, F.coalesce(decoded, F.col("_v"))).otherwise(F.col("_v")))
        level = cut_lineage(rows.withColumn("_open", _has_members(F.col("_v"), lists)))
        leaves.append(level.filter(~F.col("_open")))
        open_ = level.filter("_open").drop("_open")
        if open_.isEmpty():
            break
    found = reduce(DataFrame.unionByName, leaves)
    return found.select(*keys_of(keep), F.col("_path").alias("key_path"), F.col("_v").cast("string").alias("value"))


def _has_members(value: Column, lists: bool) -> Column:
    """Whether a VARIANT is an object, or with ``lists`` a list, with something in it."""
    kind = F.schema_of_variant(value)
    is_object = kind.startswith("OBJECT<") & (kind != "OBJECT<>")
    is_list = F.try_variant_get(value, "$[0]", "variant").isNotNull()
    return F.coalesce(is_object | is_list if lists else is_object, F.lit(False))


def keys_of(names: list[str]) -> list[Column]:
    return [F.col(n) for n in names]


def metadata_of(docs: DataFrame, kind: str, url_prefix: str = "") -> DataFrame:
    """metadata_kv(entity_rn, schema_url, key_path, value) of ``entity_rn, doc`` rows, by the rules of a kind."""
    rows = flatten_metadata(
        docs.select("entity_rn", "doc"),
        excluded=EXCLUDED_PATHS.get(kind),
        snake=kind not in ("stream", "queue", "experiment", "trial", "trial_component", "task"),
        prefixed=kind != "stream",
        lists=kind == "kv_table",
        json_text_path=None if kind in ("kv_table", "feature_group") else JSON_TEXT_PATH,
        only=TASK_KEYS if kind == "task" else None,
    )
    return rows.select("entity_rn", schema_url(kind, url_prefix).alias("schema_url"), "key_path", "value")


def keep_keys(attributes: Column, keys: list[str]) -> Column:
    """Allow-list of a map's top-level keys."""
    return F.map_filter(attributes, lambda k, v: k.isin(keys))


def drop_keys(attributes: Column, keys: list[str]) -> Column:
    return F.map_filter(attributes, lambda k, v: ~k.isin(keys))


def map_rows(df: DataFrame, attributes: str, keys: list[str]) -> DataFrame:
    """Key/value rows of a map column."""
    return df.select(*keys, F.explode(attributes).alias("key_path", "value"))
