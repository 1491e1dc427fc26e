"""Landed describe-documents: one JSON document (or response page) per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import with_once

_BAD = "_corrupt_record"
_COLUMNS = "array<struct<Name:string,Type:string,Comment:string>>"

# The fields the entity mappers read, per kind of document.
SCHEMAS: dict[str, str] = {
    "athena_table": (
        "struct<Catalog:string,Database:string,Name:string,TableType:string,CreateTime:timestamp,"
        f"Columns:{_COLUMNS}>"
    ),
    "glue_table": (
        "struct<DatabaseName:string,Name:string,Owner:string,Description:string,CreateTime:timestamp,"
        f"UpdateTime:timestamp,StorageDescriptor:struct<Columns:{_COLUMNS}>>"
    ),
    "glue_job": (
        "struct<Name:string,Description:string,Owner:string,CreatedOn:timestamp,LastModifiedOn:timestamp,"
        "Command:struct<ScriptLocation:string>>"
    ),
    "glue_run": (
        "struct<JobName:string,Id:string,JobRunState:string,StartedOn:timestamp,CompletedOn:timestamp,"
        "ErrorMessage:string>"
    ),
    "task": (
        "struct<ReplicationTaskIdentifier:string,SourceEndpointArn:string,TargetEndpointArn:string,"
        "TableMappings:string,ReplicationTaskCreationDate:timestamp,ReplicationTaskStartDate:timestamp,"
        "Status:string,StopReason:string,MigrationType:string>"
    ),
    "endpoint": (
        "struct<EndpointArn:string,EngineName:string,"
        "MicrosoftSQLServerSettings:struct<ServerName:string,DatabaseName:string>,"
        "MySQLSettings:struct<ServerName:string,DatabaseName:string>,"
        "PostgreSQLSettings:struct<ServerName:string,DatabaseName:string>,"
        "MongoDbSettings:struct<ServerName:string,DatabaseName:string>,"
        "S3Settings:struct<BucketName:string,BucketFolder:string>>"
    ),
    "kv_table": (
        "struct<TableName:string,ItemCount:bigint,CreationDateTime:timestamp,"
        "AttributeDefinitions:array<struct<AttributeName:string,AttributeType:string>>>"
    ),
    "stream": "struct<StreamName:string>",
    "queue": "struct<QueueUrl:string,Attributes:map<string,string>>",
    "bi_dataset": (
        "struct<DataSetId:string,Name:string,CreatedTime:timestamp,LastUpdatedTime:timestamp,"
        "OutputColumns:array<struct<Name:string,Type:string,Description:string>>,"
        "PhysicalTableMap:map<string,map<string,struct<DataSourceArn:string,Catalog:string,Schema:string,Name:string>>>>"
    ),
    "bi_source": "struct<DataSourceId:string,Type:string,DataSourceParameters:variant>",
    "bi_dashboard": (
        "struct<DashboardId:string,Name:string,CreatedTime:timestamp,LastPublishedTime:timestamp,"
        "Version:struct<DataSetArns:array<string>>>"
    ),
    "bi_analysis": (
        "struct<AnalysisId:string,Name:string,CreatedTime:timestamp,LastUpdatedTime:timestamp,"
        "DataSetArns:array<string>>"
    ),
    "experiment": (
        "struct<ExperimentArn:string,ExperimentName:string,CreationTime:timestamp,LastModifiedTime:timestamp>"
    ),
    "trial": (
        "struct<TrialArn:string,TrialName:string,ExperimentName:string,CreationTime:timestamp,"
        "LastModifiedTime:timestamp>"
    ),
    "trial_component": (
        "struct<TrialComponentArn:string,TrialComponentName:string,TrialName:string,"
        "Source:struct<SourceArn:string,SourceType:string>,CreationTime:timestamp,LastModifiedTime:timestamp,"
        "Parameters:map<string,struct<NumberValue:double,StringValue:string>>,"
        "Metrics:array<struct<MetricName:string,SourceArn:string,TimeStamp:timestamp,Max:double,Min:double,"
        "Last:double,Count:double,Avg:double,StdDev:double>>>"
    ),
    "association": "struct<SourceArn:string,SourceType:string,DestinationArn:string,DestinationType:string>",
    "artifact": "struct<ArtifactArn:string,Source:struct<SourceUri:string>>",
    "feature_group": (
        "struct<FeatureGroupName:string,CreationTime:timestamp,"
        "FeatureDefinitions:array<struct<FeatureName:string,FeatureType:string>>>"
    ),
}

# List key of a response page, per kind of document.
PAGE_KEYS = {
    "athena_table": "TableMetadataList",
    "glue_table": "TableList",
    "glue_job": "Jobs",
    "glue_run": "JobRuns",
    "task": "ReplicationTasks",
    "endpoint": "Endpoints",
    "bi_dataset": "DataSetSummaries",
    "bi_dashboard": "DashboardSummaryList",
    "bi_analysis": "AnalysisSummaryList",
    "trial": "TrialSummaries",
    "trial_component": "TrialComponentSummaries",
    "association": "AssociationSummaries",
    "feature_group": "FeatureGroupSummaries",
}


def rejected(lines: DataFrame, kind: str, reason: str) -> DataFrame:
    return lines.select(F.lit(kind).alias("job"), F.col("value").alias("key"), F.lit(reason).alias("reason"))


def open_pages(lines: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(one line per element of the list a response page holds, rejected pages).

    A page that is not JSON or does not hold the kind's list is rejected.
    """
    listed = F.try_variant_get(F.try_parse_json("value"), f"$.{PAGE_KEYS[kind]}", "array<variant>")
    read = with_once(lines, "_list", listed)
    pages = read.filter(F.col("_list").isNotNull()).withColumn("_items", F.to_variant_object("_list")).drop("_list")
    rejects = rejected(read.filter(F.col("_list").isNull()), kind, f"no page with {PAGE_KEYS[kind]}")
    rest = [c for c in lines.columns if c != "value"]
    items = pages.lateralJoin(lines.sparkSession.tvf.variant_explode(F.col("_items").outer()).select(
        F.col("value").alias("_item")
    ))
    return items.select(*rest, F.col("_item").cast("string").alias("value")), rejects


# Lines that are cut at their quotes: short ones without an escape or control character.
_CUT = r"\A[ -\[\]-\uffff]*\z"
_CUT_BYTES = 32768


def _cut_struct(lines: DataFrame, fields: list[StructField]) -> DataFrame:
    """``lines`` with ``_plain``, the typed struct of a document of texts alone; null for all others.

    Between the quotes of such a document are by turns a key and its text: the pieces 1 and
    3, 5 and 7 and so on.  It is taken if every key is a field of the kind, each once, all
    other pieces are the signs of one object, and the times can be read.  The steps are
    small, because the JVM compiles no large methods.
    """
    is_short = F.octet_length("value") < _CUT_BYTES
    cut = with_once(lines, "_cut", F.when(is_short & F.col("value").rlike(_CUT), F.split("value", '"')))
    # counted from 1, so that keys are at 2, 6, 10 and so on; a text may read like a key
    places = [F.array_position("_cut", f.name).cast("int").alias(f"p{i}") for i, f in enumerate(fields)]
    placed = with_once(cut, "_at", F.struct(*places))
    at = [F.col(f"_at.p{i}") for i in range(len(fields))]
    values = [F.when(p % 4 == 2, F.get("_cut", p + 1)).try_cast(f.dataType).alias(f"v{i}") for i, (p, f) in enumerate(zip(at, fields, strict=True))]
    # a piece that is not there is left out; no control character is in a plain line
    signs = F.replace(F.concat_ws("\x01", *[F.get("_cut", F.lit(i)) for i in range(0, 4 * len(fields) + 1, 2)]), F.lit(" "))
    object_of = [F.lit("\x01".join(["{", *[":", ","] * keys, ":", "}"])) for keys in range(len(fields))]
    n_keys = sum((p % 4 == 2).cast("int") for p in at)
    fits = (F.size("_cut") == n_keys * 4 + 1) & (signs == F.get(F.array(*object_of), n_keys - 1))
    valued = with_once(placed, "_got", F.struct(fits.alias("fits"), *values))
    is_read = F.col("_got.fits")
    for i, field in enumerate(fields):
        if not isinstance(field.dataType, StringType):
            is_read = is_read & ((at[i] % 4 != 2) | F.col(f"_got.v{i}").isNotNull())
    typed = [F.col(f"_got.v{i}").alias(f.name) for i, f in enumerate(fields)]
    plain = F.when(is_read, F.struct(*typed, F.lit(None).cast("string").alias(_BAD)))
    return with_once(valued, "_plain", plain).drop("_cut", "_at", "_got")


def _with_struct(lines: DataFrame, schema: str) -> DataFrame:
    """``lines`` with the typed struct ``d``, null for a line that is no JSON or has a key twice.

    It is made in steps that a later test cannot be pushed below: there it would be made
    again, with all that makes the lines, before these are dealt to many tasks.
    """
    parsed = F.from_json("value", schema.removesuffix(">") + f",{_BAD}:string>", {"columnNameOfCorruptRecord": _BAD})
    parsed = F.when(F.try_parse_json("value").isNotNull(), parsed)
    fields = StructType.fromDDL(schema).fields
    if any(f.dataType.simpleString() not in ("string", "timestamp") for f in fields):
        return with_once(lines, "d", parsed)
    return with_once(_cut_struct(lines, fields), "d", F.coalesce("_plain", parsed)).drop("_plain")


def parse_docs(lines: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(documents, rejects) of ``value`` lines.

    Documents have the typed struct ``d`` and, computed only where it is used, the whole
    document as VARIANT ``doc``.  A line that is not JSON (also with a key given twice or
    quotes of another kind), or whose values do not fit the kind's types, goes to the
    rejects; one parse serves both.
    """
    parsed = _with_struct(lines, SCHEMAS[kind])
    is_bad = F.col(f"d.{_BAD}").isNotNull() | F.col("d").isNull()
    docs = parsed.filter(~is_bad).withColumn("doc", F.try_parse_json("value")).drop("value")
    return docs, rejected(parsed.filter(is_bad), kind, "not a document of this kind")
