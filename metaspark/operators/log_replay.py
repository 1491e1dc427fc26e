"""Transaction-log replay: live files, totals, last metadata and table fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.txlog import record_count
from .joins import by_key


def vector_id(vector: Column) -> Column:
    """What tells the deletion vectors of one file apart; null without one."""
    place = F.when(vector["offset"].isNotNull(), F.concat(F.lit("@"), vector["offset"].cast("string"))).otherwise(F.lit(""))
    return F.concat(vector["storageType"], vector["pathOrInlineDv"], place)


def file_actions(actions: DataFrame) -> DataFrame:
    """Adds and removes with what a replay keeps of them.

    ``vector`` is part of a file's key: a file whose rows are deleted is removed without (or
    with an older) vector and added with a new one.  ``num_records`` are the rows that the
    vector leaves.
    """
    is_add = F.col("add").isNotNull()
    deleted = F.coalesce(F.col("add.deletionVector.cardinality"), F.lit(0))
    return actions.filter(is_add | F.col("remove").isNotNull()).select(
        "root",
        F.coalesce("add.path", "remove.path").alias("path"),
        F.when(is_add, vector_id(F.col("add.deletionVector"))).otherwise(vector_id(F.col("remove.deletionVector"))).alias("vector"),
        # odd for an add: within one commit a re-added path is live
        (F.col("version") * 2 + is_add.cast("bigint")).alias("at"),
        F.col("add.size").alias("size_bytes"),
        (record_count(F.col("add.stats")) - deleted).alias("num_records"),
        F.timestamp_millis("add.modificationTime").alias("modified_at"),
    )


STATE = ["size_bytes", "num_records", "modified_at"]


def last_files(files: DataFrame) -> DataFrame:
    """The files that the last of their actions added.

    It is chosen by ``max_by`` over numbers: a hash aggregate that combines before the
    shuffle, so neither a hot table nor a hot path lands in one task unreduced.
    """
    last = files.groupBy("root", "path", "vector").agg(F.max("at").alias("at"), *[F.max_by(c, "at").alias(c) for c in STATE])
    return last.filter(F.col("at") % 2 == 1)


def live_files(actions: DataFrame, as_of: int | None = None) -> DataFrame:
    """Files of each table, with the rows their deletion vectors leave, as the last action on each left them."""
    if as_of is not None:
        actions = actions.filter(F.col("version") <= as_of)
    return last_files(file_actions(actions)).select("root", "path", *STATE)


def log_totals(files: DataFrame) -> DataFrame:
    """Size, rows and last change per table; rows are null if any file has no count."""
    return files.groupBy("root").agg(
        F.count("*").alias("num_files"),
        F.sum("size_bytes").alias("size_bytes"),
        F.when(F.count("*") == F.count("num_records"), F.sum("num_records")).alias("num_records"),
        F.max("modified_at").alias("modified_at"),
    )


def log_metadata(actions: DataFrame, as_of: int | None = None) -> DataFrame:
    """The last metadata action of every table."""
    if as_of is not None:
        actions = actions.filter(F.col("version") <= as_of)
    last = (
        actions.filter(F.col("metaData").isNotNull())
        .groupBy("root")
        .agg(F.max_by("metaData", F.struct("version", F.to_json("metaData"))).alias("m"))
    )
    return last.select(
        "root",
        F.col("m.id").alias("table_id"),
        F.col("m.name").alias("name"),
        F.col("m.description").alias("description"),
        F.array_join("m.partitionColumns", ",").alias("partition_columns"),
        F.col("m.configuration").alias("configuration"),
        F.timestamp_millis("m.createdTime").alias("created_at"),
        F.col("m.schemaString").alias("schema_string"),
    )


def log_columns(metadata: DataFrame) -> DataFrame:
    """Column definitions from each table's schema text, ready for the type flattening."""
    schema = "struct<fields:array<struct<name:string,type:string,nullable:boolean,metadata:map<string,string>>>>"
    fields = F.from_json("schema_string", schema)["fields"]
    return metadata.select("root", F.posexplode(fields)).select(
        "root",
        F.col("pos").alias("position"),
        F.col("col.name").alias("column_name"),
        F.lit("delta").alias("dialect"),
        F.col("col.type").alias("type_string"),
        F.col("col.nullable").alias("is_nullable"),
        F.col("col.metadata")["comment"].alias("description"),
    )


def log_tables(actions: DataFrame) -> DataFrame:
    """One row per table: metadata joined with totals (totals null for an empty table)."""
    return log_metadata(actions).join(by_key(log_totals(live_files(actions))), "root", "left")
