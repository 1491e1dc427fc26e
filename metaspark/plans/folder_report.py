"""What is in this folder: every field of every dataset, with type and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import base_name, file_format
from ..functions.text import allowed
from ..operators.type_lattice import merge_types
from ..operators.type_tree import field_rows
from ..sources.objects import scan_schemas, visible_files


def dataset_of(path: Column, root: str) -> Column:
    """First path segment below ``root`` without its suffix: a table file or its folder."""
    below = F.substring_index(path, root.rstrip("/").split("://")[-1].lstrip("/") + "/", -1)
    return F.regexp_replace(F.substring_index(below, "/", 1), r"\.[A-Za-z0-9]+$", "")


def folder_columns(spark: SparkSession, root: str, exclude: list[str] | None = None) -> DataFrame:
    """Column definitions of the datasets below ``root``, from file footers: one for each column of a dataset.

    A column that files store in different types has their least common one; where there is
    none it is of type unknown and ``conflicts`` names them.  Files whose name one of the
    ``exclude`` patterns is found in are left out.
    """
    listed = visible_files(spark, root)
    visible = listed.filter(allowed(base_name(F.col("path")), exclude=exclude))
    scanned = scan_schemas(visible.withColumn("format", file_format(F.col("path"))))
    columns = scanned.filter(F.col("column_name").isNotNull()).select(
        dataset_of(F.col("path"), root).alias("entity_rn"), "column_name", "position", "type_string"
    )
    return merge_types(columns).select(
        "entity_rn",
        F.concat_ws("/", "entity_rn", F.lit("columns"), "column_name").alias("column_rn"),
        "position",
        "column_name",
        F.lit("arrow").alias("dialect"),
        "type_string",
        F.lit(True).alias("is_nullable"),
        F.lit(None).cast("string").alias("description"),
        "conflicts",
    )


def folder_report(spark: SparkSession, root: str, exclude: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(fields, rejects) of the datasets below ``root``; a reject names the types that have no common one."""
    columns = folder_columns(spark, root, exclude)
    fields, rejects = field_rows(columns.drop("conflicts"))
    unlike = columns.select("column_rn", F.explode("conflicts").alias("what")).select(
        F.lit("fields").alias("job"),
        F.concat("column_rn", F.when(F.substring_index("what", ": ", 1) != "/", F.substring_index("what", ": ", 1)).otherwise(F.lit(""))).alias("key"),
        F.concat(F.lit("types without a common one: "), F.regexp_replace("what", "^[^:]*: ", "")).alias("reason"),
    )
    return fields, rejects.unionByName(unlike)


def folder_fields(spark: SparkSession, root: str, exclude: list[str] | None = None) -> DataFrame:
    fields, _ = folder_report(spark, root, exclude)
    return fields
