"""A folder read as one dataset, with its partition columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TEXT_FORMATS = {"csv": ",", "tsv": "\t"}


def _reader(spark: SparkSession, file_format: str):
    if file_format in _TEXT_FORMATS:
        return spark.read.format("csv").option("header", True).option("sep", _TEXT_FORMATS[file_format])
    return spark.read.format(file_format)


def read_folder(
    spark: SparkSession,
    folder: str,
    file_format: str,
    flavor: str = "hive",
    field_names: list[str] | None = None,
) -> DataFrame:
    """``hive``: ``key=value`` folders, discovered and pruned by Spark.

    ``directory``: the n-th folder level below ``folder`` is the value of
    ``field_names[n]``; levels that are absent give null.
    """
    if flavor == "hive":
        return _reader(spark, file_format).option("basePath", folder).load(folder)
    if flavor != "directory" or not field_names:
        raise ValueError("directory partitioning needs field_names")
    data = _reader(spark, file_format).option("recursiveFileLookup", True).load(folder)
    marker = folder.rstrip("/").split("://")[-1].lstrip("/")
    below = F.substring_index(F.col("_metadata.file_path"), marker + "/", -1)
    levels = F.split(below, "/")
    named = {
        name: F.when(F.size(levels) > i + 1, F.try_element_at(levels, F.lit(i + 1)))
        for i, name in enumerate(field_names)
    }
    return data.select("*", *[level.alias(name) for name, level in named.items()])


def folder_fields(dataset: DataFrame) -> DataFrame:
    """Name, position, type text and nullability of a folder dataset's columns."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(dataset.schema)]
    return dataset.sparkSession.createDataFrame(
        rows, "position int, column_name string, type_string string, is_nullable boolean"
    )
