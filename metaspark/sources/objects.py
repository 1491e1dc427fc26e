"""Object listings and single-file schema scans."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from .listing import walk_objects
from .pyfs import open_filesystem

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOOTER_SCHEMA = (
    "path string, format string, position int, column_name string, "
    "type_string string, is_nullable boolean, error string"
)


def list_objects(spark: SparkSession, root: str) -> DataFrame:
    """Files under ``root`` with size and time; file contents are never read.

    Spark's own parallel listing, whose index lives on the driver: meant for up to some
    millions of objects.  Use ``walk_objects`` or a landed inventory table beyond that.
    """
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return scan.select("path", "length", F.col("modificationTime").alias("modification_time"))


def visible_files(spark: SparkSession, root: str) -> DataFrame:
    """The files below ``root`` that ``list_objects`` gives, listed in tasks: no file or folder
    whose name begins with a dot or an underscore."""
    walked = walk_objects(spark, root).filter("is_file")
    below = F.substring(F.col("path"), len(root.rstrip("/")) + 1, 1 << 30)
    return walked.filter(~below.rlike(r"/[._][^/]*")).select("path", "length", "modification_time")


def describe_objects(listing: DataFrame, mode: str = "suffix") -> DataFrame:
    """Add base name, parent folder and format to a listing."""
    plain = paths.strip_protocol(F.col("path"))
    return (
        listing.withColumn("base_name", paths.base_name(plain))
        .withColumn("parent", paths.parent_path(plain))
        .withColumn("format", paths.file_format(F.col("base_name"), mode))
        .filter(F.col("base_name") != "")
    )


def scan_schemas(objects: DataFrame) -> DataFrame:
    """One row per column of every file, from its footer or header only.

    Needs ``path`` and ``format``; filter the listing first, because a filter cannot be
    pushed through the Python scan.  A file whose schema cannot be read gives one row
    with format ``unknown``, no column and the reason.  Work is split the way ``objects``
    is partitioned: a ``list_objects`` scan packs at most a few dozen files per task.
    """

    def read_schemas(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.csv as pacsv
        import pyarrow.dataset as pads

        tab = pads.CsvFileFormat(pacsv.ParseOptions(delimiter="\t"))
        for batch in batches:
            rows = []
            for path, fmt in zip(batch["path"], batch["format"]):
                try:
                    filesystem, inner = open_filesystem(path)
                    reader = tab if fmt == "tsv" else fmt
                    schema = pads.dataset(inner, format=reader, filesystem=filesystem).schema
                    rows += [
                        (path, fmt, i, f.name, str(f.type), bool(f.nullable), None) for i, f in enumerate(schema)
                    ]
                except Exception as problem:  # any unreadable object becomes an "unknown" file
                    rows.append((path, "unknown", None, None, None, None, str(problem)))
            yield pd.DataFrame(
                rows,
                columns=["path", "format", "position", "column_name", "type_string", "is_nullable", "error"],
            ).astype({"position": "Int32"})

    return objects.select("path", "format").mapInPandas(read_schemas, FOOTER_SCHEMA)
