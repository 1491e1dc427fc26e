"""All entities in one table: union and sink."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; a column a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_catalog(rows: DataFrame, path: str, by: str = "source_rn") -> None:
    """One folder per source; only the sources in ``rows`` are replaced.

    The rebalance hint lets Spark split a source that holds a large share of the rows
    and merge small ones, so file sizes stay even without a salt.
    """
    (
        rows.hint("rebalance", by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
