"""Numbering rows of a distributed table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metaspark.session import cut_lineage


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their place (from 0) in the given order as the column ``name``.

    Rows are range-partitioned and written; each partition numbers its own rows after the
    counts of the partitions before it, of which there are as many as shuffle partitions.
    """
    dealt = cut_lineage(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(W.partitionBy("_part").orderBy(*order)) - 1
    return (
        dealt.join(F.broadcast(starts), "_part")
        .withColumn(name, (F.col("_start") + place).cast("long"))
        .drop("_part", "_start")
    )
