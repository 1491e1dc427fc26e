"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaspark.session import cut_lineage

FEW_LINKS = 1 << 17


def components(links: DataFrame) -> DataFrame:
    """``node``, ``label`` (the component's smallest node) for every node in ``links`` (a, b).

    Alternates two steps until nothing changes: every node links its larger neighbours, then
    its smaller ones, to the smallest it knows.  A step is an aggregate and a join on nodes,
    so a hub is pre-aggregated and its join can be split; every step is written and read
    again from the shared folder.  At most ``FEW_LINKS`` links, a few megabytes however large
    the input is, take the same steps in one partition: nothing is shuffled, and a step leaves
    no file for each of many tasks.
    """
    edges = cut_lineage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    )
    few = edges.count() <= FEW_LINKS
    near = lambda df: df.coalesce(1) if few else df
    edges = near(edges)
    while True:
        both = near(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lowest, "u")
        small = near(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v"))))
        new = near(cut_lineage(small.filter("u <> v").distinct()))
        new_count, old_count = new.count(), edges.count()
        if new_count == old_count and new.join(edges, ["u", "v"], "left_anti").isEmpty():
            break
        edges = new
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label"))
    return near(edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)).distinct()
