"""What changed between two collections, found by comparing digests of a hash tree.

A collection is written in folders by the first hexadecimal digits of a digest of its keys (the
leaves), beside one digest for each prefix, from all rows down to the leaves.  Two collections
are compared from the root on: only prefixes whose digests differ are opened, so unchanged
parts of the tree cost nothing, and only leaves that differ have their rows read and joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEPTH = 2  # hexadecimal digits of a leaf: 16 ** DEPTH leaves
LEAF = "_leaf"
PRINT = "_print"


def key_digest(keys: list[str]) -> Column:
    parts = [F.coalesce(F.concat(F.lit("="), F.base64(F.col(k).cast("string").cast("binary"))), F.lit("-")) for k in keys]
    return F.md5(F.concat_ws(" ", *parts))


def row_print(columns: list[str]) -> Column:
    """A 64-bit digest of the named columns; nulls count."""
    marks = [F.col(c).isNull() for c in columns]
    return F.xxhash64(*marks, *[F.to_json(F.struct(F.col(c))) for c in columns])


def write_snapshot(rows: DataFrame, folder: str, keys: list[str], depth: int = DEPTH) -> None:
    """Write a collection with one row per key, and the digests of its prefixes.

    A prefix's digest adds up its rows' digests, so it is made by partial sums in any order.
    """
    spark = rows.sparkSession
    columns = sorted(c for c in rows.columns if c not in keys)
    placed = rows.withColumn(LEAF, F.substring(key_digest(keys), 1, depth)).withColumn(PRINT, row_print([*keys, *columns]))
    placed.drop(LEAF).limit(0).coalesce(1).write.mode("overwrite").parquet(f"{folder}/schema")
    placed.hint("rebalance", LEAF).write.mode("overwrite").partitionBy(LEAF).parquet(f"{folder}/rows")
    stored = spark.read.schema(f"{PRINT} long, {LEAF} string").parquet(f"{folder}/rows")
    leaves = stored.groupBy(LEAF).agg(_sum(F.col(PRINT)), F.count("*").alias("n"))
    levels = leaves.withColumn("prefix", F.explode(F.transform(F.sequence(F.lit(0), F.lit(depth)), lambda k: F.substring(LEAF, F.lit(1), k))))
    tree = levels.groupBy("prefix").agg(_sum(F.col("digest")), F.sum("n").alias("n"))
    tree.withColumn("level", F.length("prefix")).coalesce(1).write.mode("overwrite").partitionBy("level").parquet(f"{folder}/digests")


def _sum(values: Column) -> Column:
    """The sum of 64-bit values modulo 2^64, from exact sums of their halves."""
    low = F.sum(values.bitwiseAND(F.lit((1 << 32) - 1)))
    high = F.sum(F.shiftright(values, 32))
    carried = (high + F.shiftright(low, 32)).bitwiseAND(F.lit((1 << 32) - 1))
    return F.shiftleft(carried, 32).bitwiseOR(low.bitwiseAND(F.lit((1 << 32) - 1))).alias("digest")


def changed_leaves(spark: SparkSession, before: str, after: str, depth: int = DEPTH) -> list[str]:
    """Leaves whose rows differ, found level by level; at most 16 ** depth prefixes reach the driver."""
    open_prefixes = [""]
    for level in range(depth + 1):
        def digests(folder: str) -> DataFrame:
            tree = spark.read.schema("prefix string, digest long, n long, level int").parquet(f"{folder}/digests")
            inside = F.substring("prefix", 1, max(0, level - 1)).isin(open_prefixes)
            return tree.filter((F.col("level") == level) & inside).select("prefix", "digest", "n")

        old, new = digests(before), digests(after).withColumnsRenamed({"digest": "digest_2", "n": "n_2"})
        unlike = ~(F.col("digest").eqNullSafe(F.col("digest_2")) & F.col("n").eqNullSafe(F.col("n_2")))
        open_prefixes = [r["prefix"] for r in old.join(new, "prefix", "full").filter(unlike).select("prefix").collect()]
        if not open_prefixes:
            return []
    return sorted(open_prefixes)


def changes(spark: SparkSession, before: str, after: str, keys: list[str], depth: int = DEPTH) -> DataFrame:
    """The rows of two snapshots that differ, with ``change``: ``added`` and ``changed`` rows as they are
    after, ``removed`` rows as they were before.  Only folders of differing leaves are read."""
    leaves = changed_leaves(spark, before, after, depth)

    def rows(folder: str) -> DataFrame:
        # The schema is given, so that a leaf is a text whatever its digits, and an empty collection can be read.
        schema = spark.read.parquet(f"{folder}/schema").schema.add(LEAF, "string")
        return spark.read.schema(schema).parquet(f"{folder}/rows").filter(F.col(LEAF).isin(leaves))

    old, new = rows(before), rows(after)
    named = [F.col(k).alias(f"_old_{k}") for k in keys]
    was = old.select(*named, F.col(PRINT).alias("_was"), F.struct(*[c for c in old.columns if c not in (LEAF, PRINT)]).alias("_old"))
    now = new.select(*keys, F.col(PRINT).alias("_now"), F.struct(*[c for c in new.columns if c not in (LEAF, PRINT)]).alias("_new"))
    same_key = [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in keys]
    both = now.join(was, same_key, "full").filter(~F.col("_was").eqNullSafe(F.col("_now")))
    change = F.when(F.col("_was").isNull(), "added").when(F.col("_now").isNull(), "removed").otherwise("changed")
    columns = [c for c in new.columns if c not in (LEAF, PRINT)]
    kept = [F.coalesce(F.col(f"_new.`{c}`"), F.col(f"_old.`{c}`")) if c in keys else F.when(F.col("_now").isNotNull(), F.col(f"_new.`{c}`")).otherwise(F.col(f"_old.`{c}`")) for c in columns]
    return both.select(change.alias("change"), *[k.alias(c) for k, c in zip(kept, columns)])
