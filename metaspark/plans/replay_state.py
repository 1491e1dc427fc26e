"""Log replay that goes on from where the last one stopped.

The live files of all tables, with the version they are of, are kept in a folder, one numbered
sub-folder for each replay.  The next replay opens only commits after those versions.  A
table whose commits do not follow on without a gap (its log was cleaned up beyond a
checkpoint meanwhile), or that is new, is replayed from its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import log_replay as lr
from ..sources import txlog

FILES = "root string, path string, vector string, at long, size_bytes long, num_records long, modified_at timestamp"
HEADS = "root string, saved_version long"


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the replays that were completed in a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path):
        return []
    named = [status.getPath() for status in store.listStatus(path)]
    done = [p.getName() for p in named if store.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "heads/_SUCCESS"))]
    return sorted(int(n.removeprefix("replay=")) for n in done if n.startswith("replay="))


def saved_state(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(live files, versions) of the last replay; empty before the first."""
    numbers = _numbers(spark, folder)
    if not numbers:
        return spark.createDataFrame([], FILES), spark.createDataFrame([], HEADS)
    at = f"{folder.rstrip('/')}/replay={numbers[-1]}"
    return spark.read.schema(FILES).parquet(f"{at}/files"), spark.read.schema(HEADS).parquet(f"{at}/heads")


def replay(objects: DataFrame, folder: str) -> DataFrame:
    """Replay the logs in a listing on top of the state in ``folder``; returns the live files, which it has saved.

    Tables that are no longer listed keep their last state.
    """
    spark = objects.sparkSession
    files, heads = saved_state(spark, folder)
    commits = txlog.commit_versions(objects).join(heads, "root", "left").filter("saved_version IS NULL OR version > saved_version")
    newer = commits.groupBy("root").agg(
        F.max("version").alias("newest"), F.count("*").alias("n"), F.first("saved_version").alias("saved_version")
    )
    follows = newer.filter("newest - saved_version = n").select("root", "newest")
    checkpoints = txlog.checkpoint_files(objects).groupBy("root").agg(F.max("version").alias("saved"))
    # A table whose new commits leave a gap, or that has none saved, begins at its checkpoint.
    listed = newer.select("root").union(checkpoints.join(heads, "root", "left").filter("saved_version IS NULL OR saved > saved_version").select("root"))
    afresh = listed.distinct().join(follows, "root", "left_anti")

    root_of = objects.withColumn("_root", F.regexp_extract("path", txlog.LOG_FILE, 1))
    some = lambda roots: root_of.join(roots.select(F.col("root").alias("_root")), "_root", "left_semi").drop("_root")
    added = txlog.parse_actions(txlog.commit_lines(some(follows), heads))
    whole = txlog.read_actions(some(afresh))
    kept = files.join(afresh, "root", "left_anti")
    result = lr.last_files(kept.unionByName(lr.file_actions(added)).unionByName(lr.file_actions(whole)))

    versions = whole.groupBy("root").agg(F.max("version").alias("saved_version"))
    versions = versions.unionByName(follows.select("root", F.col("newest").alias("saved_version")))
    versions = versions.unionByName(heads.join(versions.select("root"), "root", "left_anti"))
    at = f"{folder.rstrip('/')}/replay={(_numbers(spark, folder) or [-1])[-1] + 1}"
    result.select("root", "path", "vector", "at", *lr.STATE).write.mode("overwrite").parquet(f"{at}/files")
    versions.write.mode("overwrite").parquet(f"{at}/heads")
    return spark.read.schema(FILES).parquet(f"{at}/files").select("root", "path", *lr.STATE)
