"""Session helpers shared by jobs, tests and the bench."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are designed for.  Broadcasts are left to Spark's own size
# check (autoBroadcastJoinThreshold + AQE runtime sizes); skewed equi-joins are
# split by AQE.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "metaspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or where a session has none
    (a test) a folder in its warehouse, which is shared as well."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured is None:
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder for a table this run writes."""
    return f"{shared_dir(spark).rstrip('/')}/metaspark/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably: survives executor loss, unlike local checkpoints."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
