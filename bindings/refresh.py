"""The whole catalog in one table, and its incremental refresh."""

from __future__ import annotations

from pyspark.sql import functions as F

from metaspark.operators.digest_tree import changes, write_snapshot
from metaspark.plans.catalog import read_catalog, union_all, write_catalog
from metaspark.session import scratch_path
from metaspark.streaming.keyed import keyed_refresh, keyed_state
from metaspark.streaming.refresh import current_state, refresh

from . import catalogs, consumers, jobs, logs, objects  # noqa: F401  (their queries are combined here)
from .registry import CHECK_SQL, QUERIES, query, table

_KINDS = [
    "catalog_tables", "owned_tables", "kv_tables", "job_entities", "task_entities", "queue_entities",
    "stream_entities", "feature_groups", "bi_entities", "object_entities", "experiment_entities",
    "experiment_tree", "artifact_entities", "log_table_entities",
]

@query("entity_union", " UNION ALL ".join(f"SELECT * FROM ({CHECK_SQL[k]})" for k in _KINDS))
def entity_union(spark, sf_dir):
    """All kinds of entities in one table."""
    return union_all(*[QUERIES[k](spark, sf_dir) for k in _KINDS])

@query("entity_sink", CHECK_SQL["entity_union"])
def entity_sink(spark, sf_dir):
    """The union written as one folder per source, as it is read back."""
    folder = scratch_path(spark, "catalog")
    write_catalog(entity_union(spark, sf_dir), folder)
    return read_catalog(spark, folder)

@query(
    "entity_latest_stream",
    """
SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(ts, event_id) AS ts,
       arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value
FROM events GROUP BY user_id""",
)
def entity_latest_stream(spark, sf_dir):
    """Events arrive as a file stream; the catalog keeps the newest row per user."""
    schema = table(spark, sf_dir, "events").schema
    # the pattern matches a single file as well as a folder of files
    arriving = (
        spark.readStream.schema(schema)
        .load(f"{sf_dir}/events.parque[t]", format="parquet")
        .select("user_id", "event_id", "ts", "event_type", "value")
    )
    target = scratch_path(spark, "latest")
    order = [F.col("event_id")]
    refresh(arriving, target, scratch_path(spark, "latest-offsets"), ["user_id"], order).awaitTermination()
    return current_state(spark, target, ["user_id"], order)


@query(
    "entity_changes",
    """
WITH old AS (SELECT * FROM orders WHERE o_orderkey % 97 <> 3),
new AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 89 = 5 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
  FROM orders WHERE o_orderkey % 101 <> 7)
SELECT CASE WHEN old.o_orderkey IS NULL THEN 'added' WHEN new.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change,
       coalesce(new.o_orderkey, old.o_orderkey) AS o_orderkey, coalesce(new.o_custkey, old.o_custkey) AS o_custkey,
       coalesce(new.o_orderstatus, old.o_orderstatus) AS o_orderstatus, coalesce(new.o_totalprice, old.o_totalprice) AS o_totalprice
FROM old FULL JOIN new ON old.o_orderkey = new.o_orderkey
WHERE old.o_orderkey IS NULL OR new.o_orderkey IS NULL OR old.o_orderstatus <> new.o_orderstatus""",
)
def entity_changes(spark, sf_dir):
    """Orders collected twice: which ones came, changed or went between the collections."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    key = F.col("o_orderkey")
    changed = F.when(key % 89 == 5, F.lit("X")).otherwise(F.col("o_orderstatus"))
    before, after = scratch_path(spark, "collected"), scratch_path(spark, "collected")
    write_snapshot(orders.filter(key % 97 != 3), before, ["o_orderkey"])
    write_snapshot(orders.withColumn("o_orderstatus", changed).filter(key % 101 != 7), after, ["o_orderkey"])
    return changes(spark, before, after, ["o_orderkey"])


@query(
    "entity_state_stream",
    """
SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value
FROM events GROUP BY user_id HAVING arg_max(event_type, event_id) <> 'error'""",
)
def entity_state_stream(spark, sf_dir):
    """Events as a stream into keyed state; a user whose last event is an error is deleted."""
    schema = table(spark, sf_dir, "events").schema
    arriving = (
        spark.readStream.schema(schema)
        .load(f"{sf_dir}/events.parque[t]", format="parquet")
        .select("user_id", "event_id", "event_type", "value", (F.col("event_type") == "error").alias("gone"))
    )
    state = scratch_path(spark, "keyed")
    keyed_refresh(arriving, state, ["user_id"], "event_id", "gone").awaitTermination()
    return keyed_state(spark, state)
