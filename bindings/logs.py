"""Transaction logs derived from the events and orders tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from metaspark.operators import log_replay as lr
from metaspark.operators.type_tree import field_rows
from metaspark.plans import entities as en
from metaspark.session import scratch_path
from metaspark.sources import txlog
from metaspark.sources.objects import walk_objects

from .registry import entity_sql, query, table, text, wall_clock


def _log_lines(spark, sf_dir):
    """One log per user, one action line per event: purchases and views add a file,
    errors remove it, sign-ups change the metadata, clicks are no action."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    add = F.struct(
        text("part-", k, ".parquet").alias("path"),
        F.floor(F.col("value") * 100).cast("bigint").alias("size"),
        millis.alias("modificationTime"),
        F.when(k % 10 != 0, F.to_json(F.struct(k.alias("numRecords")))).alias("stats"),
    )
    remove = F.struct(text("part-", k, ".parquet").alias("path"), millis.alias("deletionTimestamp"))
    nested = '{"type":"array","elementType":"integer","containsNull":true}'
    schema = text(
        '{"type":"struct","fields":[{"name":"id","type":"long","nullable":false,"metadata":{}},{"name":"f', k,
        f'","type":{nested},"nullable":true,"metadata":{{"comment":"note"}}}},'
        '{"name":"at","type":"timestamp","nullable":true,"metadata":{}}]}',
    )
    meta = F.struct(
        F.col("event_id").cast("string").alias("id"),
        text("t", F.col("user_id")).alias("name"),
        text("k=", k).alias("description"),
        F.when(k % 2 == 0, F.array(F.lit("d"))).otherwise(F.array(F.lit("d"), F.lit("e"))).alias("partitionColumns"),
        F.create_map(F.lit("k"), k.cast("string")).alias("configuration"),
        millis.alias("createdTime"),
        schema.alias("schemaString"),
    )
    kind = F.col("event_type")
    action = F.struct(
        F.when(kind.isin("purchase", "view"), add).alias("add"),
        F.when(kind == "error", remove).alias("remove"),
        F.when(kind == "signup", meta).alias("metaData"),
        F.when(kind == "click", F.struct(F.lit("WRITE").alias("operation"))).alias("commitInfo"),
    )
    return table(spark, sf_dir, "events").select(
        text("s3://lake/users/", F.col("user_id")).alias("root"),
        F.col("event_id").alias("version"),
        F.to_json(action).alias("value"),
    )


_EVENTS = """
WITH e AS (SELECT *, CAST(props->>'k' AS BIGINT) AS k, 's3://lake/users/' || user_id AS root FROM events),
last AS (
  SELECT *, row_number() OVER (PARTITION BY root, k ORDER BY event_id DESC) AS rn
  FROM e WHERE event_type IN ('purchase', 'view', 'error')),
live AS (SELECT * FROM last WHERE rn = 1 AND event_type <> 'error'),
totals AS (
  SELECT root, count(*) AS num_files, CAST(sum(CAST(floor(value * 100) AS BIGINT)) AS BIGINT) AS size_bytes,
         CASE WHEN bool_and(k % 10 <> 0) THEN CAST(sum(k) AS BIGINT) END AS num_records,
         date_trunc('millisecond', max(ts)) AS modified_at
  FROM live GROUP BY root),
meta AS (
  SELECT root, arg_max(event_id, event_id) AS event_id, arg_max(user_id, event_id) AS user_id,
         arg_max(k, event_id) AS k, date_trunc('millisecond', arg_max(ts, event_id)) AS created_at
  FROM e WHERE event_type = 'signup' GROUP BY root)
"""


@query("log_replay_stats", _EVENTS + "SELECT * FROM totals")
def log_replay_stats(spark, sf_dir):
    actions = txlog.parse_actions(_log_lines(spark, sf_dir))
    return wall_clock(lr.log_totals(lr.live_files(actions)))


@query(
    "log_table_metadata",
    _EVENTS
    + """
SELECT root, CAST(event_id AS VARCHAR) AS table_id, 't' || user_id AS name, 'k=' || k AS description,
       CASE WHEN k % 2 = 0 THEN 'd' ELSE 'd,e' END AS partition_columns, CAST(k AS VARCHAR) AS configured_k, created_at
FROM meta""",
)
def log_table_metadata(spark, sf_dir):
    metadata = lr.log_metadata(txlog.parse_actions(_log_lines(spark, sf_dir)))
    return wall_clock(
        metadata.withColumn("configured_k", F.col("configuration")["k"]).drop("configuration", "schema_string")
    )


@query(
    "log_table_fields",
    _EVENTS
    + """
, f AS (
  SELECT root, 0 AS position, 0 AS ordinal, 'id' AS name, 'INTEGER' AS type, FALSE AS is_nullable, FALSE AS is_value,
         '/columns/id' AS rel, CAST(NULL AS VARCHAR) AS description FROM meta
  UNION ALL SELECT root, 1, 0, 'f' || k, 'LIST', TRUE, FALSE, '/columns/f' || k, 'note' FROM meta
  UNION ALL SELECT root, 1, 1, 'integer', 'INTEGER', TRUE, TRUE, '/columns/f' || k || '/values/integer', NULL FROM meta
  UNION ALL SELECT root, 2, 0, 'at', 'TIME', TRUE, FALSE, '/columns/at', NULL FROM meta)
SELECT root || rel AS field_rn, CAST(position AS INTEGER) AS position, CAST(ordinal AS INTEGER) AS ordinal, name, type,
       is_nullable, is_value, description FROM f""",
)
def log_table_fields(spark, sf_dir):
    """Fields from the schema text in each log's last metadata."""
    columns = lr.log_columns(lr.log_metadata(txlog.parse_actions(_log_lines(spark, sf_dir))))
    fields, _ = field_rows(
        columns.withColumnRenamed("root", "entity_rn").withColumn(
            "column_rn", F.concat_ws("/", "entity_rn", F.lit("columns"), "column_name")
        )
    )
    return fields.select("field_rn", "position", "ordinal", "name", "type", "is_nullable", "is_value", "description")


@query(
    "log_table_entities",
    _EVENTS
    + entity_sql(
        "FROM meta LEFT JOIN totals USING (root)",
        entity_rn="'//s3/cloud/aws/buckets/lake/keys/users/' || user_id",
        source_rn="'//s3/cloud/aws/buckets/lake'",
        name="'users/' || user_id",
        entity_type="'TABLE'",
        created_at="created_at",
        updated_at="modified_at",
        rows_number="num_records",
    ),
)
def log_table_entities(spark, sf_dir):
    return wall_clock(en.log_table_entities(lr.log_tables(txlog.parse_actions(_log_lines(spark, sf_dir)))))


@query(
    "log_table_discovery",
    """
WITH p AS (
  SELECT DISTINCT 'lake/c' || o_custkey || CASE WHEN o_orderkey % 3 = 0 THEN '/tmp_' || o_orderstatus ELSE '' END
         || CASE WHEN o_orderkey % 5 = 0 THEN '/s' || o_orderpriority ELSE '' END AS root
  FROM orders WHERE o_orderkey % 4 <> 1),
allowed AS (SELECT root FROM p WHERE NOT regexp_matches(root, 'tmp_F'))
SELECT root FROM allowed a
WHERE NOT EXISTS (SELECT 1 FROM allowed b WHERE starts_with(a.root, b.root || '/'))""",
)
def log_table_discovery(spark, sf_dir):
    """Commit paths from the orders: every customer folder may hold tables at three depths,
    a quarter of the paths are data files, one folder name is excluded."""
    key = F.col("o_orderkey")
    root = text(
        "lake/c", F.col("o_custkey"),
        F.when(key % 3 == 0, text("/tmp_", F.col("o_orderstatus"))).otherwise(F.lit("")),
        F.when(key % 5 == 0, text("/s", F.col("o_orderpriority"))).otherwise(F.lit("")),
    )
    commit = text(root, "/_delta_log/", F.lpad(key.cast("string"), 20, "0"), ".json")
    data = text(root, "/part-", key, ".parquet")
    listing = table(spark, sf_dir, "orders").select(F.when(key % 4 == 1, data).otherwise(commit).alias("path"))
    return txlog.discover_tables(listing, start="lake", exclude=["tmp_F"])


_ROOTS, _COMMIT_EVENTS = 16, 2000

_FILE_EVENTS = f"""
WITH e AS (
  SELECT *, CAST(props->>'k' AS BIGINT) AS k, user_id % {_ROOTS} AS root, event_id // {_COMMIT_EVENTS} AS version
  FROM events WHERE event_type IN ('purchase', 'view', 'error')),
last AS (SELECT *, row_number() OVER (PARTITION BY root, k ORDER BY event_id DESC) AS rn FROM e),
live AS (SELECT * FROM last WHERE rn = 1 AND event_type <> 'error')
"""


def _write_logs(spark, sf_dir):
    """A folder of log tables: every event is an action, some thousand events a commit.

    Per commit and path only the last action is written, as the format asks.
    """
    import os

    import pandas as pd

    from metaspark.sources.pyfs import open_filesystem

    folder = scratch_path(spark, "logs")
    events = table(spark, sf_dir, "events").filter(F.col("event_type").isin("purchase", "view", "error"))
    k = F.get_json_object("props", "$.k").cast("bigint")
    last = events.groupBy(
        (F.col("user_id") % _ROOTS).alias("root"), F.floor(F.col("event_id") / _COMMIT_EVENTS).alias("version"), k.alias("k")
    ).agg(F.max_by(F.struct("event_type", "value"), "event_id").alias("e"))
    path = text("part-", F.col("k"), ".parquet").alias("path")
    add = F.struct(path, F.floor(F.col("e.value") * 100).cast("bigint").alias("size"))
    action = F.struct(
        F.when(F.col("e.event_type") != "error", add).alias("add"),
        F.when(F.col("e.event_type") == "error", F.struct(path)).alias("remove"),
    )
    lines = last.select("root", "version", F.to_json(action).alias("value"))

    def write(rows: pd.DataFrame) -> pd.DataFrame:
        root, version = int(rows["root"].iloc[0]), int(rows["version"].iloc[0])
        filesystem, inner = open_filesystem(f"{folder}/{root}/_delta_log")
        filesystem.create_dir(inner, recursive=True)
        with filesystem.open_output_stream(os.path.join(inner, f"{version:020d}.json")) as out:
            out.write(("\n".join(rows["value"]) + "\n").encode())
        return pd.DataFrame({"lines": [len(rows)]})

    lines.groupBy("root", "version").applyInPandas(write, "lines long").agg(F.sum("lines")).collect()
    return folder


@query(
    "log_files_replay",
    _FILE_EVENTS
    + """
SELECT root, count(*) AS num_files, CAST(sum(CAST(floor(value * 100) AS BIGINT)) AS BIGINT) AS size_bytes FROM live GROUP BY root""",
)
def log_files_replay(spark, sf_dir):
    """Logs written as commit files to the shared folder, listed in tasks and read back."""
    actions = txlog.read_actions(walk_objects(spark, _write_logs(spark, sf_dir)))
    totals = lr.log_totals(lr.live_files(actions))
    root = F.regexp_extract("root", r"([0-9]+)$", 1).cast("bigint")
    return totals.select(root.alias("root"), "num_files", "size_bytes")
