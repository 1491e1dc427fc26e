"""Landed describe-documents of table catalogs, queues and streams -> entities and fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from metaspark.operators import metadata_kv as kv
from metaspark.operators.inventory import exclude_listed
from metaspark.operators.type_tree import field_rows
from metaspark.plans import entities as en
from metaspark.sources import dumps

from .registry import SCOPE, aws, doc_lines, entity_sql, query, table, text, wall_clock

# --- tables in catalogs of databases --------------------------------------------------


def _athena_lines(spark, sf_dir):
    """A customer is a table, its nation the database, its region the catalog."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    segment = F.col("c_mktsegment")
    kind = F.when(segment == "BUILDING", F.lit("EXTERNAL_TABLE")).when(segment == "MACHINERY", F.lit("VIRTUAL_VIEW"))
    key = F.col("c_custkey")

    def column(name, native, comment=None):
        return F.struct(F.lit(name).alias("Name"), native.alias("Type"), F.lit(comment).alias("Comment"))

    columns = F.array(
        column("id", F.lit("bigint"), "key"),
        column("tags", text("array<struct<k_", key % 7, ":string,v:decimal(10,", key % 9, ")>>")),
        column("misc", F.when(key % 10 == 0, F.lit("uniontype<int,string>")).otherwise(F.lit("date"))),
    )
    return doc_lines(
        joined,
        Catalog=F.col("r_name"),
        Database=F.col("n_name"),
        Name=F.col("c_name"),
        TableType=F.coalesce(kind, segment),
        CreateTime=F.lit("2022-03-04T05:06:07"),
        Columns=columns,
        Parameters=F.struct(
            text('["', key, '"]').alias("exclusions"), segment.alias("MarketSegment"),
            F.struct(key.alias("KeyValue")).alias("SerDeInfo"),
        ),
    )


_ATHENA = f"""
WITH c AS (
  SELECT c_custkey, c_name, c_mktsegment, n_name, r_name,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'TABLE' WHEN 'MACHINERY' THEN 'VIEW' ELSE 'UNKNOWN' END AS kind,
         '{aws("athena")}/catalogs/' || r_name || '/databases/' || n_name
           || CASE c_mktsegment WHEN 'MACHINERY' THEN '/views/' ELSE '/tables/' END || c_name AS rn
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


def _athena_docs(spark, sf_dir):
    docs, _ = dumps.parse_docs(_athena_lines(spark, sf_dir), "athena_table")
    return docs


@query(
    "catalog_tables",
    _ATHENA
    + entity_sql(
        "FROM c",
        entity_rn="rn",
        source_rn=f"'{aws('athena')}'",
        name="c_name",
        entity_type="kind",
        created_at="TIMESTAMP '2022-03-04 05:06:07'",
        rows_number="CAST(0 AS BIGINT)",
    ),
)
def catalog_tables(spark, sf_dir):
    return wall_clock(en.athena_entities(_athena_docs(spark, sf_dir), SCOPE))


@query(
    "catalog_fields",
    _ATHENA
    + """
, f AS (
  SELECT rn, '/columns/id' AS rel, 'id' AS name, 'NUMBER' AS type, 'bigint' AS logical_type, 'key' AS description FROM c
  UNION ALL SELECT rn, '/columns/tags', 'tags', 'LIST', 'list', NULL FROM c
  UNION ALL SELECT rn, '/columns/tags/subcolumns/struct', 'struct', 'STRUCT', 'struct', NULL FROM c
  UNION ALL SELECT rn, '/columns/tags/subcolumns/struct/subcolumns/k_' || c_custkey % 7, 'k_' || c_custkey % 7, 'STRING', 'string', NULL FROM c
  UNION ALL SELECT rn, '/columns/tags/subcolumns/struct/subcolumns/v', 'v', 'NUMBER', 'decimal(10, ' || c_custkey % 9 || ')', NULL FROM c
  UNION ALL SELECT rn, '/columns/misc', 'misc', 'DATETIME', 'date', NULL FROM c WHERE c_custkey % 10 <> 0)
SELECT rn AS entity_rn, rn || rel AS field_rn, name, type, logical_type, description FROM f""",
)
def catalog_fields(spark, sf_dir):
    fields, _ = field_rows(en.athena_columns(_athena_docs(spark, sf_dir), SCOPE))
    return fields.select("entity_rn", "field_rn", "name", "type", "logical_type", "description")


@query(
    "catalog_metadata",
    _ATHENA
    + """
SELECT rn AS entity_rn, 'athena.json#/definitions/AthenaDataSetExtension' AS schema_url, key_path, value FROM (
  SELECT rn, 'catalog' AS key_path, r_name AS value FROM c
  UNION ALL SELECT rn, 'database', n_name FROM c
  UNION ALL SELECT rn, 'parameters.exclusions', '["' || c_custkey || '"]' FROM c
  UNION ALL SELECT rn, 'parameters.market_segment', c_mktsegment FROM c
  UNION ALL SELECT rn, 'parameters.ser_de_info.key_value', CAST(c_custkey AS VARCHAR) FROM c)""",
)
def catalog_metadata(spark, sf_dir):
    """All keys of the documents but the four that are entity columns."""
    docs = _athena_docs(spark, sf_dir).select(en.athena_rn(SCOPE).alias("entity_rn"), "doc")
    return kv.metadata_of(docs, "athena_table")


# --- tables with owners and descriptions -----------------------------------------------


def _glue_docs(spark, sf_dir):
    """Suppliers as tables; every third has no owner."""
    key = F.col("s_suppkey")
    lines = doc_lines(
        table(spark, sf_dir, "supplier"),
        DatabaseName=text("db", F.col("s_nationkey")),
        Name=F.col("s_name"),
        Owner=F.when(key % 3 != 0, text("owner", key % 11)),
        Description=text("balance ", F.floor("s_acctbal")),
        CreateTime=F.lit("2021-01-01T00:00:00"),
        UpdateTime=F.lit("2021-06-01T12:00:00"),
        StorageDescriptor=F.struct(
            F.array(
                F.struct(F.lit("id").alias("Name"), F.lit("int").alias("Type"), F.lit(None).cast("string").alias("Comment")),
                F.struct(
                    F.lit("m").alias("Name"), text("map<string,varchar(", key % 30, ")>").alias("Type"),
                    F.lit("pairs").alias("Comment"),
                ),
            ).alias("Columns"),
            text("s3://lake/", key).alias("Location"),
        ),
    )
    # the service answers in pages: gather every document as a one-element page
    pages = lines.select(F.concat(F.lit('{"TableList":['), "value", F.lit("]}")).alias("value"))
    docs, _ = dumps.parse_docs(dumps.open_pages(pages, "glue_table")[0], "glue_table")
    return docs


_GLUE = f"WITH s AS (SELECT *, '{aws('glue')}/databases/db' || s_nationkey || '/tables/' || s_name AS rn FROM supplier)\n"


@query(
    "owned_tables",
    _GLUE
    + entity_sql(
        "FROM s",
        entity_rn="rn",
        source_rn=f"'{aws('glue')}'",
        name="s_name",
        entity_type="'TABLE'",
        owner_rn=f"CASE WHEN s_suppkey % 3 <> 0 THEN '{aws('glue')}/owners/owner' || s_suppkey % 11 END",
        description="'balance ' || CAST(floor(s_acctbal) AS BIGINT)",
        created_at="TIMESTAMP '2021-01-01 00:00:00'",
        updated_at="TIMESTAMP '2021-06-01 12:00:00'",
        rows_number="CAST(0 AS BIGINT)",
    ),
)
def owned_tables(spark, sf_dir):
    return wall_clock(en.glue_entities(_glue_docs(spark, sf_dir), SCOPE))


@query(
    "owned_table_fields",
    _GLUE
    + """
SELECT rn || rel AS field_rn, name, type, logical_type, is_key, is_value FROM (
  SELECT rn, '/columns/id' AS rel, 'id' AS name, 'INTEGER' AS type, 'int' AS logical_type, FALSE AS is_key, FALSE AS is_value FROM s
  UNION ALL SELECT rn, '/columns/m', 'm', 'MAP', 'map', FALSE, FALSE FROM s
  UNION ALL SELECT rn, '/columns/m/keys/string', 'string', 'STRING', 'string', TRUE, FALSE FROM s
  UNION ALL SELECT rn, '/columns/m/values/varchar', 'varchar', 'STRING', 'varchar(' || s_suppkey % 30 || ')', FALSE, TRUE FROM s)""",
)
def owned_table_fields(spark, sf_dir):
    fields, _ = field_rows(en.glue_columns(_glue_docs(spark, sf_dir), SCOPE))
    return fields.select("field_rn", "name", "type", "logical_type", "is_key", "is_value")


@query(
    "catalog_field_stats",
    _GLUE
    + """
, f AS (
  SELECT s_suppkey, s_nationkey, rn || rel AS field_rn, name, type FROM (
  SELECT *, '/columns/id' AS rel, 'id' AS name, 'INTEGER' AS type FROM s
  UNION ALL SELECT *, '/columns/m', 'm', 'MAP' FROM s
  UNION ALL SELECT *, '/columns/m/keys/string', 'string', 'STRING' FROM s
  UNION ALL SELECT *, '/columns/m/values/varchar', 'varchar', 'STRING' FROM s)),
r AS (SELECT *, name = 'id' AND s_suppkey % 4 <> 1 AS told FROM f)
SELECT field_rn, name, type, CASE WHEN told THEN 'number' END AS kind,
       CASE WHEN told THEN CAST(s_suppkey + CASE WHEN s_suppkey % 9 = 0 THEN 1000 ELSE 0 END AS VARCHAR) END AS low_value,
       CASE WHEN told THEN CAST(s_suppkey + 5000 AS VARCHAR) END AS high_value,
       CASE WHEN told THEN CAST(s_suppkey % 5 AS BIGINT) END AS nulls_count,
       CASE WHEN told THEN CAST(s_nationkey AS BIGINT) END AS unique_count
FROM r""",
)
def catalog_field_stats(spark, sf_dir):
    """Fields of the tables with the statistics that their catalog reports; some tables have none, some two reports."""
    supplier = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("bigint")

    def reports(rows, low, at):
        numbers = F.struct(low.alias("MinimumValue"), (key + 5000).alias("MaximumValue"), (key % 5).alias("NumberOfNulls"), F.col("s_nationkey").cast("bigint").alias("NumberOfDistinctValues"))
        data = F.struct(F.lit("LONG").alias("Type"), numbers.alias("LongColumnStatisticsData"))
        column = F.struct(F.lit("id").alias("ColumnName"), F.lit(at).alias("AnalyzedTime"), data.alias("StatisticsData"))
        return doc_lines(rows, DatabaseName=text("db", F.col("s_nationkey")), TableName=F.col("s_name"), ColumnStatisticsList=F.array(column))

    told = supplier.filter(key % 4 != 1)
    landed = reports(told, key, "2021-01-01T00:00:00Z").union(reports(told.filter(key % 9 == 0), key + 1000, "2021-02-01T00:00:00Z"))
    statistics, _ = en.glue_statistics(landed, SCOPE)
    joined = en.glue_field_stats(_glue_docs(spark, sf_dir), statistics, SCOPE)
    return joined.select("field_rn", "name", "type", "kind", "low_value", "high_value", "nulls_count", "unique_count")


# --- key-value tables -------------------------------------------------------------------


def _kv_docs(spark, sf_dir):
    """Parts as key-value tables."""
    attribute_type = F.element_at(F.array(*[F.lit(t) for t in "NSB"]), (F.col("p_partkey") % 3).cast("int") + 1)
    lines = doc_lines(
        table(spark, sf_dir, "part"),
        TableName=text("kv-", F.col("p_partkey")),
        ItemCount=F.col("p_size").cast("bigint"),
        CreationDateTime=F.lit("2020-02-02T02:02:02"),
        AttributeDefinitions=F.array(
            F.struct(F.lit("pk").alias("AttributeName"), F.lit("S").alias("AttributeType")),
            F.struct(F.lit("sk").alias("AttributeName"), attribute_type.alias("AttributeType")),
        ),
        KeySchema=F.array(
            F.struct(F.lit("pk").alias("AttributeName"), F.lit("HASH").alias("KeyType")),
            F.struct(F.lit("sk").alias("AttributeName"), F.col("p_brand").alias("KeyType")),
        ),
        ProvisionedThroughput=F.struct(F.col("p_size").alias("ReadCapacityUnits")),
    )
    docs, _ = dumps.parse_docs(lines, "kv_table")
    # a table that shares its number with a small-size part is on the exclusion list
    listed = (
        table(spark, sf_dir, "part").filter(F.col("p_size") == 1).select(text("kv-", F.col("p_partkey")).alias("name"))
    )
    return exclude_listed(docs.withColumn("name", F.col("d.TableName")), listed)


_KV = f"WITH k AS (SELECT *, '{aws('dynamodb')}/tables/kv-' || p_partkey AS rn FROM part WHERE p_size <> 1)\n"


@query(
    "kv_tables",
    _KV
    + entity_sql(
        "FROM k",
        entity_rn="rn",
        source_rn=f"'{aws('dynamodb')}'",
        name="'kv-' || p_partkey",
        entity_type="'TABLE'",
        created_at="TIMESTAMP '2020-02-02 02:02:02'",
        updated_at="TIMESTAMP '2020-02-02 02:02:02'",
        rows_number="CAST(p_size AS BIGINT)",
    ),
)
def kv_tables(spark, sf_dir):
    return wall_clock(en.kv_entities(_kv_docs(spark, sf_dir), SCOPE))


@query(
    "kv_table_fields",
    _KV
    + """
SELECT rn || '/columns/pk' AS field_rn, 'pk' AS name, 'STRING' AS type, 'S' AS logical_type, FALSE AS is_nullable FROM k
UNION ALL
SELECT rn || '/columns/sk', 'sk', CASE p_partkey % 3 WHEN 0 THEN 'NUMBER' WHEN 1 THEN 'STRING' ELSE 'BINARY' END,
       CASE p_partkey % 3 WHEN 0 THEN 'N' WHEN 1 THEN 'S' ELSE 'B' END, FALSE FROM k""",
)
def kv_table_fields(spark, sf_dir):
    fields = en.kv_fields(_kv_docs(spark, sf_dir), SCOPE)
    return fields.select("field_rn", "name", "type", "logical_type", "is_nullable")


@query(
    "kv_table_metadata",
    _KV
    + """
SELECT rn AS entity_rn, key_path, value FROM (
  SELECT rn, 'key_schema.0.attribute_name' AS key_path, 'pk' AS value FROM k
  UNION ALL SELECT rn, 'key_schema.0.key_type', 'HASH' FROM k
  UNION ALL SELECT rn, 'key_schema.1.attribute_name', 'sk' FROM k
  UNION ALL SELECT rn, 'key_schema.1.key_type', p_brand FROM k
  UNION ALL SELECT rn, 'provisioned_throughput.read_capacity_units', CAST(p_size AS VARCHAR) FROM k)""",
)
def kv_table_metadata(spark, sf_dir):
    """Lists of objects are descended into, with the position in the path."""
    docs = _kv_docs(spark, sf_dir).select(en.kv_rn(SCOPE).alias("entity_rn"), "doc")
    return kv.metadata_of(docs, "kv_table").select("entity_rn", "key_path", "value")


# --- queues and streams -----------------------------------------------------------------


def _queue_docs(spark, sf_dir):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    k = F.get_json_object("props", "$.k")
    attributes = F.create_map(
        F.lit("CreatedTimestamp"), seconds.cast("string"),
        F.lit("LastModifiedTimestamp"), (seconds + 60).cast("string"),
        F.lit("Policy"), F.lit("{}"),
        F.lit("VisibilityTimeout"), k,
        F.lit("QueueType"), F.col("event_type"),
    )
    # some queues have no policy at all
    attributes = F.when(F.col("event_id") % 2 == 0, attributes).otherwise(kv.drop_keys(attributes, ["Policy"]))
    lines = doc_lines(
        table(spark, sf_dir, "events"),
        QueueUrl=text("https://queues.example/acct/q-", F.col("event_id")),
        Attributes=attributes,
    )
    docs, _ = dumps.parse_docs(lines, "queue")
    return docs


_QUEUES = f"""
WITH q AS (SELECT *, '{aws("sqs")}/queue/q-' || event_id AS rn, date_trunc('second', ts) AS created FROM events)
"""


@query(
    "queue_attributes",
    _QUEUES
    + """
SELECT rn AS entity_rn, created AS created_at, created + INTERVAL 60 SECOND AS updated_at, key_path, value FROM (
  SELECT rn, created, 'VisibilityTimeout' AS key_path, props->>'k' AS value FROM q
  UNION ALL SELECT rn, created, 'QueueType', event_type FROM q
  UNION ALL SELECT rn, created, 'AccountID', '000000000000' FROM q)""",
)
def queue_attributes(spark, sf_dir):
    docs = _queue_docs(spark, sf_dir)
    rows = docs.select(
        en.queue_rn(SCOPE).alias("entity_rn"),
        F.timestamp_seconds(F.col("d.Attributes")["CreatedTimestamp"].cast("bigint")).alias("created_at"),
        F.timestamp_seconds(F.col("d.Attributes")["LastModifiedTimestamp"].cast("bigint")).alias("updated_at"),
        en.queue_attributes(F.col("d.Attributes"), SCOPE.account).alias("attributes"),
    )
    return wall_clock(kv.map_rows(rows, "attributes", ["entity_rn", "created_at", "updated_at"]))


@query(
    "queue_entities",
    _QUEUES
    + entity_sql(
        "FROM q",
        entity_rn="rn",
        source_rn=f"'{aws('sqs')}'",
        name="'q-' || event_id",
        entity_type="'KAFKA_TOPIC'",
        created_at="created",
        updated_at="created + INTERVAL 60 SECOND",
    ),
)
def queue_entities(spark, sf_dir):
    return wall_clock(en.queue_entities(_queue_docs(spark, sf_dir), SCOPE))


def _stream_docs(spark, sf_dir):
    lines = doc_lines(
        table(spark, sf_dir, "events"),
        StreamName=text("stream-", F.col("event_id")),
        StreamStatus=F.col("event_type"),
        Shards=F.struct(F.lit("hidden").alias("StreamName"), F.col("user_id").alias("OpenShardCount")),
    )
    docs, _ = dumps.parse_docs(lines, "stream")
    return docs


@query(
    "stream_entities",
    f"WITH s AS (SELECT *, '{aws('kinesis')}/streams/stream-' || event_id AS rn FROM events)\n"
    + entity_sql(
        "FROM s",
        entity_rn="rn",
        source_rn=f"'{aws('kinesis')}'",
        name="'stream-' || event_id",
        entity_type="'KAFKA_TOPIC'",
    ),
)
def stream_entities(spark, sf_dir):
    return wall_clock(en.stream_entities(_stream_docs(spark, sf_dir), SCOPE))


@query(
    "stream_metadata",
    """
SELECT event_id, 'StreamStatus' AS key_path, event_type AS value FROM events
UNION ALL SELECT event_id, 'Shards.OpenShardCount', CAST(user_id AS VARCHAR) FROM events""",
)
def stream_metadata(spark, sf_dir):
    """Keys stay as they are; a nested key is tested against the exclusions by its own name."""
    docs = _stream_docs(spark, sf_dir).select(F.split_part("d.StreamName", F.lit("-"), F.lit(2)).alias("entity_rn"), "doc")
    rows = kv.metadata_of(docs, "stream")
    return rows.select(F.col("entity_rn").cast("bigint").alias("event_id"), "key_path", "value")


# --- feature groups ----------------------------------------------------------------------


def _feature_docs(spark, sf_dir):
    kinds = F.array(*[F.lit(t) for t in ("Integral", "Fractional", "String")])
    lines = doc_lines(
        table(spark, sf_dir, "documents").select("doc_id", "lang", "source"),
        FeatureGroupName=text("fg-", F.col("doc_id")),
        CreationTime=F.lit("2023-01-02T03:04:05"),
        FeatureDefinitions=F.array(
            F.struct(
                F.col("lang").alias("FeatureName"),
                F.element_at(kinds, (F.col("doc_id") % 3).cast("int") + 1).alias("FeatureType"),
            ),
            F.struct(F.lit("source").alias("FeatureName"), F.lit("String").alias("FeatureType")),
        ),
    )
    docs, _ = dumps.parse_docs(lines, "feature_group")
    return docs


_FEATURE_SOURCE = "//aws/000000000000/region/eu-x/sagemaker/featurestore"


@query(
    "feature_groups",
    entity_sql(
        "FROM documents",
        entity_rn=f"'{_FEATURE_SOURCE}/feature_groups/fg-' || doc_id",
        source_rn=f"'{_FEATURE_SOURCE}'",
        name="'fg-' || doc_id",
        entity_type="'FEATURE_GROUP'",
        created_at="TIMESTAMP '2023-01-02 03:04:05'",
    ),
)
def feature_groups(spark, sf_dir):
    return wall_clock(en.feature_group_entities(_feature_docs(spark, sf_dir), SCOPE))


@query(
    "feature_fields",
    f"""
SELECT '{_FEATURE_SOURCE}/feature_groups/fg-' || doc_id || '/features/' || name AS field_rn, name, type, logical_type
FROM (
  SELECT doc_id, lang AS name, CASE doc_id % 3 WHEN 0 THEN 'INTEGER' WHEN 1 THEN 'NUMBER' ELSE 'STRING' END AS type,
         CASE doc_id % 3 WHEN 0 THEN 'Integral' WHEN 1 THEN 'Fractional' ELSE 'String' END AS logical_type FROM documents
  UNION ALL SELECT doc_id, 'source', 'STRING', 'String' FROM documents)""",
)
def feature_fields(spark, sf_dir):
    return en.feature_fields(_feature_docs(spark, sf_dir), SCOPE).select("field_rn", "name", "type", "logical_type")


# --- free-form documents ------------------------------------------------------------------


def _event_docs(spark, sf_dir):
    """Nested documents with a JSON-in-text value, lists and excluded keys."""
    return doc_lines(
        table(spark, sf_dir, "events"),
        Name=text("e", F.col("event_id")),
        EventId=F.col("event_id"),
        StorageDescriptor=F.struct(F.lit("hidden").alias("Columns"), F.col("event_type").alias("SerDeKind")),
        Parameters=F.struct(F.col("props").alias("exclusions"), F.col("user_id").alias("DataSetArnsID")),
        Tags=F.array(F.col("event_type"), F.lit("x")),
    ).select(F.try_variant_get(F.parse_json("value"), "$.Name", "string").alias("entity_rn"), F.parse_json("value").alias("doc"))


@query(
    "metadata_flatten",
    """
SELECT 'e' || event_id AS entity_rn, key_path, value FROM (
  SELECT event_id, 'event_id' AS key_path, CAST(event_id AS VARCHAR) AS value FROM events
  UNION ALL SELECT event_id, 'storage_descriptor.ser_de_kind', event_type FROM events
  UNION ALL SELECT event_id, 'parameters.exclusions.k', props->>'k' FROM events
  UNION ALL SELECT event_id, 'parameters.data_set_arns_id', CAST(user_id AS VARCHAR) FROM events
  UNION ALL SELECT event_id, 'tags', '["' || event_type || '","x"]' FROM events)""",
)
def metadata_flatten(spark, sf_dir):
    return kv.metadata_of(_event_docs(spark, sf_dir), "glue_table").select("entity_rn", "key_path", "value")


@query(
    "metadata_allowlist",
    """
SELECT o_orderkey, key_path, value FROM (
  SELECT o_orderkey, 'MigrationType' AS key_path, o_orderpriority AS value FROM orders
  UNION ALL SELECT o_orderkey, 'Status', o_orderstatus FROM orders
  UNION ALL SELECT o_orderkey, 'StopReason', 'r' || o_custkey FROM orders)""",
)
def metadata_allowlist(spark, sf_dir):
    """The six kept keys of a task document, here three of them present."""
    document = F.create_map(
        F.lit("MigrationType"), F.col("o_orderpriority"),
        F.lit("Status"), F.col("o_orderstatus"),
        F.lit("StopReason"), text("r", F.col("o_custkey")),
        F.lit("ReplicationTaskArn"), text("arn:", F.col("o_orderkey")),
    )
    kept = table(spark, sf_dir, "orders").select("o_orderkey", kv.keep_keys(document, kv.TASK_KEYS).alias("m"))
    return kv.map_rows(kept, "m", ["o_orderkey"])
