"""Object inventories, file names, schemas of files and folders."""

from __future__ import annotations

from pyspark.sql import functions as F

from metaspark.functions import names, paths
from metaspark.operators.inventory import exclude_names, filter_files, folder_members
from metaspark.plans import entities as en
from metaspark.plans.catalog import union_all
from metaspark.plans.folder_report import folder_fields, folder_report
from metaspark.session import scratch_path
from metaspark.sources.listing import ObjectListing, walk_objects
from metaspark.sources.partitioned import read_folder

from .registry import entity_sql, query, table, text

# the page URLs read as object URLs
_OBJECTS_SQL = r"""
WITH u AS (SELECT page_id, regexp_replace(url, '^https?://', 's3a://') AS o FROM pages),
p AS (
  SELECT page_id, regexp_replace(o, '^s3[an]?://', '') AS stripped,
         regexp_extract(o, '^[a-z0-9]+://([^/?#]*)', 1) AS bucket,
         ltrim(regexp_extract(o, '^[a-z0-9]+://[^/?#]*([^?#]*)', 1), '/') AS k
  FROM u),
o AS (
  SELECT *, CASE WHEN k = '' THEN bucket ELSE bucket || '/' || trim(k, '/') END AS path FROM p)
"""


def _objects(spark, sf_dir):
    url = F.regexp_replace("url", "^https?://", "s3a://")
    bucket, key = paths.url_bucket(F.col("object_url")), paths.url_key(F.col("object_url"))
    return (
        table(spark, sf_dir, "pages")
        .select("page_id", url.alias("object_url"))
        .withColumn("bucket", bucket)
        .withColumn("key", key)
        .withColumn("path", paths.join_prefix(F.col("bucket"), F.col("key")))
        .withColumn("base_name", paths.base_name(F.col("path")))
    )


@query(
    "object_inventory",
    _OBJECTS_SQL
    + r"""
SELECT page_id, stripped, bucket, k AS "key", string_split(k, '/')[-1] AS base_name,
       nullif(regexp_extract(k, '^(.*)/[^/]*$', 1), '') AS parent, path,
       CASE WHEN regexp_matches(k, '\.csv(\.gz|\.bz2)?$') THEN 'csv'
            WHEN regexp_matches(k, '\.tsv(\.gz|\.bz2)?$') THEN 'tsv'
            ELSE lower(nullif(regexp_extract(string_split(k, '/')[-1], '\.([A-Za-z0-9]+)$', 1), '')) END AS format
FROM o WHERE string_split(k, '/')[-1] <> ''""",
)
def object_inventory(spark, sf_dir):
    """Files only: a key ending in a slash is a folder and has no base name."""
    key = F.col("key")
    return (
        _objects(spark, sf_dir)
        .select(
            "page_id",
            paths.strip_protocol(F.col("object_url")).alias("stripped"),
            "bucket",
            "key",
            paths.base_name(key).alias("base_name"),
            paths.parent_path(key).alias("parent"),
            "path",
            paths.file_format(paths.base_name(key)).alias("format"),
        )
        .filter(F.col("base_name") != "")
    )


_NAME_ENDINGS = ["csv", "csv.gz", "csv.tar", "tsv", "tsv.bz2", "snappy.parquet", "parquet", "json", "CSV", "7z"]


@query(
    "format_classify",
    rf"""
WITH n AS (
  SELECT 'part-' || p_partkey AS item,
         replace(p_name, ' ', '.') || '.' || (list_value({", ".join(repr(e) for e in _NAME_ENDINGS)}))[(p_partkey % 10)::INT + 1] AS name
  FROM part
  UNION ALL
  SELECT 'page-' || page_id, string_split(regexp_extract(url, '^[a-z]+://([^?#]*)', 1), '/')[-1] FROM pages)
SELECT item, name, nullif(regexp_extract(name, '\.([a-z]+)', 1), '') AS first_extension,
       regexp_extract(name, '^[^.]*((\.[^.]*)*)$', 1) AS suffixes,
       CASE WHEN regexp_matches(name, '\.csv(\.gz|\.bz2)?$') THEN 'csv'
            WHEN regexp_matches(name, '\.tsv(\.gz|\.bz2)?$') THEN 'tsv'
            WHEN regexp_matches(name, '\.parquet$') THEN 'parquet' END AS suffix_format,
       CASE WHEN regexp_matches(name, '\.csv(\.gz|\.bz2)?$') THEN 'csv'
            WHEN regexp_matches(name, '\.tsv(\.gz|\.bz2)?$') THEN 'tsv'
            ELSE lower(nullif(regexp_extract(name, '\.([A-Za-z0-9]+)$', 1), '')) END AS format
FROM n""",
)
def format_classify(spark, sf_dir):
    endings = F.array(*[F.lit(e) for e in _NAME_ENDINGS])
    ending = F.element_at(endings, (F.col("p_partkey") % 10).cast("int") + 1)
    part = table(spark, sf_dir, "part").select(
        text("part-", F.col("p_partkey")).alias("item"),
        F.concat_ws(".", F.replace("p_name", F.lit(" "), F.lit(".")), ending).alias("name"),
    )
    page_path = F.regexp_extract("url", r"^[a-z]+://([^?#]*)", 1)
    pages = table(spark, sf_dir, "pages").select(
        text("page-", F.col("page_id")).alias("item"), paths.base_name(page_path).alias("name")
    )
    name = F.col("name")
    return part.unionByName(pages).select(
        "item",
        "name",
        paths.first_extension(name).alias("first_extension"),
        paths.all_suffixes(name).alias("suffixes"),
        paths.suffix_format(name).alias("suffix_format"),
        paths.file_format(name).alias("format"),
    )


@query(
    "filename_filter",
    "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'widget|gear') AND NOT regexp_matches(p_name, '^red')",
)
def filename_filter(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return filter_files(part, include=["widget", "gear"], exclude=["^red"], column="p_name")


@query(
    "object_names",
    r"""
WITH p AS (SELECT p_partkey, lower(replace(p_brand, '#', '-')) AS bucket,
                  lower(replace(p_brand, '#', '-')) || '/' || p_type || '/' || p_name || '/' AS path FROM part),
n AS (SELECT *, replace(regexp_replace(trim(path, '/'), '^[^/]*/', ''), '/', '\\') AS name FROM p)
SELECT p_partkey, name, '//s3/cloud/aws/buckets/' || bucket || '/keys/' || name AS entity_rn,
       '//s3-custom/store.local/buckets/' || bucket AS custom_rn,
       '//s3/cloud/aws/buckets/' || bucket || '/keys/' || name || '/columns/c/subcolumns/a' AS child_rn
FROM n""",
)
def object_names(spark, sf_dir):
    bucket = F.lower(F.replace("p_brand", F.lit("#"), F.lit("-")))
    rn = names.object_key_name(F.col("bucket"), F.col("name"))
    return (
        table(spark, sf_dir, "part")
        .select("p_partkey", bucket.alias("bucket"), text(bucket, "/", F.col("p_type"), "/", F.col("p_name"), "/").alias("path"))
        .withColumn("name", paths.object_name(F.col("path")))
        .select(
            "p_partkey",
            "name",
            rn.alias("entity_rn"),
            names.custom_bucket_name("store.local", F.col("bucket")).alias("custom_rn"),
            names.child_field_name(names.path_of(rn, columns="c"), "subcolumns", F.lit("a")).alias("child_rn"),
        )
    )


@query(
    "folder_members",
    _OBJECTS_SQL
    + """
, s AS (SELECT DISTINCT path, string_split(path, '/') AS st FROM o),
e AS (SELECT st, unnest(range(1, len(st))) AS i FROM s WHERE len(st) > 1)
SELECT DISTINCT array_to_string(st[1:i], '/') AS group_path, array_to_string(st[1:i + 1], '/') AS member_path,
       CASE WHEN i + 1 = len(st) THEN 'FILE' ELSE 'FOLDER' END AS member_kind
FROM e""",
)
def folder_tree(spark, sf_dir):
    return folder_members(_objects(spark, sf_dir))


@query(
    "object_entities",
    _OBJECTS_SQL
    + r"""
, s AS (SELECT DISTINCT path, string_split(path, '/') AS st FROM o),
f AS (SELECT DISTINCT array_to_string(st[1:i], '/') AS path FROM (SELECT st, unnest(range(1, len(st))) AS i FROM s WHERE len(st) > 1)),
all_objects AS (
  SELECT DISTINCT path, string_split(path, '/')[-1] AS name, 'FILE' AS kind FROM o WHERE string_split(k, '/')[-1] <> ''
  UNION ALL SELECT path, path, 'DAG' FROM f)
"""
    + entity_sql(
        "FROM all_objects",
        entity_rn="""CASE WHEN contains(path, '/')
            THEN '//s3/cloud/aws/buckets/' || split_part(path, '/', 1) || '/keys/' || substr(path, instr(path, '/') + 1)
            ELSE '//s3/cloud/aws/buckets/' || path END""",
        source_rn="'//s3/cloud/aws/buckets/' || split_part(path, '/', 1)",
        name="name",
        entity_type="kind",
    ),
)
def object_entities(spark, sf_dir):
    objects = _objects(spark, sf_dir)
    files = objects.filter(paths.base_name(F.col("key")) != "").dropDuplicates(["path"])
    return union_all(en.file_entities(files), en.folder_entities(objects)).withColumns(
        {"created_at": F.col("created_at").cast("timestamp_ntz"), "updated_at": F.col("updated_at").cast("timestamp_ntz")}
    )


# the fields of every test table, from the registered views themselves
FIELDS_SQL = """
WITH c AS (
  SELECT table_name, ordinal_position - 1 AS position, column_name,
         CASE data_type WHEN 'BIGINT' THEN 'int64' WHEN 'INTEGER' THEN 'int32' WHEN 'DOUBLE' THEN 'double'
              WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp[us]' WHEN 'FLOAT[]' THEN 'list'
              ELSE data_type END AS logical_type
  FROM information_schema.columns
  WHERE table_name IN ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events',
                       'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations')),
t AS (
  SELECT *, 0 AS ordinal, 0 AS depth, column_name AS name, CAST(NULL AS VARCHAR) AS parent, FALSE AS is_value,
         table_name || '/columns/' || column_name AS rn FROM c
  UNION ALL
  SELECT table_name, position, column_name, 'float', 1, 1, 'float', table_name || '/columns/' || column_name, TRUE,
         table_name || '/columns/' || column_name || '/values/float' FROM c WHERE logical_type = 'list'),
fields AS (
  SELECT table_name AS entity_rn, rn AS field_rn, parent AS parent_field_rn, CAST(position AS INTEGER) AS position,
         CAST(ordinal AS INTEGER) AS ordinal, CAST(depth AS INTEGER) AS depth, name,
         CASE WHEN logical_type IN ('int64', 'int32') THEN 'INTEGER' WHEN logical_type IN ('double', 'float') THEN 'NUMBER'
              WHEN logical_type = 'string' THEN 'STRING' WHEN logical_type = 'list' THEN 'LIST' ELSE 'DATETIME' END AS type,
         logical_type, TRUE AS is_nullable, FALSE AS is_key, is_value, CAST(NULL AS VARCHAR) AS description
  FROM t)
"""


@query("file_schema_fields", FIELDS_SQL + "SELECT * FROM fields")
def file_schema_fields(spark, sf_dir):
    """Footers of every file of the folder; a table may be one file or many."""
    return folder_fields(spark, sf_dir)


def _number_sql(source: str, column: str) -> str:
    return (
        f"SELECT '{source}' AS entity_rn, '{column}' AS column_name, CAST(min({column}) AS DOUBLE) AS low_value, "
        f"CAST(max({column}) AS DOUBLE) AS high_value, count(*) - count({column}) AS nulls_count, "
        f"count(DISTINCT {column}) AS unique_count FROM {source}"
    )


_LINEITEM_NUMBERS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
]


@query(
    "partitioned_dataset",
    """
SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS n_rows,
       count(DISTINCT o_custkey) AS n_customers,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM orders GROUP BY ALL""",
)
def partitioned_dataset(spark, sf_dir):
    """Orders laid out as a hive-partitioned folder, read back as one dataset."""
    folder = scratch_path(spark, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    (
        table(spark, sf_dir, "orders")
        .select("o_custkey", cents.alias("cents"), "o_orderstatus", F.year("o_orderdate").alias("order_year"))
        .write.partitionBy("o_orderstatus", "order_year")
        .parquet(folder)
    )
    return (
        read_folder(spark, folder, "parquet", "hive")
        .groupBy("o_orderstatus", "order_year")
        .agg(
            F.count("*").alias("n_rows"),
            F.count_distinct("o_custkey").alias("n_customers"),
            F.sum("cents").alias("total_cents"),
        )
    )


_EXCLUDED_TABLES = ["Supplier#000000003", "Supplier#000000007", "Supplier#000000011", "no such table"]


@query(
    "exclude_tables",
    "SELECT s_suppkey, s_name FROM supplier WHERE s_name NOT IN ("
    + ", ".join(repr(n) for n in _EXCLUDED_TABLES)
    + ")",
)
def exclude_tables(spark, sf_dir):
    return exclude_names(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), _EXCLUDED_TABLES, "s_name")


def _written_by(spark, rows, *columns):
    """The rows as one file for each value of the columns, in folders."""
    folder = scratch_path(spark, "listed")
    rows.repartition(*columns).write.partitionBy(*columns).parquet(folder)
    return folder


@query(
    "object_walk",
    "SELECT c_mktsegment AS segment, CAST(c_nationkey AS INTEGER) AS nation, CAST(1 AS BIGINT) AS n_files FROM customer GROUP BY ALL",
)
def object_walk(spark, sf_dir):
    """Customers in folders of segment and nation, found again by a listing in ranges of three names."""
    rows = table(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey", "c_custkey")
    walked = walk_objects(spark, _written_by(spark, rows, "c_mktsegment", "c_nationkey"), range_names=3)
    path = F.col("path")
    return (
        walked.filter(F.col("is_file") & path.endswith(".parquet") & ~paths.base_name(path).startswith("."))
        .select(
            F.regexp_extract(path, "/c_mktsegment=([^/]*)/", 1).alias("segment"),
            F.regexp_extract(path, "/c_nationkey=([^/]*)/", 1).cast("int").alias("nation"),
        )
        .groupBy("segment", "nation")
        .agg(F.count("*").alias("n_files"))
    )


@query("object_stream", "SELECT event_type, CAST(1 AS BIGINT) AS n_files FROM events GROUP BY ALL")
def object_stream(spark, sf_dir):
    """Events in a folder for each type, whose files arrive as a stream of objects."""
    folder = _written_by(spark, table(spark, sf_dir, "events").select("event_type", "event_id"), "event_type")
    spark.dataSource.register(ObjectListing)
    arriving = spark.readStream.format("objects").option("settle", 0).option("rangeNames", 2).load(folder)
    out = scratch_path(spark, "arrived")
    writer = arriving.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "arrived-offsets"))
    writer.trigger(availableNow=True).start().awaitTermination()
    path = F.col("path")
    seen = spark.read.schema(arriving.schema).parquet(out).filter(path.rlike(r"/event_type=[^/]*/[^._][^/]*\.parquet$"))
    return seen.groupBy(F.regexp_extract(path, "/event_type=([^/]*)/", 1).alias("event_type")).agg(F.count("*").alias("n_files"))


# What each part type's files store p_size and p_name as.
_STORED = {"STANDARD": "int", "PROMO": "bigint", "SMALL": "float", "LARGE": "int", "ECONOMY": "smallint", "MEDIUM": "int"}


@query(
    "merged_fields",
    """
WITH d AS (
  SELECT 'brand=' || replace(p_brand, '#', '-') AS entity_rn, list_distinct(list(p_type)) AS kinds FROM part GROUP BY ALL),
s AS (
  SELECT entity_rn, CASE WHEN list_contains(kinds, 'SMALL') AND len(kinds) > 1 THEN 'double' WHEN list_contains(kinds, 'SMALL') THEN 'float'
              WHEN list_contains(kinds, 'PROMO') THEN 'int64'
              WHEN len(list_filter(kinds, lambda k: k <> 'ECONOMY')) > 0 THEN 'int32' ELSE 'int16' END AS logical_type FROM d),
n AS (
  SELECT entity_rn, CASE WHEN NOT list_contains(kinds, 'MEDIUM') THEN 'string' WHEN len(kinds) = 1 THEN 'int64' ELSE 'unknown' END AS logical_type FROM d)
SELECT entity_rn, entity_rn || '/columns/p_size' AS key, logical_type,
       CASE WHEN logical_type IN ('double', 'float') THEN 'NUMBER' ELSE 'INTEGER' END AS type, CAST(NULL AS VARCHAR) AS reason FROM s
UNION ALL SELECT entity_rn, entity_rn || '/columns/p_name', logical_type,
       CASE logical_type WHEN 'string' THEN 'STRING' WHEN 'int64' THEN 'INTEGER' ELSE 'UNKNOWN' END, NULL FROM n
UNION ALL SELECT entity_rn, entity_rn || '/columns/p_name', NULL, NULL, 'types without a common one: int64, string' FROM n
WHERE logical_type = 'unknown'""",
)
def merged_fields(spark, sf_dir):
    """Parts in a folder for each brand, whose files disagree on types: common types, and rejects where there is none."""
    folder = scratch_path(spark, "unlike")
    part = table(spark, sf_dir, "part").withColumn("brand", F.replace("p_brand", F.lit("#"), F.lit("-")))
    for kind, size in _STORED.items():
        name = F.length("p_name").cast("long") if kind == "MEDIUM" else F.col("p_name")
        rows = part.filter(F.col("p_type") == kind).select(F.col("p_size").cast(size).alias("p_size"), name.alias("p_name"), "brand")
        rows.write.mode("append").partitionBy("brand").parquet(folder)
    fields, rejects = folder_report(spark, folder)
    dataset = F.substring_index("key", "/", 1).alias("entity_rn")
    none = F.lit(None).cast("string")
    return fields.select("entity_rn", F.col("field_rn").alias("key"), "logical_type", "type", none.alias("reason")).unionByName(
        rejects.select(dataset, "key", none.alias("logical_type"), none.alias("type"), "reason")
    )
