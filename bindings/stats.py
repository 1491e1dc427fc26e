"""Column statistics from data and from reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from metaspark.operators import profile as pr
from metaspark.operators.sketch_profile import refresh_profiles
from metaspark.plans.catalog import union_all
from metaspark.plans.folder_report import folder_fields
from metaspark.session import scratch_path

from .objects import _LINEITEM_NUMBERS, FIELDS_SQL, _number_sql
from .registry import query, table


@query(
    "column_stats_number",
    " UNION ALL ".join(
        _number_sql("lineitem", c).replace("'lineitem' AS entity_rn, ", "")
        for c in _LINEITEM_NUMBERS
    ),
)
def column_stats_number(spark, sf_dir):
    stats = pr.number_stats(table(spark, sf_dir, "lineitem"), _LINEITEM_NUMBERS)
    return stats.drop("mean_value", "median_value")


def _datetime_sql(source: str, column: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, min({column}) AS low_value, max({column}) AS high_value, "
        f"count(*) - count({column}) AS nulls_count, count(DISTINCT {column}) AS unique_count FROM {source}"
    )


_DATES = [("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")]


@query("column_stats_datetime", " UNION ALL ".join(_datetime_sql(*d) for d in _DATES))
def column_stats_datetime(spark, sf_dir):
    first, *rest = [pr.datetime_stats(table(spark, sf_dir, source), [column]) for source, column in _DATES]
    for part in rest:
        first = first.unionByName(part)
    return first


def _length_sql(kind: str, column: str, length: str) -> str:
    return (
        f"SELECT '{kind}' AS kind, '{column}' AS column_name, CAST(max({length}) AS BIGINT) AS max_length, "
        f"round(avg({length}), 6) AS avg_length, count(*) - count({column}) AS nulls_count, "
        f"count(DISTINCT {column}) AS unique_count FROM documents"
    )


@query(
    "column_stats_string",
    " UNION ALL ".join(
        [_length_sql("string", c, f"length({c})") for c in ("text", "lang", "source")]
        + [_length_sql("binary", "text", "strlen(text)")]
    ),
)
def column_stats_string(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    strings = pr.string_stats(documents, ["text", "lang", "source"]).withColumn("kind", F.lit("string"))
    binary = pr.binary_stats(documents, {"text": F.col("text").cast("binary")}).withColumn("kind", F.lit("binary"))
    return strings.unionByName(binary).withColumn("avg_length", F.round("avg_length", 6))


@query(
    "column_stats_boolean",
    """
SELECT 'quality' AS column_name, count(*) FILTER (quality = 1) AS true_count,
       count(*) FILTER (quality <> 1) AS false_count, count(*) - count(quality) AS nulls_count FROM labels
UNION ALL
SELECT 'toxic', count(*) FILTER (nullif(toxic, 0) = 1), count(*) FILTER (nullif(toxic, 0) <> 1),
       count(*) - count(nullif(toxic, 0)) FROM labels""",
)
def column_stats_boolean(spark, sf_dir):
    flags = {"quality": F.col("quality") == 1, "toxic": F.nullif("toxic", F.lit(0)) == 1}
    return pr.boolean_stats(table(spark, sf_dir, "labels"), flags)


@query(
    "column_stats_decimal",
    """
SELECT 'o_totalprice' AS column_name, min(CAST(o_totalprice AS DECIMAL(18, 2))) AS low_value,
       max(CAST(o_totalprice AS DECIMAL(18, 2))) AS high_value, count(*) - count(o_totalprice) AS nulls_count,
       count(DISTINCT CAST(o_totalprice AS DECIMAL(18, 2))) AS unique_count
FROM orders""",
)
def column_stats_decimal(spark, sf_dir):
    price = {"o_totalprice": F.col("o_totalprice").cast("decimal(18,2)")}
    return pr.decimal_stats(table(spark, sf_dir, "orders"), price)


@query(
    "column_stats_extended",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS low_value, CAST(max({c}) AS DOUBLE) AS high_value, "
        f"round(avg({c}), 4) AS mean_value, count(*) - count({c}) AS nulls_count, count(DISTINCT {c}) AS unique_count FROM part"
        for c in ("p_size", "p_retailprice")
    ),
)
def column_stats_extended(spark, sf_dir):
    """The median is a bounded-error estimate, so only the mean is checked exactly."""
    stats = pr.number_stats(table(spark, sf_dir, "part"), ["p_size", "p_retailprice"], extended=True)
    return stats.drop("median_value").withColumn("mean_value", F.round("mean_value", 4))


# columns of the test tables with the kind of their statistics: whole, double, string, time
COLUMNS = {
    "region": "r_regionkey:w r_name:s",
    "nation": "n_nationkey:w n_name:s n_regionkey:w",
    "customer": "c_custkey:w c_name:s c_nationkey:w c_acctbal:d c_mktsegment:s",
    "supplier": "s_suppkey:w s_name:s s_nationkey:w s_acctbal:d",
    "part": "p_partkey:w p_name:s p_brand:s p_type:s p_size:w p_retailprice:d",
    "orders": "o_orderkey:w o_custkey:w o_orderstatus:s o_totalprice:d o_orderdate:t o_orderpriority:s",
    "lineitem": (
        "l_orderkey:w l_partkey:w l_suppkey:w l_linenumber:w l_quantity:d l_extendedprice:d l_discount:d l_tax:d "
        "l_returnflag:s l_linestatus:s l_shipdate:t"
    ),
    "events": "event_id:w ts:t user_id:w event_type:s value:d props:s",
    "documents": "doc_id:w text:s lang:s source:s n_chars:w",
    "embeddings": "vec_id:w label:w",
    "pages": "page_id:w url:s html:s",
    "benchmark": "item_id:w text:s",
    "labels": "doc_id:w quality:w toxic:w",
    "conversations": "conv_id:w turn:w role:s text:s",
}


def _profile_sql(source: str, column: str, kind: str) -> str:
    low, high = f"min({column})", f"max({column})"
    number, time, string = kind in "wd", kind == "t", kind == "s"
    parts = {
        "entity_rn": f"'{source}'",
        "column_name": f"'{column}'",
        "kind": f"'{ {'w': 'number', 'd': 'number', 's': 'string', 't': 'datetime'}[kind] }'",
        "low_number": f"CAST({low} AS DOUBLE)" if number else "CAST(NULL AS DOUBLE)",
        "high_number": f"CAST({high} AS DOUBLE)" if number else "CAST(NULL AS DOUBLE)",
        "low_time": low if time else "CAST(NULL AS TIMESTAMP)",
        "high_time": high if time else "CAST(NULL AS TIMESTAMP)",
        "max_length": f"CAST(max(length({column})) AS BIGINT)" if string else "CAST(NULL AS BIGINT)",
        "avg_length": f"round(avg(length({column})), 6)" if string else "CAST(NULL AS DOUBLE)",
        "nulls_count": f"count(*) - count({column})",
        "unique_count": f"count(DISTINCT {column})",
    }
    return "SELECT " + ", ".join(f"{v} AS {k}" for k, v in parts.items()) + f" FROM {source}"


PROFILE_SQL = {
    source: " UNION ALL ".join(_profile_sql(source, *c.split(":")) for c in columns.split())
    for source, columns in COLUMNS.items()
}


def typed_profile(stats):
    """The common statistics with bounds as numbers and times."""
    number, time = F.col("kind") == "number", F.col("kind") == "datetime"
    bound = lambda side: [
        F.when(number, F.col(f"{side}_value").try_cast("double")).alias(f"{side}_number"),
        F.when(time, F.col(f"{side}_value").try_cast("timestamp_ntz")).alias(f"{side}_time"),
    ]
    rest = [c for c in ("entity_rn", "field_rn", "column_name", "name", "type", "kind") if c in stats.columns]
    return stats.select(
        *rest, *bound("low"), *bound("high"), "max_length", F.round("avg_length", 6).alias("avg_length"), "nulls_count", "unique_count"
    )


@query("column_profile", PROFILE_SQL["lineitem"].replace("'lineitem' AS entity_rn, ", ""))
def column_profile(spark, sf_dir):
    """Every column of lineitem, the kind chosen by its type."""
    return typed_profile(pr.profile(table(spark, sf_dir, "lineitem"), distinct="exact"))


def table_profiles(spark, sf_dir):
    """Statistics of every column of all test tables that has a kind."""
    return union_all(*[
        pr.profile(table(spark, sf_dir, source), distinct="exact").withColumn("entity_rn", F.lit(source)) for source in COLUMNS
    ])


@query(
    "stats_join_fields",
    FIELDS_SQL
    + f", stats AS ({' UNION ALL '.join(PROFILE_SQL.values())})"
    + """
SELECT f.entity_rn, f.field_rn, f.name, f.type, s.* EXCLUDE (entity_rn, column_name)
FROM fields f LEFT JOIN stats s ON f.depth = 0 AND f.entity_rn = s.entity_rn AND f.name = s.column_name""",
)
def stats_join_fields(spark, sf_dir):
    """Fields of every file of the folder with the statistics of every column."""
    return typed_profile(pr.join_stats(folder_fields(spark, sf_dir), table_profiles(spark, sf_dir)))


def flagship(spark, sf_dir):
    """One row per field of every file of the folder, with type and statistics."""
    return pr.join_stats(folder_fields(spark, sf_dir), table_profiles(spark, sf_dir))


@query(
    "reported_stats",
    """
WITH r AS (SELECT *, p_partkey % 7 AS t, (CAST(p_partkey AS BIGINT) * 37 - 20000) AS unscaled FROM part)
SELECT p_partkey,
       CASE t WHEN 3 THEN 'datetime' WHEN 4 THEN 'string' WHEN 5 THEN 'binary' WHEN 6 THEN 'boolean' ELSE 'number' END AS kind,
       CASE t WHEN 0 THEN CAST(p_size AS DOUBLE) WHEN 1 THEN p_retailprice WHEN 2 THEN round(unscaled / 100.0, 4) END AS low_number,
       CASE t WHEN 0 THEN CAST(p_size + p_partkey AS DOUBLE) WHEN 1 THEN p_retailprice * 2
              WHEN 2 THEN round((unscaled + 12345) / 1000.0, 4) END AS high_number,
       CASE t WHEN 3 THEN '2020-01-01' END AS low_date,
       CASE WHEN t IN (4, 5) THEN CAST(p_size AS BIGINT) END AS max_length,
       CASE WHEN t IN (4, 5) THEN p_retailprice END AS avg_length,
       CASE t WHEN 6 THEN p_partkey END AS true_count,
       CASE t WHEN 6 THEN CAST(p_size AS BIGINT) END AS false_count,
       CASE WHEN t IS NOT NULL THEN p_partkey % 5 END AS nulls_count,
       CASE WHEN t NOT IN (5, 6) THEN CAST(p_size AS BIGINT) END AS unique_count
FROM r""",
)
def reported_stats(spark, sf_dir):
    """Reports as a table catalog gives them, one per part, of all seven types."""
    kind = F.col("p_partkey") % 7
    nulls = (F.col("p_partkey") % 5).alias("NumberOfNulls")
    size = F.col("p_size").cast("bigint")
    unscaled = F.col("p_partkey").cast("bigint") * 37 - 20000

    def encoded(value, scale):
        # eight big-endian bytes, two's complement
        return F.struct(F.base64(F.unhex(F.lpad(F.hex(value), 16, "0"))).alias("UnscaledValue"), F.lit(scale).alias("Scale"))

    def numeric(low, high):
        return F.struct(
            low.alias("MinimumValue"), high.alias("MaximumValue"), nulls, size.alias("NumberOfDistinctValues")
        )

    lengths = [size.alias("MaximumLength"), F.col("p_retailprice").alias("AverageLength"), nulls]
    types = F.array(*[F.lit(t) for t in ("LONG", "DOUBLE", "DECIMAL", "DATE", "STRING", "BINARY", "BOOLEAN")])
    report = F.struct(
        F.element_at(types, kind.cast("int") + 1).alias("Type"),
        F.when(kind == 0, numeric(size, size + F.col("p_partkey"))).alias("LongColumnStatisticsData"),
        F.when(kind == 1, numeric(F.col("p_retailprice"), F.col("p_retailprice") * 2)).alias("DoubleColumnStatisticsData"),
        F.when(kind == 2, numeric(encoded(unscaled, 2), encoded(unscaled + 12345, 3))).alias("DecimalColumnStatisticsData"),
        F.when(kind == 3, numeric(F.lit("2020-01-01"), F.lit("2021-01-01"))).alias("DateColumnStatisticsData"),
        F.when(kind == 4, F.struct(*lengths, size.alias("NumberOfDistinctValues"))).alias("StringColumnStatisticsData"),
        F.when(kind == 5, F.struct(*lengths)).alias("BinaryColumnStatisticsData"),
        F.when(
            kind == 6, F.struct(F.col("p_partkey").alias("NumberOfTrues"), size.alias("NumberOfFalses"), nulls)
        ).alias("BooleanColumnStatisticsData"),
    )
    landed = table(spark, sf_dir, "part").select("p_partkey", F.to_json(report).alias("value"))
    stats = pr.reported_stats(landed.select("p_partkey", F.from_json("value", pr.REPORTED).alias("report")))
    number = F.col("kind") == "number"
    return stats.select(
        "p_partkey",
        "kind",
        F.when(number, F.round(F.col("low_value").try_cast("double"), 4)).alias("low_number"),
        F.when(number, F.round(F.col("high_value").try_cast("double"), 4)).alias("high_number"),
        F.when(F.col("kind") == "datetime", F.col("low_value")).alias("low_date"),
        "max_length",
        "avg_length",
        "true_count",
        "false_count",
        "nulls_count",
        "unique_count",
    )


_MERGED = ["l_orderkey", "l_quantity", "l_extendedprice", "l_linestatus"]


@query(
    "merged_profiles",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{'text' if c == 'l_linestatus' else 'number'}' AS kind, count(*) AS n_rows, count(*) - count({c}) AS nulls_count,
       {f'CAST(NULL AS DOUBLE) AS low_number, CAST(NULL AS DOUBLE) AS high_number, min({c}) AS low_text, max({c}) AS high_text'
        if c == 'l_linestatus' else
        f'CAST(min({c}) AS DOUBLE) AS low_number, CAST(max({c}) AS DOUBLE) AS high_number, CAST(NULL AS VARCHAR) AS low_text, CAST(NULL AS VARCHAR) AS high_text'},
       TRUE AS distinct_close, TRUE AS median_close FROM lineitem"""
        for c in _MERGED
    ),
)
def merged_profiles(spark, sf_dir):
    """Line items that land in two lots: the second collection reads its files only, and both profiles are merged.

    Estimates are compared with exact counts: distinct values within 6 %, the median's rank within 4 %.
    """
    folder, state = scratch_path(spark, "lots"), scratch_path(spark, "profiles")
    lines = table(spark, sf_dir, "lineitem").select(*_MERGED, "l_returnflag")
    for lot in (F.col("l_returnflag") == "N", F.col("l_returnflag") != "N"):
        lines.filter(lot).drop("l_returnflag").repartition(*_MERGED).write.mode("append").parquet(folder)
        found = refresh_profiles(spark, folder, state)
    numbers = [c for c in _MERGED if c != "l_linestatus"]
    medians = {r["column_name"]: r["median_estimate"] for r in found.filter("kind = 'number'").select("column_name", "median_estimate").collect()}
    exact = lines.agg(
        *[(F.count(F.when(F.col(c) < medians[c], 1)) / F.count(c)).alias(f"below_{c}") for c in numbers],
        *[(F.count(F.when(F.col(c) <= medians[c], 1)) / F.count(c)).alias(f"upto_{c}") for c in numbers],
    )
    facts = F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 (((F.col(f"below_{c}") <= 0.54) & (F.col(f"upto_{c}") >= 0.46)) if c in numbers else F.lit(True)).alias("median_close"))
        for c in _MERGED
    ])
    # each column by its values alone: several distinct counts in one aggregate copy every row for each
    distinct = union_all(*[lines.select(c).distinct().agg(F.lit(c).alias("column_name"), F.count(c).alias("d")) for c in _MERGED])
    known = exact.select(F.inline(facts)).join(distinct, "column_name")
    close = F.abs(F.col("unique_estimate") - F.col("d")) <= 0.06 * F.col("d")
    return found.join(known, "column_name").select(
        "column_name", "kind", "n_rows", "nulls_count", "low_number", "high_number", "low_text", "high_text", close.alias("distinct_close"), "median_close"
    )
