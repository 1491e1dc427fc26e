"""Upstream and downstream names of jobs, datasets and consumers.

Edges are rows (via_rn, other_rn, role) with role input, output or consume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..functions.paths import arn_tail
from ..functions.status import lookup
from .joins import by_key

EDGE = ["via_rn", "other_rn", "role"]

# Engine -> (system, settings key, table level).
ENGINES = {
    "sqlserver": ("mssql", "MicrosoftSQLServerSettings", "tables"),
    "mysql": ("mysql", "MySQLSettings", "tables"),
    "mariadb": ("mysql", "MySQLSettings", "tables"),
    "postgres": ("postgresql", "PostgreSQLSettings", "tables"),
    "mongodb": ("mongodb", "MongoDbSettings", "collections"),
    "s3": ("s3", "S3Settings", None),
}


def edges(rows: DataFrame, via: Column, other: Column, role: str) -> DataFrame:
    """Distinct edges; rows without the other end are left out."""
    return (
        rows.select(via.alias("via_rn"), other.alias("other_rn"), F.lit(role).alias("role"))
        .filter(F.col("other_rn").isNotNull() & (F.col("other_rn") != ""))
        .distinct()
    )


def endpoint_sources(endpoints: DataFrame) -> DataFrame:
    """Add ``engine`` and ``database_rn`` to endpoints; unknown engines get a null name.

    Needs endpoint_arn, engine_name, server_name, database_name, bucket_name, bucket_folder.
    """
    engine = F.col("engine_name")
    system = lookup(engine, {k: v[0] for k, v in ENGINES.items()})
    server = names.path_of(names.host_source(system, F.col("server_name")), databases=F.col("database_name"))
    stored = names.object_key_name(F.col("bucket_name"), F.col("bucket_folder"))
    return endpoints.withColumn(
        "database_rn", F.when(engine == "s3", stored).when(system.isNotNull(), server)
    ).withColumn("table_level", lookup(engine, {k: v[2] for k, v in ENGINES.items() if v[2]}))


def endpoint_table_name(database: Column, engine: Column, schema: Column, table: Column) -> Column:
    """Resource name of a table behind an endpoint; object targets separate with a backslash."""
    level = lookup(engine, {k: v[2] for k, v in ENGINES.items() if v[2]})
    in_database = F.concat_ws("/", database, F.lit("schemas"), schema, level, table)
    in_bucket = F.concat_ws("\\", database, schema, table)
    return F.when(engine == "s3", in_bucket).when(level.isNotNull(), in_database)


def tasks_with_endpoints(tasks: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Left-join the source and the target endpoint of every task (N:1, twice).

    An endpoint is unique by ARN; a missing one leaves nulls and the task keeps its row.
    """
    cols = [c for c in endpoints.columns if c != "endpoint_arn"]

    def side(name: str) -> DataFrame:
        return endpoints.select(
            F.col("endpoint_arn").alias(f"{name}_endpoint_arn"), *[F.col(c).alias(f"{name}_{c}") for c in cols]
        )

    return tasks.join(by_key(side("source")), "source_endpoint_arn", "left").join(
        by_key(side("target")), "target_endpoint_arn", "left"
    )


def data_source_name(
    source_type: Column, params: Column, table: Column, account: Column | str, region: Column | str
) -> Column:
    """Upstream resource name of a BI dataset's physical table, by data-source type.

    ``params``: struct bucket, key, host, port, database, warehouse; ``table``: struct
    catalog, schema, name.  Other types give the empty string.
    """
    host_port = F.concat_ws(":", params["host"], params["port"].cast("string"))
    athena = names.path_of(
        names.account_source("athena", account, region),
        catalogs=table["catalog"], databases=table["schema"], tables=table["name"],
    )
    snowflake = names.path_of(
        names.host_source("snowflake", params["host"]), warehouses=params["warehouse"], databases=params["database"]
    )
    return (
        F.when(source_type == "S3", names.bi_object_name(account, region, params["bucket"], params["key"]))
        .when(source_type == "ATHENA", athena)
        .when(source_type == "POSTGRESQL", names.path_of(names.host_source("postgresql", host_port), databases=params["database"]))
        .when(source_type == "MYSQL", names.path_of(names.host_source("mysql", host_port), databases=params["database"]))
        .when(source_type == "SNOWFLAKE", snowflake)
        .otherwise(F.lit(""))
    )


def physical_tables(datasets: DataFrame) -> DataFrame:
    """(dataset_id, source_id, table) rows of each dataset's physical table map."""
    return (
        datasets.select("dataset_id", F.explode("physical_tables").alias("table_key", "by_kind"))
        .select("dataset_id", F.explode("by_kind").alias("kind", "t"))
        .select(
            "dataset_id",
            arn_tail(F.col("t.DataSourceArn")).alias("source_id"),
            F.struct(
                F.col("t.Catalog").alias("catalog"), F.col("t.Schema").alias("schema"), F.col("t.Name").alias("name")
            ).alias("table"),
        )
    )


def dataset_upstreams(
    datasets: DataFrame, sources: DataFrame, account: Column | str, region: Column | str
) -> DataFrame:
    """(dataset_id, source_id, upstream_rn): physical tables joined with data sources by id.

    ``sources``: source_id, source_type, params.  One source may serve a large share of
    all tables; the join is N:1, so Spark splits the hot partition (or broadcasts a small
    source table).
    """
    joined = physical_tables(datasets).join(by_key(sources), "source_id")
    name = data_source_name(F.col("source_type"), F.col("params"), F.col("table"), account, region)
    return joined.select("dataset_id", "source_id", name.alias("upstream_rn"))


def consumer_inputs(consumers: DataFrame, dataset_arns: str = "dataset_arns") -> DataFrame:
    """(consumer columns..., dataset_id): the datasets a dashboard or analysis reads."""
    rest = [c for c in consumers.columns if c != dataset_arns]
    return consumers.select(*rest, F.explode(dataset_arns).alias("arn")).select(
        *rest, arn_tail(F.col("arn")).alias("dataset_id")
    )
