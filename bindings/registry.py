"""Bindings of the jobs to the fourteen test tables, each beside its check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metaspark.plans.entities import Scope
from metaspark.sources.dumps import parse_docs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {}

SCOPE = Scope(account="000000000000", region="eu-x")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            CHECK_SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(*parts: Column | str | int) -> Column:
    """Concatenation of literals and columns (strings name no columns here)."""
    return F.concat(*[F.lit(str(p)) if not isinstance(p, Column) else p.cast("string") for p in parts])


def doc_lines(rows: DataFrame, **fields: Column) -> DataFrame:
    """One JSON document per row, the way a landed dump holds them."""
    return rows.select(F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()])).alias("value"))


def dealt_out(rows: DataFrame) -> DataFrame:
    """Rows over many tasks, as many landed files would be.

    The test tables are single files, read in one task.  They are dealt by their values
    and without a number, so that Spark sizes the tasks: all cores have some, and more rows
    make more tasks, not larger ones.
    """
    return rows.repartition(*rows.columns)


def landed_docs(rows: DataFrame, kind: str, **fields: Column) -> DataFrame:
    """Parsed documents of a large table, whose rows are dealt out while narrow, before they become text."""
    docs, _ = parse_docs(doc_lines(dealt_out(rows), **fields), kind)
    return docs


def wall_clock(df: DataFrame) -> DataFrame:
    """Timestamps as zone-less values, so the comparison does not depend on a session zone."""
    return df.select(
        *[F.col(n).cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(n) for n, t in df.dtypes]
    )


# Check SQL of the entity columns a mapper leaves null.
NULL_ENTITY = {
    "owner_rn": "CAST(NULL AS VARCHAR)",
    "description": "CAST(NULL AS VARCHAR)",
    "created_at": "CAST(NULL AS TIMESTAMP)",
    "updated_at": "CAST(NULL AS TIMESTAMP)",
    "rows_number": "CAST(NULL AS BIGINT)",
    "source_code_url": "CAST(NULL AS VARCHAR)",
}


def entity_sql(source: str, **columns: str) -> str:
    """SELECT of the common entity columns for check SQL."""
    order = ["entity_rn", "source_rn", "name", "entity_type", *NULL_ENTITY]
    items = ", ".join(f"{columns.get(c, NULL_ENTITY.get(c))} AS {c}" for c in order)
    return f"SELECT {items} {source}"


def aws(system: str) -> str:
    return f"//{system}/cloud/aws/account/000000000000/region/eu-x"
