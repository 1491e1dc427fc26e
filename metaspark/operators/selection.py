"""Selection rules -> selected tables, for all tasks at once.

A rule names a schema and a table, either of which may be ``%`` (any).  Instead of a
theta join, every table offers its four patterns and every rule has exactly one, so the
match is a single equi-join on (database, pattern).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import with_once
from .joins import by_key

RULES = (
    "struct<rules:array<struct<`rule-type`:string,`rule-id`:string,`rule-name`:string,"
    "`object-locator`:struct<`schema-name`:string,`table-name`:string>,`rule-action`:string>>>"
)
PATTERN = ["any_schema", "any_table", "schema_key", "table_key"]


def parse_rules(tasks: DataFrame, mappings: str = "table_mappings") -> tuple[DataFrame, DataFrame]:
    """(tasks with ``rules``, rejects): the selection rules of each task's mapping JSON.

    ``%`` alone is a wildcard, anything else is literal; ``exclude`` excludes, every other
    action includes.  A task whose mapping is not JSON with a list of rules is rejected,
    and so is a selection rule that lacks one of its locator's names.  A task without a
    mapping has no rules.
    """
    read = with_once(tasks, "_rules", F.from_json(mappings, RULES)["rules"])
    broken = F.col(mappings).isNotNull() & (F.col("_rules").isNull() | F.try_parse_json(mappings).isNull())
    chosen = F.filter("_rules", lambda r: r["rule-type"] == "selection")
    named = lambda r: (
        r["object-locator"]["schema-name"].isNotNull() & r["object-locator"]["table-name"].isNotNull()
    )
    rules = F.transform(
        F.filter(chosen, named),
        lambda r: F.struct(
            r["rule-id"].alias("rule_id"),
            F.nullif(r["object-locator"]["schema-name"], F.lit("%")).alias("schema_name"),
            F.nullif(r["object-locator"]["table-name"], F.lit("%")).alias("table_name"),
            (F.coalesce(r["rule-action"], F.lit("include")) != "exclude").alias("include"),
        ),
    )
    none = F.array().cast("array<struct<rule_id:string,schema_name:string,table_name:string,include:boolean>>")
    reject = lambda rows, reason: rows.select(
        F.lit("selection").alias("job"), F.col("task_id").alias("key"), reason.alias("reason")
    )
    nameless = read.filter(~broken).select(
        "task_id", F.explode(F.filter(chosen, lambda r: ~named(r))).alias("r")
    )
    rejects = reject(read.filter(broken), F.lit("mapping without rules")).unionByName(
        reject(nameless, F.concat(F.lit("rule without a locator: "), F.coalesce("r.rule-id", F.lit("?"))))
    )
    whole = read.filter(~broken).withColumn("rules", F.coalesce(rules, none)).drop("_rules")
    return whole, rejects


def _pattern(schema: Column, table: Column) -> list[Column]:
    return [
        schema.isNull().alias("any_schema"),
        table.isNull().alias("any_table"),
        F.coalesce(schema, F.lit("")).alias("schema_key"),
        F.coalesce(table, F.lit("")).alias("table_key"),
    ]


def select_tables(tasks: DataFrame, tables: DataFrame) -> DataFrame:
    """Distinct (task_id, database_rn, schema_name, table_name) every task selects.

    ``tasks``: task_id, database_rn, rules (see ``parse_rules``); one row per task and
    endpoint.  ``tables``: database_rn, schema_name, table_name.

    Includes that match nothing in the database select everything; excluded tables are
    removed afterwards.
    """
    anything = F.lit(None).cast("string")
    schema, table = F.col("schema_name"), F.col("table_name")
    offered = F.array(
        F.struct(*_pattern(schema, table)),
        F.struct(*_pattern(schema, anything)),
        F.struct(*_pattern(anything, table)),
        F.struct(*_pattern(anything, anything)),
    )
    keyed = tables.select("database_rn", "schema_name", "table_name", F.explode(offered).alias("p")).select(
        "database_rn", "schema_name", "table_name", "p.*"
    )
    excludes = F.filter("rules", lambda r: ~r["include"]).alias("excludes")
    owner = ["task_id", "database_rn"]
    included = (
        tasks.select(*owner, F.explode(F.filter("rules", lambda r: r["include"])).alias("r"))
        .select(*owner, *_pattern(F.col("r.schema_name"), F.col("r.table_name")))
        .distinct()
    )
    # which include rules match at least one table: a semi-join on the small pattern set
    patterns = keyed.select("database_rn", *PATTERN).distinct()
    effective = included.join(by_key(patterns), ["database_rn", *PATTERN], "left_semi")
    unresolved = tasks.select(*owner).join(by_key(effective.select(*owner).distinct()), owner, "left_anti")
    everything = unresolved.select(*owner, *_pattern(anything, anything))
    wanted = effective.select(*owner, *PATTERN).unionByName(everything)

    excluded = F.exists(
        "excludes",
        lambda r: (r["schema_name"].isNull() | (r["schema_name"] == schema))
        & (r["table_name"].isNull() | (r["table_name"] == table)),
    )
    return (
        wanted.join(by_key(tasks.select(*owner, excludes)), owner)
        .join(by_key(keyed), ["database_rn", *PATTERN])
        .filter(~excluded)
        .select(*owner, "schema_name", "table_name")
        .distinct()
    )
