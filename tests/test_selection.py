"""Selection rules against a plain reading of their definition."""

import json
import random

import pytest

from conftest import rows
from metaspark.operators.selection import parse_rules, select_tables

CATALOG = [("A", "t1"), ("A", "t2"), ("B", "t1"), ("B", "t3")]


def rule(action, schema, table, kind="selection"):
    return {"rule-type": kind, "rule-id": "1", "rule-name": "n", "rule-action": action, "filters": [],
            "object-locator": {"schema-name": schema, "table-name": table}}


def select(spark, tasks, tables):
    """tasks: {task: (database, [rules])}; tables: {database: [(schema, table)]}."""
    task_df = spark.createDataFrame(
        [(t, db, json.dumps({"rules": rules})) for t, (db, rules) in tasks.items()],
        "task_id string, database_rn string, table_mappings string",
    )
    table_df = spark.createDataFrame(
        [(db, s, t) for db, members in tables.items() for s, t in members] or [("-", "-", "-")],
        "database_rn string, schema_name string, table_name string",
    )
    out = {t: [] for t in tasks}
    for r in rows(select_tables(parse_rules(task_df)[0], table_df).select("task_id", "schema_name", "table_name")):
        out[r[0]].append(r[1:])
    return {t: sorted(chosen) for t, chosen in out.items()}


def by_definition(rules, catalog):
    def match(r, s, t):
        loc = r["object-locator"]
        return loc["schema-name"] in ("%", s) and loc["table-name"] in ("%", t)

    chosen = [r for r in rules if r["rule-type"] == "selection"]
    include = {c for c in catalog for r in chosen if r["rule-action"] != "exclude" and match(r, *c)}
    exclude = {c for c in catalog for r in chosen if r["rule-action"] == "exclude" and match(r, *c)}
    survivors = set(catalog) - exclude
    return sorted(survivors & include if include else survivors)


CASES = {
    "all but one": ([rule("include", "%", "%"), rule("exclude", "A", "t2")], [("A", "t1"), ("B", "t1"), ("B", "t3")]),
    "overlap once": ([rule("include", "A", "%"), rule("include", "A", "t1")], [("A", "t1"), ("A", "t2")]),
    "any schema": ([rule("include", "%", "t1")], [("A", "t1"), ("B", "t1")]),
    "exclude any schema": ([rule("exclude", "%", "t1")], [("A", "t2"), ("B", "t3")]),
    "nothing resolved": ([rule("include", "Z", "z")], CATALOG),
    "excluded include": ([rule("include", "A", "t1"), rule("exclude", "A", "t1")], []),
    "literal percent": ([rule("exclude", "1%", "2")], CATALOG),
    "other rules only": ([rule("rename", "%", "%", "transformation")], CATALOG),
    "no rules": ([], CATALOG),
    "exclude all": ([rule("exclude", "%", "%")], []),
    "other action includes": ([rule("explicit", "B", "t3")], [("B", "t3")]),
}


def test_listed_cases(spark):
    got = select(spark, {n: ("db", r) for n, (r, _) in CASES.items()}, {"db": CATALOG})
    assert got == {n: sorted(expected) for n, (_, expected) in CASES.items()}
    for rules, expected in CASES.values():
        assert by_definition(rules, CATALOG) == sorted(expected)


@pytest.mark.parametrize("seed", range(3))
def test_random_rules(spark, seed):
    pick = random.Random(seed)
    schemas, names = ["A", "B", "%x", ""], ["t1", "t2", "t3", "1%"]
    tables = {
        f"db{i}": sorted({(pick.choice(schemas), pick.choice(names)) for _ in range(pick.randint(1, 9))}) for i in range(4)
    }
    tasks = {}
    for i in range(60):
        rules = [
            rule(pick.choice(["include", "exclude", "explicit"]), pick.choice([*schemas, "%", "%"]), pick.choice([*names, "%", "%"]),
                 pick.choice(["selection"] * 5 + ["transformation"]))
            for _ in range(pick.randint(0, 5))
        ]
        tasks[f"task{i}"] = (pick.choice(sorted(tables)), rules)
    got = select(spark, tasks, tables)
    assert got == {t: by_definition(rules, tables[db]) for t, (db, rules) in tasks.items()}


def test_plan_has_no_cross_or_nested_loop_join(spark):
    task_df = spark.range(100).selectExpr("cast(id as string) task_id", "cast(id % 7 as string) database_rn", "'{}' table_mappings")
    table_df = spark.range(100).selectExpr("cast(id % 7 as string) database_rn", "cast(id as string) schema_name", "'t' table_name")
    plan = select_tables(parse_rules(task_df)[0], table_df)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_broken_mappings_and_rules_are_rejected(spark):
    rule = '{"rule-type":"selection","rule-id":"7","object-locator":{"schema-name":"s"%s},"rule-action":"exclude"}'
    texts = [
        ("broken", "broken {"), ("not rules", '{"a":1}'), ("none", None), ("ok", '{"rules":[%s]}' % (rule % ',"table-name":"t"')),
        ("nameless", '{"rules":[%s]}' % (rule % "")), ("no locator", '{"rules":[{"rule-type":"selection","rule-action":"exclude"}]}'),
    ]
    tasks = spark.createDataFrame([(t, "d", m) for t, m in texts], "task_id string, database_rn string, table_mappings string")
    tables = spark.createDataFrame([("d", "s", "t"), ("d", "s", "u")], "database_rn string, schema_name string, table_name string")
    kept, rejects = parse_rules(tasks)
    assert sorted(r.key for r in rejects.collect()) == ["broken", "nameless", "no locator", "not rules"]
    found = select_tables(kept, tables).groupBy("task_id").count().collect()
    assert {r.task_id: r["count"] for r in found} == {"none": 2, "ok": 1, "nameless": 2, "no locator": 2}
