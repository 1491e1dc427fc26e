"""Type texts of four dialects -> field trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from metaspark.operators.type_tree import field_rows

from .registry import query, table, text

# One template per remainder of the part key; N is the part's size, so the number of
# different texts grows with the data.  Expected fields are listed beside each.
# (dialect, type text, [(relative path, parent path or None, name, type, logical, key, value)])
_TEMPLATES = [
    ("glue", "struct<a:int,b:varchar(N)>", [
        ("", None, "c", "STRUCT", "struct", False, False),
        ("/subcolumns/a", "", "a", "INTEGER", "int", False, False),
        ("/subcolumns/b", "", "b", "STRING", "varchar(N)", False, False),
    ]),
    ("glue", "array<struct<x_N:bigint,y:timestamp>>", [
        ("", None, "c", "LIST", "list", False, False),
        ("/subcolumns/struct", "", "struct", "STRUCT", "struct", False, False),
        ("/subcolumns/struct/subcolumns/x_N", "/subcolumns/struct", "x_N", "NUMBER", "bigint", False, False),
        ("/subcolumns/struct/subcolumns/y", "/subcolumns/struct", "y", "INTEGER", "timestamp", False, False),
    ]),
    ("glue", "map<string,array<char(N)>>", [
        ("", None, "c", "MAP", "map", False, False),
        ("/keys/string", "", "string", "STRING", "string", True, False),
        ("/values/list", "", "list", "LIST", "list", False, True),
        ("/values/list/subcolumns/char", "/values/list", "char", "CHAR", "char(N)", False, False),
    ]),
    ("glue", "DECIMAL(38,N)", [("", None, "c", "NUMBER", "decimal(38, N)", False, False)]),
    ("athena", "union<int,struct<k.N:date>>", [
        ("", None, "c", "UNION", "union", False, False),
        ("/subcolumns/int", "", "int", "INTEGER", "int", False, False),
        ("/subcolumns/struct", "", "struct", "STRUCT", "struct", False, False),
        ("/subcolumns/struct/subcolumns/k.N", "/subcolumns/struct", "k.N", "DATETIME", "date", False, False),
    ]),
    ("athena", "set<decimal(20,N)>", [
        ("", None, "c", "LIST", "list", False, False),
        ("/subcolumns/decimal", "", "decimal", "NUMBER", "decimal(20, N)", False, False),
    ]),
    ("athena", "interval", [("", None, "c", "DURATION", "interval", False, False)]),
    ("arrow", "struct<a: int64, b: list<item: decimal128(20, N)>>", [
        ("", None, "c", "STRUCT", "struct", False, False),
        ("/subcolumns/a", "", "a", "INTEGER", "int64", False, False),
        ("/subcolumns/b", "", "b", "LIST", "list", False, False),
        ("/subcolumns/b/values/decimal128", "/subcolumns/b", "decimal128", "NUMBER", "decimal128(20, N)", False, True),
    ]),
    ("arrow", "map<string, timestamp[us, tz=UTC]>", [
        ("", None, "c", "MAP", "map", False, False),
        ("/keys/string", "", "string", "STRING", "string", True, False),
        ("/values/timestamp", "", "timestamp", "DATETIME", "timestamp[us, tz=UTC]", False, True),
    ]),
    ("arrow", "list<element: struct<n_N: bool>>", [
        ("", None, "c", "LIST", "list", False, False),
        ("/values/struct", "", "struct", "STRUCT", "struct", False, True),
        ("/values/struct/subcolumns/n_N", "/values/struct", "n_N", "BOOLEAN", "bool", False, False),
    ]),
    ("arrow", "dictionary<values=string, indices=int32, ordered=0>", [
        ("", None, "c", "STRUCT", "dictionary", False, False),
    ]),
    ("arrow", "struct<broken_N", [("", None, "c", "UNKNOWN", "struct<broken_N", False, False)]),
    ("delta", '{"type":"array","elementType":"integer","containsNull":true}', [
        ("", None, "c", "LIST", "list", False, False),
        ("/values/integer", "", "integer", "INTEGER", "integer", False, True),
    ]),
    ("delta", '{"type":"struct","fields":[{"name":"f_N","type":"timestamp","nullable":true,"metadata":{}}]}', [
        ("", None, "c", "STRUCT", "struct", False, False),
        ("/subcolumns/f_N", "", "f_N", "TIME", "timestamp", False, False),
    ]),
    ("glue", "uniontype<int,char(N)>", []),
    ("athena", "geometry_N", []),
]
_COUNT = len(_TEMPLATES)


def _quoted(value) -> str:
    if value is None:
        return "NULL"
    return str(value).upper() if isinstance(value, bool) else "'" + str(value).replace("'", "''") + "'"


_EXPECTED = ", ".join(
    f"({i}, {j}, " + ", ".join(_quoted(v) for v in row) + ")"
    for i, (_, _, rows) in enumerate(_TEMPLATES)
    for j, row in enumerate(rows)
)


def _columns(spark, sf_dir):
    dialects = F.array(*[F.lit(d) for d, _, _ in _TEMPLATES])
    texts = F.array(*[F.lit(t) for _, t, _ in _TEMPLATES])
    pick = (F.col("p_partkey") % _COUNT).cast("int") + 1
    rn = text("part/", F.col("p_partkey"))
    return table(spark, sf_dir, "part").select(
        rn.alias("entity_rn"),
        text(rn, "/columns/c").alias("column_rn"),
        F.lit(0).alias("position"),
        F.lit("c").alias("column_name"),
        F.element_at(dialects, pick).alias("dialect"),
        F.replace(F.element_at(texts, pick), F.lit("N"), F.col("p_size").cast("string")).alias("type_string"),
        F.lit(True).alias("is_nullable"),
        F.lit(None).cast("string").alias("description"),
    )


@query(
    "type_tree",
    f"""
WITH e(t, ordinal, rel, parent, name, type, logical, is_key, is_value) AS (VALUES {_EXPECTED})
SELECT 'part/' || p_partkey || '/columns/c' || replace(rel, 'N', p_size::VARCHAR) AS field_rn,
       'part/' || p_partkey || '/columns/c' || replace(parent, 'N', p_size::VARCHAR) AS parent_field_rn,
       CAST(ordinal AS INTEGER) AS ordinal, replace(name, 'N', p_size::VARCHAR) AS name, type,
       replace(logical, 'N', p_size::VARCHAR) AS logical_type, is_key, is_value
FROM part JOIN e ON p_partkey % {_COUNT} = e.t""",
)
def type_tree(spark, sf_dir):
    fields, _ = field_rows(_columns(spark, sf_dir))
    return fields.select("field_rn", "parent_field_rn", "ordinal", "name", "type", "logical_type", "is_key", "is_value")


@query(
    "type_rejects",
    f"""
SELECT 'fields' AS job, 'part/' || p_partkey || '/columns/c' AS "key"
FROM part WHERE p_partkey % {_COUNT} IN ({", ".join(str(i) for i, t in enumerate(_TEMPLATES) if not t[2])})""",
)
def type_rejects(spark, sf_dir):
    _, rejects = field_rows(_columns(spark, sf_dir))
    return rejects.select("job", "key")
