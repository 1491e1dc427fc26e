"""The registered queries: contract, check SQL on DuckDB, whole tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry_module
from compare import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_entry(spark):
    df = entry_module.entry(spark)
    rows = df.collect()
    assert len(rows) == 64 and {r.kind for r in rows} == {"number", "datetime", "string", None}


def test_check_sql_belongs_to_queries():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    left = set(entry_module.queries()) - set(entry_module.oracle_sql())
    assert all(name == "pipeline" or name.startswith("op") for name in left)


def test_entity_names_are_unique(spark):
    union = entry_module.queries()["entity_union"](spark, SF)
    assert union.groupBy("entity_rn").count().filter("count > 1").isEmpty()


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_matches_its_check_sql(spark, con, name):
    df = entry_module.queries()[name](spark, SF)
    columns, rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(entry_module.oracle_sql()[name])
    want_columns, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert columns == want_columns
    assert rows == want


@pytest.mark.parametrize("missing", ["public_tokenizers", "metaspark.llm", "metaspark.llm.align"])
def test_entry_without_the_training_data_operators(missing):
    """Whatever they lack, the other queries are there."""
    import subprocess

    script = f"""
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as entry
names = set(entry.queries())
assert "entity_union" in names and not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in names), names
assert set(entry.oracle_sql()) <= names
print("others stay", len(names))
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True, timeout=120)
    assert "others stay" in done.stdout, done.stderr[-2000:]
