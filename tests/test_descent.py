"""Group descent, with cycles, diamonds and other member types."""

import random
from collections import deque

import pytest

from conftest import rows
from metaspark.operators.descent import descend, reach, update

EDGE = "group_rn string, member_rn string, member_type string"
G = "DATABASE_SERVICE"


def test_fixture(spark):
    members = spark.createDataFrame(
        [("db", "s1", G), ("db", "s2", G), ("s1", "t1", "TABLE"), ("s1", "t2", "TABLE"), ("s2", "s3", G),
         ("s3", "t3", "TABLE"), ("s2", "v1", "VIEW"), ("s3", "db", G)], EDGE)
    roots = spark.createDataFrame([("db",)], "group_rn string")
    tables, rejects = descend(members, roots)
    assert rows(tables) == [("db", "t1", 2), ("db", "t2", 2), ("db", "t3", 3)]
    assert [r[1] for r in rows(rejects)] == ["v1"]


def test_random_graphs(spark):
    pick = random.Random(7)
    edges = set()
    for _ in range(120):
        parent = f"g{pick.randrange(20)}"
        edges.add((parent, f"g{pick.randrange(20)}", G) if pick.random() < 0.4 else (parent, f"t{pick.randrange(40)}", "TABLE"))
    # one group holds a third of all tables
    edges |= {("g3", f"x{i}", "TABLE") for i in range(60)}
    children = {}
    for p, c, k in edges:
        children.setdefault(p, []).append((c, k))
    expected = []
    for root in children:
        depth, seen, queue, found = 0, {root}, deque([(root, 0)]), {}
        while queue:
            group, depth = queue.popleft()
            for c, k in children.get(group, []):
                if k == "TABLE":
                    found.setdefault(c, depth + 1)
                elif c not in seen:
                    seen.add(c)
                    queue.append((c, depth + 1))
        expected += [(root, t, d) for t, d in found.items()]
    tables, _ = descend(spark.createDataFrame(sorted(edges), EDGE))
    assert rows(tables) == sorted(expected, key=repr)


def test_empty(spark):
    tables, rejects = descend(spark.createDataFrame([], EDGE))
    assert tables.count() == 0 and rejects.count() == 0


def test_deep_chain_keeps_a_short_plan(spark):
    chain = [(f"g{i}", f"g{i + 1}", G) for i in range(14)] + [("g14", "t", "TABLE"), ("g14", "g0", G)]
    tables, _ = descend(spark.createDataFrame(chain, EDGE), spark.createDataFrame([("g0",)], "group_rn string"))
    assert rows(tables) == [("g0", "t", 15)]


@pytest.mark.parametrize("seed", [1, 2])
def test_update_equals_a_full_descent(spark, seed):
    """Random graphs with cycles; members come, go and turn from tables into groups."""
    rnd = random.Random(seed)
    kind = lambda n: "DATABASE_SERVICE" if n.startswith("g") else "TABLE"
    rows = {(f"g{rnd.randrange(30)}", rnd.choice([f"g{rnd.randrange(30)}", f"t{rnd.randrange(60)}"])) for _ in range(55)}
    changed = set(rows)
    for row in rnd.sample(sorted(rows), 3):
        changed.discard(row)
    changed |= {(f"g{rnd.randrange(34)}", f"t{rnd.randrange(60)}") for _ in range(3)} | {("g1", "g2"), ("g2", "g1")}
    frame = lambda some: spark.createDataFrame([(g, m, kind(m)) for g, m in sorted(some)], "group_rn string, member_rn string, member_type string")
    before, after = frame(rows), frame(changed)
    tables, _, groups = reach(before)
    new_tables, new_groups, again = update(tables, groups, before, after)
    want_tables, _, want_groups = reach(after)
    everything = lambda df: sorted(map(tuple, df.collect()))
    assert everything(new_tables) == everything(want_tables)
    assert everything(new_groups) == everything(want_groups)
    assert 0 < again.count() < want_groups.select("root_rn").distinct().count()
    same_tables, _, none = update(tables, groups, before, before)
    assert none.count() == 0 and everything(same_tables) == everything(tables)
