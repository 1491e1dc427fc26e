"""Transaction logs on disk: discovery, replay, checkpoints, metadata, fields."""

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import rows
from metaspark.operators import log_replay as lr
from metaspark.sources import txlog
from metaspark.sources.objects import walk_objects

SCHEMA = json.dumps(
    {"type": "struct", "fields": [
        {"name": "id", "type": "long", "nullable": False, "metadata": {"comment": "key"}},
        {"name": "tags", "type": {"type": "array", "elementType": "string", "containsNull": True}, "nullable": True, "metadata": {}},
    ]}
)


def add(path, size, records=None, at=1_000):
    stats = {} if records is None else {"stats": json.dumps({"numRecords": records})}
    return {"add": {"path": path, "size": size, "modificationTime": at, "partitionValues": {}, "dataChange": True, **stats}}


def remove(path):
    return {"remove": {"path": path, "deletionTimestamp": 5}}


def meta(name, columns=("d",)):
    return {"metaData": {"id": "m", "name": name, "description": "about", "partitionColumns": list(columns),
                         "configuration": {"a": "b"}, "createdTime": 1_600_000_000_000, "schemaString": SCHEMA}}


def commit(root, version, *actions):
    folder = os.path.join(root, "_delta_log")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{version:020d}.json"), "w") as out:
        out.write("\n".join(json.dumps(a) for a in actions) + "\n")


@pytest.fixture
def table(tmp_path):
    root = str(tmp_path / "lake" / "t")
    commit(root, 0, meta("first"), add("a", 100, 10, at=9_000), add("b", 200, 20))
    commit(root, 1, remove("a"), add("c", 50, 5))
    commit(root, 2, add("d", 10, None, at=3_000), {"commitInfo": {"operation": "WRITE"}})
    return root


def test_replay(spark, tmp_path, table):
    actions = txlog.read_actions(walk_objects(spark, str(tmp_path / "lake")))
    after_one = lr.log_totals(lr.live_files(actions, as_of=1)).first()
    assert (after_one.num_files, after_one.size_bytes, after_one.num_records) == (2, 250, 25)
    after_two = lr.log_totals(lr.live_files(actions)).first()
    # one file has no count: the table's rows are unknown
    assert (after_two.num_files, after_two.size_bytes, after_two.num_records) == (3, 260, None)
    assert after_two.root == table
    # the greatest time of a live file, not the last one listed
    assert lr.log_totals(lr.live_files(actions)).select(F.unix_millis("modified_at")).first()[0] == 3_000


def test_metadata_and_fields(spark, tmp_path, table):
    commit(table, 3, meta("renamed", ("d", "e")))
    actions = txlog.read_actions(walk_objects(spark, str(tmp_path / "lake")))
    last = lr.log_metadata(actions).first()
    assert (last.name, last.description, last.partition_columns, last.configuration) == ("renamed", "about", "d,e", {"a": "b"})
    assert lr.log_metadata(actions, as_of=2).first().name == "first"
    columns = lr.log_columns(lr.log_metadata(actions)).orderBy("position").collect()
    assert [(c.column_name, c.is_nullable, c.description) for c in columns] == [("id", False, "key"), ("tags", True, None)]
    assert columns[1].type_string.startswith('{"type":"array"')
    tables = lr.log_tables(actions).first()
    assert tables.num_files == 3 and tables.name == "renamed"


def test_checkpoint_replaces_the_commits_before_it(spark, tmp_path, table):
    text, whole = pa.string(), pa.int64()
    action = pa.schema([
        ("txn", pa.struct([("appId", text)])),
        ("add", pa.struct([("path", text), ("size", whole), ("modificationTime", whole), ("stats", text), ("dataChange", pa.bool_())])),
        ("remove", pa.struct([("path", text)])),
        ("metaData", pa.struct([("id", text), ("name", text), ("partitionColumns", pa.list_(text)), ("schemaString", text)])),
    ])
    saved = pa.Table.from_pylist(
        [
            {"add": {"path": "b", "size": 200, "modificationTime": 1_000, "stats": '{"numRecords":20}'}},
            {"add": {"path": "z", "size": 7, "modificationTime": 1_000, "stats": '{"numRecords":1}'}},
            {"remove": {"path": "a"}},
            {"metaData": {"id": "m", "name": "saved", "partitionColumns": [], "schemaString": SCHEMA}},
        ],
        schema=action,
    )
    pq.write_table(saved, os.path.join(table, "_delta_log", f"{1:020d}.checkpoint.parquet"))
    actions = txlog.read_actions(walk_objects(spark, str(tmp_path / "lake")))
    # commits 0 and 1 are no longer read: z comes from the checkpoint, c is gone
    assert rows(lr.live_files(actions).select("path")) == [("b",), ("d",), ("z",)]
    assert lr.log_metadata(actions).first().name == "saved"


def test_same_commit_remove_then_add_is_live(spark):
    lines = spark.createDataFrame([("t", 1, json.dumps(remove("a"))), ("t", 1, json.dumps(add("a", 1, 1)))], "root string, version long, value string")
    assert lr.live_files(txlog.parse_actions(lines)).count() == 1


def test_discovery(spark):
    log = f"_delta_log/{0:020d}.json"
    listing = [
        f"lake/a/{log}", f"lake/a/inner/{log}", f"lake/b/deep/er/{log}", f"lake/b/_pii/{log}",
        f"other/x/{log}", "lake/c/part-0.parquet", f"lake/d/_delta_log/{3:020d}.checkpoint.parquet",
        "lake/e/_delta_log/notes.json", f"lake/ab/{log}",
    ]
    df = spark.createDataFrame([(p,) for p in listing], "path string")
    assert rows(txlog.discover_tables(df)) == [("lake/a",), ("lake/ab",), ("lake/b/_pii",), ("lake/b/deep/er",), ("lake/d",), ("other/x",)]
    assert rows(txlog.discover_tables(df, start="lake/", exclude=["_pii"])) == [
        ("lake/a",), ("lake/ab",), ("lake/b/deep/er",), ("lake/d",)]
    # every folder on the way must be allowed, the start is never tested
    assert rows(txlog.discover_tables(df, start="lake", include=["/b"])) == [("lake/b/_pii",), ("lake/b/deep/er",)]
    assert rows(txlog.discover_tables(df, start="lake/a", include=["nothing"])) == [("lake/a",)]


ACTION = pa.schema([
    ("add", pa.struct([("path", pa.string()), ("size", pa.int64())])),
    ("sidecar", pa.struct([("path", pa.string()), ("sizeInBytes", pa.int64())])),
])


def save(folder, name, *actions):
    os.makedirs(folder, exist_ok=True)
    pq.write_table(pa.Table.from_pylist(list(actions), schema=ACTION), os.path.join(folder, name))


def live(spark, tmp_path):
    return rows(lr.live_files(txlog.read_actions(walk_objects(spark, str(tmp_path / "lake")))).select("path"))


def test_a_checkpoint_counts_with_all_its_parts(spark, tmp_path, table):
    log = os.path.join(table, "_delta_log")
    name = "{:020d}.checkpoint.{:010d}.{:010d}.parquet"
    save(log, name.format(2, 1, 2), {"add": {"path": "p1", "size": 1}})
    assert live(spark, tmp_path) == [("b",), ("c",), ("d",)]
    save(log, f"{1:020d}.checkpoint.parquet", {"add": {"path": "older", "size": 1}})
    assert live(spark, tmp_path) == [("d",), ("older",)]
    save(log, name.format(2, 2, 2), {"add": {"path": "p2", "size": 1}})
    assert live(spark, tmp_path) == [("p1",), ("p2",)]


@pytest.mark.parametrize("ending", ["parquet", "json"])
def test_a_named_checkpoint_and_its_side_files(spark, tmp_path, table, ending):
    log = os.path.join(table, "_delta_log")
    save(os.path.join(log, "_sidecars"), "s.parquet", {"add": {"path": "side", "size": 4}})
    actions = [{"add": {"path": "top", "size": 1}}, {"sidecar": {"path": "s.parquet", "sizeInBytes": 9}}]
    name = f"{2:020d}.checkpoint.80a083e8-7026-4e79-81be-64bd76c43a11.{ending}"
    if ending == "parquet":
        save(log, name, *actions)
    else:
        with open(os.path.join(log, name), "w") as out:
            out.write("\n".join(map(json.dumps, actions)))
    assert live(spark, tmp_path) == [("side",), ("top",)]
    commit(table, 3, add("late", 1))
    assert live(spark, tmp_path) == [("late",), ("side",), ("top",)]


def test_covered_commits_are_left_out_before_they_are_opened(spark, tmp_path, table):
    save(os.path.join(table, "_delta_log"), f"{1:020d}.checkpoint.parquet", {"add": {"path": "x", "size": 1}})
    with open(os.path.join(table, "_delta_log", f"{0:020d}.json"), "w") as out:
        out.write("\udcff broken".encode("utf-8", "surrogatepass").decode("latin-1"))
    assert live(spark, tmp_path) == [("d",), ("x",)]
    actions = txlog.read_actions(walk_objects(spark, str(tmp_path / "lake")))
    plan = actions._jdf.queryExecution().optimizedPlan().toString()
    commits = plan[plan.index("saved_version") - 400 :]
    assert "MapInArrow" in plan and "saved_version" in commits


def test_long_commits_come_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(txlog, "LINES", 3)
    root = str(tmp_path / "lake" / "t")
    commit(root, 0, *[add(f"f{i}", i) for i in range(10)])
    assert len(live(spark, tmp_path)) == 10


def save_as_is(folder, name, *actions):
    """A checkpoint with all that the actions hold."""
    os.makedirs(folder, exist_ok=True)
    pq.write_table(pa.Table.from_pylist([{"add": {k: v for k, v in a["add"].items() if k != "partitionValues"}} for a in actions]), os.path.join(folder, name))


def vectored(path, size, records, deleted, name, at=1_000):
    action = add(path, size, records, at)
    action["add"]["deletionVector"] = {"storageType": "u", "pathOrInlineDv": name, "offset": 1, "sizeInBytes": 40, "cardinality": deleted}
    return action


def totals(files):
    return sorted(map(tuple, lr.log_totals(files).select("num_files", "size_bytes", "num_records").collect()))


@pytest.mark.parametrize("checkpointed", [False, True])
def test_deletion_vectors_take_rows_off(spark, tmp_path, checkpointed):
    root = str(tmp_path / "lake" / "t")
    commit(root, 0, meta("m"), add("a", 100, 10), add("b", 100, 3))
    commit(root, 1, remove("a"), vectored("a", 100, 10, 4, "v1"))
    gone = remove("a")
    gone["remove"]["deletionVector"] = {"storageType": "u", "pathOrInlineDv": "v1", "offset": 1, "cardinality": 4}
    commit(root, 2, gone, vectored("a", 100, 10, 7, "v2"), remove("b"))
    if checkpointed:
        save_as_is(os.path.join(root, "_delta_log"), f"{1:020d}.checkpoint.parquet", vectored("a", 100, 10, 4, "v1"), add("b", 100, 3))
    actions = txlog.read_actions(walk_objects(spark, str(tmp_path / "lake")))
    if not checkpointed:
        assert totals(lr.live_files(actions, as_of=0)) == [(2, 200, 13)]
    assert totals(lr.live_files(actions, as_of=1)) == [(2, 200, 9)]
    assert totals(lr.live_files(actions)) == [(1, 100, 3)]


def test_many_side_files_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(txlog, "LINES", 7)
    root = str(tmp_path / "lake" / "t")
    log = os.path.join(root, "_delta_log")
    for j in range(50):
        save(os.path.join(log, "_sidecars"), f"s{j}.parquet", *[{"add": {"path": f"p{j}-{k}", "size": 1}} for k in range(4)])
    with open(os.path.join(log, f"{2:020d}.checkpoint.80a083e8-7026-4e79-81be-64bd76c43a11.json"), "w") as out:
        out.write("\n".join(json.dumps({"sidecar": {"path": f"s{j}.parquet", "sizeInBytes": 9}}) for j in range(50)))
    files = txlog.checkpoint_files(walk_objects(spark, str(tmp_path / "lake")))
    assert txlog.side_files(files).count() == 50
    read = txlog.checkpoint_actions(files)
    tasks = [r["n"] for r in read.filter("add IS NOT NULL").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(tasks) == 200 and len(tasks) >= 8 and max(tasks) <= 60
    assert len(live(spark, tmp_path)) == 200


def test_replay_goes_on_from_its_state(spark, tmp_path):
    from metaspark.plans.replay_state import replay, saved_state

    lake, state = str(tmp_path / "lake"), str(tmp_path / "state")
    root, other = f"{lake}/t", f"{lake}/u"
    commit(root, 0, meta("m"), add("a", 100, 10), add("b", 100, 3))
    commit(root, 1, remove("a"), vectored("a", 100, 10, 4, "v1"))
    commit(other, 0, add("x", 1, 1))
    assert totals(replay(walk_objects(spark, lake), state)) == [(1, 1, 1), (2, 200, 9)]
    for version in (0, 1):  # opened no more
        with open(os.path.join(root, "_delta_log", f"{version:020d}.json"), "wb") as out:
            out.write(b"\xff broken")
    assert totals(replay(walk_objects(spark, lake), state)) == [(1, 1, 1), (2, 200, 9)]
    commit(root, 2, remove("b"), add("c", 7, 2))
    commit(f"{lake}/new", 0, add("n", 5, 5))
    assert totals(replay(walk_objects(spark, lake), state)) == [(1, 1, 1), (1, 5, 5), (2, 107, 8)]
    # a gap: commit 4 follows a cleaned-up log whose checkpoint is of version 3
    commit(root, 4, add("e", 1, 1))
    save_as_is(os.path.join(root, "_delta_log"), f"{3:020d}.checkpoint.parquet", add("d", 2, 2))
    assert totals(replay(walk_objects(spark, lake), state)) == [(1, 1, 1), (1, 5, 5), (2, 3, 3)]
    heads = {r.root.rsplit("/", 1)[1]: r.saved_version for r in saved_state(spark, state)[1].collect()}
    assert heads == {"t": 4, "u": 0, "new": 0}
