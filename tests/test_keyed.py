"""Latest rows as the state of a stream."""

import json
import os

from metaspark.streaming.keyed import keyed_refresh, keyed_state

SCHEMA = "k long, at long, v string, gone boolean, over boolean"


def run(spark, folder, state, **more):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        changes = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(folder)
        keyed_refresh(changes, state, ["k"], "at", "gone", "over", **more).awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as out:
        for row in rows:
            out.write(json.dumps(dict(zip(("k", "at", "v", "gone", "over"), row))) + "\n")


def test_updates_deletes_late_rows_and_restarts(spark, tmp_path):
    changes, state, feed = (str(tmp_path / n) for n in ("in", "state", "feed"))
    put(changes, "a0.json", [(1, 5, "a", False), (2, 5, "b", False), (3, 5, "c", None), (None, 5, "n", False), (4, None, "x", False)])
    put(changes, "a1.json", [(1, 6, "a2", False), (2, 6, None, True), (3, 4, "old", False), (1, 6, "a1", False)])
    run(spark, changes, state, feed=feed)
    first = {r[0]: r[1:] for r in map(tuple, keyed_state(spark, state).collect())}
    assert first == {None: (5, "n"), 1: (6, "a2"), 3: (5, "c")}
    put(changes, "b0.json", [(2, 5, "late", False), (3, 9, None, True), (3, 8, "later than c, older than its end", False)])
    run(spark, changes, state, feed=feed)
    second = {r[0]: r[1:] for r in map(tuple, keyed_state(spark, state).collect())}
    assert second == {None: (5, "n"), 1: (6, "a2")}
    put(changes, "c0.json", [(2, 7, "again", False)])
    run(spark, changes, state, feed=feed)
    assert {r[0]: r[1:] for r in map(tuple, keyed_state(spark, state).collect())} == {**second, 2: (7, "again")}
    put(changes, "d0.json", [(1, 9, None, False, True), (3, 9, None, False, True), (None, 4, None, False, True), (3, 3, "new life", False)])
    run(spark, changes, state, feed=feed)
    assert {r[0]: r[1:] for r in map(tuple, keyed_state(spark, state).collect())} == {None: (5, "n"), 2: (7, "again"), 3: (3, "new life")}
    fed = {(r.k, r.at, r.is_deleted) for r in spark.read.parquet(feed).collect()}
    assert {(2, 6, True), (3, 9, True), (2, 7, False)} <= fed


def test_a_read_opens_the_last_version_only(spark, tmp_path):
    changes, state = str(tmp_path / "in"), str(tmp_path / "state")
    for batch in range(8):
        put(changes, f"f{batch:02d}.json", [(k, batch, f"v{batch}", False) for k in range(batch, 8)])
    run(spark, changes, state)
    assert len(os.listdir(f"{state}/commits")) >= 8
    assert sorted(map(tuple, keyed_state(spark, state).collect())) == [(k, k, f"v{k}") for k in range(8)]
    old = sorted(map(tuple, keyed_state(spark, state, batch_id=3).collect()))
    assert old == [(k, min(k, 3), f"v{min(k, 3)}") for k in range(8)]
    plan = keyed_state(spark, state)._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and "FileScan" not in plan
