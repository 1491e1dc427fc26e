"""Profiles kept for each file and merged."""

import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from metaspark.operators.sketch_profile import SCHEMA, refresh_profiles


def write(folder, name, rows, seed):
    rnd = random.Random(seed)
    os.makedirs(folder, exist_ok=True)
    numbers = [rnd.choice([None, rnd.randrange(5000), rnd.randrange(5000)]) for _ in range(rows)]
    texts = [f"t{rnd.randrange(900)}" for _ in range(rows)]
    pq.write_table(pa.table({"n": pa.array(numbers, pa.int64()), "t": texts}), f"{folder}/{name}.parquet")
    return list(zip(numbers, texts))


def check(found, data):
    got = {r.column_name: r for r in found.collect()}
    numbers = [n for n, _ in data if n is not None]
    n, t = got["n"], got["t"]
    assert (n.n_rows, n.nulls_count, n.low_number, n.high_number) == (len(data), len(data) - len(numbers), min(numbers), max(numbers))
    assert (t.low_text, t.high_text, t.nulls_count) == (min(x for _, x in data), max(x for _, x in data), 0)
    assert n.unique_estimate == pytest.approx(len(set(numbers)), rel=0.06)
    assert t.unique_estimate == pytest.approx(len({x for _, x in data}), rel=0.06)
    rank = sum(x <= n.median_estimate for x in numbers) / len(numbers)
    assert 0.46 < rank < 0.54 and t.median_estimate is None


def test_new_changed_and_removed_files(spark, tmp_path):
    lake, state = str(tmp_path / "lake"), str(tmp_path / "state")
    files = {name: write(lake, name, 3000, seed) for seed, name in enumerate(("a", "b b", "c"))}
    every = lambda: [row for rows in files.values() for row in rows]
    kept = lambda: spark.read.schema(SCHEMA).parquet(state).select("path", "modification_time").distinct().count()
    check(refresh_profiles(spark, lake, state), every())
    assert kept() == 3
    check(refresh_profiles(spark, lake, state), every())
    assert kept() == 3
    files["d"] = write(f"{lake}/sub", "d", 2000, 9)
    files["a"] = write(lake, "a", 500, 10)
    os.remove(f"{lake}/c.parquet")
    del files["c"]
    check(refresh_profiles(spark, lake, state), every())
    assert kept() == 5
