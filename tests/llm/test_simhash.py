"""SimHash by Golay keys against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from metaspark.llm import simhash
from metaspark.llm import queries  # noqa: F401
from metaspark.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(p).encode(), 42) for p in parts]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def reached(rows):
    """Component of every (id, fingerprint), comparing all pairs."""
    group = list(range(len(rows)))

    def top(j):
        while group[j] != j:
            j = group[j]
        return j

    for j, (_, a) in enumerate(rows):
        for k in range(j):
            if (a ^ rows[k][1]).bit_count() <= 2:
                group[top(j)] = top(k)
    members = {}
    for j, (doc, _) in enumerate(rows):
        members.setdefault(top(j), []).append(doc)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in members.items()}
    return [least[top(j)] for j in range(len(rows))]


def test_code_is_perfect():
    patterns = simhash.ERRORS
    assert len(set(patterns.tolist())) == 2048 and max(int(p).bit_count() for p in patterns.tolist()) == 3
    words = np.arange(4096) << 11
    words ^= simhash.syndromes(words)
    assert (simhash.syndromes(words) == 0).all()
    assert min(int(w).bit_count() for w in words[1:].tolist()) == 7


def test_two_bits_apart_share_a_bucket():
    rnd = random.Random(1)
    for _ in range(400):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), rnd.randint(0, 2)):
            b ^= 1 << bit
        bucket, row = simhash.buckets(np.array([a, b], dtype=np.uint64))
        assert set(bucket[row == 0].tolist()) & set(bucket[row == 1].tolist())


@pytest.mark.parametrize("light", [2, 8, 512])
def test_links_connect_what_all_pairs_connect(spark, light):
    """Crowded buckets too: clusters of fingerprints a few bits around a centre."""
    rnd = random.Random(light)
    prints = set()
    for _ in range(12):
        centre = rnd.getrandbits(64)
        prints.add(centre)
        for _ in range(60):
            own = centre
            for bit in rnd.sample(range(64), rnd.randint(1, 3)):
                own ^= 1 << bit
            prints.add(own)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "print long").repartition(4)
    found = simhash.links(frame, light).collect()
    for r in found:
        assert ((r.a ^ r.b) & ((1 << 64) - 1)).bit_count() <= 2
    assert len(found) <= 17 * len(prints)
    parent = {p: p for p in signed}

    def top(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for r in found:
        parent[top(r.a)] = top(r.b)
    want = reached(list(zip(signed, prints)))
    got = {}
    for p, w in zip(signed, want):
        got.setdefault(w, set()).add(top(p))
    assert all(len(tops) == 1 for tops in got.values())
    assert len({next(iter(t)) for t in got.values()}) == len(got)


def test_strange_rows_and_clashing_columns(spark):
    rnd = random.Random(5)
    long_text = " ".join(rnd.choice(["alpha", "Beta", "gamma", "é", "ß"]) for _ in range(70_000))
    base = " ".join(f"w{rnd.randrange(10**6)}" for _ in range(300))
    rows = [
        (1, base), (2, base.upper()), (3, base.replace(" ", "\t\n")), (4, None), (5, ""), (6, " \x0b "), (None, base), (None, "x y"),
        (7, "one two"), (8, "One  two"), (9, long_text), (9, long_text), (10, "a"), (11, "naïve 😀 café ÀB"), (12, base + " more"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame = frame.withColumns({c: F.lit("own") for c in ("print", "component_id", "bucket", "least", "label", "a", "b")})
    out = simhash.near_duplicates(frame)
    assert out.columns == ["doc_id", "print", "component_id"]
    prints = [(doc, fingerprint(text)) for doc, text in rows]
    want = sorted(((d, p, c) for (d, p), c in zip(prints, reached(prints))), key=repr)
    got = sorted(((r.doc_id, r["print"] % (1 << 64), r.component_id) for r in out.collect()), key=repr)
    assert got == want
    assert simhash.near_duplicates(frame.limit(0)).collect() == []


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r.doc_id, fingerprint(r.text)) for r in docs]
    want = {(d, f"{p:016x}", c) for (d, p), c in zip(prints, reached(prints))}
    assert {tuple(r) for r in QUERIES["op12_golay_simhash"](spark, SF).collect()} == want
