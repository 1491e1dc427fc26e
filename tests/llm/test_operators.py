"""The training-data operators against brute force, on strange rows and on the small tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from metaspark.llm import ann, bpe, fingerprint, jaccard, langid, mixing, queries, quotes, recurrent, sharding, toxicity
from metaspark.llm.components import components
from metaspark.llm.registry import QUERIES
from metaspark.llm.words import shingle_sets, text_slices

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def strange_rows():
    """Nulls in every column, empty and blank texts, a very long one, copies and a repeated row."""
    rnd = random.Random(3)
    long_text = " ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "é", "ß"]) for _ in range(40_000))
    base = " ".join(f"word{i}" for i in range(60))
    rows = [
        (1, base, "en", "a", 1), (2, base.upper(), "en", "a", 1), (3, base + " more", "en", "b", 1),
        (4, None, None, None, None), (5, "", "fr", None, 0), (6, " \t\n ", "fr", "b", 3), (None, base, "en", None, 1),
        (7, "one two three", None, "c", 3), (8, "One  two\tthree", "de", "c", 3), (9, long_text, "de", "a", 9),
        (10, "12 34 !! 56", "es", "d", 4), (10, "12 34 !! 56", "es", "d", 4), (11, "naïve 😀 café", "fr", "d", 4),
    ]
    return rows


@pytest.fixture(scope="module")
def strange(spark):
    df = spark.createDataFrame(strange_rows(), DOCS)
    clash = ["_size", "_rate", "slot", "tox_score", "lang_pred", "n_tokens", "set_id", "label", "component_id", "score", "row", "part"]
    return df.withColumns({c: F.lit("own") for c in clash})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def plain(spark, strange):
    return spark.createDataFrame([], DOCS), strange


def test_mix_targets_and_copies(spark, strange, docs):
    rows = mixing.mix(docs).collect()
    sizes = collections.Counter()
    for r in rows:
        assert r["_size"] == len(WORD.findall(r.text or ""))
        sizes[r.source] += r["_size"]
    names = sorted(sizes, key=lambda s: s.encode())
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, full, left = {}, set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        level = (left - sum(3 * sizes[s] for s in full)) / sum(weight[s] for s in free)
        new = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not new:
            break
        full |= new
    target = {s: 3 * sizes[s] if s in full else weight[s] * level for s in names}
    for r in rows:
        assert r["_target"] == pytest.approx(target[r.source]) and r["_source_size"] == sizes[r.source]
        assert math.floor(target[r.source] / sizes[r.source]) <= r["_copies"] <= math.ceil(target[r.source] / sizes[r.source])
    assert sum(r["_copies"] * r["_size"] for r in rows) == pytest.approx(sum(sizes.values()), rel=0.35)
    assert sorted(map(tuple, mixing.mix(docs).select("doc_id", "_copies").collect())) == sorted((r.doc_id, r["_copies"]) for r in rows)
    mixed = mixing.mix(strange)
    assert mixed.count() == strange.count() and mixing.expand(mixed).count() == mixed.agg(F.sum("_copies")).first()[0]
    salted = mixing.mix(strange, broadcast_sources=0).select("doc_id", "_copies", "_target")
    assert sorted(salted.collect(), key=str) == sorted(mixed.select("doc_id", "_copies", "_target").collect(), key=str)
    assert mixing.expand(mixing.mix(spark.createDataFrame([], DOCS))).count() == 0


def test_shards(spark, strange):
    rows = QUERIES["op2_shard_tree"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    slots = collections.defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert r.size == len(raw) + 8 and r.text_crc32 == zlib.crc32(raw) and 0 <= r.shard < 24
        assert r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    placed = sharding.shard(strange, sharding.even_tree(4), sharding.even_tree(5))
    assert placed.count() == strange.count() and placed.filter("doc_id IS NULL AND _place IS NULL").isEmpty()
    numbered = sharding.slotted(placed.withColumn("s", F.col("_place.shard")), "s", ["doc_id", "text"], 100_000)
    per = collections.defaultdict(list)
    for r in numbered.collect():
        per[r.s].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in per.values())


def test_shard_weights_confine_movement(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "doc_id")
    tree = sharding.even_tree(12)
    heavier = [leaf._replace(weight=3.0) if leaf.shard == 4 else leaf for leaf in tree]
    moved = sharding.shard(keys, tree, heavier).select(F.col("_place.shard").alias("a"), F.col("_grown.shard").alias("b"))
    counts = {(r.a, r.b): r["count"] for r in moved.groupBy("a", "b").count().collect()}
    assert all(a == b or b == 4 for a, b in counts)
    got = sum(n for (_, b), n in counts.items() if b == 4)
    assert got == pytest.approx(20_000 * 3 / 14, rel=0.05)


def test_language(spark, strange, docs):
    rows = QUERIES["op3_language_bayes"](spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    model = langid.train(strange)
    found = {r.doc_id: r for r in langid.identify(strange, model).collect()}
    assert {found[i].lang_pred for i in (4, 5, 6, 10)} == {"und"} and found[1].lang_pred in model.languages
    empty = langid.train(spark.createDataFrame([], DOCS))
    assert empty.languages == [] and {r.lang_pred for r in langid.identify(strange, empty).collect()} == {"und"}
    assert langid.identify(spark.createDataFrame([], DOCS), model).count() == 0


def brute_segments(scores):
    """Maximal segments by definition: best segment, then the same left and right of it."""
    best = None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            total = sum(scores[i:j])
            if total > 1e-9 and (best is None or total > best[2] + 1e-9):
                best = (i, j, total)
    if best is None:
        return []
    left = brute_segments(scores[: best[0]])
    right = [(a + best[1], b + best[1], s) for a, b, s in brute_segments(scores[best[1] :])]
    return [*left, best, *right]


def test_maximal_segments():
    rnd = random.Random(1)
    for _ in range(200):
        n = rnd.randint(1, 18)
        hits = sorted(rnd.sample(range(n), rnd.randint(0, min(n, 6))))
        weights = [rnd.choice([0.13, 0.57, 1.01, 1.9]) + rnd.random() * 0.01 for _ in hits]
        scores = [-0.2] * n
        for at, w in zip(hits, weights):
            scores[at] = w
        got = toxicity.maximal_segments(hits, weights, 0.2)
        want = brute_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in want])


def test_toxicity(spark, strange):
    big = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op4_toxic_segments"](spark, big).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{big}/labels.parquet").collect()}
    held = [(labels[i], r.predicted) for i, r in rows.items() if r.held_out and i in labels]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    marks = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (9, None), (1, 0)], "doc_id long, label int")
    for model in (toxicity.train(strange, marks), toxicity.train(strange, marks.limit(0))):
        scored = toxicity.score(strange, model)
        assert scored.count() == strange.count() and scored.filter("tox_score IS NULL OR tox_score > 1 OR tox_score < 0").isEmpty()
        assert scored.filter("text IS NULL OR text = ''").select("tox_score").distinct().count() == 1
    assert toxicity.score(spark.createDataFrame([], DOCS), model).count() == 0


def brute_components(texts):
    sets = {i: shingles(t) for i, t in texts}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_steps_of_few_links_take_one_partition(spark, monkeypatch):
    import metaspark.llm.components as module

    links = spark.createDataFrame([(i, i + 1) for i in range(0, 40) if i % 7] + [(100, i) for i in range(101, 130)], "a long, b long")
    parts = []
    cut = module.cut_lineage

    def counted(df):
        out = cut(df)
        parts.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(module, "cut_lineage", counted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        few = sorted(map(tuple, components(links).collect()))
        assert len(parts) > 2 and set(parts[1:]) == {1}
        parts.clear()
        monkeypatch.setattr(module, "FEW_LINKS", 0)
        assert sorted(map(tuple, components(links).collect())) == few
        assert max(parts[1:]) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert dict(few) == {i: (i + 6) // 7 * 7 - 6 if i % 7 else i - 6 for i in range(1, 41)} | {i: 100 for i in range(100, 130)}


def near_copies(seed, groups=12, copies=12):
    """Groups of texts that share a passage, with edits about the threshold, some very short."""
    rnd = random.Random(seed)
    passage = " ".join(f"common{i}" for i in range(55))
    rows, n = [], 0
    for g in range(groups):
        size = rnd.choice([3, 6, 9, 14, 30, 90, 250])
        base = [f"g{g}w{rnd.randint(0, 400)}" for _ in range(size)]
        for _ in range(copies):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, size // 25))):
                w[rnd.randrange(len(w))] = f"edit{rnd.randint(0, 9)}"
            if rnd.random() < 0.5:
                w = passage.split() + w
            n += 1
            rows.append((n, " ".join(w)))
    return rows


def test_texts_of_one_labelled_id_are_learned_once(spark):
    rows = [(7, f"text number {n}") for n in range(1000)] + [(7, "text number 3"), (8, "other"), (None, "none"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1), (8, 0), (8, 0), (9, 1), (None, 1)], "doc_id long, label int")
    assert toxicity.training_rows(docs, labels).count() == 1001
    assert 50 < toxicity.training_rows(docs, labels, most=100).count() < 160
    model = toxicity.train(docs, labels)
    assert model.words.get("other") is None


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(spark, seed, monkeypatch):
    if seed == 2:  # many small blocks, heavy shingles and no broadcast
        monkeypatch.setattr(jaccard, "BUCKET_BLOCK", 4)
        monkeypatch.setattr(jaccard, "BROADCAST_PAIRS", 0)
        monkeypatch.setattr(jaccard, "HEAVY_SHARE", 0.0)
        monkeypatch.setattr(jaccard, "PART_SIGNATURES", 256)
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_on_tables_and_strange_rows(spark, strange, docs):
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()}
    assert got == brute_components(texts)
    out = jaccard.near_duplicates(strange).collect()
    assert len(out) == strange.count()
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in out}
    assert found[1][1] == found[2][1] == found[3][1] == found[None][1] == 1 and found[7] == (1, 7) and found[8] == (1, 7)
    assert found[4] == (0, 4) and found[5] == (0, 5) and found[6] == (0, 6) and found[10] == (1, 10)
    assert jaccard.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("copies", [1, 3])
def test_near_copies_without_id_bridge(spark, copies):
    w = [f"word{i}" for i in range(120)]
    changed = lambda at: " ".join([*w[:at], *(f"new{i}" for i in range(at, 120))])
    rows = [(7, changed(120)), (4, changed(94))] + [(None, changed(106))] * copies + [(None, "another text " * 20), (5, "far away")]
    sets = [shingles(t) for _, t in rows]
    like = lambda a, b: len(a & b) / len(a | b)
    assert like(sets[0], sets[1]) < 0.75 <= min(like(sets[0], sets[2]), like(sets[2], sets[1]))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id} == {7: 4, 4: 4, 5: 5}
    assert sorted((r.component_id for r in got if r.doc_id is None), key=repr) == [4] * copies + [None]
    alone = jaccard.groups(df.filter("doc_id IS NULL").unionByName(spark.createDataFrame([(None, changed(110))], df.schema)))
    assert len({r.label for r in alone.collect()}) == 2


@pytest.mark.parametrize("block", [3, 1024])
def test_links_that_only_a_second_pair_shows(spark, monkeypatch, block):
    """Sketches that rule nothing out: most pairs of a bucket fail, others of the same components are links."""
    monkeypatch.setattr(jaccard, "sketch", lambda shingles: bytes(8))
    monkeypatch.setattr(jaccard, "BUCKET_BLOCK", block)
    rnd = random.Random(block)
    rows, n = [], 0
    for g in range(4):
        base = [f"g{g}w{k}" for k in range(60)]
        for _ in range(14):
            w = list(base)
            for _ in range(rnd.randint(0, 2)):
                w[rnd.randrange(len(w))] = f"edit{rnd.randint(0, 99)}"
            n += 1
            rows.append((n, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()}
    assert got == brute_components(rows)


def test_similar_sets_share_a_signature():
    rnd = np.random.default_rng(0)
    starts, heavy = jaccard.bands(75), np.zeros(1 << jaccard.HEAVY_BITS, dtype=bool)
    crowded = rnd.random(1 << jaccard.HEAVY_BITS) < 0.5
    for size in [1, 2, 3, 4, 5, 7, 8, 15, 40, 41, 150, 700] * 8:
        a = np.unique(rnd.integers(0, 1 << 63, size, dtype=np.uint64))
        gone = int(rnd.integers(0, len(a) // 4 + 1))
        b = np.unique(np.concatenate((a[gone:], rnd.integers(0, 1 << 63, int(rnd.integers(0, max(1, size // 8))), dtype=np.uint64))))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both) or np.array_equal(a, b):
            continue
        for table in (heavy, crowded):
            sig, row = jaccard.signatures(np.concatenate((a, b)), np.array([len(a), len(a) + len(b)]), table, 75, starts)
            assert set(sig[row == 0].tolist()) & set(sig[row == 1].tolist())
        words = min(len(jaccard.sketch(a)), len(jaccard.sketch(b))) // 8
        d = int(jaccard.differing(jaccard.folded(jaccard.sketch(a), words), jaccard.folded(jaccard.sketch(b), words)))
        assert d <= len(a) + len(b) - 2 * both


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (30, 30)]
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {k: v for k, v in found.items() if k != 30} == {1: 1, 2: 1, 3: 1, 7: 1, 8: 1, 9: 1, 20: 20, 21: 20}
    chain = spark.range(1, 60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.label for r in components(chain).collect()} == {1}


def test_shingles_of_words():
    texts = [r[1] for r in strange_rows()]
    sizes = []
    for _, _, data, offsets in text_slices(pa.array(texts), 64):
        _, ends = shingle_sets(data, offsets)
        sizes += np.diff(np.concatenate(([0], ends))).tolist()
    assert sizes == [len(shingles(t)) for t in texts]


@pytest.fixture(scope="module")
def tables():
    with open(public_tokenizers.path(queries.RANKS), "rb") as file:
        ranks = bpe.read_ranks(file.read())
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(spark, strange, tables):
    import regex

    ranks, library = tables
    machine, pattern = bpe.Transducer(ranks), regex.compile(public_tokenizers.PATTERN)
    rnd = random.Random(2)
    parts = ["a", "aaaa", "the", " the", "é", "ß", "\n", "1", "!", "😀", "  ", "中", "ing", "<|endoftext|>", "̀"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(400)]
    texts += [bytes(rnd.randrange(256) for _ in range(40)).decode("utf-8", "replace") for _ in range(100)]
    for text in texts:
        ids = machine.encode(text, pattern)
        assert ids.tolist() == library.encode_ordinary(text)
        for step in (1, 3):
            assert "".join(bpe.decode_text(ids, machine.bytes_of, step)) == text
    coded = bpe.encode(strange, public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN).collect()
    assert len(coded) == strange.count()
    for r in coded:
        ids = np.array(library.encode_ordinary(r.text or ""), dtype="<u4")
        assert r.token_ids == ids.tobytes() and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_bpe_without_room_for_states(tables, monkeypatch):
    import regex

    monkeypatch.setattr(bpe, "STATES", 40)
    monkeypatch.setattr(bpe, "PIECES", 7)
    monkeypatch.setattr(bpe, "PAIRS", 9)
    ranks, library = tables
    machine, pattern = bpe.Transducer(ranks), regex.compile(public_tokenizers.PATTERN)
    text = "tokenization of unbelievable antidisestablishmentarianism, naïve café   zzzz" * 3
    assert machine.encode(text, pattern).tolist() == library.encode_ordinary(text)


def test_language_scores_need_little_beside_the_texts():
    import tracemalloc

    model = langid.Model(["a", "b"], np.zeros(2), np.zeros((1 << langid.BITS, 2), dtype=np.float32))
    column = pa.array(["some words of a text " * 50] * 2000)
    tracemalloc.start()
    langid.scores(model, column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6


def test_bpe_comes_back_to_its_states(tables, monkeypatch):
    ranks, library = tables
    machine = bpe.Transducer(ranks)
    words = ["tokenization", "unbelievable", "antidisestablishment", "mentarianism"]
    for word in words:
        machine.short(word.encode())
    monkeypatch.setattr(bpe, "STATES", len(machine.names))
    steps, step = [], machine._next
    monkeypatch.setattr(machine, "_next", lambda *guess: steps.append(guess) or step(*guess))
    piece = "tok\x00" + "mentarianism" * 3
    assert machine.short(piece.encode()) == machine.short(piece.encode()) == library.encode_ordinary(piece)
    assert len(steps) < len(piece)


def test_utf8_stream_of_broken_bytes():
    raw = "aé中😀".encode() + b"\xff\xc3(" + "😀".encode()[:3]
    for step in range(1, 9):
        stream = bpe.Utf8Stream()
        out = "".join(stream.feed(raw[i : i + step]) for i in range(0, len(raw), step)) + stream.feed(b"", final=True)
        assert out == raw.decode("utf-8", "replace")


def test_fingerprints(spark, strange, docs):
    rows = QUERIES["op7_quartile_fingerprint"](spark, SF).orderBy("doc_id").collect()
    texts = [r.text or "" for r in docs.orderBy("doc_id").collect()]
    for r, text, following in zip(rows, texts, texts[1:] + texts[:1]):
        k = len(text) // 4
        changed = text[: len(text) - k] + following[:k]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert [r.fingerprint, r.edited_fingerprint] == fingerprint.fingerprints(pa.array([text, changed]))
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.98
    one = fingerprint.fingerprints(pa.array(["same text here", "same text here", "", None]))
    assert one[0] == one[1] and one[2] == one[3] and fingerprint.likeness(one[:1], one[1:2])[0] == 1.0
    got = strange.select(fingerprint.fingerprint(F.col("text")).alias("f"))
    assert got.filter("f IS NULL").isEmpty()


def test_fingerprints_of_short_texts():
    short = ["a", "b", "z", "ab", "ba", "abc", "acb", "abcdefgh", "abcdefgi", "bbcdefgh", "abcdefghi", "seventeen bytes!!", "seventeen bytes!?", "0123456789", "9876543210"]
    prints = fingerprint.fingerprints(pa.array(short))
    assert len(set(prints)) == len(short)
    data = np.frombuffer("".join(short).encode(), dtype=np.uint8)
    ends = np.cumsum([0, *map(len, short)])
    counts = fingerprint.bucket_counts(data, ends)
    assert counts.sum(axis=1).tolist() == [3 * len(t) for t in short]
    pairs = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :]]
    assert fingerprint.likeness(*map(list, zip(*pairs))).max() < 1.0
    for text, own in zip(short, counts):  # what stands beside a text in a batch doesn't matter
        alone = fingerprint.bucket_counts(np.frombuffer(text.encode(), dtype=np.uint8), np.array([0, len(text)]))
        assert (alone[0] == own).all()
    for at in range(12):
        text = "word word wo"
        changed = text[:at] + "#" + text[at + 1 :]
        assert len(set(fingerprint.fingerprints(pa.array([text, changed])))) == 2


def test_fingerprints_of_strange_rows(spark, strange, monkeypatch):
    monkeypatch.setattr(fingerprint, "ROWS_PER_RANGE", 2)

    def make(ids, texts, following):
        return [pa.array(ids, type=pa.int64()), pa.array(texts), pa.array(following)]

    columns = "doc_id long, text string, following string"
    out = fingerprint.with_next(strange, columns, make).collect()
    key = lambda r: (-1 if r[0] is None else r[0], r[1] or "")
    want = sorted(strange_rows(), key=key)
    assert sorted(map(tuple, out), key=lambda r: key(r)) == [
        (a[0], a[1] or "", b[1] or "") for a, b in zip(want, want[1:] + want[:1])
    ]
    assert fingerprint.with_next(spark.createDataFrame([], DOCS), columns, make).count() == 0
    single = spark.createDataFrame([(5, "abc")], "doc_id long, text string")
    assert [tuple(r) for r in fingerprint.with_next(single, columns, make).collect()] == [(5, "abc", "abc")]


def brute_links(rows):
    """Reply of each (conv, turn): the turn before; texts without quotes."""
    turns = collections.defaultdict(list)
    for r in rows:
        turns[r.conv_id].append(r)
    return {c: sorted(v, key=lambda r: r.turn) for c, v in turns.items()}


def test_quotes_on_the_table(spark):
    raw = spark.read.parquet(f"{SF}/conversations.parquet")
    found = {(r.conv_id, r.turn): r for r in QUERIES["op8_quote_links"](spark, SF).collect()}
    assert len(found) == raw.count()
    norm = lambda t: " ".join(t.lower().split())
    for rows in brute_links(raw.collect()).values():
        for k, r in enumerate(rows):
            got = found[r.conv_id, r.turn]
            assert got.text == r.text.strip() and got.quotes == min(k, 2) == got.linked
            want = None
            if k:
                before = norm(rows[k - 1].text)
                want = next(o.turn for o in rows if before in {norm(o.text), *map(norm, o.text.split("\n"))})
            assert got.reply_turn == want


def test_quote_levels_and_replies(spark):
    rows = [
        (1, 0, "user", "How do I sort?\nAnd filter?"), (1, 1, "bot", "> How do I SORT?\nUse order by."),
        (1, 2, "user", ">> And filter?\n> Use   order by.\nThanks\n> unknown words"), (1, 3, "bot", "> And filter?\nUse where."),
        (2, 0, "user", None), (2, 1, "bot", "no quote"), (None, 0, "user", "> x"), (3, None, "user", "y"),
        (4, 0, "user", ""), (4, 0, "user", ""), (5, 7, "user", "> > deep"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("position", F.lit("own"))
    out = quotes.link(df).collect()
    assert len(out) == len(rows)
    by = {(r.conv_id, r.turn): r for r in out}
    assert [by[1, t].reply_turn for t in range(4)] == [None, 0, 1, 0]
    assert [by[1, t].reply_depth for t in range(4)] == [0, 1, 2, 1] and by[1, 2].quotes == 3 and by[1, 2].linked == 2
    assert [by[1, t].text for t in range(4)] == ["How do I sort?\nAnd filter?", "Use order by.", "Thanks", "Use where."]
    assert by[2, 0].text is None and by[2, 1].reply_turn == 0 and by[None, 0].position is None and by[5, 7].text == ""
    assert quotes.link(df.limit(0)).count() == 0


def test_trimmed_quotes(spark):
    """Quotes of several lines that are part of a longer message come from the message with most of their lines."""
    rows = [
        (1, 0, "Hello\nfirst point\nsecond point"), (1, 1, "between"), (1, 2, "> Hello\n> first  POINT\nagreed"),
        (1, 3, "> first point\n>\n> second point\nas well"), (1, 4, "Hello\nsome other\nlast line"),
        (1, 5, "> Hello\n> some other\n> [...]\nok"), (1, 6, "> Hello\n> unheard of\nwhat?"), (1, 7, "> made up\n> twice\n>> between\nno"),
        (2, 0, "unrelated"), (2, 1, "x\ny"), (2, 2, "> first point\n> second point\nnot here"), (2, 3, "> later one\n> later two\nz"),
        (2, 4, "later one\nlater two\nend"), (3, 0, "a\nb\nc"), (3, 1, "a\nb\nc"), (3, 2, "b\nc\nd"), (3, 3, "> b\n> c\n> d\n> e\nr"),
        (3, 4, "> b\n> c\nr"), (3, 5, "more"), (3, 6, "> b c\n> d\nr"),
    ]
    rows += [(4, t, f"line {t}\nregards\nBob") for t in range(20)] + [(4, 20, "> line 7\n> regards\nfine"), (4, 21, "> regards\n> Bob\nfine")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    by = {(r.conv_id, r.turn): r for r in quotes.link(df).collect()}
    assert [by[1, t].reply_turn for t in range(8)] == [None, 0, 0, 0, 3, 4, 5, 1]
    assert [by[1, t].linked for t in range(8)] == [0, 0, 1, 1, 0, 1, 0, 1]
    assert [by[2, t].reply_turn for t in range(5)] == [None, 0, 1, 2, 3] and sum(by[2, t].linked for t in range(5)) == 0
    assert [by[3, t].reply_turn for t in range(7)] == [None, 0, 1, 2, 0, 4, 2]
    assert by[4, 20].reply_turn == 7 and by[4, 21].reply_turn == 0 and by[4, 20].linked == by[4, 21].linked == 1


def test_neighbours_equal_brute_force(spark):
    rnd = np.random.default_rng(4)
    vectors = rnd.standard_normal((3000, 24)).astype(np.float32)
    vectors[100:140] = vectors[100]  # ties
    rows = [(i, v.tolist(), "own") for i, v in enumerate(vectors)]
    strange = [(5000, None, ""), (5050, [0.0] * 24, ""), (5051, [float("nan")] * 24, ""), (5052, [1.0, None] + [1.0] * 22, ""),
           (5053, [float("inf")] + [1.0] * 23, ""), (None, [1.0] * 24, ""), (5100, [1.0, 2.0], ""), (5101, [2.0, 4.0], ""), (50, rows[50][1], "")]
    df = spark.createDataFrame(rows + strange, "vec_id long, embedding array<float>, block string")
    got = collections.defaultdict(list)
    for r in ann.search(df, df.filter("vec_id % 50 = 0")).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    wide = vectors.astype(np.float64)
    right = 0
    for q in range(0, 3000, 50):
        cosines = ann.cosines(wide[q], wide)
        cosines[q] = -9
        best = np.lexsort((np.arange(3000), -cosines))[:5]
        mine = sorted(got[q])
        right += len({v for _, v, _ in mine} & set(best.tolist()))
        assert [k for k, *_ in mine] == [1, 2, 3, 4, 5] and all(s == cosines[v] for _, v, s in mine)
    assert right >= 0.98 * 5 * 60
    assert got[5100] == [(1, 5101, pytest.approx(1.0))] and not {5000, 5050, 5051} & set(got)
    assert [v for _, v, _ in sorted(got[100])] == [101, 102, 103, 104, 105]
    assert ann.search(df.limit(0), df.limit(0)).count() == 0


def test_code_bounds_hold():
    rnd = np.random.default_rng(5)
    x, q = rnd.standard_normal((4000, 64)), rnd.standard_normal((50, 64))
    turn = ann.rotation(64)
    packed, inner = ann.codes(x, turn)
    estimate, error = ann.estimates(q, packed, inner, turn)
    exact = np.stack([ann.cosines(v, x) for v in q])
    assert (np.abs(estimate - exact) <= error).mean() > 0.98 and abs((estimate - exact).mean()) < 0.003


def test_language_model(spark, strange):
    big = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{big}/documents.parquet").select("doc_id", "text").collect()
    tokens = lambda t: [*words(t), None]
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    count = collections.Counter()
    for r in docs:
        if not held(r.doc_id):
            count.update(tokens(r.text))
    total, kinds = sum(count.values()), len(count)
    got = {r.doc_id: r for r in QUERIES["op10_recurrent_lm"](spark, big).collect()}
    for r in docs:
        own = tokens(r.text)
        want = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in own)
        mine = got[r.doc_id]
        assert mine.base_score == pytest.approx(want, rel=1e-9) and mine.n_tokens == len(own) and mine.train_tokens == total
        assert mine.n_known == sum(count[w] > 0 for w in own) and mine.held_out == held(r.doc_id)
    fresh = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in fresh) > sum(r.base_score for r in fresh)
    few = recurrent.score(strange, strange.filter("doc_id < 9")).collect()
    assert len(few) == strange.count() and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in few)
    none = recurrent.score(strange, strange.limit(0)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in none)
    assert recurrent.score(strange.limit(0), strange).count() == 0


def test_network_learns_from_every_document(spark, monkeypatch):
    monkeypatch.setattr(recurrent, "LEAST_TOKENS", 1, raising=False)
    monkeypatch.setattr(recurrent, "TRAINER_TOKENS", 200)

    def shares(self, symbols):
        self.flat[: recurrent.SYMBOLS] = np.bincount(symbols, minlength=recurrent.SYMBOLS) / len(symbols)

    monkeypatch.setattr(recurrent.Network, "fit", shares)
    rows = [(n if n % 3 else None, " ".join([f"own{n}"] * (20 + n))) for n in range(60)] + [(None, "same row " * 30)] * 9
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = recurrent.summary(recurrent.count_words(df), df.count())
    seen = recurrent.train(df, known)[: recurrent.SYMBOLS]
    symbols = np.concatenate([s for s, _ in recurrent._symbols(known, pa.array([t for _, t in rows]))])
    assert np.allclose(seen, np.bincount(symbols, minlength=recurrent.SYMBOLS) / known.tokens, atol=1e-6)


def test_network_gradient_and_windows():
    rnd = np.random.default_rng(6)
    network = recurrent.Network.fresh(np.ones(recurrent.SYMBOLS))
    network.flat += rnd.standard_normal(len(network.flat)).astype(np.float32) * 0.1
    inputs = rnd.integers(0, recurrent.SYMBOLS, (6, 3))
    targets = rnd.integers(0, recurrent.SYMBOLS, (6, 3))
    fresh = rnd.random((6, 3)) < 0.2
    state = rnd.standard_normal((3, recurrent.HIDDEN)).astype(np.float32) * 0.1
    wide = network.flat.astype(np.float64)
    network.flat = wide
    network.p = network._views(wide)
    _, grad, _ = network.gradient(inputs, targets, fresh, state.astype(np.float64))
    checked = np.argsort(-np.abs(grad))[:: max(1, np.count_nonzero(grad) // 60)][:60]
    for k in checked:
        old, losses = wide[k], []
        for step in (1e-4, -1e-4):
            wide[k] = old + step
            losses.append(network.gradient(inputs, targets, fresh, state.astype(np.float64))[0])
        wide[k] = old
        assert (losses[0] - losses[1]) / 2e-4 == pytest.approx(grad[k], rel=1e-2, abs=1e-5)
    sizes = [1, 90, 5, 300, 17]
    symbols = rnd.integers(0, recurrent.SYMBOLS, sum(sizes)).astype(np.int32)
    ends = np.cumsum(sizes)
    symbols[ends - 1] = recurrent.END
    whole = network.score(symbols, ends, lanes=5, window=1000)
    assert network.score(symbols, ends, lanes=2, window=7) == pytest.approx(whole, rel=1e-6)


def test_symbol_probabilities_sum_to_one():
    network = recurrent.Network.fresh(np.random.default_rng(7).random(recurrent.SYMBOLS) + 0.1)
    states = np.repeat(np.random.default_rng(8).standard_normal((1, recurrent.HIDDEN)).astype(np.float32), recurrent.SYMBOLS, axis=0)
    logs = network.log_probabilities(states, np.arange(recurrent.SYMBOLS))
    assert np.exp(logs).sum() == pytest.approx(1.0, abs=1e-4)
