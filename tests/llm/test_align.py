"""Alignment of two tokenizers against brute force."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from metaspark.llm import align, queries  # noqa: F401
from metaspark.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"
A, B = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
PATTERN = public_tokenizers.PATTERN
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(rows):
    """The result for rows of (id, text), token by token."""
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    of_char = {chr(b): b for b in shown}
    for b in range(256):
        if b not in shown:
            of_char[chr(256 + len(of_char) - len(shown))] = b
    found, counts = [], collections.Counter()
    for doc, text in rows:
        ids_a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = second.encode(text) if text else []
        raw_a = [bytes(of_char[c] for c in first.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [second.id_to_piece(i)]]
        if not text or {b"".join(raw_a), b"".join(raw_b)} != {b" " + text.encode()}:
            found.append((doc, [], [], [], []))
            continue
        ends = [np.cumsum([len(x) for x in raw]).tolist() for raw in (raw_a, raw_b)]
        both = sorted(set(ends[0]) & set(ends[1]))
        links = [(b, a) for a, e in zip(ids_a, ends[0]) for b in [dict(zip(ends[1], ids_b)).get(e)] if b is not None] if len(ids_a) < 200 else [
            (dict_b[e], a) for dict_b in [dict(zip(ends[1], ids_b))] for a, e in zip(ids_a, ends[0]) if e in dict_b
        ]
        groups, low = [], 0
        for high in both:
            groups.append(tuple([str(i) for i, e in zip(ids, at) if low < e <= high] for ids, at in zip((ids_a, ids_b), ends)) if len(ids_a) < 3000 else None)
            low = high
        found.append((doc, ids_a, ids_b, groups, links))
        counts.update(links)
    most = collections.Counter()
    for (b, _), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for doc, ids_a, ids_b, groups, links in found:
        text = None if None in groups else ";".join(f"{','.join(a)}|{','.join(b)}" for a, b in groups)
        digest = None if text is None else hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((doc, len(ids_a), len(ids_b), len(groups), len(links), sum(counts[x] == most[x[0]] for x in links), sum(counts[x] for x in links), digest))
    return out


def compare(got, want):
    got, want = (sorted(map(tuple, x), key=lambda r: repr(r[:7])) for x in (got, want))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[: 7 if w[7] is None else 8] == w[: 7 if w[7] is None else 8]


def strange_rows():
    rnd = random.Random(2)
    long_text = " ".join(rnd.choice(["alpha", "Über", "naïve", "x1", "日本", "\U0001f600"]) for _ in range(9000))
    return [
        (1, "one two three"), (1, "one two three"), (None, "one two three"), (2, None), (3, ""), (4, " "), (5, "\t\n  \x0b"), (6, "a▁b"),
        (7, "<|endoftext|> <s> <0x41> </s>"), (8, "naïve 😀 café"), (9, long_text), (10, "\x00\x01"), (11, "I'm  it's"), (12, "日本語" * 5),
    ]


def test_strange_rows_and_clashing_columns(spark):
    frame = spark.createDataFrame(strange_rows(), "doc_id long, text string")
    frame = frame.withColumns({c: F.lit("own") for c in (*COLUMNS[1:], "row", "radix", "salt", "index", "page", "first")})
    out = align.align(frame, A, B, PATTERN)
    assert out.columns == COLUMNS
    compare(out.collect(), brute(strange_rows()))
    assert align.align(frame.limit(0), A, B, PATTERN).collect() == []


def test_small_runs_and_pages(spark, monkeypatch):
    """Many runs, pages and merges give what one of each gives; one row is in each radix's pages."""
    monkeypatch.setattr(align, "RUN_LINKS", 50)
    monkeypatch.setattr(align, "PAGE_POSTINGS", 7)
    rnd = random.Random(4)
    rows = [(j, " ".join(rnd.choice(["the", "cat", "sat", "Ünder", "a", "mat"]) for _ in range(30)) + " the the the") for j in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    compare(align.align(frame, A, B, PATTERN, radixes=3).collect(), brute(rows))


def test_merges_of_indexes():
    rnd = random.Random(7)
    total, runs = collections.Counter(), []
    for _ in range(9):
        own = collections.Counter(rnd.randrange(5) * 6 + rnd.randrange(6) for _ in range(40))
        total += own
        pairs = np.array(sorted(own))
        runs.append(align.packed(pairs, np.array([own[p] for p in pairs.tolist()])))
    pairs, counts = align.merged(runs)
    assert dict(zip(pairs.tolist(), counts.tolist())) == dict(total) and (np.diff(pairs) > 0).all()
    best = align.with_best(pairs, counts, 6)
    for b in range(5):
        top = max(n for p, n in total.items() if p // 6 == b)
        assert {p for p, k in zip(pairs.tolist(), best) if k and p // 6 == b} == {p for p, n in total.items() if p // 6 == b and n == top}


def test_numbers():
    table, length = align.decimals(10234)
    for j in (0, 7, 10, 99, 100, 999, 1000, 9999, 10000, 10234):
        assert table[j, : length[j]].tobytes() == str(j).encode()


@pytest.mark.parametrize("sf", [SF])
def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    compare(QUERIES["op11_token_alignment"](spark, sf).collect(), brute([tuple(r) for r in docs]))


def test_ranked_merges_equal_the_file_s_own_library():
    with open(A) as a, open(B, "rb") as b:
        pair = align.Pair(a.read(), b.read(), PATTERN)
    assert pair.ranked is not None
    rnd = random.Random(3)
    odd = [" ", "  ", "\n", "\t", "'s", "'LL", "１", "\u0085", "\u200b", "\u3000", "é", "ß", "x1", "!", "？", "日本", "😀", "\u0300", "Ⅷ", "²", "\x1c", "<|endoftext|>", "▁"]
    texts = ["".join(rnd.choice([*odd, chr(rnd.randrange(0xD800)), chr(rnd.randrange(0xE000, 0x110000))]) for _ in range(rnd.randint(0, 30))) for _ in range(4000)]
    texts += [" " * 300_000 + "x", "a" * 60_000, "\n" * 4000 + "b", "ab " * 50_000]
    assert pair.encode_a(texts) == [e.ids for e in pair.a.encode_batch(texts, add_special_tokens=False)]
