"""Repair of conversations against brute force."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from metaspark.llm import queries, repair  # noqa: F401
from metaspark.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"
WANTED = re.compile(r"(s?(ua)+)?\Z")
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    """(conv_id, turn, role, text) rows after damage, in order within conversations."""
    out = []
    for conv, turn, role, text in rows:
        show = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        if kind:
            out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def search(rows, marks):
    """All edits, by depth first: (cost, audit, repaired rows) of the least cost and first audit."""
    best = [(10**9, "", [])]

    def allowed(initials):
        return any(WANTED.match(initials + tail) for tail in ("", "a", "ua", "u" + "a"))

    def walk(at, cost, audit, made, inserted):
        if cost > best[0][0] or not allowed("".join(r[0][:1] or "?" for r in made)):
            return
        if at == len(rows):
            if WANTED.match("".join(r[0][:1] or "?" for r in made)):
                best[0] = min(best[0], (cost, audit, list(made)), key=lambda x: x[:2])
        if inserted < 2:
            for role in ("user", "assistant"):
                walk(at, cost + 3, audit + "I", [*made, (role, "")], inserted + 1)
        if at < len(rows):
            _, _, role, text = rows[at]
            walk(at + 1, cost + 4, audit + "D", made, 0)
            if marks[at] not in ("blank", "duplicate"):
                extra = 3 * (marks[at] == "truncated")
                walk(at + 1, cost + extra, audit + "K", [*made, (role, text)], 0)
                for to in ("user", "assistant"):
                    walk(at + 1, cost + extra + 3, audit + "R", [*made, (to, text)], 0)

    walk(0, 0, "", [], 0)
    return best[0]


def steps(rows, marks):
    """The same by plain dynamic programming over whole texts."""
    move = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def spread(known):
        for _ in range(3):
            for state, (cost, audit, made) in list(known.items()):
                for role in ("user", "assistant"):
                    to = move[state].get(role[0])
                    if to is not None:
                        new = (cost + 3, audit + "I", [*made, (role, "")])
                        known[to] = min(known.get(to, new), new, key=lambda x: x[:2])
        return known

    known = {"": (0, "", [])}
    for (_, _, role, text), mark in zip(rows, marks):
        after = {}
        for state, (cost, audit, made) in spread(known).items():
            found = [(state, (cost + 4, audit + "D", made))]
            if mark not in ("blank", "duplicate"):
                extra = 3 * (mark == "truncated")
                for to, name, more in ((role, "K", 0), ("user", "R", 3), ("assistant", "R", 3)):
                    if to[:1] in move[state]:
                        found.append((move[state][to[:1]], (cost + extra + more, audit + name, [*made, (to, text)])))
            for to, new in found:
                after[to] = min(after.get(to, new), new, key=lambda x: x[:2])
        known = after
    known = spread(known)
    return min((known[s] for s in ("", "a") if s in known), key=lambda x: x[:2])


def expected(rows, solve):
    ids = {r[0] for r in rows}
    out = []
    for conv in ids:
        own = damage([r for r in rows if r[0] == conv])
        marks = faults(own)
        turns = {r[1] for r in own if r[1] is not None}
        initials = [r[2][:1] for r in own]
        cost, audit, made = solve(own, marks)
        out.append((
            conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(marks.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def run(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    frame = frame.withColumns({c: F.lit("own") for c in ("times", "fault", "name", "conv", "place", "audit", "cost", "kind")})
    out = repair.repair(repair.damaged(frame), frame)
    assert out.columns == COLUMNS
    return sorted(map(tuple, out.collect()), key=repr)


def random_rows(seed, conversations, turns):
    rnd = random.Random(seed)
    texts = ["Hi.", "Hi.", "no end", "Ends! ", "", " \t", "What?", "one.two", "é?\n"]
    rows = []
    for conv in range(conversations):
        for turn in range(rnd.randint(1, turns)):
            role = rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", None])
            rows.append((conv, rnd.choice([turn, turn, turn + 1, None]), role, rnd.choice(texts + [None, f"t{rnd.random()}."])))
    return rows


def test_short_ones_equal_every_edit(spark):
    rows = random_rows(1, 150, 4)
    assert run(spark, rows) == expected(rows, search)


def test_long_ones_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", 5)
    monkeypatch.setattr(repair, "FAN", 3)
    rows = random_rows(2, 6, 90) + [(99, 7, "user", "Same.")] * 400 + [(None, t, "user", f"{t}.") for t in range(40)]
    assert run(spark, rows) == expected(rows, steps)


def test_two_ways_of_the_test_agree():
    rows = random_rows(3, 60, 4)
    assert expected(rows, search) == expected(rows, steps)


def test_strange_tables(spark):
    rows = [(1, None, None, None), (2, 3, "", ""), (None, None, None, None), (3, 1, "user", "x " * 200_000), (4, 5, "user", "a."), (4, 5, "user", "a.")]
    assert run(spark, rows) == expected(rows, search)
    assert run(spark, rows[:0]) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_ropes_order_as_texts(seed):
    rnd = random.Random(seed)
    ropes = [repair.Rope(c) for c in "DIKR"]
    for _ in range(300):
        ropes.append(rnd.choice(ropes) + rnd.choice(ropes[-6:]))
    ropes = [r for r in ropes if r.length < 5000]
    for _ in range(400):
        a, b = rnd.choice(ropes), rnd.choice(ropes)
        assert (a < b) == (str(a) < str(b))


def test_grammar_gives_the_matrix_of_the_symbols():
    rnd = random.Random(9)
    plain, names = repair.Grammar([]), list(repair.ALPHABET)
    rules = ["".join(rnd.choices(names, k=2)) for _ in range(20)] + [chr(repair.FIRST_RULE + rnd.randrange(20)) + rnd.choice(names) for _ in range(20)]
    grammar = repair.Grammar(rules)
    for _ in range(60):
        text = "".join(rnd.choices(names[:5], k=rnd.randint(1, 60)))
        a, b = plain.of(text), grammar.of(text)
        assert {k: (c, str(e)) for k, (c, e) in a.items()} == {k: (c, str(e)) for k, (c, e) in b.items()}


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, QUERIES["op13_grammar_repair"](spark, SF).collect()), key=repr)
    assert got == expected(rows, steps)
