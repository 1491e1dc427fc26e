"""Repair of conversations at least cost, by dynamic programming on grammar-compressed sequences.

A conversation is a sequence of symbols: the initial of each row's role and its fault.  Its
repair runs an automaton over the symbols whose accepted texts are the wanted role orders;
each row is kept, given another role or deleted, and rows may be inserted.  What a sequence
of symbols does is one min-plus matrix over pairs of states: the least cost and, of the
edits of that cost, the first in ASCII order.  The matrix of two sequences in a row is the
product of theirs, so Re-Pair rules (the commonest pairs of symbols over all distinct
sequences, then of what they make) have one matrix each, computed bottom-up and shared by
all conversations.  An entry's edits are a rope: a pair of the entries it came from, with
length and digest, compared without writing it out.

Rows of a conversation are sorted by range, so a long one lies in many tasks; each makes
blocks of at most ``BLOCK`` symbols.  Blocks are multiplied in groups of ``FAN`` until one is left
of each conversation.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaspark.session import scratch_path

from .order import numbered

#: States: nothing yet, after the system row, after a user's row, after an assistant's row.
STATES = range(4)
ACCEPTED = (0, 3)
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
INITIALS = "sua?"  # ?: any other
LEGAL = frozenset(("su", "ua", "au"))
ROLES = {"u": "user", "a": "assistant"}
BLOCK = 1024
FAN = 16
RULES = 768
PAIRS_A_ROUND = 128
LEAST_PAIRS = 2
PRIME = (1 << 61) - 1
BASE = 0x1F3D5B79A2C4E68
WORD = r"[^\x20\x09-\x0D]"


def symbol(initial: str, fault: str) -> str:
    """One character for an initial and a fault (``ok``, ``truncated`` or ``gone``)."""
    return chr(ord("A") + INITIALS.index(initial if initial in INITIALS else "?") + 4 * ("ok", "truncated", "gone").index(fault))


ALPHABET = {symbol(i, f): (i, f) for i in INITIALS for f in ("ok", "truncated", "gone")}
FIRST_RULE = 0xE000  # rules are characters from here on (private use)


class Rope:
    """An immutable text: a string, or two ropes in a row.  Equal digests count as equal texts."""

    __slots__ = ("left", "right", "text", "length", "digest")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.left, self.right, self.text = left, right, text
        if left is None:
            self.length, self.digest = len(text), 0
            for c in text:
                self.digest = (self.digest * BASE + ord(c)) % PRIME
        else:
            self.length = left.length + right.length
            self.digest = (left.digest * pow(BASE, right.length, PRIME) + right.digest) % PRIME

    def __add__(self, other: Rope) -> Rope:
        if not self.length or not other.length:
            return other if not self.length else self
        if self.length + other.length <= 32:
            return Rope(str(self) + str(other))
        return Rope("", self, other)

    def _prefix(self, size: int) -> int:
        """Digest of the first ``size`` characters."""
        at, out = self, 0
        while size:
            if size == at.length:
                return (out * pow(BASE, size, PRIME) + at.digest) % PRIME
            if at.left is None:
                for c in at.text[:size]:
                    out = (out * BASE + ord(c)) % PRIME
                return out
            if size < at.left.length:
                at = at.left
            else:
                out = (out * pow(BASE, at.left.length, PRIME) + at.left.digest) % PRIME
                size -= at.left.length
                at = at.right
        return out

    def _char(self, place: int) -> str:
        at = self
        while at.left is not None:
            if place < at.left.length:
                at = at.left
            else:
                place -= at.left.length
                at = at.right
        return at.text[place]

    def __lt__(self, other: Rope) -> bool:
        if self.left is None and other.left is None:
            return self.text < other.text
        low, high = 0, min(self.length, other.length)  # the first low characters are equal
        while low < high:
            middle = (low + high + 1) // 2
            if self._prefix(middle) == other._prefix(middle):
                low = middle
            else:
                high = middle - 1
        if low == self.length or low == other.length:
            return self.length < other.length
        return self._char(low) < other._char(low)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            at = todo.pop()
            if at.left is None:
                out.append(at.text)
            else:
                todo += (at.right, at.left)
        return "".join(out)


#: (from, to) -> (cost, edits); pairs that nothing leads to are missing.
Matrix = dict[tuple[int, int], tuple[int, Rope]]


def _better(found: Matrix, key: tuple[int, int], cost: int, edits: Rope) -> None:
    known = found.get(key)
    if known is None or cost < known[0] or (cost == known[0] and edits < known[1]):
        found[key] = (cost, edits)


def insertions() -> Matrix:
    """What inserted rows alone do."""
    found: Matrix = {(s, s): (0, Rope()) for s in STATES}
    for _ in STATES:
        for (i, j), (cost, edits) in list(found.items()):
            for role in ROLES:
                if (to := MOVES.get((j, role))) is not None:
                    _better(found, (i, to), cost + INSERT, edits + Rope("I"))
    return found


INSERTIONS = insertions()


def row_matrix(initial: str, fault: str) -> Matrix:
    """Insertions, then one edit of a row.  Its edits end with the row's, so of two for the
    same states none is the beginning of the other, and the first stays first whatever follows."""
    one: Matrix = {}
    for s in STATES:
        _better(one, (s, s), DELETE, Rope("D"))
        if fault != "gone":
            extra = TRUNCATED if fault == "truncated" else 0
            if (to := MOVES.get((s, initial))) is not None:
                _better(one, (s, to), extra, Rope("K"))
            for role in ROLES:
                if (to := MOVES.get((s, role))) is not None:
                    _better(one, (s, to), REROLE + extra, Rope("R"))
    return product(INSERTIONS, one)


def product(left: Matrix, right: Matrix) -> Matrix:
    found: Matrix = {}
    for (i, k), (c, x) in left.items():
        for j in STATES:
            step = right.get((k, j))
            if step is None:
                continue
            known, cost = found.get((i, j)), c + step[0]
            if known is None or cost < known[0]:
                found[i, j] = (cost, x + step[1])
            elif cost == known[0]:
                _better(found, (i, j), cost, x + step[1])
    return found


class Grammar:
    """Re-Pair rules with a matrix each, and the matrices of symbols."""

    def __init__(self, rules: list[str]):
        self.rules = [(pair, chr(FIRST_RULE + j)) for j, pair in enumerate(rules)]
        self.matrix = {name: row_matrix(*what) for name, what in ALPHABET.items()}
        for pair, name in self.rules:
            self.matrix[name] = product(self.matrix[pair[0]], self.matrix[pair[1]])

    def reduced(self, sequence: str) -> str:
        for pair, name in self.rules:
            if len(sequence) < 2:
                break
            sequence = sequence.replace(pair, name)
        return sequence

    def of(self, sequence: str) -> Matrix:
        """The matrix of a sequence that is not empty."""
        short = self.reduced(sequence)
        found = self.matrix[short[0]]
        for name in short[1:]:
            found = product(found, self.matrix[name])
        return found


def finished(matrix: Matrix) -> tuple[int, str]:
    """Least cost and first edits of a whole conversation, with insertions after its last row."""
    ends: Matrix = {}
    for (i, k), (cost, edits) in matrix.items():
        if i == 0:
            for j in ACCEPTED:
                if (k, j) in INSERTIONS:
                    more, tail = INSERTIONS[k, j]
                    _better(ends, (0, 0), cost + more, edits + tail)
    cost, edits = ends[0, 0]
    return cost, str(edits)


def re_pair(sequences: DataFrame, rules: int = RULES) -> list[str]:
    """Pairs of symbols to replace one after another, from all distinct sequences (column ``symbols``).

    A round counts adjacent pairs in every sequence as reduced so far and takes the
    commonest ``PAIRS_A_ROUND``; only these come to the driver.  What is left of sequences
    after the last rule is multiplied out, so the number of rules bounds memory, not the result.
    """
    known: list[str] = []
    while len(known) < rules:
        most = min(PAIRS_A_ROUND, rules - len(known))
        so_far = list(known)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            steps = [(pair, chr(FIRST_RULE + j)) for j, pair in enumerate(so_far)]
            for batch in batches:
                counts: Counter[str] = Counter()
                for text in batch.column(0).to_pylist():
                    for pair, name in steps:
                        text = text.replace(pair, name)
                    counts.update(map("".join, zip(text, text[1:])))
                yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["pair", "n"])

        counted = sequences.select("symbols").mapInArrow(work, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        top = counted.filter(F.col("n") >= LEAST_PAIRS).orderBy(F.desc("n"), "pair").limit(most).collect()
        if not top:
            break
        known += [r["pair"] for r in top]
    return known


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with made faults, by CRC-32 of ``conv_id:turn`` modulo 20: 0 is dropped, 1 has an
    empty text, 2 loses its ``.``, ``!`` and ``?``, 3 comes twice, 4 gets the role user."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    made = rows.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    return made.filter("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.cast("long").alias("times"))


def with_faults(rows: DataFrame) -> DataFrame:
    """One row per distinct row of a conversation: ``times``, ``fault`` of the first of them (blank,
    duplicate, truncated or null) and ``name``, its symbol; the others are duplicates (or blank)."""
    once = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times"))
    early = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    earliest = once.groupBy(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.md5("text").alias("_text")).agg(F.min(early).alias("_first"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.md5("text") == F.col("_text"))
    first = F.col("turn").eqNullSafe(F.col("_first.turn"))
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = (
        F.when(~F.col("text").rlike(WORD), F.lit("blank")).when(~first, F.lit("duplicate")).when(~ended, F.lit("truncated"))
    )
    out = once.join(earliest, same).withColumn("fault", fault)
    return out.select("conv_id", "turn", "role", "text", "times", "fault", symbol_of(F.col("role"), F.col("fault")).alias("name"))


def symbol_of(role: Column, fault: Column) -> Column:
    place = F.when(role.startswith("s"), 0).when(role.startswith("u"), 1).when(role.startswith("a"), 2).otherwise(3)
    state = F.when(fault.isNull(), 0).when(fault == "truncated", 4).otherwise(8)
    return F.char(F.lit(ord("A")) + place + state)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of symbols of the conversations of a partition, which are sorted; numbered within it."""
    at, held, number = None, "", 0
    out: list[tuple] = []
    gone = {name: symbol(initial, "gone") for name, (initial, _) in ALPHABET.items()}

    def batch_of() -> pa.RecordBatch:
        columns = list(zip(*out)) or [(), (), ()]
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
            ["conv", "place", "symbols"],
        )

    for batch in batches:
        for conv, name, times in zip(*(c.to_pylist() for c in batch.columns)):
            if conv != at:
                if held:
                    out.append((at, number, held))
                at, held, number = conv, "", 0
            held += name
            left = times - 1
            while left or len(held) > BLOCK:
                more = min(left, BLOCK)
                held, left = held + gone[name] * more, left - more
                while len(held) > BLOCK:
                    out.append((at, number, held[:BLOCK]))
                    held, number = held[BLOCK:], number + 1
                if len(out) >= 1024:
                    yield batch_of()
        if out:
            yield batch_of()
    if held:
        out.append((at, number, held))
    yield batch_of()


ENTRIES = "costs array<long>, edits array<string>, illegal long, head string, tail string"


def _dense(matrix: Matrix) -> tuple[list, list]:
    pairs = [matrix.get((i, j)) for i in STATES for j in STATES]
    return [p and p[0] for p in pairs], [p and str(p[1]) for p in pairs]


def _sparse(costs: list, edits: list) -> Matrix:
    return {(k // 4, k % 4): (c, Rope(e)) for k, (c, e) in enumerate(zip(costs, edits)) if c is not None}


def _evaluated(rules: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(rules)
        for batch in batches:
            out = []
            for sequence in batch.column(0).to_pylist():
                initials = "".join(ALPHABET[c][0] for c in sequence)
                illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
                out.append((sequence, *_dense(grammar.of(sequence)), illegal, initials[0], initials[-1]))
            yield _entries(out, ["symbols"])

    return work


def _entries(rows: list[tuple], keys: list[str]) -> pa.RecordBatch:
    kinds = {"conv": pa.string(), "place": pa.int64(), "symbols": pa.string()}
    types = [*(kinds[k] for k in keys), pa.list_(pa.int64()), pa.list_(pa.string()), pa.int64(), pa.string(), pa.string()]
    columns = list(zip(*rows)) or [()] * len(types)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], [*keys, "costs", "edits", "illegal", "head", "tail"]
    )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Products of the blocks with one (conversation, place), which come together in order, ``FAN`` at most."""
    at = found = None
    for batch in batches:
        out = []
        for conv, place, costs, edits, illegal, head, tail in zip(*(c.to_pylist() for c in batch.columns)):
            own = _sparse(costs, edits)
            if (conv, place) != at:
                if found:
                    out.append((*at, *_dense(found[0]), *found[1:]))
                at, found = (conv, place), (own, illegal, head, tail)
            else:
                more = illegal + (found[3] + head not in LEGAL)
                found = (product(found[0], own), found[1] + more, found[2], tail)
        yield _entries(out, ["conv", "place"])
    if found:
        yield _entries([(*at, *_dense(found[0]), *found[1:])], ["conv", "place"])


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [finished(_sparse(c, e)) for c, e in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        cost, audit = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(3), pa.array(cost, pa.int64()), pa.array(audit, pa.string())],
            ["conv", "illegal", "cost", "audit"],
        )


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each repaired conversation: its audit comes first, then its rows in order."""
    at, edits, place, system, user, digest, fresh = None, "", 0, False, False, None, True
    out: list[tuple] = []

    def put(role: str, text: str) -> None:
        nonlocal fresh
        digest.update(f"{'' if fresh else chr(10)}{role}:{text}".encode())
        fresh = False

    def inserted() -> None:
        nonlocal place, system, user
        while place < len(edits) and edits[place] == "I":
            system, user = False, system or not user
            put(ROLES["u" if user else "a"], "")
            place += 1

    for batch in batches:
        for conv, audit, role, text, times in zip(*(c.to_pylist() for c in batch.columns)):
            if audit is not None:
                if digest is not None:
                    inserted()
                    out.append((at, digest.hexdigest()))
                at, edits, place, system, user, digest, fresh = conv, audit, 0, False, False, hashlib.sha256(), True
                continue
            for _ in range(times):
                inserted()
                edit = edits[place]
                place += 1
                if edit == "K":
                    system, user = role.startswith("s"), role.startswith("u")
                    put(role, text)
                elif edit == "R":
                    system, user = False, system or not user
                    put(ROLES["u" if user else "a"], text)
        yield _two(out)
        out = []
    if digest is not None:
        inserted()
        out.append((at, digest.hexdigest()))
    yield _two(out)


def _two(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["conv", "repaired_sha256"])


def repair(rows: DataFrame, originals: DataFrame) -> DataFrame:
    """One row for each distinct ``conv_id`` of ``originals`` with the faults and the cheapest repair of its rows.

    ``rows``: ``conv_id``, ``turn``, ``role``, ``text`` and ``times`` (how often the row stands there, side
    by side).  A conversation's rows are taken by turn, unknown turns first, those of one
    turn by role and text.  A null ``conv_id`` is a conversation of its own.  Conversations
    without rows have zeros, an empty audit and the digest of nothing.  The digest and the
    audit of one conversation are made in order by one task, a batch of rows at a time; all
    else of a long conversation is divided.
    """
    spark = rows.sparkSession

    def written(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    faulty = written(with_faults(rows), "faults")
    named = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))
    faulty = faulty.withColumn("conv", named)
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    dealt = faulty.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "name", "times")
    blocks = dealt.mapInArrow(_blocks, "conv string, place long, symbols string")
    # Monotonically increasing numbers follow the partitions, which follow the order.
    blocks = written(blocks.withColumn("place", F.monotonically_increasing_id()), "blocks")
    distinct = written(blocks.select("symbols").distinct(), "sequences")
    rules = re_pair(distinct)
    entries = written(distinct.mapInArrow(_evaluated(rules), f"symbols string, {ENTRIES}"), "matrices")
    columns = ["conv", "place", "costs", "edits", "illegal", "head", "tail"]
    left = blocks.join(entries, "symbols").select(*columns)
    several = blocks.groupBy("conv").count().filter("count > 1").select("conv")
    ready = left.join(several, "conv", "left_anti")
    open_rows = written(blocks.join(several, "conv", "left_semi"), "long")
    if not open_rows.isEmpty():
        ready = ready.union(_multiplied(open_rows, entries, written).select(*columns))
    ends = ready.select("conv", "costs", "edits", "illegal").mapInArrow(_ended, "conv string, illegal long, cost long, audit string")
    ends = written(ends, "repairs")

    none = lambda kind: F.lit(None).cast(kind)
    head = ends.select("conv", "audit", none("string").alias("role"), none("string").alias("text"), none("long").alias("times"), none(faulty.schema["turn"].dataType).alias("turn"))
    body = faulty.select("conv", none("string").alias("audit"), "role", "text", "times", "turn")
    both = head.union(body).repartition("conv").sortWithinPartitions("conv", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "text")
    digests = both.select("conv", "audit", "role", "text", "times").mapInArrow(_digested, "conv string, repaired_sha256 string")

    later = F.when(F.col("fault") == "blank", 0).otherwise(F.col("times") - 1)
    counts = faulty.groupBy("conv", "turn").agg(
        F.sum(F.when(F.col("fault") == "blank", F.col("times")).otherwise(0)).alias("blank"),
        F.sum(later + F.when(F.col("fault") == "duplicate", 1).otherwise(0)).alias("duplicate"),
        F.sum(F.when(F.col("fault") == "truncated", 1).otherwise(0)).alias("truncated"),
    )
    counts = counts.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
    )
    all_ids = originals.select("conv_id").distinct().withColumn("conv", named)
    out = all_ids.join(counts, "conv", "left").join(ends, "conv", "left").join(digests, "conv", "left")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(
        "conv_id",
        *[number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def _multiplied(blocks: DataFrame, entries: DataFrame, written) -> DataFrame:
    """One row for each conversation of several blocks: the product of its blocks, ``FAN`` of them at a time."""
    own = numbered(blocks, [F.col("conv"), F.col("place")], "number")
    start = own.groupBy("conv").agg(F.min("number").alias("start"))
    own = own.join(start, "conv").select("conv", (F.col("number") - F.col("start")).alias("place"), "symbols")
    rest = own.join(entries, "symbols").select("conv", "place", "costs", "edits", "illegal", "head", "tail")
    while True:
        rest = written(rest, "products")
        if rest.agg(F.max("place")).first()[0] == 0:
            return rest
        grouped = rest.withColumn("_in", F.col("place")).withColumn("place", F.floor(F.col("place") / FAN).cast("long"))
        grouped = grouped.repartition("conv", "place").sortWithinPartitions("conv", "place", "_in").drop("_in")
        rest = grouped.select(*rest.columns).mapInArrow(_joined, f"conv string, place long, {ENTRIES}")
