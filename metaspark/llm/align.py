"""Alignment of two tokenizers: which tokens of one meet which of the other, counted over a corpus.

Both tokenizations of a text cut the same bytes; where both end a token they cut them into
groups, and the two tokens that end there are linked.  Counting is external.  A task
collects the links of some megabytes of text, sorts them by pair of ids, the second
tokenizer's first, and spills them as zstd runs, one for each residue of the second
tokenizer's id (a radix): an index of the run's distinct pairs with their counts, and pages
of postings, the rows that hold each pair.  The indexes of a radix are merged with a heap,
a bounded number at a time; in the merged order all pairs of an id come in succession, so
counts and the id's highest count are known as the merge passes.  Then the postings are
read again, each after the counts of its radix, and give every row its share.

A pair or an id with a third of all links has an index entry per run; its postings are in
many pages, which are dealt to ``SPREAD`` tasks of each radix.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from metaspark.session import scratch_path

from .frames import lean

RADIXES = 32
SPREAD = 8
ROWS = 64  # texts tokenized at once
RUN_LINKS = 1 << 19
RUN_ROWS = 1 << 16
ROW_BITS = 20  # of a run's rows
PAGE_POSTINGS = 1 << 16
MERGED_AT_ONCE = 64
LEVEL = 1
LONG_RUN = 5000
FACTS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1
    characters for themselves, the other bytes in order for the characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + j): b for j, b in enumerate(hidden)}


def merge_ranks(file: str) -> tuple[dict[bytes, int], list[int]] | None:
    """(bytes of each token to its place in the merges, id by place) of a plain byte-level BPE file, else None.

    Plain: pieces are cut by the pattern alone, all merges apply, and no token has two merges.
    """
    read = json.loads(file)
    model, cut = read["model"], read.get("pre_tokenizer") or {}
    plain = read.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if not plain or model.get("type") != "BPE" or any(model.get(k) for k in odd):
        return None
    alphabet = byte_alphabet()
    if not all(c in model["vocab"] for c in alphabet):
        return None
    names = sorted(alphabet, key=model["vocab"].__getitem__)
    names += ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    if len(set(names)) < len(names):
        return None
    ranks = {bytes(alphabet[c] for c in name): place for place, name in enumerate(names)}
    return ranks, [model["vocab"][name] for name in names]


class Pair:
    """The two tokenizers, with the bytes of each token."""

    def __init__(self, byte_level_file: str, piece_model: bytes, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_str(byte_level_file)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.ranked, self.id_of = None, None
        if (known := merge_ranks(byte_level_file)) is not None:
            ranks, ids = known
            self.ranked = tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            self.id_of = None if ids == list(range(len(ids))) else ids
        self.spaces = re.compile(rf"\s{{{LONG_RUN}}}")
        alphabet = byte_alphabet()
        size = self.a.get_vocab_size()
        self.bytes_a = [bytes(alphabet[c] for c in self.a.id_to_token(j) or "") for j in range(size)]
        self.bytes_b = []
        for j in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(j)
            self.bytes_b.append(bytes((int(piece[3:5], 16),)) if self.b.is_byte(j) else piece.replace("▁", " ").encode())
        self.size_a, self.size_b = (np.array([len(x) for x in v], dtype=np.int64) for v in (self.bytes_a, self.bytes_b))

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """Ids by the first tokenizer.  A plain file's merges are applied by their ranks, which gives the
        same ids several times faster; texts with very long runs of white space go to the file's own library."""
        if self.ranked is None:
            return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        out = []
        for text in texts:
            if len(text) > LONG_RUN and self.spaces.search(text):
                out.append(self.a.encode(text, add_special_tokens=False).ids)
            else:
                ids = self.ranked.encode_ordinary(text)
                out.append(ids if self.id_of is None else [self.id_of[i] for i in ids])
        return out

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of each text by both; none for an empty text or where their bytes aren't those of space and text."""
        out = []
        for text, ids, other in zip(texts, self.encode_a([" " + t for t in texts]), self.b.encode(texts, num_threads=1)):
            raw = b" " + text.encode()
            same = text and b"".join(map(self.bytes_a.__getitem__, ids)) == raw == b"".join(map(self.bytes_b.__getitem__, other))
            out.append((ids, other) if same else ([], []))
        return out


def decimals(most: int) -> tuple[np.ndarray, np.ndarray]:
    """ASCII digits of 0 to ``most``, left-aligned with one place more for what follows, and their number."""
    values = np.arange(most + 1)
    width = len(str(most))
    length = np.ones(most + 1, dtype=np.int64)
    for k in range(1, width):
        length += values >= 10**k
    table = np.zeros((most + 1, width + 1), dtype=np.uint8)
    for k in range(width):
        power = length - 1 - k
        table[:, k] = np.where(power >= 0, values // 10 ** np.maximum(power, 0) % 10 + 48, 0)
    return table, length


class Grouped:
    """Groups and links of some texts, one after another."""

    def __init__(self, pair: Pair, coded: list[tuple[list[int], list[int]]]):
        rows = len(coded)
        self.count_a, self.count_b = (np.array([len(c[k]) for c in coded], dtype=np.int64) for k in (0, 1))
        self.a, self.b = (np.fromiter(chain.from_iterable(c[k] for c in coded), np.int64, int(n.sum())) for k, n in enumerate((self.count_a, self.count_b)))
        ends_a, ends_b = np.cumsum(pair.size_a[self.a]), np.cumsum(pair.size_b[self.b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        self.last_a, self.last_b = np.searchsorted(ends_a, common), np.searchsorted(ends_b, common)
        until = np.cumsum(self.count_a)
        self.row = np.searchsorted(until, self.last_a, side="right")
        self.groups = np.bincount(self.row, minlength=rows)

    def links(self, size_a: int) -> np.ndarray:
        """Second and first id of every link in one number (the second times ``size_a``, and the first)."""
        return self.b[self.last_b] * size_a + self.a[self.last_a]

    def digests(self, digits: tuple[np.ndarray, np.ndarray]) -> list[str]:
        """SHA-256 of the written groups of each text; '' for one without tokens."""
        table, length = digits
        group_a = np.searchsorted(self.last_a, np.arange(len(self.a)))
        group_b = np.searchsorted(self.last_b, np.arange(len(self.b)))
        place_a = np.arange(len(self.a)) + np.concatenate(([0], self.last_b + 1))[group_a]
        place_b = np.arange(len(self.b)) + self.last_a[group_b] + 1
        ids = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        after = np.full(len(ids), ord(","), dtype=np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        after[place_a[self.last_a]], after[place_b[self.last_b]] = ord("|"), ord(";")
        out = table[ids]
        size = length[ids]
        out[np.arange(len(ids)), size] = after
        text = out[np.arange(table.shape[1])[None, :] <= size[:, None]].tobytes()
        ends = np.cumsum(size + 1)
        found, at, begin = [], 0, 0
        for tokens in (self.count_a + self.count_b).tolist():
            at += tokens
            end = int(ends[at - 1]) if at else 0
            found.append(hashlib.sha256(text[begin : end - 1]).hexdigest() if tokens else "")
            begin = end
        return found


def packed(*columns: np.ndarray) -> bytes:
    """Arrays of whole numbers (the first ascending, kept as steps) as one zstd frame, in planes of bytes."""
    parts, widths = [], []
    for values in (np.diff(columns[0], prepend=0), *columns[1:]):
        width = 8
        while width > 1 and (not len(values) or int(values.max()) < 1 << 4 * width):
            width //= 2
        widths.append(width)
        parts.append(np.ascontiguousarray(values, dtype=f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes())
    return zstandard.ZstdCompressor(level=LEVEL).compress(bytes((len(parts), *widths)) + b"".join(parts))


def unpacked(frame: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(frame)
    widths = raw[1 : 1 + raw[0]]
    at = 1 + raw[0]
    size = (len(raw) - at) // sum(widths)
    out = []
    for width in widths:
        planes = np.frombuffer(raw, dtype=np.uint8, count=width * size, offset=at).reshape(width, size)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(-1).astype(np.int64))
        at += width * size
    return [np.cumsum(out[0]), *out[1:]]


def _runs(pairs: np.ndarray, rows: np.ndarray, radixes: int, size_a: int) -> Iterator[tuple[int, bytes | None, bytes | None]]:
    """(radix, index, None) and (radix, None, page) of some links: an index has each distinct pair
    and its count; a page has postings in order: pair, row, links of the pair in the row."""
    if not len(pairs):
        return
    keys = np.sort(pairs << ROW_BITS | rows)
    head = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    times, keys = np.diff(np.append(head, len(keys))), keys[head]
    pairs, rows = keys >> ROW_BITS, keys & (1 << ROW_BITS) - 1
    radix = (pairs // size_a % radixes).astype(np.uint16)
    order = np.argsort(radix, kind="stable")
    pairs, rows, times, radix = pairs[order], rows[order], times[order], radix[order]
    cuts = np.append(np.flatnonzero(np.diff(radix, prepend=-1)), len(radix))
    for begin, end in zip(cuts, cuts[1:]):
        r, p, w, n = int(radix[begin]), pairs[begin:end], rows[begin:end], times[begin:end]
        first = np.flatnonzero(np.diff(p, prepend=-1))
        yield r, packed(p[first], np.add.reduceat(n, first)), None
        for at in range(0, len(p), PAGE_POSTINGS):
            cut = slice(at, at + PAGE_POSTINGS)
            yield r, None, packed(p[cut], w[cut], n[cut])


def _spilled(a_file, b_model, pattern: str, radixes: int, doc_type: pa.DataType):
    """A row of facts for each text, and rows of runs, as (kind, …)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(a_file.value.decode(), b_model.value, pattern)
        digits = decimals(max(len(pair.bytes_a), len(pair.bytes_b)))
        size_a = len(pair.bytes_a)
        task = TaskContext.get().partitionId() << 36
        links: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        held = done = since = run = 0  # since: the first row of the links held

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal links, owners, held, run, since
            for radix, index, page in _runs(np.concatenate(links), np.concatenate(owners), radixes, size_a):
                run += 1
                yield _row(radix=radix, salt=run % SPREAD, first=task + since, index=index, page=page)
            links, owners, held, since = [], [], 0, done

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = Grouped(pair, pair.encode([t or "" for t in part.column(1).to_pylist()]))
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(done, done + n) + task),
                        part.column(0),
                        pa.array(found.count_a),
                        pa.array(found.count_b),
                        pa.array(found.groups),
                        pa.array(found.groups),
                        pa.array(found.digests(digits), type=pa.string()),
                        *(pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.binary(), pa.binary())),
                    ],
                    NAMES,
                )
                links.append(found.links(size_a))
                owners.append(found.row + (done - since))
                held += len(links[-1])
                done += n
                if held > RUN_LINKS or done - since > RUN_ROWS:
                    yield from flush()
        if links:
            yield from flush()

    def _row(radix: int, salt: int, first: int, index: bytes | None, page: bytes | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([first], type=pa.int64()),
                pa.nulls(1, doc_type),
                *(pa.nulls(1, pa.int64()) for _ in range(4)),
                pa.nulls(1, pa.string()),
                pa.array([radix], type=pa.int32()),
                pa.array([salt], type=pa.int32()),
                pa.array([index], type=pa.binary()),
                pa.array([page], type=pa.binary()),
            ],
            NAMES,
        )

    return work


NAMES = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "radix", "salt", "index", "page"]


def merged(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of some indexes, ascending, with their counts added up: a merge by a heap of the runs."""
    opened = [unpacked(r) for r in runs]
    order = heapq.merge(*(zip(p.tolist(), n.tolist()) for p, n in opened))
    pairs, counts, last = [], [], -1
    for pair, n in order:
        if pair == last:
            counts[-1] += n
        else:
            pairs.append(pair)
            counts.append(n)
            last = pair
    return np.array(pairs, dtype=np.int64), np.array(counts, dtype=np.int64)


def with_best(pairs: np.ndarray, counts: np.ndarray, size_a: int) -> np.ndarray:
    """Whether each count is the highest of its second id; pairs come in that id's order."""
    head = np.flatnonzero(np.diff(pairs // size_a, prepend=-1))
    most = np.maximum.reduceat(counts, head) if len(head) else counts
    return counts == np.repeat(most, np.diff(np.append(head, len(pairs))))


def _counted(size_a: int):
    """One row (radix, counts) per radix, from its indexes, which come together."""

    def row(radix: int, runs: list[bytes]) -> pa.RecordBatch:
        pairs, counts = merged(runs)
        frame = packed(pairs, counts, with_best(pairs, counts, size_a).astype(np.int64))
        return pa.RecordBatch.from_arrays([pa.array([radix], type=pa.int32()), pa.array([frame], type=pa.binary())], ["radix", "counts"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, runs = None, []
        for batch in batches:
            for radix, index in zip(batch.column(0).to_pylist(), batch.column(1)):
                if radix != at and runs:
                    yield row(at, runs)
                    runs = []
                at = radix
                runs.append(index.as_py())
                if len(runs) >= MERGED_AT_ONCE:
                    runs = [packed(*merged(runs))]
        if runs:
            yield row(at, runs)

    return work


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, count_sum, n_best) of the postings of each page; a radix's counts come before its pages."""
    known: list[np.ndarray] = []
    for batch in batches:
        for first, counts, page in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            if counts.is_valid:
                known = unpacked(counts.as_py())
                continue
            pairs, rows, times = unpacked(page.as_py())
            place = np.searchsorted(known[0], pairs)
            distinct, where = np.unique(rows, return_inverse=True)
            total, best = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
            np.add.at(total, where, known[1][place] * times)
            np.add.at(best, where, known[2][place] * times)
            yield pa.RecordBatch.from_arrays([pa.array(distinct + first), pa.array(total), pa.array(best)], ["row", "count_sum", "n_best"])


def align(docs: DataFrame, byte_level_file: str, piece_file: str, pattern: str, radixes: int = RADIXES) -> DataFrame:
    """Facts of the alignment of every row's text: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_best``, ``count_sum``, ``groups_sha256``.

    ``byte_level_file``: vocabulary of the first tokenizer, which gets a space before the
    text, and ``pattern`` the expression that cuts text into its pieces; ``piece_file``: model of
    the second, which adds a space itself.  Both are read on the driver
    and broadcast (vocabularies, of fixed size); every token has at least one byte, so a
    group has one link.  A null or empty text, or one whose tokens do not give back its
    bytes, has no tokens and zeros.  Repeated rows count as often as they are there; ids may
    be null or equal.  Columns other than ``doc_id`` and ``text`` are not looked at; an
    empty table stays empty.
    """
    spark = docs.sparkSession
    with open(byte_level_file, "rb") as a, open(piece_file, "rb") as b:
        files = [spark.sparkContext.broadcast(f.read()) for f in (a, b)]
    size_a = Tokenizer.from_file(byte_level_file).get_vocab_size()
    path = scratch_path(spark, "alignment")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = texts.schema["doc_id"].dataType
    schema = f"row long, doc_id {id_type.simpleString()}, {FACTS}, radix int, salt int, index binary, page binary"
    texts.mapInArrow(lean(_spilled(*files, pattern, radixes, to_arrow_type(id_type))), schema).write.parquet(path)
    spilled = spark.read.parquet(path)

    indexes = spilled.filter("index IS NOT NULL").select("radix", "index")
    counts = indexes.repartition(radixes, "radix").sortWithinPartitions("radix").mapInArrow(_counted(size_a), "radix int, counts binary")
    kept = scratch_path(spark, "pair-counts")
    counts.write.parquet(kept)
    salted = spark.read.parquet(kept).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    salted = salted.select("radix", "salt", F.lit(-1).cast("long").alias("first"), "counts", F.lit(None).cast("binary").alias("page"))
    pages = spilled.filter("page IS NOT NULL").select(
        "radix", "salt", F.col("row").alias("first"), F.lit(None).cast("binary").alias("counts"), "page"
    )
    beside = salted.union(pages).repartition("radix", "salt").sortWithinPartitions("radix", "salt", "first")
    shares = beside.select("first", "counts", "page").mapInArrow(_shares, "row long, count_sum long, n_best long")
    shares = shares.groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    facts = spilled.filter("page IS NULL AND index IS NULL").select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    whole = facts.join(shares, "row", "left")
    return whole.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups_sha256",
    )
