"""Exact Jaccard self-join of documents on word n-grams by PartEnum signatures.

Texts with equal shingle sets are one set.  A size band and the next one hold all sets a
set can be similar to; for both, the shingle domain is cut into more parts than similar
sets can differ in, so two of them agree in a whole part and share that part's signature.
Sets that share a signature are candidates: first each with one of its bucket, then, in
buckets that do not lie in one component yet, pairs across components which a parity sketch
does not rule out, as many as connect what such pairs connect.  Candidates are verified on
their texts.  Where one of them fails, another pair may still link its components: the sets of
its bucket that have such a partner left are brought together with their texts and verified
there.  A bucket gives fewer pairs than it has sets in either step.  Nothing is lost:
signatures, sketches and skipped pairs only leave out pairs that are too unlike or already
connected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaspark.session import cut_lineage, scratch_path

from .components import components
from .frames import lean, small_batches
from .words import mixed, shingle_sets, text_slices

WORDS = 5
PERCENT = 75
SPREAD = 1.4
HEAVY_SHARE = 0.0012
HEAVY_SAMPLE = 1 << 14
HEAVY_BITS = 22
HEAVY_MOST = 1 << 16
BLOCK_SIGNATURES = 1 << 18
BLOCK_OWNERS = 1 << 16
PART_SIGNATURES = 1 << 18
PARTS_IN_TASK = 8
REMEMBERED = 1 << 17
BUCKET_BLOCK = 1024
BLOCK_SHINGLES = 2048
FOUND_PAIRS = 1 << 16
BROADCAST_PAIRS = 400_000
U64 = np.uint64
STEP = U64(0x9E3779B97F4A7C15)


def bands(percent: int, limit: int = 1 << 44) -> np.ndarray:
    """First sizes of the bands: a size's partners lie in its own band or a neighbour."""
    starts = [1]
    while starts[-1] < limit:
        starts.append(starts[-1] * 100 // percent + 1)
    return np.array(starts, dtype=np.int64)


def set_keys(flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set, from all its shingles and their number."""
    sums = np.concatenate((np.zeros(1, U64), np.cumsum(mixed(flat ^ STEP), dtype=U64)))
    starts = np.concatenate(([0], ends[:-1]))
    return mixed(sums[ends] - sums[starts] + (ends - starts).astype(U64) * STEP)


def sketch(shingles: np.ndarray) -> bytes:
    """Parities of hashed shingles in at least four bits each: sets that differ in d shingles differ in at most d bits."""
    bits = max(64, 1 << int(4 * len(shingles) - 1).bit_length())
    place = (mixed(shingles ^ U64(0x5851F42D4C957F2D)) & U64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def folded(raw: bytes, words: int) -> np.ndarray:
    return np.bitwise_xor.reduce(np.frombuffer(raw, dtype=U64).reshape(-1, words), axis=0)


def differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)


def signatures(flat: np.ndarray, ends: np.ndarray, heavy: np.ndarray, percent: int, starts: np.ndarray):
    """(signature, row) arrays of the sets, for their own band and the next.

    A part is a hash class of shingles; its signature is the sum of its shingles' hashes.
    Heavy shingles, those of very common passages, are left out at first: a set with more
    light parts in use than similar sets can differ in shares a used one with every partner.
    The sets with fewer, which could miss each other, also use all shingles and unused parts.
    """
    sizes = np.diff(np.concatenate(([0], ends)))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    is_light = ~heavy[(flat >> U64(64 - HEAVY_BITS)).astype(np.int64)]
    band = np.searchsorted(starts, np.maximum(sizes, 1), side="right") - 1
    out_sig, out_row = [], []
    for ahead in (0, 1):
        low, high = starts[band + ahead], starts[band + ahead + 1] - 1
        partner = np.minimum(high, sizes * 100 // percent)
        used = (sizes > 0) & (partner >= low)
        reach = (sizes + partner) * (100 - percent) // (100 + percent)
        most = 2 * high * (100 - percent) // (100 + percent)
        todo = used
        for light in (True, False):
            parts = np.where(todo, (most * (SPREAD if light else 1)).astype(np.int64) + 1, 0)
            offset = np.cumsum(parts) - parts
            pick = todo[owner] & is_light if light else todo[owner]
            own, shingle = owner[pick], flat[pick]
            h = mixed(shingle ^ (band[own] + ahead).astype(U64) * STEP ^ U64(light))
            place = offset[own] + (h % np.maximum(parts[own], 1).astype(U64)).astype(np.int64)
            sums = np.zeros(int(parts.sum()), dtype=U64)
            np.add.at(sums, place, mixed(h))
            if light:
                part = np.flatnonzero(np.bincount(place, minlength=len(sums)))
                row = np.searchsorted(offset + parts, part, side="right")
                count = np.bincount(row, minlength=len(sizes))
                rank = np.arange(len(part)) - (np.cumsum(count) - count)[row]
                enough = todo & (count > reach)
                keep = rank <= reach[row]
                todo = todo & ~enough
            else:
                part = np.arange(len(sums))
                row = np.searchsorted(offset + parts, part, side="right")
                keep = part - offset[row] <= reach[row]
            part, row = part[keep], row[keep]
            place_in = (part - offset[row]).astype(U64)
            name = (band[row] + ahead).astype(U64) * U64(2) + U64(light)
            out_sig.append(mixed(sums[part] + place_in * STEP + mixed(name)))
            out_row.append(row)
    return np.concatenate(out_sig), np.concatenate(out_row)


def row_key(doc_id: Column, text: Column) -> Column:
    """A digest of id and text (16 bytes); null is a value of its own."""
    of = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))
    return F.unhex(F.md5(F.concat(of(doc_id), F.lit(" "), of(text))))


def _sets(text_at: int):
    """Columns 0 and 1 as they are, with facts of the set of each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(text_at)):
                flat, ends = shingle_sets(data, offsets, WORDS)
                starts = np.concatenate(([0], ends[:-1]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first),
                        batch.column(1).slice(first, end - first),
                        pa.array(ends - starts, type=pa.int64()),
                        pa.array(set_keys(flat, ends).view(np.int64)),
                        pa.array([sketch(flat[a:b]) if b > a else b"" for a, b in zip(starts, ends)], type=pa.binary()),
                    ],
                    ["doc_id", "row_key", "n_shingles", "set_id", "sketch"],
                )

    return work


def heavy_shingles(docs: DataFrame, rows: int) -> np.ndarray:
    """Table over hash prefixes: shingles in more than ``HEAVY_SHARE`` of a sample of about
    ``HEAVY_SAMPLE`` documents (of all, if fewer), the ``HEAVY_MOST`` commonest.  The choice
    affects the spread of the work, not the result."""
    chosen = docs
    if rows > HEAVY_SAMPLE:
        chosen = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int(HEAVY_SAMPLE / rows * (1 << 40)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                flat, _ = shingle_sets(data, offsets, WORDS)
                value, count = np.unique(flat >> U64(64 - HEAVY_BITS), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.astype(np.int32)), pa.array(count)], ["prefix", "n"])

    counted = chosen.select("text").mapInArrow(lean(work), "prefix int, n long").groupBy("prefix").agg(F.sum("n").alias("n"))
    least = max(20.0, HEAVY_SHARE * min(rows, HEAVY_SAMPLE))
    table = np.zeros(1 << HEAVY_BITS, dtype=bool)
    table[[r.prefix for r in counted.filter(F.col("n") > least).orderBy(F.desc("n")).limit(HEAVY_MOST).collect()]] = True
    return table


def _signature_blocks(known, percent: int, parts: int):
    """Signatures in blocks per range of signatures: sorted values, and their sets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = np.unpackbits(np.frombuffer(known.value, dtype=np.uint8)).astype(bool)
        starts = bands(percent)
        seen: set[int] = set()
        sigs: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        keys: list[np.ndarray] = []
        held = owned = 0

        def blocks() -> pa.RecordBatch:
            sig, owner, key = np.concatenate(sigs), np.concatenate(owners), np.concatenate(keys)
            order = np.argsort(sig)
            sig, owner = sig[order], owner[order]
            part = ((sig >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)
            first = np.flatnonzero(np.diff(part, prepend=-1))
            columns: list[list] = [[], [], [], []]
            for a, b in zip(first, [*first[1:], len(sig)]):
                distinct, place = np.unique(owner[a:b], return_inverse=True)
                row = (int(part[a]), sig[a:b].tobytes(), key[distinct].tobytes(), place.astype(np.uint16).tobytes())
                for column, value in zip(columns, row):
                    column.append(value)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                ["part", "sigs", "keys", "places"],
            )

        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                flat, ends = shingle_sets(data, offsets, WORDS)
                key = set_keys(flat, ends)
                sizes = np.diff(np.concatenate(([0], ends)))
                fresh = np.zeros(len(key), dtype=bool)
                for j, k in enumerate(key.tolist()):
                    if sizes[j] and k not in seen:
                        fresh[j] = True
                        seen.add(k)
                if len(seen) > REMEMBERED:
                    seen.clear()
                if not fresh.any():
                    continue
                flat, sizes, key = flat[np.repeat(fresh, sizes)], sizes[fresh], key[fresh]
                if owned + len(key) > BLOCK_OWNERS and held:
                    yield blocks()
                    sigs, owners, keys, held, owned = [], [], [], 0, 0
                for at in range(0, len(key), BLOCK_OWNERS):
                    cut = slice(at, at + BLOCK_OWNERS)
                    total = np.cumsum(sizes)
                    base = total[at] - sizes[at]
                    own = flat[base : total[min(at + BLOCK_OWNERS, len(key)) - 1]]
                    sig, row = signatures(own, total[cut] - base, heavy, percent, starts)
                    sigs.append(sig)
                    owners.append(row + owned)
                    keys.append(key[cut])
                    held, owned = held + len(sig), owned + len(key[cut])
                    if held > BLOCK_SIGNATURES or owned >= BLOCK_OWNERS:
                        yield blocks()
                        sigs, owners, keys, held, owned = [], [], [], 0, 0
        if held:
            yield blocks()

    return work


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of two sets or more, from blocks sorted by part; equal buckets of a part once."""

    def buckets(blocks: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch | None:
        sig, key = (np.concatenate(c) for c in zip(*blocks))
        order = np.argsort(sig)
        sig, key = sig[order], key[order]
        again = sig[1:] == sig[:-1]
        shared = np.zeros(len(sig), dtype=bool)
        shared[1:] |= again
        shared[:-1] |= again
        sig, key = sig[shared], key[shared]
        order = np.lexsort((key, sig))
        sig, key = sig[order], key[order]
        new = np.ones(len(sig), dtype=bool)
        new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
        sig, key = sig[new], key[new]
        first = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1]))) if len(sig) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(sig)))
        if not (size > 1).any():
            return None
        name = mixed(np.add.reduceat(mixed(key.view(U64)), first) + size.astype(U64))
        _, once = np.unique(name, return_index=True)
        once = once[size[once] > 1]
        rows = np.concatenate([np.arange(a, a + n) for a, n in zip(first[once], size[once])])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(name[once].view(np.int64), size[once])),
                pa.array(key[rows]),
                pa.array(np.repeat(key[first[once]], size[once])),
            ],
            ["bucket", "set_id", "leader"],
        )

    at, blocks = None, []
    for batch in batches:
        for j, part in enumerate(batch.column(0).to_pylist()):
            if part != at and blocks:
                if (found := buckets(blocks)) is not None:
                    yield found
                blocks = []
            at = part
            sig, key, place = (
                np.frombuffer(batch.column(c)[j].as_buffer(), dtype=kind) for c, kind in ((1, U64), (2, np.int64), (3, np.uint16))
            )
            blocks.append((sig, key[place]))
    if blocks and (found := buckets(blocks)) is not None:
        yield found


def _likely(percent: int):
    """Keep the pairs (a, b) that sizes and sketches do not rule out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb, sa, sb = (c.to_pylist() for c in batch.columns)
            keep = []
            for j in range(len(a)):
                if min(na[j], nb[j]) * 100 < percent * max(na[j], nb[j]):
                    continue
                words = min(len(sa[j]), len(sb[j])) // 8
                d = int(differing(folded(sa[j], words), folded(sb[j], words)))
                if d * (100 + percent) <= (na[j] + nb[j]) * (100 - percent):
                    keep.append(j)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[j] for j in keep], type=pa.int64()), pa.array([b[j] for j in keep], type=pa.int64())], ["a", "b"]
            )

    return work


def _grouped(handle, columns: list[str]):
    """``handle`` for each group of rows with one (bucket, i, j), which come together; it gives rows of ``columns``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        found: set[tuple[int, ...]] = set()

        def flushed() -> pa.RecordBatch:
            made = list(zip(*found)) or [()] * len(columns)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in made], columns)

        for batch in batches:
            for bucket, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (bucket, i, j) != at:
                    if len(rows) > 1:
                        found.update(handle(at, rows))
                    at, rows = (bucket, i, j), []
                    if len(found) > FOUND_PAIRS:
                        yield flushed()
                rows.append(tuple(row))
        if len(rows) > 1:
            found.update(handle(at, rows))
        yield flushed()

    return work


class Block:
    """The sets of one (bucket, i, j): rows of set id, label, size, side and sketch.

    ``side`` 0 and 1 are the two blocks of a pair of blocks; a block with itself has side 0 only.
    """

    def __init__(self, rows: list[tuple], percent: int):
        self.ids, self.labels, self.sizes, sides = (np.array([r[k] for r in rows], dtype=np.int64) for k in range(4))
        self.left = np.flatnonzero(sides == 0)
        self.right = np.flatnonzero(sides == 1) if sides.any() else self.left
        self.percent = percent
        words = min(len(r[4]) for r in rows) // 8
        self.sketches = np.stack([folded(r[4], words) for r in rows])
        self.open = len(self.left) > 0 and len(self.right) > 0 and len({*self.labels.tolist()}) > 1

    def near(self, own: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` that sizes and sketches let be linked with ``own``."""
        n, sizes = self.sizes[own], self.sizes[others]
        others = others[np.minimum(n, sizes) * 100 >= self.percent * np.maximum(n, sizes)]
        d = differing(self.sketches[others], self.sketches[own])
        return others[d * (100 + self.percent) <= (self.sizes[others] + n) * (100 - self.percent)]


def _spanning(percent: int):
    """Likely pairs that connect the labels of a block as all its likely pairs do."""

    def handle(at_block: tuple, rows: list[tuple]) -> Iterator[tuple[int, int, int]]:
        block = Block(rows, percent)
        if not block.open:
            return
        part = block.labels.copy()
        for own in block.left:
            near = block.near(own, block.right[part[block.right] != part[own]])
            for label, at in zip(*np.unique(part[near], return_index=True)):
                a, b = int(block.ids[own]), int(block.ids[near[at]])
                yield min(a, b), max(a, b), at_block[0]
                part[part == label] = part[own]

    return _grouped(handle, ["a", "b", "bucket"])


def _undecided(percent: int):
    """The sets of a block that have a likely partner of another label."""

    def handle(at: tuple, rows: list[tuple]) -> Iterator[tuple[int, ...]]:
        block = Block(rows, percent)
        if not block.open:
            return
        keep = np.zeros(len(rows), dtype=bool)
        for own in block.left:
            near = block.near(own, block.right[block.labels[block.right] != block.labels[own]])
            if len(near):
                keep[near] = keep[own] = True
        for j in np.flatnonzero(keep):
            yield *at, *rows[j][:4]

    return _grouped(handle, ["bucket", "i", "j", "set_id", "label", "n", "side"])


def _exact(percent: int):
    """Links that connect the labels of a block as all its links do; ``rows``: set id, label, size, side, text."""

    def handle(_: tuple, rows: list[tuple]) -> Iterator[tuple[int, int]]:
        sets, keys = [], []
        for _, _, data, offsets in text_slices(pa.array([r[4] for r in rows], type=pa.large_string())):
            flat, ends = shingle_sets(data, offsets, WORDS)
            sets += [own.copy() for own in np.split(flat, ends[:-1])]
            keys += set_keys(flat, ends).view(np.int64).tolist()
        part = {r[1]: r[1] for r in rows}

        def top(label: int) -> int:
            while part[label] != label:
                label = part[label]
            return label

        sides = [[j for j, r in enumerate(rows) if r[3] == side and keys[j] == r[0]] for side in (0, 1)]
        for i in sides[0]:
            for j in sides[1] or sides[0]:
                a, b = top(rows[i][1]), top(rows[j][1])
                n, m = len(sets[i]), len(sets[j])
                if a == b or min(n, m) * 100 < percent * max(n, m):
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if both * 100 >= percent * (n + m - both):
                    part[b] = a
                    yield min(rows[i][0], rows[j][0]), max(rows[i][0], rows[j][0])

    return _grouped(handle, ["a", "b"])


def _verified(percent: int):
    """Links among the pairs (a, b, text of a, text of b); the shingles of one a are kept for its next pair."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, left = None, np.zeros(0, U64)
        for batch in batches:
            keep, names = [], batch.column(1).to_pylist()
            for j, a in enumerate(batch.column(0).to_pylist()):
                own = pa.array([batch.column(2)[j].as_py() if a != at else None, batch.column(3)[j].as_py()], type=pa.large_string())
                sets, keys = [], []
                for _, _, data, offsets in text_slices(own):
                    flat, ends = shingle_sets(data, offsets, WORDS)
                    sets += np.split(flat, ends[:-1])
                    keys += set_keys(flat, ends).view(np.int64).tolist()
                if a != at:
                    at, left = (a, sets[0]) if keys[0] == a else (None, left)
                right = sets[1]
                if at is None or keys[1] != names[j]:
                    continue  # another text with the same key
                both = len(np.intersect1d(left, right, assume_unique=True))
                if both * 100 >= percent * (len(left) + len(right) - both):
                    keep.append(j)
            kept = pa.array(keep, type=pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(kept), batch.column(1).take(kept)], ["a", "b"])

    return work


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _links(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs of set ids that are links.  ``texts``: ``set_id`` and ``text`` of one document per set."""
    few = pairs.count() <= BROADCAST_PAIRS
    small = F.broadcast if few else lambda df: df
    left = texts.join(small(pairs.select(F.col("a").alias("set_id")).distinct()), "set_id")
    right = texts.join(small(pairs.select("a", F.col("b").alias("set_id"))), "set_id")
    left = left.select(F.col("set_id").alias("a"), F.col("text").alias("text_a"))
    right = right.select("a", F.col("set_id").alias("b"), F.col("text").alias("text_b"))
    return right.join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(lean(_verified(percent)), "a long, b long")


def similar_sets(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(rows of ``doc_id``, ``row_key``, ``n_shingles``, ``set_id``; links ``a``, ``b`` between set ids).

    The links connect exactly the sets that are connected by pairs with
    100 * intersection >= percent * union; pairs inside a component need not all be there.
    """
    small_batches(docs.sparkSession)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    keyed = texts.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row_key"), "text")
    sets = keyed.mapInArrow(lean(_sets(2)), "doc_id long, row_key binary, n_shingles long, set_id long, sketch binary")
    sets = _written(sets, "sets")
    rows, shingles = sets.agg(F.count("*"), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    full = sets.filter("n_shingles > 0")
    one = full.groupBy("set_id").agg(
        F.min("row_key").alias("_key"), F.min("n_shingles").alias("n"), F.min("sketch").alias("sketch")
    )
    copies = not full.groupBy("row_key").count().filter("count > 1").isEmpty()
    heavy = np.packbits(heavy_shingles(texts, rows)).tobytes()
    known = docs.sparkSession.sparkContext.broadcast(heavy)
    parts = max(1, int(0.65 * shingles) // PART_SIGNATURES)
    blocks = texts.select("text").mapInArrow(
        lean(_signature_blocks(known, percent, parts)), "part long, sigs binary, keys binary, places binary"
    )
    shared = blocks.repartition(-(-parts // PARTS_IN_TASK), "part").sortWithinPartitions("part")
    shared = shared.mapInArrow(lean(_shared), "bucket long, set_id long, leader long").distinct()
    members = _written(shared, "members")

    chosen = _written(one, "chosen")
    facts = chosen.select("set_id", "n", "sketch")
    side = lambda k: facts.select(F.col("set_id").alias(k), F.col("n").alias("n" + k), F.col("sketch").alias("s" + k))
    star = members.filter("set_id <> leader").select(F.col("leader").alias("a"), F.col("set_id").alias("b")).distinct()
    star = star.join(side("b"), "b").join(side("a"), "a").select("a", "b", "na", "nb", "sa", "sb")
    star = cut_lineage(star.mapInArrow(lean(_likely(percent)), "a long, b long"))
    where = chosen.select("set_id", "_key")
    first = cut_lineage(_links(star, _texts_of(keyed, where, star, copies), percent))

    spanning = _open_rows(members, chosen, first).mapInArrow(lean(_spanning(percent)), "a long, b long, bucket long")
    spanning = cut_lineage(spanning.distinct())
    rest = spanning.select("a", "b").distinct()
    found = cut_lineage(_links(rest, _texts_of(keyed, where, rest, copies), percent))
    second = cut_lineage(first.union(found))
    # Where all pairs of a bucket are links, they connect what any likely pair of it does.
    failed = spanning.join(found, ["a", "b"], "left_anti").select("bucket").distinct()
    again = members.join(failed, "bucket", "left_semi")
    left = _open_rows(again, chosen, second).mapInArrow(
        lean(_undecided(percent)), "bucket long, i long, j long, set_id long, label long, n long, side long"
    )
    left = _written(left, "undecided")
    if not left.isEmpty():
        own = F.col("set_id")
        met = left.join(_texts_of(keyed, where, left.select(own.alias("a"), own.alias("b")), copies), "set_id")
        met = met.select("bucket", "i", "j", "set_id", "label", "n", "side", "text")
        met = met.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
        second = cut_lineage(second.union(met.mapInArrow(lean(_exact(percent)), "a long, b long")))
    return sets.select("doc_id", "row_key", "n_shingles", "set_id"), second


def _open_rows(members: DataFrame, chosen: DataFrame, links: DataFrame) -> DataFrame:
    """The sets of buckets that the links leave in more than one component, in pairs of blocks
    (bucket, i, j) that come together.  A block has ``BUCKET_BLOCK`` sets, fewer if they are long."""
    labels = components(links).withColumnRenamed("node", "set_id")
    known = chosen.select("set_id", "n").join(labels, "set_id", "left").select("set_id", "n", F.coalesce("label", "set_id").alias("label"))
    labelled = members.select("bucket", "set_id").join(known, "set_id")
    room = F.greatest(F.lit(1.0), F.max("n") / BLOCK_SHINGLES)
    open_buckets = labelled.groupBy("bucket").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.ceil(F.count("*") * room / BUCKET_BLOCK).cast("int").alias("blocks")
    ).filter("lo <> hi").select("bucket", "blocks")
    rows_in = labelled.join(open_buckets, "bucket").join(chosen.select("set_id", "sketch"), "set_id")
    own = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    rows_in = rows_in.withColumn("_own", own).withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    grouped = rows_in.select(
        "bucket",
        F.least("_own", "_with").alias("i"),
        F.greatest("_own", "_with").alias("j"),
        "set_id",
        "label",
        "n",
        F.when(F.col("_own") > F.col("_with"), 1).otherwise(0).alias("side"),
        "sketch",
    )
    return grouped.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")


def _texts_of(keyed: DataFrame, where: DataFrame, pairs: DataFrame, copies: bool) -> DataFrame:
    """``set_id`` and ``text`` of one document for every set in ``pairs``; ``copies``: rows with
    equal ids (null ones too) and texts may be there."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct().join(where, "set_id")
    ids = cut_lineage(ids)
    if ids.count() <= BROADCAST_PAIRS:
        ids = F.broadcast(ids)
    found = keyed.join(ids, F.col("row_key") == F.col("_key")).select("set_id", "text")
    return found.dropDuplicates(["set_id"]) if copies else found


def groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``row_key``, ``n_shingles``, ``set_id`` and ``label`` (the component's smallest
    set id) of every row of ``docs``.  Rows without shingles belong to no component, whatever
    their label."""
    sets, links = similar_sets(docs, percent)
    labels = components(links)
    named = sets.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    return named.withColumn("label", F.coalesce("label", "set_id"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` of every row of ``docs``.

    Equal sets are linked.  A null text, an empty one or one without words has no shingles
    and is its own component.  Repeated rows stay; a null ``doc_id`` is its own component
    where its text has no words and else takes the smallest id it is linked with.  Columns
    other than ``doc_id`` and ``text`` are not looked at.
    """
    named = groups(docs, percent)
    smallest = named.filter("n_shingles > 0").groupBy("label").agg(F.min("doc_id").alias("_least"))
    out = named.join(smallest, "label", "left")
    least = F.when(F.col("n_shingles") > 0, F.col("_least")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", least.alias("component_id"))
