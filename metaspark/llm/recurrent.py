"""Language-model scoring with a gated recurrent network in numpy.

Words are counted over the whole training text in Spark.  The network predicts symbols: the
commonest words, an end, and classes that the other words fall into by their last letters; a
softmax over groups of symbols and one inside the group make a step's cost grow with the
square root of the symbols.  A word of a class is then as likely as its count in the class,
so probabilities of all words, unseen ones included, sum to one.  The network is trained by
backpropagation through truncated windows on all training documents, in as many trainers as
they need, whose weights are averaged.  Scoring carries the state through
all windows of a document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaspark.session import scratch_path

from .frames import lean
from .words import mixed, text_slices, word_hashes, word_spans

GROUP = 32  # groups, and symbols in a group
SYMBOLS = GROUP * GROUP
CLASSES = GROUP - 1
END = SYMBOLS - 1
FIRST_CLASS = END - CLASSES  # symbols below are words
HIDDEN = 32
LOOKUP = 1 << 16
LOOKUP_BITS = 18  # leading bits of a hash that say where in the lookup it would be
ADD = 0.1
TRAINER_TOKENS = 1 << 22
UPDATES = 192
WINDOW = 32
LANES = 512
SCORE_LANES = 256
SCORE_WINDOW = 64
SLICE_BYTES = 8 << 20
COUNT_WORDS = 1 << 21
WEIGHT_BLOCK = 1024
BLOCK = 2048  # rows whose work arrays stay in the processor's cache
FAINT = 1e-30
SEED = 5


class Counts(NamedTuple):
    """What scoring knows of the training counts; of fixed size."""

    hashes: np.ndarray  # the commonest words, ascending
    counts: np.ndarray
    symbols: np.ndarray  # their symbols, -1 for words of a class
    tokens: int  # N, with ends
    words: int  # V, with the end
    ends: int
    class_log: np.ndarray  # log10 of each class's total
    frequency: np.ndarray  # of the symbols
    first: np.ndarray  # number of hashes whose leading bits are less


def word_classes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class of every word, from its last three bytes (A-Z as a-z)."""
    code = np.zeros(len(starts), dtype=np.uint64)
    for back in (1, 2, 3):
        at = ends - back
        byte = data[np.maximum(at, starts)].astype(np.uint64)
        byte += np.uint64(32) * ((byte >= 65) & (byte <= 90)).astype(np.uint64)
        code = code * np.uint64(257) + np.where(at >= starts, byte, np.uint64(256))
    return (mixed(code) % np.uint64(CLASSES)).astype(np.int64)


def count_words(docs: DataFrame) -> DataFrame:
    """``word`` (hash), ``n``, ``class`` of every distinct word of ``text``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def rows() -> pa.RecordBatch:
            words, first, n = np.unique(np.concatenate([h for h, _ in held]), return_index=True, return_counts=True)
            classes = np.concatenate([c for _, c in held])[first]
            return pa.RecordBatch.from_arrays(
                [pa.array(words.view(np.int64)), pa.array(n), pa.array(classes.astype(np.int32))], ["word", "n", "class"]
            )

        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                starts, ends, _ = word_spans(data, offsets)
                if len(starts):
                    held.append((word_hashes(data, starts, ends), word_classes(data, starts, ends)))
                    size += len(starts)
                if size > COUNT_WORDS:
                    yield rows()
                    held, size = [], 0
        if size:
            yield rows()

    found = docs.select("text").mapInArrow(work, "word long, n long, class int")
    return found.groupBy("word").agg(F.sum("n").alias("n"), F.min("class").alias("class"))


def summary(counted: DataFrame, documents: int) -> Counts:
    """The lookup of the commonest words and the totals of the classes.

    Counts fall into eight steps a doubling; the lookup takes whole steps, from the largest
    counts on, while they hold ``LOOKUP`` words at most.
    """
    step = F.floor(F.log2("n") * 8).cast("int")
    steps = counted.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()  # some hundreds at most
    least, held = None, 0
    for r in steps:
        if (held := held + r["count"]) > LOOKUP:
            break
        least = r.step
    top = [] if least is None else counted.filter(step >= least).collect()
    top.sort(key=lambda r: (-r.n, r.word))
    words = min(len(top), FIRST_CLASS)
    totals = {r["class"]: (r.s, r.v) for r in counted.groupBy("class").agg(F.sum("n").alias("s"), F.count("*").alias("v")).collect()}
    mass = np.array([totals.get(k, (0, 0))[0] for k in range(CLASSES)], dtype=np.float64)
    kinds = np.array([totals.get(k, (0, 0))[1] for k in range(CLASSES)], dtype=np.float64)
    tokens, distinct = int(mass.sum()) + documents, int(kinds.sum()) + bool(documents)
    for r in top[:words]:
        mass[r["class"]] -= r.n
        kinds[r["class"]] -= 1
    frequency = np.full(SYMBOLS, ADD)
    frequency[:words] += [r.n for r in top[:words]]
    frequency[FIRST_CLASS:END] += mass + ADD * kinds
    frequency[END] += documents
    hashes = np.array([r.word for r in top], dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    hashes = hashes[order]
    first = np.searchsorted(hashes >> np.uint64(64 - LOOKUP_BITS), np.arange((1 << LOOKUP_BITS) + 1, dtype=np.uint64))
    symbols = np.where(np.arange(len(top)) < words, np.arange(len(top)), -1)
    counts = np.array([r.n for r in top], dtype=np.float64)
    class_log = np.log10(mass + ADD * kinds + ADD)
    return Counts(
        hashes, counts[order], symbols[order], tokens, distinct, documents, class_log, frequency, first.astype(np.int32)
    )


def looked_up(known: Counts, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place in the lookup (-1: not in it) and own symbol (-1: none) of every word.

    The leading bits of a hash leave a few places to compare, one on average.
    """
    if not len(known.hashes):
        return np.full(len(words), -1), np.full(len(words), -1)
    leading = (words >> np.uint64(64 - LOOKUP_BITS)).astype(np.int64)
    at, stop = known.first[leading], known.first[leading + 1]
    np.minimum(at, len(known.hashes) - 1, out=at)
    same = known.hashes[at] == words
    place = np.where(same, at, -1)
    left = np.flatnonzero(~same & (at + 1 < stop))
    at, stop, words = at[left], stop[left], words[left]
    while len(left):
        at += 1
        same = known.hashes[at] == words
        place[left[same]] = at[same]
        more = ~same & (at + 1 < stop)
        left, at, stop, words = left[more], at[more], stop[more], words[more]
    return place, np.where(place >= 0, known.symbols[place], -1)


def with_ends(symbols: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all rows, an end after each; and the rows' ends."""
    per_row = np.bincount(row, minlength=rows)
    ends = np.cumsum(per_row + 1)
    out = np.full(int(ends[-1]) if rows else 0, END, dtype=np.int32)
    out[np.arange(len(symbols)) + row] = symbols
    return out, ends


def beginnings(fresh: np.ndarray) -> list[np.ndarray]:
    """The lanes that begin a document, step by step."""
    step, lane = np.nonzero(fresh)
    return np.split(lane, np.searchsorted(step, np.arange(1, len(fresh))))


SHAPES = (
    ("x", (SYMBOLS, 3 * HIDDEN)),  # what the last symbol gives the gates
    ("u", (HIDDEN, 2 * HIDDEN)),
    ("ug", (HIDDEN, HIDDEN)),
    ("g", (HIDDEN, GROUP)),
    ("bg", (GROUP,)),
    ("w", (GROUP, HIDDEN, GROUP)),
    ("bw", (GROUP, GROUP)),
)


class Network:
    """The gated recurrent network, its two-level softmax, and one training step.

    Work arrays are kept from window to window: the system clears the pages of new ones.
    """

    def __init__(self, weights: np.ndarray):
        self.flat = np.array(weights, dtype=np.float32)
        self.p = self._views(self.flat)
        self.kept: dict[str, np.ndarray] = {}

    def room(self, name: str, shape: tuple[int, ...], dtype: np.dtype) -> np.ndarray:
        """The work array of that name, with what was in it."""
        size = math.prod(shape)
        held = self.kept.get(name)
        if held is None or len(held) < size or held.dtype != dtype:
            held = self.kept[name] = np.empty(size, dtype=dtype)
        return held[:size].reshape(shape)

    @staticmethod
    def _views(flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in SHAPES:
            size = math.prod(shape)
            out[name] = flat[at : at + size].reshape(shape)
            at += size
        return out

    @classmethod
    def fresh(cls, frequency: np.ndarray, seed: int = SEED) -> Network:
        """Small random weights; output biases from the symbols' frequencies."""
        draws = np.random.Generator(np.random.PCG64(seed))
        flat = draws.standard_normal(sum(math.prod(s) for _, s in SHAPES)) * 0.08
        out = cls(flat)
        share = (frequency / frequency.sum()).reshape(GROUP, GROUP)
        out.p["w"][:] = 0
        out.p["g"][:] = 0
        out.p["bg"][:] = np.log(share.sum(axis=1))
        out.p["bw"][:] = np.log(share / share.sum(axis=1, keepdims=True))
        out.p["x"][:, :HIDDEN] -= 1.0  # keep the state at first
        return out

    def states(self, inputs: np.ndarray, fresh: np.ndarray, state: np.ndarray, keep: bool = True) -> tuple[np.ndarray, list]:
        """States after each step of a window (steps x lanes) and, with ``keep``, what the way back needs.

        ``fresh`` marks steps that begin a document: their state starts at zero.  The gates'
        weights are negated once, not the gates at every step.
        """
        p = self.p
        kind, (steps, lanes) = p["u"].dtype, inputs.shape
        gates = self.room("gates", (steps if keep else 1, 2, lanes, HIDDEN), kind)
        new, before, reset = (self.room(name, (len(gates), lanes, HIDDEN), kind) for name in ("new", "before", "reset"))
        out = self.room("out", (steps, lanes, HIDDEN), kind)
        moved = self.room("moved", (2, lanes, HIDDEN), kind)
        to_z, to_r, to_new = (np.ascontiguousarray(v) for v in np.split(p["x"], 3, axis=1))
        np.negative(to_z, out=to_z)
        np.negative(to_r, out=to_r)
        across = -np.stack(np.split(p["u"], 2, axis=1))
        symbols = np.ascontiguousarray(inputs)
        for t, begins in enumerate(beginnings(fresh)):
            at = t if keep else 0
            both, z, r, own = gates[at], gates[at, 0], gates[at, 1], new[at]
            np.copyto(before[at], state)
            state = before[at]
            if len(begins):
                state[begins] = 0
            for gate, weights in ((z, to_z), (r, to_r), (own, to_new)):
                np.take(weights, symbols[t], axis=0, out=gate, mode="clip")
            both += np.matmul(state, across, out=moved)
            np.exp(both, out=both)
            both += 1
            np.reciprocal(both, out=both)
            np.multiply(r, state, out=reset[at])
            own += np.matmul(reset[at], p["ug"], out=moved[0])
            np.tanh(own, out=own)
            np.subtract(own, state, out=out[t])
            out[t] *= z
            out[t] += state
            state = out[t]
        return out, [before, gates[:, 0], gates[:, 1], reset, new]

    def log_probabilities(self, states: np.ndarray, targets: np.ndarray, back: dict | None = None) -> np.ndarray:
        """Natural log probabilities of the targets; with ``back``, gradients of their negative sum too.

        Steps are taken in order of their targets' groups, so that a group's members are one
        product, or one for each ``BLOCK`` of them.
        """
        p, kind = self.p, states.dtype
        group, member = targets // GROUP, targets % GROUP
        order = np.argsort(group.astype(np.uint8), kind="stable")
        group, member = group[order], member[order]
        cuts = np.searchsorted(group, np.arange(GROUP + 1)).tolist()
        rows = np.take(states, order, axis=0, out=self.room("rows", states.shape, kind), mode="clip")
        room, steps, ones = self.room("logits", (BLOCK, GROUP), kind), np.arange(BLOCK), np.ones(BLOCK, dtype=kind)
        found = np.empty(len(rows), dtype=kind)

        def softmax(own: slice, weights: np.ndarray, bias: np.ndarray, wanted: np.ndarray):
            """(log probabilities of the wanted, d logits)."""
            at = steps[: len(wanted)]
            logits = np.matmul(rows[own], weights, out=room[: len(wanted)])
            logits += bias
            logits -= logits.max()
            picked = logits[at, wanted]
            np.exp(logits, out=logits)
            total = logits @ ones[:GROUP]
            if total.min() < FAINT:  # rows far below the highest: each by its own maximum
                logits = rows[own] @ weights + bias
                logits -= logits.max(axis=1, keepdims=True)
                picked = logits[at, wanted]
                np.exp(logits, out=logits)
                total = logits @ ones[:GROUP]
            picked -= np.log(total)
            if back is not None:
                logits /= total[:, None]
                logits[at, wanted] -= 1
            return picked, logits

        if back is not None:
            for name in ("g", "bg", "w", "bw"):
                back[name] = np.zeros_like(p[name])
            d_rows, added = self.room("d_rows", states.shape, kind), self.room("added", states.shape, kind)
            to_rows = np.ascontiguousarray(p["g"].T)
        for at in range(0, len(rows), BLOCK):
            own = slice(at, min(at + BLOCK, len(rows)))
            found[own], d = softmax(own, p["g"], p["bg"], group[own])
            if back is not None:
                back["g"] += rows[own].T @ d
                back["bg"] += ones[: len(d)] @ d
                np.matmul(d, to_rows, out=d_rows[own])
        for k, (first, last) in enumerate(zip(cuts, cuts[1:])):
            if back is not None:
                to_rows = np.ascontiguousarray(p["w"][k].T)
            for at in range(first, last, BLOCK):
                own = slice(at, min(at + BLOCK, last))
                inner, d = softmax(own, p["w"][k], p["bw"][k], member[own])
                found[own] += inner
                if back is not None:
                    back["w"][k] += rows[own].T @ d
                    back["bw"][k] += ones[: len(d)] @ d
                    d_rows[own] += np.matmul(d, to_rows, out=added[own])
        out = np.empty_like(found)
        out[order] = found
        if back is not None:
            place = np.empty_like(order)
            place[order] = np.arange(len(order))
            back["states"] = np.take(d_rows, place, axis=0, out=added, mode="clip")
        return out

    def gradient(self, inputs: np.ndarray, targets: np.ndarray, fresh: np.ndarray, state: np.ndarray):
        """(loss a token, gradient, last state) of a window; each weight's gradient is one product over the window."""
        steps, lanes = inputs.shape
        states, (before, z, r, reset, new) = self.states(inputs, fresh, state)
        back: dict[str, np.ndarray] = {}
        loss = -self.log_probabilities(states.reshape(-1, HIDDEN), targets.ravel(), back).mean()
        from_out = back["states"].reshape(steps, lanes, HIDDEN)
        p, scale = self.p, np.float32(1.0 / targets.size)
        grad = np.zeros_like(self.flat)
        g = self._views(grad)
        d_gates = self.room("d_gates", (3, *new.shape), new.dtype)
        d_z, d_r, d_new = d_gates
        begins = beginnings(fresh)
        across_z, across_r, across_new = (np.ascontiguousarray(v.T) for v in (*np.split(p["u"], 2, axis=1), p["ug"]))
        d_state = np.zeros((lanes, HIDDEN), dtype=new.dtype)
        one, other, d_reset = (np.empty_like(d_state) for _ in range(3))  # room for products
        for t in range(steps - 1, -1, -1):
            d_state += from_out[t]
            np.multiply(new[t], new[t], out=one)
            np.subtract(1, one, out=one)
            one *= z[t]
            np.multiply(d_state, one, out=d_new[t])
            np.subtract(1, z[t], out=other)
            np.subtract(new[t], before[t], out=one)
            one *= z[t]
            one *= other
            np.multiply(d_state, one, out=d_z[t])
            np.matmul(d_new[t], across_new, out=d_reset)
            np.subtract(1, r[t], out=one)
            one *= reset[t]
            np.multiply(d_reset, one, out=d_r[t])
            d_state *= other
            d_reset *= r[t]
            d_state += d_reset
            d_state += np.matmul(d_z[t], across_z, out=one)
            d_state += np.matmul(d_r[t], across_r, out=one)
            if len(begins[t]):
                d_state[begins[t]] = 0
        flat = lambda v: v.reshape(-1, v.shape[-1])
        g["ug"][:] = flat(reset).T @ flat(d_new)
        g["u"][:, :HIDDEN], g["u"][:, HIDDEN:] = flat(before).T @ flat(d_z), flat(before).T @ flat(d_r)
        g["x"][:] = self.by_symbol(d_gates.reshape(3, -1, HIDDEN), inputs.ravel())
        for name in ("g", "bg", "w", "bw"):
            g[name][:] = back[name]
        grad *= scale
        return loss, grad, states[-1].copy()

    def by_symbol(self, values: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Sums of the rows of each of ``values`` by symbol, side by side.

        Rows are taken in order of how often their symbol occurs: symbols that occur equally
        often are added up at once.
        """
        parts, _, width = values.shape
        count = np.bincount(symbol, minlength=SYMBOLS)
        by_count = np.argsort(count, kind="stable")
        rank = np.empty(SYMBOLS, dtype=np.uint16)
        rank[by_count] = np.arange(SYMBOLS)
        order = np.argsort(rank[symbol], kind="stable")
        rows = np.take(values, order, axis=1, out=self.room("by_symbol", values.shape, values.dtype), mode="clip")
        ones = np.ones(len(symbol), dtype=values.dtype)
        sums = np.zeros((parts, SYMBOLS, width), dtype=values.dtype)
        at, times = 0, np.bincount(count)
        first = np.cumsum(times) - times
        for n in np.flatnonzero(times).tolist():
            own, kinds = slice(int(first[n]), int(first[n] + times[n])), int(times[n])
            if n:
                block = rows[:, at : at + n * kinds].reshape(parts, kinds, n, width)
                sums[:, own] = block.sum(axis=2) if n < 8 else ones[:n] @ block
                at += n * kinds
        out = np.empty((SYMBOLS, parts, width), dtype=values.dtype)
        out[by_count] = sums.transpose(1, 0, 2)
        return out.reshape(SYMBOLS, parts * width)

    def fit(self, symbols: np.ndarray, lanes: int = LANES, window: int = WINDOW, rate: float = 0.02) -> float:
        """One pass over a stream of documents (each with its end), cut into lanes; returns the last losses' mean.

        There are as many lanes as leave ``UPDATES`` updates of the weights, ``lanes`` at most.  The state goes on from window to window; gradients stop at a window's start.
        """
        lanes = max(1, min(lanes, len(symbols) // (window * UPDATES)))
        steps = (len(symbols) - 1) // lanes
        if steps < 1:
            return 0.0
        before = np.concatenate(([END], symbols[:-1]))
        cut = lambda v: v[: steps * lanes].reshape(lanes, steps).T
        inputs, targets = cut(before), cut(symbols)
        state = np.zeros((lanes, HIDDEN), dtype=np.float32)
        m, v = np.zeros_like(self.flat), np.zeros_like(self.flat)
        losses = []
        updates = -(-steps // window)
        for n, at in enumerate(range(0, steps, window), 1):
            some = inputs[at : at + window]
            loss, grad, state = self.gradient(some, targets[at : at + window], some == END, state)
            norm = float(np.sqrt((grad * grad).sum()))
            grad *= min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            pace = rate * min(1.0, n / 20) * (1.0 - 0.9 * n / updates)
            self.flat -= np.float32(pace / (1 - 0.9**n)) * m / (np.sqrt(v / np.float32(1 - 0.99**n)) + 1e-8)
            losses.append(loss)
        return float(np.mean(losses[-20:]))

    def score(self, symbols: np.ndarray, ends: np.ndarray, lanes: int = SCORE_LANES, window: int = SCORE_WINDOW) -> np.ndarray:
        """Natural log probability of every document (its symbols up to its end).

        Lanes read documents one after another, window by window; a lane's state is carried
        on inside a document and starts anew with the next.
        """
        rows = len(ends)
        starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
        sizes = (ends - starts).astype(np.int64)
        lanes = max(1, min(lanes, rows))
        load = np.zeros(lanes, dtype=np.int64)
        place = np.empty(rows, dtype=np.int64)
        lane_of = np.empty(rows, dtype=np.int64)
        for j in np.argsort(-sizes, kind="stable").tolist():
            lane = int(load.argmin())
            lane_of[j], place[j] = lane, load[lane]
            load[lane] += sizes[j]
        steps = int(load.max())
        targets = np.full((steps, lanes), END, dtype=np.int32)
        owner = np.full((steps, lanes), rows, dtype=np.int32)
        row = np.repeat(np.arange(rows), sizes)
        step = np.arange(len(symbols)) - starts[row] + place[row]
        targets[step, lane_of[row]] = symbols
        owner[step, lane_of[row]] = row
        inputs = np.concatenate((np.full((1, lanes), END, dtype=np.int32), targets[:-1]))
        begins = np.ones((steps, lanes), dtype=bool)
        begins[1:] = owner[1:] != owner[:-1]
        out = np.zeros(rows + 1)
        state = np.zeros((lanes, HIDDEN), dtype=np.float32)
        for at in range(0, steps, window):
            own = owner[at : at + window]
            alive = np.flatnonzero((own < rows).any(axis=0))
            states, _ = self.states(inputs[at : at + window, alive], begins[at : at + window, alive], state[alive], keep=False)
            state[alive] = states[-1]
            who = own[:, alive].ravel()
            wanted, states = targets[at : at + window, alive].ravel(), states.reshape(-1, HIDDEN)
            real = who < rows
            if not real.all():
                who, wanted, states = who[real], wanted[real], states[real]
            out += np.bincount(who, weights=self.log_probabilities(states, wanted), minlength=rows + 1)
        return out[:rows]


def _symbols(known: Counts, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _, _, data, offsets in text_slices(column):
        starts, ends, row = word_spans(data, offsets)
        _, symbol = looked_up(known, word_hashes(data, starts, ends))
        of_class = np.flatnonzero(symbol < 0)
        symbol[of_class] = FIRST_CLASS + word_classes(data, starts[of_class], ends[of_class])
        yield with_ends(symbol, row, len(offsets) - 1)


def train(docs: DataFrame, known: Counts) -> np.ndarray:
    """The network's weights, from all documents of ``docs``.

    Trainers take about ``TRAINER_TOKENS`` tokens each, dealt by hash of id and text, so their
    number grows with the input; all begin with the weights of one that has read the first
    trainer's documents.  One that is dealt more than twice as many (many equal rows) goes on
    as another trainer.  Their weights are averaged in two levels of Spark aggregates.
    """
    base = Network.fresh(known.frequency).flat
    if not known.tokens:
        return base
    trainers = max(1, round(known.tokens / TRAINER_TOKENS))
    chosen = docs.select(F.xxhash64("doc_id", "text").alias("at"), "text")
    chosen = chosen.withColumn("trainer", F.pmod("at", F.lit(trainers)).cast("int"))
    context = docs.sparkSession.sparkContext
    counts = context.broadcast(tuple(known))

    def averaged(rows: DataFrame, weights: np.ndarray) -> np.ndarray:
        begin = context.broadcast(weights.tobytes())

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Counts(*counts.value)
            at, held, size = None, [], 0

            def trained() -> pa.RecordBatch:
                network = Network(np.frombuffer(begin.value, dtype=np.float32))
                stream = np.concatenate(held)
                network.fit(stream)
                flat = np.pad(network.flat, (0, -len(network.flat) % WEIGHT_BLOCK)).reshape(-1, WEIGHT_BLOCK)
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array([at] * len(flat), type=pa.int32()),
                        pa.array(range(len(flat)), type=pa.int32()),
                        pa.array([float(len(stream))] * len(flat)),
                        pa.array((flat.astype(np.float64) * len(stream)).tolist(), type=pa.list_(pa.float64())),
                    ],
                    ["trainer", "block", "weight", "vals"],
                )

            for batch in batches:
                trainer = batch.column(0).to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(trainer)) + 1).tolist(), len(trainer)]
                for a, b in zip(cuts, cuts[1:]):
                    if a < b:
                        if trainer[a] != at and held:
                            yield trained()
                            held, size = [], 0
                        at = int(trainer[a])
                        for stream, _ in _symbols(known, batch.column(1).slice(a, b - a)):
                            held.append(stream)
                            if (size := size + len(stream)) > 2 * TRAINER_TOKENS:
                                yield trained()
                                held, size = [], 0
            if held:
                yield trained()

        dealt = rows.repartition(trainers, "trainer").sortWithinPartitions("trainer", "at").select("trainer", "text")
        parts = dealt.mapInArrow(lean(work), "trainer int, block int, weight double, vals array<double>")
        added = F.reduce(
            F.collect_list("vals"),
            F.array_repeat(F.lit(0.0), WEIGHT_BLOCK),
            lambda a, b: F.zip_with(a, b, lambda x, y: x + y),
        ).alias("vals")
        level = parts.withColumn("salt", F.pmod("trainer", F.lit(math.isqrt(trainers) + 1)))
        level = level.groupBy("block", "salt").agg(F.sum("weight").alias("weight"), added)
        found = level.groupBy("block").agg(F.sum("weight").alias("weight"), added).collect()
        if not found:
            return weights
        found.sort(key=lambda r: r.block)
        return np.concatenate([np.array(r.vals) / r.weight for r in found]).astype(np.float32)[: len(weights)]

    if trainers > 1:
        base = averaged(chosen.filter("trainer = 0"), base)
    return averaged(chosen, base)


def score(docs: DataFrame, training: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of every row of ``docs``.

    Learns from ``training`` (both have ``doc_id`` and ``text``).  A null or empty text is
    one end token.  Repeated rows each get a row; without training texts every token is
    unknown and both scores come from the smoothing alone.  Words outside the lookup of the
    commonest are joined with the counts in Spark, once per row and word.
    """
    spark = docs.sparkSession
    context = spark.sparkContext

    def written(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    counted = written(count_words(training), "counts")
    known = summary(counted, training.count())
    weights = train(training.select("doc_id", "text"), known)
    counts, network = context.broadcast(tuple(known)), context.broadcast(weights.tobytes())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Counts(*counts.value)
        model = Network(np.frombuffer(network.value, dtype=np.float32))
        log_count = np.log10(known.counts + ADD)
        end_log = math.log10(known.ends + ADD)
        next_row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(1), SLICE_BYTES):
                rows = last - first
                starts, ends, row = word_spans(data, offsets)
                words = word_hashes(data, starts, ends)
                place, symbol = looked_up(known, words)
                in_class = symbol < 0
                classes = word_classes(data, starts[in_class], ends[in_class])
                symbol[in_class] = FIRST_CLASS + classes
                stream, stream_ends = with_ends(symbol, row, rows)
                model_log = model.score(stream, stream_ends) / math.log(10)
                total = lambda which, values: np.bincount(row[which], weights=values, minlength=rows)
                found = place >= 0
                base = total(found, log_count[place[found]]) + end_log
                both = found & in_class
                model_log += total(both, log_count[place[both]]) - total(in_class, known.class_log[classes])
                rare_word, rare_row = words[~found], row[~found]
                order = np.lexsort((rare_word, rare_row))
                rare_word, rare_row = rare_word[order], rare_row[order]
                new = np.ones(len(order), dtype=bool)
                new[1:] = (rare_word[1:] != rare_word[:-1]) | (rare_row[1:] != rare_row[:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(order))).astype(np.int32)
                lists = np.concatenate(([0], np.cumsum(np.bincount(rare_row[at], minlength=rows)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(next_row, next_row + rows)),
                        batch.column(0).slice(first, rows),
                        pa.array(np.diff(np.concatenate(([0], stream_ends)))),
                        pa.array(total(found, np.ones(int(found.sum()))).astype(np.int64) + bool(known.ends)),
                        pa.array(base),
                        pa.array(model_log),
                        pa.ListArray.from_arrays(pa.array(lists), pa.array(rare_word[at].view(np.int64))),
                        pa.ListArray.from_arrays(pa.array(lists), pa.array(times)),
                    ],
                    ["row", "doc_id", "n_tokens", "known", "base", "model", "rare", "times"],
                )
                next_row += rows

    schema = (
        "row long, doc_id long, n_tokens long, known long, base double, model double, rare array<long>, times array<int>"
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = written(texts.mapInArrow(lean(work), schema), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("p")).select("row", F.col("p.rare").alias("word"), "p.times")
    count = F.coalesce(F.col("n"), F.lit(0))
    joined = rare.join(counted.select("word", "n"), "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(count + ADD)).alias("rare_log"),
        F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    whole = scored.drop("rare", "times").join(joined, "row", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    floor = math.log10(known.tokens + ADD * (known.words + 1))
    return whole.select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + rare_log - F.col("n_tokens") * floor).alias("base_score"),
        (F.col("model") + rare_log).alias("score"),
    )
