"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

Two adjacent tokens can stand in an encoding exactly if merging their bytes gives the two
back.  The transducer that guesses the next token and checks it against the last one is
nondeterministic: a state holds, for each place where a token may have begun, the token
before it and the vocabulary's trie node reached since.  Determinised, states are sets of
such guesses; they and their moves are made when a text first needs them.  Only one guess
per prefix ends in a valid token, so every open guess has one path of tokens behind it, and
the tokens that all paths share are settled.  A piece longer than ``LOOK`` bytes emits them as
it is read; what is held back are the bytes in which open guesses still differ.

Decoding takes the bytes of ids some thousand tokens at a time through a table-driven
UTF-8 machine, which carries an incomplete character to the next chunk.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .frames import extended, lean, small_batches

STATES = 1 << 16
ARCS = 1 << 18
PIECES = 1 << 17
PAIRS = 1 << 17
LOOK = 64
ROWS = 128  # rows encoded at once
JOIN_TOKENS = 1 << 16
NODE_BITS = 24
NODE = (1 << NODE_BITS) - 1
GUESSES = -1


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Tokens and ranks of a file with a base64 token and its rank a line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())}


class Transducer:
    """Encoder of pieces for one table of ranks.

    The trie is one table of steps (node and byte to node) beside arrays; a guess is one
    number, the last token (plus one) above the trie node.  A state is a table of its own from
    a byte to its arc, the next state and the token that ends with the byte (or -1); at
    ``GUESSES`` are its guesses, the earliest begun first.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.steps: dict[int, int] = {}
        self.token_at, self.depth, self.inner = array("i", [-1]), array("i", [0]), bytearray(1)
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                step = self.steps.get(node << 8 | byte)
                if step is None:
                    self.inner[node] = 1
                    step = self.steps[node << 8 | byte] = len(self.token_at)
                    self.token_at.append(-1)
                    self.depth.append(self.depth[node] + 1)
                    self.inner.append(0)
                node = step
            self.token_at[node] = rank
        self.size_of = array("i", map(len, self.bytes_of))
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.start: dict = {GUESSES: (0,)}
        self.names: dict[tuple[int, ...], dict] = {(0,): self.start}
        self.arcs = 0

    def last_merge(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for one that no merge makes."""
        if token in self.parts:
            return self.parts[token]
        ids = [self.ranks[bytes((b,))] for b in self.bytes_of[token]]
        while len(ids) > 2:
            best = min(
                ((self.ranks.get(self.bytes_of[a] + self.bytes_of[b], 1 << 60), j) for j, (a, b) in enumerate(zip(ids, ids[1:])))
            )
            if best[0] >= 1 << 60:
                break
            ids[best[1] : best[1] + 2] = [best[0]]
        self.parts[token] = found = (ids[0], ids[1]) if len(ids) == 2 else None
        return found

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the bytes of ``left`` then ``right`` encode as just these two tokens.

        Undo the later of the last merges on either side until the tokens that meet would
        have merged across the border before what is undone (then not), or nothing is left.
        Among merges of one rank the leftmost comes first.
        """
        name = left << 32 | right
        found = self.pairs.get(name)
        if found is not None:
            return found
        ok = self.size_of[right] == 1 or self.last_merge(right) is not None
        a, b, limit = left, right, 1 << 60
        while ok and left >= 0:
            across = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
            if across is not None and across < limit:
                ok = False
                break
            halves_a, halves_b = self.last_merge(a), self.last_merge(b)
            if halves_a is None and halves_b is None:
                break
            if halves_b is None or (halves_a is not None and a > b):
                limit, a = a, halves_a[1]
            else:
                limit, b = b + 1, halves_b[0]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[name] = ok
        return ok

    def _next(self, guesses: tuple[int, ...] | list[int], byte: int) -> tuple[list[int], int]:
        """(guesses after the byte, token that ends with it or -1).

        At most one guess ends in a token that may follow its last one.  Guesses that no
        further byte can extend are not kept.
        """
        after, ended = [], -1
        steps, token_at, pairs, inner = self.steps, self.token_at, self.pairs, self.inner
        for guess in guesses:
            step = steps.get((guess & NODE) << 8 | byte)
            if step is None:
                continue
            if ended < 0:
                token = token_at[step]
                if token >= 0:
                    last = (guess >> NODE_BITS) - 1
                    known = pairs.get(last << 32 | token)
                    if self.may_follow(last, token) if known is None else known:
                        ended = token
            if inner[step]:
                after.append(guess >> NODE_BITS << NODE_BITS | step)
        if ended >= 0:
            after.append(ended + 1 << NODE_BITS)
        return after, ended

    def _move(self, state: dict, byte: int) -> tuple[dict, int]:
        """The arc of a state for a byte, made now.

        It is kept, up to a bound, if it leads to a state of the table.  In a full table new guesses
        get a state that is forgotten, and the way goes on until it comes to one of the table.
        """
        guesses, ended = self._next(state[GUESSES], byte)
        key = tuple(guesses)
        to = self.names.get(key)
        if to is None:
            to = {GUESSES: key}
            if len(self.names) >= STATES:
                return to, ended
            self.names[key] = to
        if self.arcs < ARCS:
            self.arcs += 1
            state[byte] = to, ended
        return to, ended

    def run(self, piece: bytes) -> Iterator[int]:
        """Token ids of ``piece``, in order as they are settled.

        States are made while the table has room, so those that texts need first and most
        are deterministic.
        """
        ends: list[int] = []  # the token that ends each prefix, after what is emitted
        state = self.start
        for byte in piece:
            state, ended = state.get(byte) or self._move(state, byte)
            ends.append(ended)
            if len(ends) > LOOK:
                border = self._border(ends, state[GUESSES])
                if border:
                    yield from self._path(ends, border)
                    del ends[:border]
        yield from self._path(ends, len(ends))

    def short(self, piece: bytes) -> list[int]:
        """Token ids of a piece of at most ``LOOK`` bytes, as ``run`` gives them."""
        ends: list[int] = []
        state = self.start
        for byte in piece:
            state, ended = state.get(byte) or self._move(state, byte)
            ends.append(ended)
        return self._path(ends, len(ends))

    def _border(self, ends: list[int], guesses: tuple[int, ...] | list[int]) -> int:
        """The last place up to which the paths of all open guesses have the same tokens."""
        depth, size_of = self.depth, self.size_of
        places = {len(ends) - depth[g & NODE] for g in guesses}
        while len(places) > 1:
            last = max(places)
            places.remove(last)
            places.add(last - size_of[ends[last - 1]])
        return places.pop()

    def _path(self, ends: list[int], end: int) -> list[int]:
        """The tokens up to a place, followed from the right."""
        out = []
        while end > 0:
            token = ends[end - 1]
            out.append(token)
            end -= self.size_of[token]
        out.reverse()
        return out

    def encode(self, text: str, pattern) -> np.ndarray:
        """Ids of a text."""
        return np.frombuffer(self.encoded(text, pattern), dtype="<u4")

    def encoded(self, text: str, pattern) -> bytes:
        """Ids of a text (little-endian 32-bit), its pattern matches encoded separately; pieces
        seen lately are remembered, up to a bound."""
        pieces = pattern.findall(text)
        found = list(map(self.pieces.get, pieces))
        if None in found:
            for j, ids in enumerate(found):
                if ids is None:
                    found[j] = self._piece(pieces[j])
        return b"".join(found)

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece) or self.older.get(piece)
        if ids is None:
            raw = piece.encode()
            whole = self.ranks.get(raw)  # a piece that is a token stays one, made by merges or not
            ids = array("I", (whole,) if whole is not None else self.short(raw) if len(raw) <= LOOK else self.run(raw))
            if sys.byteorder == "big":
                ids.byteswap()
            ids = ids.tobytes()
        if len(self.pieces) >= PIECES:
            self.older, self.pieces = self.pieces, {}
        self.pieces[piece] = ids
        return ids


def utf8_table() -> list[bytes]:
    """The next state by state and byte.

    States: 0 between characters, 1 to 3 that many continuation bytes to come, 4 to 7 after
    E0, ED, F0, F4, whose next byte has a narrower range; 8: malformed.
    """
    table = [bytearray([8] * 256) for _ in range(8)]
    for byte in range(256):
        start = 0 if byte < 0x80 else 8
        if 0xC2 <= byte <= 0xDF:
            start = 1
        elif 0xE0 <= byte <= 0xEF:
            start = {0xE0: 4, 0xED: 5}.get(byte, 2)
        elif 0xF0 <= byte <= 0xF4:
            start = {0xF0: 6, 0xF4: 7}.get(byte, 3)
        table[0][byte] = start
    for state, low, high, to in ((1, 0x80, 0xBF, 0), (2, 0x80, 0xBF, 1), (3, 0x80, 0xBF, 2), (4, 0xA0, 0xBF, 1), (5, 0x80, 0x9F, 1), (6, 0x90, 0xBF, 2), (7, 0x80, 0x8F, 2)):
        for byte in range(low, high + 1):
            table[state][byte] = to
    return [bytes(row) for row in table]


UTF8 = utf8_table()
STEPS = np.frombuffer(b"".join(UTF8) + bytes([8] * 256), dtype=np.uint8).reshape(9, 256)
#: Bits of the character that a first byte holds, by the state after it.
FIRST_BITS = {1: 0x1F, 2: 0x0F, 3: 0x07, 4: 0x0F, 5: 0x0F, 6: 0x07, 7: 0x07}
HIGH = re.compile(rb"[\x80-\xff]+")


LEADS = [bytes((b,)) for b in range(0xC0, 0x100)]


def well_formed(chunk: bytes) -> bool:
    """Whether the table's states go from 0 to 0 over the chunk without an error: every first byte of a
    character beyond ASCII starts a walk of its own, all walks step together, three steps at most."""
    if chunk.isascii():
        return True
    data = np.frombuffer(chunk + b"   ", dtype=np.uint8)
    high = np.flatnonzero(data >= 0x80)
    at = high[data[high] >= 0xC0]
    state, length = STEPS[0, data[at]], len(at)
    for _ in range(3):
        at, state = at[state > 0] + 1, state[state > 0]
        if not len(at):
            break
        state = STEPS[state, data[at]]
        length += len(at)
    return not state.any() and length == len(high)


class Utf8Stream:
    """UTF-8 decoding of byte chunks cut anywhere, by a table of states.

    The memory is the state and the bits of the character so far.  Each longest malformed
    beginning of a character becomes U+FFFD.  A well-formed beginning of a chunk passes as one.
    """

    def __init__(self):
        self.state = self.bits = 0

    def feed(self, chunk: bytes, final: bool = False) -> str:
        out: list[str] = []
        at = 0
        if not self.state and chunk:
            last = max(chunk.rfind(lead, len(chunk) - 3) for lead in LEADS) if chunk[-1] >= 0x80 else -1
            cut = len(chunk) if last < 0 else last
            if well_formed(chunk[:cut]):
                out.append(chunk[:cut].decode())
                at = cut
        self._walk(chunk[at:] if at else chunk, out)
        if final and self.state:
            out.append("\ufffd")
            self.state = 0
        return "".join(out)

    def _walk(self, chunk: bytes, out: list[str]) -> None:
        """The table's states byte by byte, as far as bytes are not ASCII."""
        at = 0
        for run in HIGH.finditer(chunk):
            if run.start() > at:
                self._plain(chunk[at : run.start()], out)
            state, bits = self.state, self.bits
            for byte in run[0]:
                to = UTF8[state][byte]
                if to == 8 and state:
                    out.append("\ufffd")
                    state, to = 0, UTF8[0][byte]
                if to == 8:
                    out.append("\ufffd")
                    to = 0
                elif not state:
                    bits = byte & FIRST_BITS[to]
                else:
                    bits = bits << 6 | byte & 0x3F
                    if not to:
                        out.append(chr(bits))
                state = to
            self.state, self.bits = state, bits
            at = run.end()
        if at < len(chunk):
            self._plain(chunk[at:], out)

    def _plain(self, ascii_bytes: bytes, out: list[str]) -> None:
        if self.state:
            out.append("\ufffd")
            self.state = 0
        out.append(ascii_bytes.decode("ascii"))


def decode_chunks(ids: np.ndarray, bytes_of: list[bytes], step: int = JOIN_TOKENS) -> Iterator[bytes]:
    """Bytes of the ids, ``step`` tokens at a time."""
    for at in range(0, len(ids), step):
        yield b"".join(map(bytes_of.__getitem__, ids[at : at + step].tolist()))


def decode_text(ids: np.ndarray, bytes_of: list[bytes], step: int = JOIN_TOKENS) -> Iterator[str]:
    stream = Utf8Stream()
    for chunk in decode_chunks(ids, bytes_of, step):
        yield stream.feed(chunk)
    yield stream.feed(b"", final=True)


def encode(docs: DataFrame, ranks_file: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens``, ``token_ids`` (little-endian 32-bit), ``ids_sha256`` and ``decoded_sha256``.

    ``ranks_file`` is a local file of every executor's installation, or is read there from
    the driver's: its lines are broadcast (a vocabulary, of fixed size).  A null text is
    empty: no tokens, the digests of nothing.  Each row is encoded by its own text alone;
    columns of these names are replaced, others stay.
    """
    small_batches(docs.sparkSession)
    with open(ranks_file, "rb") as file:
        lines = file.read()
    known = docs.sparkSession.sparkContext.broadcast(lines)
    names = ["n_tokens", *(["token_ids"] if with_ids else []), "ids_sha256", "decoded_sha256"]
    kept = docs.drop("n_tokens", "token_ids", "ids_sha256", "decoded_sha256")
    place = kept.columns.index("text")
    columns = "n_tokens long, " + ("token_ids binary, " if with_ids else "") + "ids_sha256 string, decoded_sha256 string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Transducer(read_ranks(known.value))
        matches = regex.compile(pattern)
        gc.disable()  # the collector would walk the growing tables again and again; what goes is freed without it
        try:
            for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
                counts, blobs, ids_hash, text_hash = [], [], [], []
                for value in batch.column(place):
                    raw = machine.encoded(value.as_py() or "", matches)
                    decoded = hashlib.sha256()
                    for text in decode_text(np.frombuffer(raw, dtype="<u4"), machine.bytes_of):
                        decoded.update(text.encode())
                    counts.append(len(raw) // 4)
                    ids_hash.append(hashlib.sha256(raw).hexdigest())
                    text_hash.append(decoded.hexdigest())
                    if with_ids:
                        blobs.append(raw)
                made = [pa.array(counts, type=pa.int64()), *([pa.array(blobs, type=pa.binary())] if with_ids else [])]
                made += [pa.array(ids_hash, type=pa.string()), pa.array(text_hash, type=pa.string())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *names])
        finally:
            gc.enable()

    return kept.mapInArrow(lean(work), extended(kept, columns))
