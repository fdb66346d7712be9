"""Byte-level BPE encoding and decoding with a vocabulary of ranks.

Pre-tokenisation uses no regular expression. Each code point has a class; with a look at its successor it
becomes a symbol, and each symbol is a function on the states of a small automaton. Composing functions
is associative, so the states before all characters come from a blocked scan over function numbers. A
token begins where state and symbol say so. The slices between are looked up by distinct content; only new ones are merged.
"""

from __future__ import annotations

import base64
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .vector import PieceCache, binary, per_text, slices, spread

# Classes of code points. The white space of Unicode.
OTHER, LETTER, NUMBER, WHITE = range(4)
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Symbols: a class, or an apostrophe that can begin a contraction of one or two letters, or white space
# before white space (or the end), a space before something else, other white space before something else.
SYMBOLS = O, L, N, SHORT, LONG, RUN, SPACE, BREAK = range(8)
# States: what the token that is open consists of so far.
STATES = NONE, LETTERS, NUMBERS, OTHERS, WHITES, LEAD, ONE_MORE, TWO_MORE = range(8)

# Bytes of a piece beyond which it is merged by itself.
LONG_PIECE = 256
# Bytes of text that are cut into pieces at a time, and entries of the cache: a worker's memory grows with both.
ENCODED_BYTES = 1 << 19
ENCODED_PIECES = 50_000


def step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a token begins here."""
    if state in (ONE_MORE, TWO_MORE):
        return (ONE_MORE if state == TWO_MORE else NONE), False
    if symbol in (SHORT, LONG) and state not in (OTHERS, LEAD):
        return (ONE_MORE if symbol == SHORT else TWO_MORE), True
    if symbol == RUN:
        return WHITES, state != WHITES
    if symbol == SPACE:
        return LEAD, True
    if symbol == BREAK:
        return NONE, True
    run = {L: LETTERS, N: NUMBERS}.get(symbol, OTHERS)
    return run, state not in (run, LEAD)


@lru_cache(1)
def tables() -> dict[str, np.ndarray]:
    """Classes of all code points, and the automaton as numbered functions closed under composition."""
    kinds = np.zeros(sys.maxunicode + 1, np.uint8)
    for cp in range(sys.maxunicode + 1):
        kinds[cp] = {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(cp))[0], OTHER)
    kinds[WHITE_SPACE] = WHITE
    plain = [tuple(step(s, c)[0] for s in STATES) for c in SYMBOLS]
    # The first character of a text forgets what was before it.
    functions = [*plain, *((f[NONE],) * len(STATES) for f in plain)]
    number = {f: i for i, f in reversed(list(enumerate(functions)))}
    of_symbol = np.array([number[f] for f in functions])
    done = 0
    while done < len(functions):
        for f in functions[: done + 1]:
            for a, b in ((f, functions[done]), (functions[done], f)):
                both = tuple(b[s] for s in a)
                if both not in number:
                    number[both] = len(functions)
                    functions.append(both)
        done += 1
    values = np.array(functions, np.uint8)
    then = np.array([[number[tuple(g[f])] for g in values] for f in values], np.uint16)
    begins = np.array([[step(s, c)[1] for s in STATES] for c in SYMBOLS])
    return {"kinds": kinds, "of_symbol": of_symbol.astype(np.uint16), "values": values, "then": then, "begins": begins}


def scan(numbers: np.ndarray, then: np.ndarray, width: int = 128) -> np.ndarray:
    """Compositions of each function with all before it."""
    n = len(numbers)
    if n <= width:
        out = numbers.copy()
        for i in range(1, n):
            out[i] = then[out[i - 1], out[i]]
        return out
    rows = -(-n // width)
    padded = np.zeros(rows * width, numbers.dtype)
    padded[:n] = numbers
    columns = np.ascontiguousarray(padded.reshape(rows, width).T)
    flat, m = then.ravel(), np.int64(then.shape[1])
    for i in range(1, width):
        columns[i] = flat[columns[i - 1] * m + columns[i]]
    earlier = scan(columns[-1], then, width)[:-1]
    columns[:, 1:] = flat[earlier[None, :] * m + columns[:, 1:]]
    return columns.T.reshape(-1)[:n]


def piece_begins(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For code points of texts that begin at ``first``: which begin a piece."""
    t, n = tables(), len(points)
    kind = t["kinds"][points]
    starts = np.zeros(n + 1, bool)
    starts[first] = True
    starts[n] = True
    after = np.zeros(n + 3, np.uint32)  # the next characters of the same text, else 0
    after[:n] = points
    one = np.where(starts[1:], 0, after[1 : n + 1])
    two = np.where(starts[1:] | np.append(starts[2:], True), 0, after[2 : n + 2])
    symbol = np.array([O, L, N, BREAK], np.uint8)[kind]
    quote = points == ord("'")
    pair = lambda a, b: (one == ord(a)) & (two == ord(b))
    symbol[quote & np.isin(one, [ord(c) for c in "stmd"])] = SHORT
    symbol[quote & (pair("r", "e") | pair("v", "e") | pair("l", "l"))] = LONG
    white = kind == WHITE
    more = np.append(kind[1:] == WHITE, True) | starts[1:]
    symbol[white & (points == 0x20)] = SPACE
    symbol[white & more] = RUN
    numbers = t["of_symbol"][symbol + len(SYMBOLS) * starts[:n]]
    state = t["values"][scan(numbers, t["then"]), NONE]
    before = np.empty(n, np.uint8)
    before[0] = NONE
    before[1:] = np.where(starts[1:n], NONE, state[:-1])
    return t["begins"][symbol, before]


class Vocabulary:
    """Ranks of byte strings, and the pairs of tokens that make a token."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        tokens = [b""] * (max(self.ranks.values()) + 1)
        keys, merged = array("q"), array("q")
        for token, rank in self.ranks.items():
            tokens[rank] = token
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    merged.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.merged = np.array(keys, np.int64)[order], np.array(merged, np.int64)[order]
        self.lengths = np.array([len(x) for x in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def merge(self, pieces: list[bytes]) -> list[tuple]:
        """Token ids of pieces: the pair of lowest rank is merged first, of equal ones the leftmost.

        All pieces go through the rounds together; a round makes one merge in each piece that has one. Pieces
        beyond ``LONG_PIECE`` bytes go one by one through a queue of pairs, so that the work stays n log n.
        """
        out: list = [None] * len(pieces)
        todo = []
        for i, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[i] = (whole,)
            elif len(p) > LONG_PIECE:
                out[i] = self.merge_long(p)
            else:
                todo.append(i)
        if not todo:
            return out
        number = np.array(todo)
        sizes = np.array([len(pieces[i]) for i in todo])
        ids = self.byte[np.frombuffer(b"".join(pieces[i] for i in todo), np.uint8)]
        none = np.int64(1) << 30
        while len(number):
            ends = np.cumsum(sizes)
            key = (ids[:-1] << 32) | ids[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.append(np.where(self.keys[at] == key, self.merged[at], none), none)
            rank[ends - 1] = none
            best = np.minimum.reduceat((rank << 32) | np.arange(len(ids)), ends - sizes)
            ready = (best >> 32) == none
            if ready.any():
                of = np.repeat(ready, sizes)
                values, bounds = ids[of].tolist(), np.cumsum(sizes[ready]).tolist()
                for i, a, b in zip(number[ready].tolist(), [0, *bounds], bounds):
                    out[i] = tuple(values[a:b])
            left = (best & 0xFFFFFFFF)[~ready]
            ids[left] = (best >> 32)[~ready]
            stays = np.repeat(~ready, sizes)
            stays[left + 1] = False
            ids, number, sizes = ids[stays], number[~ready], sizes[~ready] - 1
        return out


    @cached_property
    def pairs(self) -> dict[int, int]:
        """The pairs as a dictionary; made by workers that meet a long piece."""
        return dict(zip(self.keys.tolist(), self.merged.tolist()))

    def merge_long(self, piece: bytes) -> tuple:
        """The same for one piece, by a heap of pairs and links between neighbours.

        A pair in the heap counts only while its place still begins a pair of that rank.
        """
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        n, pairs = len(ids), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = [pairs.get(a << 32 | b, -1) for a, b in zip(ids, ids[1:])] + [-1]
        heap = [r << 32 | i for i, r in enumerate(rank) if r >= 0]
        heapify(heap)
        while heap:
            top = heappop(heap)
            i, r = top & 0xFFFFFFFF, top >> 32
            if rank[i] != r:
                continue
            gone = after[i]
            ids[i], rank[gone], ids[gone] = r, -1, -1
            after[i] = right = after[gone]
            rank[i] = -1
            if right < n:
                before[right] = i
                rank[i] = pairs.get(r << 32 | ids[right], -1)
                if rank[i] >= 0:
                    heappush(heap, rank[i] << 32 | i)
            left = before[i]
            if left >= 0:
                rank[left] = pairs.get(ids[left] << 32 | r, -1)
                if rank[left] >= 0:
                    heappush(heap, rank[left] << 32 | left)
        return tuple(x for x in ids if x >= 0)


@lru_cache(4)
def vocabulary(path: str) -> tuple[Vocabulary, PieceCache]:
    v = Vocabulary(path)
    return v, PieceCache(v.merge, limit=ENCODED_PIECES)


def encode_texts(data: np.ndarray, offsets: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts, where each text's ids begin, and the byte of its text at which each piece's ids begin."""
    _, cache = vocabulary(path)
    if not len(data):
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(at, offsets[:-1])
    begins = at[piece_begins(points, first[offsets[:-1] < len(data)])]
    ids, lengths = cache(binary(data, np.append(begins, len(data))))
    return ids, per_text(lengths, np.searchsorted(begins, offsets)), np.repeat(begins, lengths)


def decode_ids(data: np.ndarray, starts: np.ndarray, path: str) -> pa.Array:
    """The bytes that runs of ids stand for; ``starts`` are the places of the runs in bytes."""
    v, _ = vocabulary(path)
    ids = np.ascontiguousarray(data).view(np.uint32)
    lengths = v.lengths[ids]
    bounds = np.concatenate([[0], np.cumsum(lengths)])[starts // 4]
    return binary(v.bytes[spread(v.starts[ids], lengths)], bounds)


def encode(docs: DataFrame, path: str, offsets: bool = False, decoded: bool = False) -> DataFrame:
    """doc_id, ``ids`` (little-endian unsigned 32-bit integers) and n_tokens of every whole text.

    With ``offsets`` also ``begins``: for each id, the byte of the text (32-bit) at which its piece begins, so
    that a run of ids can be traced to its place. With ``decoded`` also the bytes that the ids stand for, decoded in the same task. Null text counts as empty and gives no ids, an empty table gives none, repeated
    rows are encoded each, columns other than doc_id and text are dropped. ``path`` must exist on every executor.
    """
    schema = "doc_id bigint, ids binary, n_tokens bigint" + (", begins binary" if offsets else "") + (", decoded binary" if decoded else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, starts in slices(batches, size=ENCODED_BYTES):
            ids, bounds, begins = encode_texts(data, starts, path)
            columns = [rows.column("doc_id"), binary(ids.view(np.uint8), bounds * 4), pa.array(np.diff(bounds), pa.int64())]
            if offsets:
                local = begins - np.repeat(starts[:-1], np.diff(bounds))
                columns.append(binary(local.astype(np.uint32).view(np.uint8), bounds * 4))
            if decoded:
                columns.append(decode_ids(ids.view(np.uint8), bounds * 4, path))
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

    return docs.select("doc_id", "text").withColumn("doc_id", docs["doc_id"].cast("bigint")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All columns and ``decoded``: the bytes that the ids stand for."""
    from pyspark.sql import types as T

    schema = T.StructType([*(f for f in encoded.schema if f.name != "decoded"), T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, starts in slices(batches, "ids"):
            decoded = decode_ids(data.copy(), starts, path)
            names = [n for n in rows.schema.names if n != "decoded"]
            yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in names), decoded], names=[*names, "decoded"])

    return encoded.mapInArrow(run, schema)
