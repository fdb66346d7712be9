"""Benchmark decontamination: windows of benchmark words as a broadcast hash set, found in the windows of documents.

A window is ``width`` consecutive words of an item; an item of fewer words, but not none, is one window. Words are
runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z lower-cased. Tasks hash the windows of
all positions of their documents with array operations, look them up in the set, and *verify* each match by the
SHA-256 of the window's words, so that a collision of 64-bit hashes is no hit.

Documents are not shuffled. What is broadcast is a block of windows of measured size: a set beyond ``block_bytes``
is dealt into several blocks, documents are scanned once for each, and what the scans found is united. A window
costs the same few bytes however long its words are.

Defined results: a null text has no words; a null item id stands as the empty string; rows of one item id are one
item, but no window runs over two rows; repeated documents are scanned each; without items nothing is hit; columns
of any name pass through ``cleaned``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of
from .vector import LOWER, SLICE_BYTES, slices

WIDTH = 10
BLOCK_BYTES = 16 << 20
# Bytes of one window beside its item id: hash, digest, width.
WINDOW_BYTES = 64
FILTER_BITS = 20

IS_WORD = np.zeros(256, bool)
IS_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


@lru_cache(maxsize=4)
def powers(n: int, base: int) -> np.ndarray:
    steps = np.full(n, np.uint64(base))
    steps[:1] = 1
    return np.cumprod(steps)


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number of each word's lower-cased bytes, by prefix sums over at most some bytes at a time."""
    found = np.empty(len(begins), np.uint64)
    inverse = pow(int(BASE), -1, 1 << 64)
    at = 0
    while at < len(begins):
        to = max(at + 1, int(np.searchsorted(ends, begins[at] + SLICE_BYTES, "right")))
        low, high = begins[at], ends[to - 1]
        n = 1 << int(high - low).bit_length()
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((LOWER[data[low:high]].astype(np.uint64) + np.uint64(1)) * powers(n, int(BASE))[: high - low], out=sums[1:])
        first, last = begins[at:to] - low, ends[at:to] - low
        found[at:to] = (sums[last] - sums[first]) * powers(n, inverse)[first]
        at = to
    found ^= found >> np.uint64(32)
    found *= MIX
    return found ^ (found >> np.uint64(29))


class Words:
    """The words of some texts: where each begins and ends, its hash, and the number of the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = IS_WORD[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        self.data = data
        self.begins = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1])[: len(data)]))
        self.ends = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False)[: len(data)])) + 1
        self.hashes = word_hashes(data, self.begins, self.ends)
        self.first = np.searchsorted(self.begins, offsets)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The first words of all windows inside one text, and the windows' hashes."""
        n = len(self.begins) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        total = np.zeros(n, np.uint64)
        for i in range(width):
            total = total * MIX + self.hashes[i : i + n]
        last = np.repeat(self.first[1:], np.diff(self.first))[:n]
        at = np.flatnonzero(np.arange(n) + width <= last)
        return at, total[at]

    def digest(self, word: int, width: int) -> bytes:
        spans = zip(self.begins[word : word + width], self.ends[word : word + width])
        return hashlib.sha256(b" ".join(LOWER[self.data[b:e]].tobytes() for b, e in spans)).digest()


def item_windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """width, hash, digest and item of each window of each item, once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches):
            words = Words(data, offsets)
            counts = np.diff(words.first)
            for k in sorted({min(width, int(n)) for n in counts} - {0}):
                at, hashes = words.windows(k)
                text = np.searchsorted(words.first, at, "right") - 1
                own = (counts[text] == k) if k < width else np.ones(len(at), bool)
                at, hashes, text = at[own], hashes[own], text[own]
                for low in range(0, len(at), 50_000):
                    part = slice(low, low + 50_000)
                    digests = [words.digest(int(w), k) for w in at[part]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(digests), k, np.int32)), pa.array(hashes[part].view(np.int64)),
                            pa.array(digests, pa.binary()), rows.column("item").take(pa.array(text[part])),
                        ],
                        names=["width", "hash", "digest", "item"],
                    )

    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), text_of().alias("text"))
    return named.mapInArrow(run, "width int, hash bigint, digest binary, item string").distinct()


class WindowSet:
    """Windows by width: a bit map that rejects most hashes at once, the sorted hashes, and items by digest."""

    def __init__(self, table: pa.Table):
        widths = table.column("width").to_numpy()
        hashes = table.column("hash").to_numpy().view(np.uint64)
        self.hashes = {int(k): np.unique(hashes[widths == k]) for k in np.unique(widths)}
        self.items: dict[bytes, list[str]] = {}
        for digest, item in zip(table.column("digest").to_pylist(), table.column("item").to_pylist()):
            self.items.setdefault(digest, []).append(item)

    @property
    def filters(self) -> dict[int, np.ndarray]:
        """Made in the worker, so that it is not sent."""
        if not hasattr(self, "_filters"):
            self._filters = {}
            for k, hashes in self.hashes.items():
                self._filters[k] = np.zeros(1 << FILTER_BITS, bool)
                self._filters[k][hashes >> np.uint64(64 - FILTER_BITS)] = True
        return self._filters

    def __getstate__(self):
        return {"hashes": self.hashes, "items": self.items}

    def search(self, words: Words) -> Iterator[tuple[int, int, list[str]]]:
        """First word, width and items of every verified occurrence."""
        for k, known in self.hashes.items():
            at, hashes = words.windows(k)
            likely = self.filters[k][hashes >> np.uint64(64 - FILTER_BITS)]
            at, hashes = at[likely], hashes[likely]
            found = known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes
            for word in at[found].tolist():
                items = self.items.get(words.digest(word, k))
                if items is not None:
                    yield word, k, items


def scan(docs: DataFrame, windows: WindowSet) -> DataFrame:
    """All columns, and ``__n_words``, ``__hits`` (places of the hit words, ascending) and ``__items``."""
    from pyspark.sql import types as T

    schema = T.StructType([*docs.schema, *T._parse_datatype_string("__n_words bigint, __hits array<int>, __items array<string>")])
    held = docs.sparkSession.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches):
            words = Words(data, offsets)
            hits, items = [()] * len(rows), [()] * len(rows)
            places: dict[int, tuple[list[np.ndarray], set[str]]] = {}
            for word, width, found in held.value.search(words):
                text = int(np.searchsorted(words.first, word, "right")) - 1
                where, who = places.setdefault(text, ([], set()))
                where.append(np.arange(word, word + width) - words.first[text])
                who.update(found)
            for text, (where, who) in places.items():
                hits[text], items[text] = np.unique(np.concatenate(where)).tolist(), sorted(who)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(np.diff(words.first), pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                names=[*rows.schema.names, "__n_words", "__hits", "__items"],
            )

    return docs.mapInArrow(run, schema)


def located(docs: DataFrame, items: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of the documents, and what ``scan`` adds, over all blocks of windows."""
    windows = stored(item_windows(items, width), "windows")
    size = windows.agg(F.sum(F.octet_length("item") + WINDOW_BYTES)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("digest", "item"), F.lit(blocks))
    if blocks == 1:
        return scan(docs, WindowSet(windows.toArrow()))
    # Rows of one id and text have the same hits, so they may share what the scans found.
    key = F.struct(F.col("doc_id").alias("d"), F.sha2(text_of(), 256).alias("t"))
    scans = [
        scan(docs.select("doc_id", "text"), WindowSet(windows.filter(block == b).toArrow())).filter(F.size("__hits") > 0).select(key.alias("__key"), "__hits", "__items")
        for b in range(blocks)
    ]
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c)
    found = reduce(DataFrame.union, scans).groupBy("__key").agg(union("__hits"), union("__items"))
    nothing = scan(docs, WindowSet(windows.limit(0).toArrow())).drop("__hits", "__items").withColumn("__key", key)
    return nothing.join(found, nothing["__key"].eqNullSafe(found["__key"]), "left").select(
        *[nothing[c] for c in docs.columns], "__n_words",
        F.coalesce("__hits", F.array().cast("array<int>")).alias("__hits"), F.coalesce("__items", F.array().cast("array<string>")).alias("__items"),
    )


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, ``hits`` (places of hit words) and ``items`` (ids as strings, sorted) of every document."""
    found = located(docs.select("doc_id", "text"), items, width, block_bytes)
    return found.select(
        "doc_id", F.col("__n_words").alias("n_words"), F.size("__hits").cast("bigint").alias("n_hit"), F.col("__hits").alias("hits"), F.col("__items").alias("items")
    )


def cleaned(docs: DataFrame, items: DataFrame, remove: str = "spans", width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, all columns, without what the benchmark has in them.

    ``remove="documents"`` drops every document with a hit. ``remove="spans"`` keeps all documents and cuts each run
    of hit words out of the text, from the first letter of the run to the last; what stands around it stays.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove spans or documents, not {remove}")
    found = located(docs, items, width, block_bytes)
    if remove == "documents":
        return found.filter(F.size("__hits") == 0).select(*docs.columns)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, hits = batch.column("text").to_pylist(), batch.column("__hits").to_pylist()
            for i, places in enumerate(hits):
                if places:
                    texts[i] = without_words(texts[i], np.array(places))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names], names=names)

    return found.select(*names, "__hits").mapInArrow(run, docs.schema)


def without_words(text: str, places: np.ndarray) -> str:
    raw = text.encode()
    words = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    starts = np.flatnonzero(np.append(True, np.diff(places) > 1))
    stops = np.append(starts[1:], len(places)) - 1
    kept, at = [], 0
    for a, b in zip(words.begins[places[starts]], words.ends[places[stops]]):
        kept.append(raw[at:a])
        at = b
    return b"".join([*kept, raw[at:]]).decode()
