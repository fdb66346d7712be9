"""Texts of Arrow batches as flat byte arrays: words, pieces, and a bounded cache of what pieces stand for.

Everything here works on a slice of one Arrow batch inside a task; Spark partitions and moves the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

# Bytes of text that are worked on at a time; one longer text is a slice of its own.
SLICE_BYTES = 2 << 20
# The same where a byte of text makes many of intermediate arrays: workers share an executor's memory, and keep what they had once.
SMALL_SLICE_BYTES = 1 << 20
# Entries a worker process keeps; the cache starts anew when it is full, which changes no result.
CACHE_ENTRIES = 100_000

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row slices of about ``size`` bytes of text, with the texts' bytes and where each text begins."""
    for batch in batches:
        column = batch.column(text)
        column = (column.fill_null("") if pa.types.is_string(column.type) else column.fill_null(b"")).cast(pa.large_binary())
        if not len(column):
            continue
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        held = column.buffers()[2]
        data = np.frombuffer(held, np.uint8) if held else np.zeros(0, np.uint8)
        row = 0
        while row < len(column):
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
            yield batch.slice(row, end - row), data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
            row = end
            pa.default_memory_pool().release_unused()


def words(data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and the number of the first word of each text (and the total).

    ``cuts`` marks bytes inside words at which a new piece begins.
    """
    n = len(data)
    if not n:
        return pa.array([], pa.binary()), np.zeros(len(offsets), np.int64)
    inside = ~IS_SPACE[data]
    text_begins = np.zeros(n + 1, bool)
    text_begins[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    begins = np.flatnonzero(inside & (~before | text_begins[:n] | (False if cuts is None else cuts)))
    kept = np.cumsum(inside)
    ends = np.append(kept[begins[1:] - 1], kept[-1]) if len(begins) else np.zeros(0, np.int64)
    array = binary(data[inside], np.concatenate([[0], ends]))
    return array, np.searchsorted(begins, offsets)


def binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary array over bytes that its values tile."""
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    )


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of the runs start, start + 1 … of the given lengths, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class PieceCache:
    """Integers that distinct pieces of text stand for, computed once per worker and batch of new pieces.

    Of the caches of one worker process, which serves many tasks, only the one in use keeps entries.
    """

    in_use: PieceCache | None = None

    def __init__(self, encode: Callable[[list[bytes]], Iterable[tuple]], dtype=np.uint32, limit: int = CACHE_ENTRIES):
        self.encode, self.dtype, self.limit, self.known = encode, dtype, limit, {}

    def __call__(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The integers of all pieces in order, and how many each piece has."""
        if PieceCache.in_use is not self:
            if PieceCache.in_use is not None:
                PieceCache.in_use.known.clear()
            PieceCache.in_use = self
        coded = pieces.dictionary_encode()
        # One array of Python bytes; a list made value by value takes many times as long.
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, distinct))
        new = [i for i, v in enumerate(found) if v is None]
        if new:
            values = list(self.encode([distinct[i] for i in new]))
            if len(self.known) + len(new) > self.limit:
                self.known.clear()
            for i, value in zip(new, values, strict=True):
                found[i] = value
                if len(self.known) < self.limit:
                    self.known[distinct[i]] = value
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), self.dtype, int(sizes.sum()))
        codes = coded.indices.to_numpy(zero_copy_only=False)
        lengths = sizes[codes]
        return flat[spread((np.cumsum(sizes) - sizes)[codes], lengths)], lengths


def per_text(lengths: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where each text's integers begin, from the lengths of pieces and the number of each text's first piece."""
    return np.concatenate([[0], np.cumsum(lengths)])[first]
