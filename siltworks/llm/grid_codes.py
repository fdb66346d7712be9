"""Codes of vectors by a product of small codebooks, assigned through memoised grid cells.

Vectors of integers (``floor(scale * x)``) are cut into parts; each part position has a codebook, fitted by a fixed
number of assign-and-average rounds over *all* vectors. To assign a part, its coarse cell, a box of a power of two a
side, is hashed. For a cell that is met the first time the smallest and the largest distance of each entry to the
box are worked out; an entry whose smallest distance exceeds the largest distance of another is dominated: it is
nearest to no point of the box. The others are cached under the cell, and only they are evaluated exactly. Equal
hashes are checked against the cell's coordinates, and a part of another cell is compared with every entry.

A round is one pass without a shuffle of vectors: tasks send sums by part, entry and component, which Spark adds up.
Integers are exact at any size: where squares could leave 64 bits, Python's integers are used, and sums travel in limbs.

Defined results: vectors that are null, or hold a null or non-finite component (or one that is beyond a double when
scaled, which single-precision input never is), are dropped; no vectors give no rows;
fewer vectors than entries make smaller codebooks; vectors shorter than the longest are filled up with zeros to its
length, rounded up to a whole number of components a part; rows of one id are coded each and come in the order of
their vectors among the first, null ids last; an error beyond a 64-bit integer is given as the greatest one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
# Cells that a worker remembers for each part; beyond that it starts anew with those of the last rows, which changes no result.
CACHED_CELLS = 30_000
# Rows that are worked on at a time.
SLICE_ROWS = 4096
LIMB = 40
LONG_MAX = (1 << 63) - 1

Codebooks = tuple[tuple[tuple[int, ...], ...], ...]


def exact(values: np.ndarray) -> np.ndarray:
    """Whole numbers held as doubles, as 64-bit integers, or as Python's where squares of sums might not fit."""
    if not values.size or np.abs(values).max() < 1 << 26:
        return values.astype(np.int64)
    return np.array([int(x) for x in values.ravel()], object).reshape(values.shape)


class Memo(NamedTuple):
    """Cells by their hash, ascending, and which entries matter in each."""

    keys: np.ndarray
    cells: np.ndarray
    masks: np.ndarray

    def joined(self, other: Memo) -> Memo:
        if not len(other.keys):
            return self
        both = [np.concatenate(x) for x in zip(self, other)]
        order = np.argsort(both[0])
        return Memo(*(x[order] for x in both))


class Grid:
    """The nearest entry of each part, with a memo of the entries that matter in each cell."""

    def __init__(self, codebooks: Codebooks):
        self.codebooks = [np.array(c, object).reshape(len(c), len(c[0]) if c else 0) for c in codebooks]
        self.small = [all(abs(x) < 1 << 26 for e in c for x in e) for c in codebooks]
        self.memo = [Memo(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)) for _ in codebooks]
        self.evaluated = self.parts = 0

    def side(self, part: int) -> int:
        """log2 of a cell's side: one to two mean deviations of the entries' components."""
        entries = self.codebooks[part].astype(np.float64)
        spread = float(np.abs(entries / 64 - (entries / 64).mean(axis=0)).mean() * 64) if entries.size else 0.0
        return int(np.ceil(np.log2(spread))) if spread >= 1 else 0

    def alive(self, part: int, cells: np.ndarray, book: np.ndarray, side: int) -> np.ndarray:
        """For each cell, which entries no other entry dominates across its box."""
        low = cells[:, None, :] * (1 << side)
        high = low + ((1 << side) - 1)
        outside = np.maximum(np.maximum(low - book, book - high), 0)
        farthest = np.maximum(abs(book - low), abs(book - high))
        nearest, most = (outside * outside).sum(axis=2), (farthest * farthest).sum(axis=2)
        return (nearest <= most.min(axis=1)[:, None]).astype(bool)

    def candidates(self, part: int, vectors: np.ndarray, book: np.ndarray) -> np.ndarray:
        side = self.side(part)
        cells = vectors // (1 << side)
        plain = np.array([[int(x) & 0xFFFFFFFFFFFFFFFF for x in c] for c in cells], np.uint64).reshape(cells.shape) if cells.dtype == object else cells.view(np.uint64)
        mixers = np.random.default_rng(11).integers(1, 1 << 63, cells.shape[1], np.uint64) | np.uint64(1)
        hashes = (plain * mixers).sum(axis=1, dtype=np.uint64)
        hashes ^= hashes >> np.uint64(31)
        keys, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        known = self.memo[part]
        at = np.searchsorted(known.keys, keys)
        new = np.append(known.keys, np.uint64(0))[at] != keys if len(known.keys) else np.ones(len(keys), bool)
        if new.any():
            chosen = cells[first[new]]
            known = Memo(keys[new], chosen, self.alive(part, chosen, book, side)).joined(known)
            at = np.searchsorted(known.keys, keys)
            # A slice's own cells are always at hand; beyond the bound only they are remembered.
            self.memo[part] = known if len(known.keys) <= CACHED_CELLS else Memo(known.keys[at], known.cells[at], known.masks[at])
        masks = known.masks[at][place]
        masks[(known.cells[at][place] != cells).any(axis=1)] = True
        return masks

    def nearest(self, part: int, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each vector's part, ties to the lower index, and its squared distance."""
        book = self.codebooks[part]
        if vectors.dtype != object and self.small[part]:
            book = book.astype(np.int64)
        else:
            vectors = vectors.astype(object)
        rows, entries = np.nonzero(self.candidates(part, vectors, book))
        self.parts += len(vectors)
        self.evaluated += len(rows)
        apart = vectors[rows] - book[entries]
        distances = (apart * apart).sum(axis=1) if apart.shape[1] else np.zeros(len(rows), np.int64)
        starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        least = np.minimum.reduceat(distances, starts)
        ties = np.flatnonzero(distances == least[rows])
        _, chosen = np.unique(rows[ties], return_index=True)
        return entries[ties[chosen]], least


@lru_cache(maxsize=1)
def grid(codebooks: Codebooks) -> Grid:
    """One for all tasks of a round in a worker."""
    return Grid(codebooks)


def vectors_of(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of rows, and the integers of each part."""
    for batch in batches:
        for low in range(0, batch.num_rows, SLICE_ROWS):
            rows = batch.slice(low, SLICE_ROWS)
            values = rows.column("v").flatten().to_numpy(zero_copy_only=False)
            whole = exact(values).reshape(rows.num_rows, parts, len(values) // rows.num_rows // parts)
            yield rows, [whole[:, p] for p in range(parts)]


def integers(vectors: DataFrame, parts: int, scale: int) -> DataFrame:
    """vec_id, label and ``v``, the components as whole doubles, of the vectors that are kept; all of one length."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) != float("inf"))
    kept = vectors.select("vec_id", "label", "embedding").filter(F.col("embedding").isNotNull() & F.forall("embedding", finite))
    longest = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    length = -(-longest // parts) * parts
    filled = kept.withColumn("embedding", F.concat(F.col("embedding").cast("array<double>"), F.array_repeat(F.lit(0.0), F.lit(length) - F.size("embedding"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.floor(batch.column("embedding").flatten().to_numpy(zero_copy_only=False) * scale)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * length), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), lists], names=["vec_id", "label", "v"])

    schema = T.StructType([vectors.schema["vec_id"], vectors.schema["label"], T.StructField("v", T.ArrayType(T.DoubleType()))])
    return stored(filled.mapInArrow(run, schema), "vectors")


def first_codebooks(vectors: DataFrame, parts: int, entries: int) -> Codebooks:
    """The parts of the vectors of the smallest ids."""
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    length = len(rows[0]["v"]) // parts if rows else 0
    return tuple(tuple(tuple(int(x) for x in r["v"][p * length : (p + 1) * length]) for r in rows) for p in range(parts))


def averaged(vectors: DataFrame, codebooks: Codebooks) -> Codebooks:
    """Codebooks after one round: the floor of each entry's mean; entries that no part is nearest to stay."""
    parts = len(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = grid(codebooks)
        sums: dict[tuple[int, int, int], int] = {}
        for _, pieces in vectors_of(batches, parts):
            for p, piece in enumerate(pieces):
                entries, _ = cells.nearest(p, piece)
                order = np.argsort(entries, kind="stable")
                at, ordered = entries[order], piece[order]
                starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                counts = np.diff(np.append(starts, len(at)))
                totals = np.add.reduceat(ordered, starts, axis=0)
                for e, n, row in zip(at[starts].tolist(), counts.tolist(), totals.tolist()):
                    for i, x in enumerate([n, *row]):
                        sums[p, e, i - 1] = sums.get((p, e, i - 1), 0) + x
        found = [(*key, j, limb) for key, x in sums.items() for j, limb in enumerate(limbs(x))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[i] for f in found], t) for i, t in enumerate([pa.int32()] * 4 + [pa.int64()])],
            names=["part", "entry", "i", "limb", "x"],
        )

    rows = vectors.select("v").mapInArrow(run, "part int, entry int, i int, limb int, x bigint").groupBy("part", "entry", "i", "limb").agg(F.sum("x").alias("x")).collect()
    sums: dict[tuple[int, int, int], int] = {}
    for r in rows:
        key = r["part"], r["entry"], r["i"]
        sums[key] = sums.get(key, 0) + (r["x"] << (LIMB * r["limb"]))
    return tuple(
        tuple(
            tuple(sums[p, e, i] // sums[p, e, -1] for i in range(len(entry))) if (p, e, -1) in sums else entry
            for e, entry in enumerate(book)
        )
        for p, book in enumerate(codebooks)
    )


def limbs(x: int) -> list[int]:
    """x as digits of 40 bits, all of its sign, so that sums of digits are digits of the sum."""
    sign, x, digits = (-1, -x, []) if x < 0 else (1, x, [])
    while True:
        digits.append(sign * (x & ((1 << LIMB) - 1)))
        x >>= LIMB
        if not x:
            return digits


class Codes(NamedTuple):
    """What compression gives: vec_id, label, code, error of each kept vector; and the codebooks."""

    coded: DataFrame
    codebooks: Codebooks

    def digest(self) -> str:
        text = ",".join(str(x) for book in self.codebooks for entry in book for x in entry)
        return hashlib.sha256(text.encode()).hexdigest()


def coded(vectors: DataFrame, codebooks: Codebooks) -> DataFrame:
    """vec_id, label, ``code`` (two hexadecimal digits a part) and ``error`` (squared distance over all parts)."""
    parts = len(codebooks)
    digits = np.array([f"{i:02x}" for i in range(256)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = grid(codebooks)
        for rows, pieces in vectors_of(batches, parts):
            found = [cells.nearest(p, piece) for p, piece in enumerate(pieces)]
            code = ["".join(c) for c in zip(*(digits[e].tolist() for e, _ in found))]
            errors = [min(sum(e), LONG_MAX) for e in zip(*(d.tolist() for _, d in found))]
            yield pa.RecordBatch.from_arrays(
                [rows.column("vec_id"), rows.column("label"), pa.array(code, pa.string()), pa.array(errors, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    schema = T.StructType([vectors.schema["vec_id"], vectors.schema["label"], *T._parse_datatype_string("code string, error bigint")])
    return vectors.mapInArrow(run, schema)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codes:
    """Codes of all vectors of a table of vec_id, embedding and label."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two digits, so 1 to 256 entries")
    kept = integers(vectors, parts, scale)
    codebooks = first_codebooks(kept, parts, entries)
    if codebooks and codebooks[0]:
        for _ in range(rounds):
            codebooks = averaged(kept, codebooks)
    return Codes(stored(coded(kept, codebooks), "codes"), codebooks)


def label_errors(codes: DataFrame) -> DataFrame:
    """The codes with ``label_error``: errors summed over equal labels, null ones together.

    Sums are formed in every task before the exchange and come back by a join, so a hot label is no hot task.
    """
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("bigint")
    sums = codes.groupBy(F.col("label").alias("__label")).agg(total.alias("label_error"))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("__label"))).drop("__label")


def decoded(codes: Codes, scale: int = SCALE) -> DataFrame:
    """The codes with ``approximate``: the vector that each code stands for, in the units of the input."""
    books = F.array(*[F.array(*[F.array(*[F.lit(float(x) / scale) for x in e]) for e in book]) for book in codes.codebooks])
    index = lambda p: F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int") + 1
    pieces = [F.element_at(F.element_at(books, p + 1), index(p)) for p in range(len(codes.codebooks))]
    return codes.coded.withColumn("approximate", F.concat(*pieces))
