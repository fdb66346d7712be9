"""Similarity join of word shingles by universe partition and the pigeonhole principle.

Sets of sizes r and s whose Jaccard similarity is at least t differ in at most H = (r + s)(1 - t)/(1 + t)
shingles. So the universe of shingles is hashed into segments, by bands of size: partners are in one band or two
neighbouring ones, and a set is indexed for its own band and the one below. Of H + 1 segments one at least is
the same in both; that segment's content is a signature they share.

Some contents cost much: nothing, or only shingles that very many documents hold. A set leaves such segments out,
and makes up for it by one-deletion neighbourhoods: a segment whose content is indexed together with
all contents that lack one shingle counts twice, as it finds partners that differ there in up to one shingle.
Which segments are left out follows from their contents, and those that count twice are taken in the order of
segments: so what the set with fewer of them relies on, its partner has indexed as well. Sets that cannot
make up for it index everything. Shingles are counted over all documents to tell which are common; that decides about cost alone.

Texts are cut into shingles once; distinct sets are stored and read from there. Candidates are verified on whole sets, and
equal sets are one node throughout. Of any signature all sets are compared to the first one. What verified links leave
apart in a signature is compared pair by pair, or in blocks where the signature has very many sets. Links join
only what is in one component, so they are counted by comparing the sets of each component, in blocks, leaving out pairs that were counted before.
Shingles are 64-bit hashes of their words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_folder
from ..sinks import files
from .common import row_key, stored, text_of, without
from .components import components
from .vector import LOWER, SMALL_SLICE_BYTES, PieceCache, slices, words

# The share of documents that is very many. At most mean set size / share shingles have it, which bounds what is sent to all tasks.
COMMON_SHARE = 0.001
LEAST_COMMON = 10
# Slots that shingles are counted in, at most, and those that travel together.
MOST_SLOTS, BLOCK_SLOTS = 1 << 23, 1 << 14
# Signatures of more sets than this are not paired one by one: their sets are compared in blocks, each pair of
# blocks in one task, of so many shingles and sets at most on average.
MANY = 64
BLOCK_SHINGLES, BLOCK_SETS = 200_000, 1_000
# Sets that one task remembers, so that copies in it send their set and its signatures once.
REMEMBERED = 200_000
# Bits, at most, of the bitmap that says which stored sets can be among those that are moved, and bits for each of them.
MOST_BITS, BITS_EACH = 1 << 27, 16
# Shingles whose signatures are made at a time.
SLICE_SHINGLES = 400_000

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scattering of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


@lru_cache(1)
def word_numbers() -> PieceCache:
    import xxhash

    return PieceCache(lambda pieces: [(xxhash.xxh64_intdigest(p),) for p in pieces], np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text: of ``width`` words, or of all words if there are fewer."""
    pieces, first = words(LOWER[data], offsets)
    numbers, _ = word_numbers()(pieces)
    n = len(numbers)
    grams = np.zeros(n, np.uint64)
    for k in range(width):
        grams[: max(n - k, 0)] = grams[: max(n - k, 0)] * _ODD[0] + numbers[k:] + np.uint64(k + 1)
    grams = mix(grams)
    found = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            found.append(np.unique(grams[a : b - width + 1]))
        elif b > a:
            short = np.uint64(b - a)
            for x in numbers[a:b]:
                short = np.uint64((int(short) * int(_ODD[0]) + int(x)) & (2**64 - 1))
            found.append(mix(np.array([short], np.uint64) ^ _ODD[1]))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def set_number(shingles: np.ndarray) -> int:
    """A 64-bit number of a set: a sum over its members, so their order does not matter."""
    total = int(mix(shingles + _ODD[0]).sum(dtype=np.uint64)) + int(_ODD[1]) * len(shingles)
    return int(mix(np.array([total & (2**64 - 1)], np.uint64))[0].view(np.int64))


@lru_cache(8)
def bands(percent: int, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """The least size of each band, and its number of segments."""
    least, segments = [1], []
    while least[-1] <= largest:
        after = 100 * least[-1] // percent + 1
        r = after - 1
        s = 100 * r // percent
        segments.append((r + s) * (100 - percent) // (100 + percent) + 1)
        least.append(after)
    return np.array(least[:-1], np.int64), np.array(segments, np.int64)


def signatures(sets: list[np.ndarray], percent: int, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of the sets, and for each the position of its set."""
    sizes = np.array([len(s) for s in sets], np.int64)
    if not sizes.sum():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    shingles, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    rare = np.ones(len(shingles), bool)
    if len(common):
        rare = common[np.minimum(np.searchsorted(common, shingles), len(common) - 1)] != shingles
    weight = mix(shingles + _ODD[2])
    least, counts = bands(percent, 1 << int(sizes.max()).bit_length())
    own = np.searchsorted(least, sizes, "right") - 1
    out, of = [], []
    for below in (0, 1):
        band = own - below
        use = (sizes > 0) & (band >= 0)
        m = np.where(use, counts[np.maximum(band, 0)], 0)
        base = np.cumsum(m) - m
        total = int(m.sum())
        if not total:
            continue
        member = use[owner]
        x, who, uncommon, w = shingles[member], owner[member], rare[member], weight[member]
        salt = mix(band[who].astype(np.uint64) + _ODD[0])
        segment = base[who] + ((mix(x ^ salt) >> np.uint64(33)).astype(np.int64) % m[who])
        content = np.zeros(total, np.uint64)
        np.add.at(content, segment, w)
        held = np.bincount(segment, uncommon, total).astype(np.int64)
        holder = np.repeat(np.arange(len(sets)), m)
        place = np.arange(total) - base[holder]
        left_out = held == 0
        missing = np.bincount(holder, left_out, len(sets)).astype(np.int64)
        # The shortest run of first segments in which as many can count twice as are left out.
        twice = np.cumsum(held >= 2)
        twice = twice - np.where(base > 0, twice[np.maximum(base - 1, 0)], 0)[holder]
        enough = np.where(twice >= missing[holder], place + 1, np.int64(1) << 40)
        run = np.zeros(len(sets), np.int64)
        run[use] = np.minimum.reduceat(enough, base[use])
        run[missing == 0] = 0
        everything = run >= np.int64(1) << 40
        run = np.where(everything, m, run)
        name = mix(place.astype(np.uint64) * _ODD[0] + salted(band)[holder])
        index = everything[holder]
        chosen = ~left_out | index
        out.append(mix(content[chosen] + name[chosen]))
        of.append(holder[chosen])
        deep = place < run[holder]
        again = mix(name + _ODD[1])
        chosen = deep & (~left_out | index)
        out.append(mix(content[chosen] + again[chosen]))
        of.append(holder[chosen])
        lacking = deep[segment] & ((held[segment] - uncommon > 0) | index[segment])
        out.append(mix(content[segment[lacking]] - w[lacking] + again[segment[lacking]]))
        of.append(who[lacking])
    return np.concatenate(out), np.concatenate(of)


def salted(band: np.ndarray) -> np.ndarray:
    return mix(band.astype(np.uint64) * _ODD[2] + _ODD[1])


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, a number of (doc_id, text), and the text, empty where null."""
    return docs.select("doc_id", row_key().alias("key"), text_of().alias("text"))


class Fresh:
    """Tells the set numbers that a task has not met yet; it forgets all when it has met ``REMEMBERED``."""

    def __init__(self) -> None:
        self.met: set[int] = set()

    def __call__(self, number: int) -> bool:
        if number in self.met:
            return False
        if len(self.met) >= REMEMBERED:
            self.met.clear()
        self.met.add(number)
        return True


def shingled(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, key, n_shingles, the number of each document's set, and where a task meets a set first, its shingles.

    ``row`` numbers the rows; it is to be stored before use.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh = Fresh()
        for rows, data, offsets in slices(batches, size=SMALL_SLICE_BYTES):
            sets = shingle_sets(data, offsets, width)
            numbers = list(map(set_number, sets))
            held = [s.view(np.int64) if len(s) and fresh(x) else None for s, x in zip(sets, numbers, strict=True)]
            columns = [rows.column("doc_id"), rows.column("key"), pa.array(map(len, sets), pa.int64()), pa.array(numbers, pa.int64())]
            columns.append(pa.array(held, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "n_shingles", "set", "shingles"])

    made = keyed(docs).mapInArrow(run, "doc_id bigint, key bigint, n_shingles bigint, set bigint, shingles array<bigint>")
    return made.select("*", F.col("shingles").isNotNull().alias("held"), F.monotonically_increasing_id().alias("row"))


def set_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Numbers and shingles of rows (set, shingles), about ``SLICE_SHINGLES`` at a time, each set once as far as remembered."""
    fresh = Fresh()
    for batch in batches:
        lists = batch.column("shingles")
        values, offsets = lists.values.to_numpy(zero_copy_only=False).view(np.uint64), lists.offsets.to_numpy()
        numbers, sets, held = [], [], 0
        for x, a, b in zip(batch.column("set").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if not fresh(x):
                continue
            numbers.append(x)
            sets.append(values[a:b])
            held += b - a
            if held >= SLICE_SHINGLES:
                yield numbers, sets
                numbers, sets, held = [], [], 0
        if sets:
            yield numbers, sets


def common_shingles(mine: DataFrame, n_docs: int) -> np.ndarray:
    """Sorted shingles that at least ``COMMON_SHARE`` of all documents hold.

    All rows are counted, in two passes. The first one adds up how many shingles fall into each of a number of slots that does
    not grow with the table; one that is common lies in a slot that holds as many. The second one counts the shingles of such
    slots by themselves. Of copies in one task one is counted: signatures are sent once for each set, too.
    """
    least = max(LEAST_COMMON, int(COMMON_SHARE * n_docs))
    held = mine.filter("held")
    total = held.agg(F.sum("n_shingles")).first()[0] or 0
    if total < least:
        return np.zeros(0, np.uint64)
    slots = max(BLOCK_SLOTS, min(MOST_SLOTS, 1 << (4 * total // least).bit_length()))

    def in_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(slots, np.uint32)
        for batch in batches:
            np.add.at(counts, slot_of(shingles_of(batch), slots), 1)
        for i, block in enumerate(counts.reshape(-1, BLOCK_SLOTS)):
            if block.any():
                packed = zlib.compress(block.astype(np.min_scalar_type(block.max())).tobytes(), 1)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([packed])], names=["block", "counts"])

    def full_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, packed in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                data = zlib.decompress(packed)
                found = np.frombuffer(data, f"u{len(data) // BLOCK_SLOTS}")
                sums[i] = sums[i] + found if i in sums else found.astype(np.int64)
        for i, counts in sums.items():
            bits = np.packbits(counts >= least).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([bits])], names=["block", "bits"])

    sent = held.select("shingles").mapInArrow(in_slots, "block int, counts binary")
    told = sent.repartition("block").mapInArrow(full_slots, "block int, bits binary").toArrow()  # at most MOST_SLOTS bits
    full = np.zeros((slots // BLOCK_SLOTS, BLOCK_SLOTS // 8), np.uint8)
    for i, bits in zip(told.column("block").to_pylist(), told.column("bits").to_pylist(), strict=True):
        full[i] = np.frombuffer(bits, np.uint8)
    table = mine.sparkSession.sparkContext.broadcast(full.reshape(-1))

    def by_themselves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = shingles_of(batch)
            at = slot_of(values, slots)
            values, n = np.unique(values[(table.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], names=["s", "n"])

    counted = held.select("shingles").mapInArrow(by_themselves, "s bigint, n bigint").groupBy("s").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return np.sort(np.array([r["s"] for r in counted.select("s").toLocalIterator()], np.int64).view(np.uint64))


def shingles_of(batch: pa.RecordBatch) -> np.ndarray:
    """The shingles of all rows of (shingles)."""
    return batch.column("shingles").flatten().to_numpy(zero_copy_only=False).view(np.uint64)


def slot_of(shingles: np.ndarray, slots: int) -> np.ndarray:
    return (shingles & np.uint64(slots - 1)).astype(np.int64)


def shared_signatures(sets: DataFrame, percent: int, common: np.ndarray) -> DataFrame:
    """(sig, set, n, first, first_n) of all signatures that several sets have; ``first`` is the least of them, n are sizes.

    Signatures are partitioned and sorted by Spark, and runs of one are read as a stream: a signature with
    very many sets needs no memory for them.
    """
    table = sets.sparkSession.sparkContext.broadcast(common)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for numbers, held in set_slices(batches):
            names, sizes = np.array(numbers, np.int64), np.array([len(s) for s in held], np.int32)
            sig, of = signatures(held, percent, table.value)
            for a in range(0, len(sig), 1 << 18):
                part = of[a : a + (1 << 18)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig[a : a + (1 << 18)].view(np.int64)), pa.array(names[part]), pa.array(sizes[part])], names=["sig", "set", "n"]
                )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row: sig, set, n, and of its run the first set, whether it was sent, and its n
        for batch in batches:
            sig, name, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("sig", "set", "n"))
            if not len(sig):
                continue
            if held:
                sig, name, n = np.append(held[0], sig), np.append(held[1], name), np.append(held[2], n)
            begins = np.append(True, sig[1:] != sig[:-1])
            start = np.maximum.accumulate(np.where(begins, np.arange(len(sig)), 0))
            first = name[start]
            if held:
                first[start == 0] = held[3]
            repeat = np.append(False, (sig[1:] == sig[:-1]) & (name[1:] == name[:-1]))
            other = name != first
            # A member that is not the run's first is sent; the first one is sent with the first such member.
            send = other & ~repeat
            if held:
                send[0] = False
            before = np.append(False, other[:-1] & (sig[1:] == sig[:-1]))
            leads = send & ~before
            if held and held[4]:
                leads &= start != 0
            at, lead = np.flatnonzero(send), np.flatnonzero(leads)
            first_size = n[start]
            if held:
                first_size = np.where(start == 0, held[5], first_size)
            lead_n = first_size[lead]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([sig[lead], sig[at]])), pa.array(np.concatenate([first[lead], name[at]])),
                 pa.array(np.concatenate([lead_n, n[at]]).astype(np.int32)), pa.array(np.concatenate([first[lead], first[at]])),
                 pa.array(np.concatenate([lead_n, first_size[at]]).astype(np.int32))],
                names=["sig", "set", "n", "first", "first_n"],
            )
            begin = start[-1]
            sent = bool(send[begin:].any()) or bool(held and held[4] and begin == 0)
            held = (sig[-1], name[-1], n[-1], first[-1], sent, first_size[-1])

    rows = sets.mapInArrow(emit, "sig bigint, set bigint, n int")
    return rows.repartition(F.col("sig")).sortWithinPartitions("sig", "set").mapInArrow(runs, "sig bigint, set bigint, n int, first bigint, first_n int")


def set_rows(spread: DataFrame, chosen: DataFrame, n: int) -> DataFrame:
    """(set, shingles) of the ``n`` rows of stored sets that ``chosen`` (row) names.

    A bitmap of their hashed numbers, of bounded size, goes to all tasks first, so that hardly any other set is
    moved to meet them; with more rows than it can tell apart it holds back less, and the join decides as before.
    """
    bits = min(MOST_BITS, 1 << max(n * BITS_EACH, 64).bit_length())

    def place(batch: pa.RecordBatch) -> np.ndarray:
        rows = batch.column("row").to_numpy(zero_copy_only=False).view(np.uint64)
        return (mix(rows + _ODD[0]) & np.uint64(bits - 1)).astype(np.int64)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = place(batch)
            value = (np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(value)], names=["word", "value"])

    words = chosen.select("row").mapInArrow(mark, "word bigint, value bigint").groupBy("word").agg(F.bit_or("value").alias("value"))
    told = words.toArrow()  # at most MOST_BITS / 64 rows
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[told.column("word").to_numpy()] = told.column("value").to_numpy()
    table = spread.sparkSession.sparkContext.broadcast(bitmap.view(np.uint64))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = place(batch)
            hit = (table.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            yield batch.filter(pa.array(hit.astype(bool)))

    rows = spread.filter("held").select("row", "set", "shingles")
    found = rows.mapInArrow(probe, "row bigint, set bigint, shingles array<bigint>")
    return found.join(chosen.select("row"), "row", "left_semi").select("set", "shingles")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    left, right = sets.select(F.col("set").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("set").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    alike = 100 * both >= percent * (F.size("x") + F.size("y") - both)
    return pairs.join(left, "a").join(right, "b").filter(alike).select("a", "b")


def alike_in_block(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which sets are similar enough, comparing left ones to right ones, as a symmetric matrix.

    Intersections of all pairs come from products of 0/1 matrices, some thousand shingles at a time; shingles
    of one set alone are left out.
    """
    g, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    values, owner = np.concatenate(sets), np.repeat(np.arange(g), sizes)
    _, column, uses = np.unique(values, return_inverse=True, return_counts=True)
    number = np.cumsum(uses > 1) - 1
    owner, column = owner[uses[column] > 1], number[column[uses[column] > 1]]
    by = np.argsort(column, kind="stable")
    owner, column = owner[by], column[by]
    both = np.zeros((g, g), np.float32)
    width = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [low, low + width])
        held = np.zeros((g, width), np.float32)
        held[owner[a:b], column[a:b] - low] = 1
        both += held @ held.T
    union = sizes[:, None] + sizes[None, :] - both
    alike = (100 * both >= percent * union) & (left[:, None] & right[None, :] | right[:, None] & left[None, :])
    np.fill_diagonal(alike, False)
    return alike


def least_linked(alike: np.ndarray) -> np.ndarray:
    """For each position the least one that links lead to, itself included."""
    label = np.arange(len(alike))
    while True:
        moved = np.minimum(label, np.where(alike, label[None, :], len(alike)).min(1))
        moved = moved[moved]
        if (moved == label).all():
            return label
        label = moved


def similar_in_block(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """For each set the least position that links within the block lead to, comparing left ones to right ones."""
    return least_linked(alike_in_block(sets, left, right, percent))


def families(rows: DataFrame) -> DataFrame:
    """(set, family): sets (sig, set, first) that signatures connect, whether they are similar or not."""
    # A set is joined to the least first set of its signatures, and the other first ones to that: hardly more edges than sets.
    low = F.min("first").over(Window.partitionBy("set"))
    linked = rows.select("set", "first", low.alias("low"))
    ends = (linked.select(F.col("low").alias("a"), F.col(c).alias("b")).distinct() for c in ("set", "first"))
    edges = next(ends).union(next(ends)).filter("a != b")
    return components(edges).withColumnRenamed("node", "set").withColumnRenamed("component", "family")


def within(member: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, links) of members (set, n, copies, family, part, inside) that link in their family.

    ``links`` counts the documents of sets that b is similar to, a is b or one that links lead to. Rows of one b
    come from several tasks and add up. Pairs of equal ``part`` are left out, and so are whole blocks of two
    sets ``inside``; of a family, these must have one part. It is cut into blocks of bounded size, and each
    pair of blocks is compared in one task, once, however many signatures its sets share.
    """
    of = lambda inside: F.coalesce(
        F.greatest(
            F.ceil(F.sum(F.when(F.col("inside") == inside, F.col("n"))) / BLOCK_SHINGLES),
            F.ceil(F.count(F.when(F.col("inside") == inside, 1)) / BLOCK_SETS),
        ),
        F.lit(0),
    ).cast("int")
    sized = member.join(member.groupBy("family").agg(of(False).alias("outer"), of(True).alias("inner")), "family")
    number = lambda blocks: F.pmod(F.xxhash64("set"), F.greatest(blocks, F.lit(1))).cast("int")
    block = F.when(F.col("inside"), F.col("outer") + number("inner")).otherwise(number("outer"))
    others = F.col("outer") + F.when(F.col("inside"), F.lit(0)).otherwise(F.col("inner"))
    placed = sized.join(sets, "set").withColumn("block", block).filter(others > 0)
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
    pairs = placed.select(
        "family", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "block", "set", "copies", "part", "shingles"
    )

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        left, right = key[1].as_py(), key[2].as_py()
        names, block, copies = (table.column(c).to_numpy() for c in ("set", "block", "copies"))
        held = [np.asarray(x.values).view(np.uint64) for x in table.column("shingles")]
        alike = alike_in_block(held, block == left, block == right, percent)
        parts = table.column("part")
        part, known = parts.fill_null(0).to_numpy(), parts.is_valid().to_numpy(zero_copy_only=False)
        alike &= ~((part[:, None] == part[None, :]) & known[:, None] & known[None, :])
        links = np.where(alike, copies[None, :], 0).sum(1)
        linked, label = np.flatnonzero(links), least_linked(alike)
        return pa.table({"a": names[label[linked]], "b": names[linked], "links": links[linked]})

    return pairs.groupBy("family", "left", "right").applyInArrow(compare, "a bigint, b bigint, links bigint")


def fits(n: str, other: str, percent: int) -> Column:
    """Sizes that allow the similarity."""
    return 100 * F.least(n, other) >= percent * F.greatest(n, other)


def links_of(labels: DataFrame, sizes: DataFrame, family: DataFrame, known: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(set, linked): documents of *other* sets that the documents of a set link with.

    Pairs of one family are in ``known`` already. Of two sets alone in a component each has the other's documents.
    Elsewhere the sets of a component are compared, but for pairs of one family; of the family that most are in, blocks are not even paired.
    """
    member = labels.withColumnRenamed("node", "set").join(sizes, "set").join(family, "set", "left")
    parts = member.groupBy("component", "family").agg(F.count(F.lit(1)).alias("n_sets"), F.sum("copies").alias("docs"))
    most = F.max(F.when(F.col("family").isNotNull(), F.struct("n_sets", "family")))
    whole = parts.groupBy("component").agg(F.sum("n_sets").alias("n_sets"), F.sum("docs").alias("docs"), most.alias("most"))
    member = stored(member.join(whole.filter("most IS NULL OR most.n_sets < n_sets"), "component"), "unlinked")
    two = member.filter("n_sets = 2").select("set", (F.col("docs") - F.col("copies")).alias("links"))
    rest = member.filter("n_sets > 2").select(
        "set", "n", "copies", F.col("component").alias("family"), F.col("family").alias("part"),
        F.coalesce(F.col("family") == F.col("most.family"), F.lit(False)).alias("inside"),
    )
    more = within(rest, sets, percent).select(F.col("b").alias("set"), "links")
    return known.select(F.col("b").alias("set"), "links").union(two).union(more).groupBy("set").agg(F.sum("links").alias("linked"))


def similar_documents(docs: DataFrame, width: int = 5, percent: int = 80, count_links: bool = True) -> DataFrame:
    """One row per document: doc_id, its row key, n_shingles, component_id, ``component``, a number without nulls, and n_links.

    Documents link when their sets of distinct ``width``-word shingles (ASCII lower-cased) have 100 * intersection >= percent *
    union; component_id is the least doc_id that links reach, itself included, n_links the number of other rows that a
    row links with (left out without ``count_links``). With fewer words the whole
    sequence is one shingle. Null texts and texts without words have an empty set and link with nothing. Equal sets
    link, so repeated rows do; null doc_ids have no part in the least (a component of null ids only has a null id). Columns
    besides doc_id and text are ignored, an empty table gives an empty result. No pair is dropped: copies are
    counted as often as they are there.
    """
    spark, all_sets = docs.sparkSession, work_folder(docs.sparkSession, "sets")
    made = shingled(docs, width)
    made.write.parquet(all_sets)
    spread = spark.read.schema(made.schema).parquet(all_sets)
    mine = stored(spread.drop("shingles"), "rows")
    common = common_shingles(spread, mine.count())
    distinct = spread.filter("held").select("set", "shingles")
    shared = stored(shared_signatures(distinct, percent, common), "shared")
    wanted = shared.select("set").distinct()
    # Tasks that met the same set have each stored it; only one row of each candidate is moved.
    chosen = stored(mine.filter("held").join(wanted, "set", "left_semi").groupBy("set").agg(F.min("row").alias("row")), "chosen")
    sets = stored(set_rows(spread, chosen, chosen.count()), "full")
    files.delete(spark, all_sets)  # the largest table here; only candidates are looked at from now on
    sizes = stored(mine.filter("n_shingles > 0").groupBy("set").agg(F.max("n_shingles").alias("n"), F.count(F.lit(1)).alias("copies")), "sizes")
    # Each set is compared to the first one of its signatures.
    star = shared.filter("set != first").filter(fits("n", "first_n", percent))
    tested = stored(star.select(F.col("first").alias("a"), F.col("set").alias("b")).distinct(), "pairs")
    links = stored(verified(tested, sets, percent), "links")
    labels = components(links)
    # What is still apart in one signature, and has not been compared, is compared now.
    labelled = shared.select("sig", "set", "n", "first").join(labels.withColumnRenamed("node", "set"), "set", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "set"))
    apart = labelled.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("k"))
    rest = stored(labelled.join(apart.filter("k > 2 AND low < high").select("sig", "k"), "sig"), "apart")
    # Where very many sets share such a signature, whole families are compared, block by block.
    family = stored(families(rest.filter(F.col("k") > MANY)), "families")
    within_family = family.join(sizes, "set").withColumns({"part": F.lit(None).cast("bigint"), "inside": F.lit(False)})
    known = stored(within(within_family, sets, percent), "links")
    few = rest.filter(F.col("k") <= MANY).join(family, "set", "left")
    elsewhere = ~F.coalesce(F.col("fa") == F.col("fb"), F.lit(False))
    one, two = (few.select("sig", *[F.col(c).alias(c[0] + x) for c in ("set", "n", "component", "family")]) for x in "ab")
    unlike = fits("na", "nb", percent) & elsewhere & (F.col("sa") < F.col("sb")) & (F.col("ca") != F.col("cb"))
    more = one.join(two, "sig").filter(unlike).select(F.col("sa").alias("a"), F.col("sb").alias("b")).distinct()
    more = stored(more.join(tested, ["a", "b"], "left_anti"), "pairs")
    later = stored(verified(more, sets, percent).union(known.filter("a != b").select("a", "b")), "links")
    if later.head(1):
        labels = components(links.union(later))
    named = sizes.select("set", "copies").join(labels.withColumnRenamed("node", "set"), "set", "left")
    if count_links:
        named = named.join(links_of(labels, sizes, family, known, sets, percent), "set", "left")
    member = mine.join(named, "set", "left").withColumn("component", F.coalesce("component", "set"))
    member = stored(member, "members")
    least = member.filter("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    own = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
    result = member.join(least, "component", "left").withColumn("component_id", own)
    columns = ["doc_id", "key", "n_shingles", "component_id", "component"]
    if count_links:
        result = result.withColumn("n_links", F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("linked", F.lit(0)))
        columns.append("n_links")
    return result.select(*columns)


def without_similar(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, all columns: that with the least doc_id, null ids last.

    Documents without words are in no component and stay; of rows that repeat doc_id and text one stays.
    """
    found = stored(similar_documents(docs, width, percent, count_links=False), "similar")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    first = found.filter("n_shingles > 0").groupBy("component").agg(F.min(place).alias("first"))
    kept = (F.col("n_shingles") == 0) | (F.col("key") == F.col("first.key"))
    return without(docs, found.join(first, "component", "left").select("key", kept.alias("kept")))
