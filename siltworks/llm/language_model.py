"""Scores of texts by an n-gram model with deleted interpolation.

The probability of a word is a mixture of its maximum-likelihood estimates after contexts of every length and
of a uniform part. Weights depend on how often the longest known context was seen: each bucket of context
frequency has its own, learnt by expectation-maximisation on counts of *deleted* training documents, with
estimates from the remaining ones. Final estimates use all training documents.

Counts go through Spark in packed form. Documents are dealt to blocks; a block's distinct n-grams, as sorted
hashes, are split by hash range, so that each range meets in one task, is summed up there, and every
block gets back counts in the order in which it sent hashes. So an n-gram moves once per block that
has it, in about five bytes, however frequent it is. Hashes of words have 64 bits, those of longer n-grams 56.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .common import stored, text_of
from .vector import LOWER, PieceCache, slices, words

ORDER = 2
FOLDS, HELD_OUT, DELETED = 7, 2, 3  # crc32 of doc_id modulo FOLDS: never learnt from; set apart to learn weights
PART_BYTES = 8 << 20  # text that is counted or scored at a time; a longer text is a part of its own
ROUNDS = 60
LEVELS = 48  # powers of two of a context's frequency
STEP, NOTHING = 4, 255  # probabilities are counted in quarters of their binary logarithm; no probability
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
BEGIN, END = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)
ROW = "block int, kind int, doc_id bigint, fold int, text string, key bigint, part int, piece int, counts binary"


def bits_of(order: int) -> int:
    return 64 if order == 1 else 56


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


@lru_cache(1)
def word_numbers() -> PieceCache:
    import xxhash

    return PieceCache(lambda pieces: [(xxhash.xxh64_intdigest(p),) for p in pieces], np.uint64)


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed planes of bytes: high bytes, mostly zero, take no room."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data, n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(dtype).ravel()


def starts_of(pieces: int, bits: int) -> np.ndarray:
    """The first hash of each of equal ranges."""
    return np.array([-(-(p << 32) // pieces) << (bits - 32) for p in range(pieces)], np.uint64)


@dataclass
class Part:
    """Some documents of a block: their tokens with a beginning and an end, and their n-grams."""

    block: int
    number: int
    doc_ids: list
    folds: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    first: np.ndarray = field(init=False)  # of each document's tokens, the beginning included
    position: np.ndarray = field(init=False)
    document: np.ndarray = field(init=False)

    def __post_init__(self):
        pieces, first = words(LOWER[self.data], self.offsets)
        numbers, _ = word_numbers()(pieces)
        n = np.diff(first) + 2
        self.first = np.concatenate([[0], np.cumsum(n)])
        self.document = np.repeat(np.arange(len(n)), n)
        self.position = np.arange(self.first[-1]) - self.first[:-1][self.document]
        self.tokens = np.empty(self.first[-1], np.uint64)
        inside = (self.position > 0) & (self.position < n[self.document] - 1)
        self.tokens[inside] = mix(numbers)
        self.tokens[self.first[:-1]] = BEGIN
        self.tokens[self.first[1:] - 1] = END

    def grams(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-grams that end at each token, and which tokens have one."""
        h = self.tokens.copy()
        for back in range(1, order):
            h[back:] = mix(h[back:] * _ODD[0] + self.tokens[:-back])
        has = self.position >= order - 1
        return (h >> np.uint64(64 - bits_of(order)))[has], has

    def distinct(self, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct hashes, which of them each token's n-gram is (-1: none), and tokens that have one."""
        h, has = self.grams(order)
        by = np.argsort(h)
        ordered = h[by]
        new = np.append(True, ordered[1:] != ordered[:-1])[: len(h)]
        index = np.empty(len(h), np.int64)
        index[by] = np.cumsum(new) - 1
        out = np.full(len(has), -1, np.int64)
        out[has] = index
        return ordered[new], out, has


def parts(batches: Iterator[pa.RecordBatch], received: dict | None = None) -> Iterator[Part]:
    """Parts of blocks, the same ones whenever rows come in the same order.

    Rows of counts, which come before a block's texts, go to ``received`` by (block, part), then (piece, order); their
    order is in the column of folds.
    """
    block, number, held, size = None, 0, [], 0

    def made() -> Part:
        data = np.concatenate([h[2] for h in held]) if held else np.zeros(0, np.uint8)
        lengths = np.array([len(h[2]) for h in held], np.int64)
        return Part(block, number, [h[0] for h in held], np.array([h[1] for h in held], np.int64), data, np.concatenate([[0], np.cumsum(lengths)]))

    for rows, data, offsets in slices(batches):
        at = {c: rows.column(c).to_pylist() for c in ("block", "kind", "doc_id", "fold", "part", "piece", "counts")}
        for i in range(len(rows)):
            if at["kind"][i] == 0:
                received.setdefault((at["block"][i], at["part"][i]), {})[at["piece"][i], at["fold"][i]] = at["counts"][i]
                continue
            if held and (at["block"][i] != block or size >= PART_BYTES):
                yield made()
                number, held, size = (number + 1 if at["block"][i] == block else 0), [], 0
            elif at["block"][i] != block:
                number = 0
            block = at["block"][i]
            text = data[offsets[i] : offsets[i + 1]].copy()
            held.append((at["doc_id"][i], at["fold"][i], text))
            size += len(text)
    if held:
        yield made()


def fold(doc_id: Column) -> Column:
    """The fold of a document; a null id is in none that is special."""
    return F.coalesce((F.crc32(doc_id.cast("string")) % FOLDS).cast("int"), F.lit(-1))


def dealt(docs: DataFrame, blocks: int) -> DataFrame:
    """Documents with their block; deleted ones have blocks of their own, as they are scored twice."""
    own = max(1, blocks // FOLDS)
    key = F.xxhash64("doc_id", text_of())
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), fold(F.col("doc_id")).alias("fold"), text_of().alias("text"), key.alias("key"))
    block = F.when(F.col("fold") == DELETED, F.pmod("key", F.lit(own))).otherwise(own + F.pmod("key", F.lit(blocks)))
    return rows.select(
        block.cast("int").alias("block"), F.lit(1).alias("kind"), "doc_id", "fold", "text", "key",
        *[F.lit(None).cast(t).alias(n) for n, t in (("part", "int"), ("piece", "int"), ("counts", "binary"))],
    )


def by_block(rows: DataFrame, blocks: int) -> DataFrame:
    """Each block in one partition: counts first, then texts in an order that is always the same."""
    return rows.repartitionById(blocks + max(1, blocks // FOLDS), "block").sortWithinPartitions("block", "kind", "doc_id", "key")


def counted(rows: DataFrame, blocks: int, order: int) -> DataFrame:
    """(block, part, piece, counts): for each part, corpus counts of its n-grams in a range of hashes, in their order.

    Rows with block -1 hold, instead, words and tokens of that range: without and with deleted documents.
    """
    sent = "piece int, block int, part int, order int, n int, hashes binary, kept binary, deleted binary"

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            kept, deleted = ~np.isin(part.folds, (HELD_OUT, DELETED)), part.folds == DELETED
            for k in range(1, order + 1):
                hashes, index, has = part.distinct(k)
                document = part.document[has]
                n = [np.bincount(index[has], which[document], len(hashes)).astype(np.uint32) for which in (kept, deleted)]
                low = starts_of(blocks, bits_of(k))
                cuts = np.append(np.searchsorted(hashes, low), len(hashes))
                out = []
                for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    if b > a:
                        steps = np.diff(hashes[a:b], prepend=low[piece])
                        out.append((piece, part.block, part.number, k, b - a, pack(steps), *(pack(c[a:b]) for c in n)))
                types = [pa.int32()] * 5 + [pa.binary()] * 3
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[c.split()[0] for c in sent.split(", ")])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A range of hashes of one order: everything that was sent, summed up and sent back."""
        names = ["block", "part", "piece", "order", "counts"]
        types = [pa.int32()] * 4 + [pa.binary()]
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            piece, k = held[0][0], held[0][3]
            low = starts_of(blocks, bits_of(k))[piece]
            sizes = [h[4] for h in held]
            hashes = np.concatenate([np.cumsum(unpack(h[5], h[4], np.uint64)) + low for h in held])
            by = np.argsort(hashes)
            ordered = hashes[by]
            begins = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
            sums = []
            for column in (6, 7):
                own = np.concatenate([unpack(h[column], h[4], np.uint32) for h in held]).astype(np.uint64)
                sums.append(np.add.reduceat(own[by], begins))
            back = np.empty(len(by), np.int64)
            back[by] = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(by))))
            kept, every = sums[0], sums[0] + sums[1]
            out, at = [], 0
            for h, size in zip(held, sizes):
                index = back[at : at + size]
                out.append((h[1], h[2], piece, k, both_of(kept[index], every[index])))
                at += size
            if k == 1:
                word = ordered[begins] != BEGIN
                facts = [np.count_nonzero(word & (kept > 0)), kept[word].sum(), np.count_nonzero(word & (every > 0)), every[word].sum()]
                out.append((-1, 0, piece, k, np.array(facts, np.uint64).tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for row in zip(*columns):
                if held and (row[0], row[3]) != (held[0][0], held[0][3]):
                    yield flush()
                    held = []
                held.append(row)
        if held:
            yield flush()

    ranges = by_block(rows, blocks).mapInArrow(send, sent).repartitionById(blocks, "piece").sortWithinPartitions("piece", "order")
    return ranges.mapInArrow(total, "block int, part int, piece int, order int, counts binary")


@dataclass(frozen=True)
class Facts:
    """Distinct words and tokens of the training documents: without the deleted ones, and all."""

    kept_words: int
    kept_tokens: int
    all_words: int
    all_tokens: int


def facts_of(counts: DataFrame) -> Facts:
    rows = counts.filter("block = -1").select("counts").toLocalIterator()  # one row per range
    sums = sum((np.frombuffer(r["counts"], np.uint64).astype(object) for r in rows), np.zeros(4, object))
    return Facts(*map(int, sums))


def estimates(part: Part, received: dict, order: int, facts: Facts, kept: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token but beginnings: its bucket, its probabilities by order (0: uniform), its own count."""
    count, known = [], part.position > 0
    for k in range(1, order + 1):
        hashes, index, _ = part.distinct(k)
        pieces = received.get((part.block, part.number), {})
        halves = [half(pieces[p, k], kept) for p in sorted(p for p, o in pieces if o == k)]
        values = np.concatenate([*halves, np.zeros(1, np.uint64)]).astype(np.float64)
        if len(values) != len(hashes) + 1:
            raise ValueError("a part's counts do not fit its n-grams")
        count.append(values[index])  # the last one, zero, is that of no n-gram
    n, v = (facts.kept_tokens, facts.kept_words) if kept else (facts.all_tokens, facts.all_words)
    at = np.flatnonzero(known)
    p = np.zeros((order + 1, len(at)))
    p[0] = 1 / (v + 1)
    p[1] = count[0][at] / max(n, 1)
    bucket = np.zeros(len(at), np.int64)
    for k in range(2, order + 1):
        context = np.where(part.position[at] >= k - 1, count[k - 2][at - 1], 0)
        seen = context > 0
        p[k][seen] = count[k - 1][at][seen] / context[seen]
        bucket[seen] = (k - 1) * LEVELS + np.minimum(np.log2(context[seen]).astype(np.int64), LEVELS - 1)
    return bucket, p, count[0][at]


def grid(bucket: np.ndarray, p: np.ndarray) -> np.ndarray:
    """One number for a bucket and rounded probabilities, the uniform one left out."""
    key = bucket.copy()
    for row in p[1:]:
        with np.errstate(divide="ignore"):
            step = np.where(row > 0, np.minimum(np.rint(-STEP * np.log2(row)), NOTHING - 1), NOTHING)
        key = key * 256 + step.astype(np.int64)
    return key


def learn(keys: np.ndarray, counts: np.ndarray, uniform: float, order: int) -> np.ndarray:
    """Weights (bucket, order) by expectation-maximisation on counted, rounded probabilities.

    A bucket without counts takes the weights of its context length, or equal ones. Orders whose context is unknown have weight 0.
    """
    buckets = order * LEVELS
    usable = np.zeros((buckets, order + 1))
    for length in range(order):
        usable[length * LEVELS : (length + 1) * LEVELS, : length + 2] = 1
    usable /= usable.sum(1, keepdims=True)
    p, rest = np.zeros((order + 1, len(keys))), keys.copy()
    for k in range(order, 0, -1):
        step, rest = rest % 256, rest // 256
        p[k] = np.where(step == NOTHING, 0, 2.0 ** (-step / STEP))
    p[0] = uniform
    groups = rest // LEVELS

    def maximise(group: np.ndarray, start: np.ndarray) -> np.ndarray:
        weights = start.copy()
        for _ in range(ROUNDS):
            shares = weights[group].T * p
            shares *= counts / shares.sum(0)
            sums = np.array([np.bincount(group, s, len(weights)) for s in shares]).T
            total = sums.sum(1, keepdims=True)
            weights = np.where(total > 0, sums / np.maximum(total, 1e-300), weights)
        return weights

    if not len(keys):
        return usable
    lengths = maximise(groups, usable[::LEVELS])
    # A little of the uniform part stays, so that no word is impossible.
    weights = maximise(rest, np.repeat(lengths, LEVELS, 0))
    return 0.999 * weights + 0.001 * usable


def both_of(kept: np.ndarray, every: np.ndarray) -> bytes:
    """Counts without and with deleted documents, which hardly ever need 64 bits, with their number."""
    return np.uint32(len(kept)).tobytes() + pack(np.concatenate([kept, every]))


def half(data: bytes, kept: bool) -> np.ndarray:
    n = int(np.frombuffer(data, np.uint32, 1)[0])
    return np.split(unpack(data[4:], 2 * n, np.uint64), 2)[0 if kept else 1]


def blocks_with_counts(rows: DataFrame, counts: DataFrame, blocks: int) -> DataFrame:
    back = counts.filter("block >= 0").select(
        "block", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("doc_id"), F.col("order").alias("fold"), F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("bigint").alias("key"), "part", "piece", "counts",
    )
    return by_block(back.unionByName(rows), blocks)


def scored(docs: DataFrame, order: int = ORDER, blocks: int | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null text counts as empty: one token, its end. A null doc_id is trained on; repeated rows count each and get equal scores; columns besides
    doc_id and text are ignored; an empty table gives an empty result. Scores are log10 probabilities of whole
    texts. ``blocks`` (by default the shuffle partitions) should grow with the corpus: a block's text passes through one task in
    parts, a range of n-gram hashes is summed up in one.
    """
    blocks = blocks or shuffle_partitions(docs.sparkSession)
    rows = dealt(docs, blocks)
    counts = stored(counted(rows, blocks, order), "counts")
    facts = facts_of(counts)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        received: dict = {}
        for part in parts(batches, received):
            bucket, p, _ = estimates(part, received, order, facts, kept=True)
            keys, n = np.unique(grid(bucket, p), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["cell", "n"])

    own = max(1, blocks // FOLDS)
    deleted = blocks_with_counts(rows.filter(F.col("fold") == DELETED), counts.filter(F.col("block") < own), blocks)
    cells = deleted.mapInArrow(gather, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    weights = learn(cells["cell"].to_numpy(np.int64), cells["n"].to_numpy(np.float64), 1 / (facts.kept_words + 1), order)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        received: dict = {}
        for part in parts(batches, received):
            bucket, p, count = estimates(part, received, order, facts, kept=False)
            document = part.document[part.position > 0]
            n = len(part.doc_ids)
            model = np.log10((weights[bucket].T * p).sum(0))
            base = np.log10((count + 1) / (facts.all_tokens + facts.all_words + 1))
            columns = [
                pa.array(part.doc_ids, pa.int64()), pa.array(part.folds == HELD_OUT), pa.array(np.bincount(document, minlength=n), pa.int64()),
                pa.array(np.bincount(document, count > 0, n).astype(np.int64)), pa.array(np.full(n, facts.all_tokens, np.int64)),
                pa.array(np.bincount(document, base, n)), pa.array(np.bincount(document, model, n)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in out.split(", ")])
            received.pop((part.block, part.number), None)

    out = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return blocks_with_counts(rows, counts, blocks).mapInArrow(score, out)
