"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over words is trained from confirmed toxic examples and *unlabelled* text alone. The risk of
the unlabelled part is corrected by the class prior, and its share that stands for negatives is kept from
going below zero: risk = prior * E_P[loss(f)] + max(0, E_U[loss(-f)] - prior * E_P[loss(-f)]). Where that difference is
negative, the step goes against it. Training sees a bounded sample of rows; scoring runs over all texts
in numpy, in the partitions as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .vector import LOWER, SMALL_SLICE_BYTES, PieceCache, per_text, slices, words

# Bounds of the training sample: confirmed toxic rows, and rows used without their label.
POSITIVE_ROWS = 3_000
UNLABELLED_ROWS = 10_000
# Features are words and beginnings of words. Those are used whose share of confirmed examples differs from
# that of unlabelled ones by so many standard errors, the most telling ones at most.
BEGINNINGS = (4, 5, 6)
LEAST_DOCUMENTS, ERRORS, FEATURES = 3, 4.0, 20_000
# A feature is a cell of this many; words that share one by chance hardly matter, as most words are rare.
CELLS = 1 << 22
ROUNDS, RATE, PENALTY = 300, 0.1, 1e-5

# Letters and digits make words, lower-cased where they are ASCII; bytes of other characters count as letters.
_WORD_BYTES = np.full(256, 0x20, np.uint8)
for _b in (*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)):
    _WORD_BYTES[_b] = LOWER[_b]


@lru_cache(1)
def word_hashes() -> PieceCache:
    import xxhash

    def of(piece: bytes) -> tuple:
        short = (xxhash.xxh64_intdigest(piece[:n], n) for n in BEGINNINGS if n < len(piece))
        return xxhash.xxh64_intdigest(piece), *short

    return PieceCache(lambda pieces: map(of, pieces), np.uint64)


def hashed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all words and their beginnings, and the number of the text each belongs to."""
    pieces, first = words(_WORD_BYTES[data], offsets)
    hashes, lengths = word_hashes()(pieces)
    return (hashes & np.uint64(CELLS - 1)).astype(np.int64), np.repeat(np.arange(len(first) - 1), np.diff(per_text(lengths, first)))


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # sorted cells
    weights: np.ndarray
    bias: float

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Between 0 and 1 for each text; one without known words gets what the bias says."""
        columns, rows = self.columns(*hashed(data, offsets))
        f = np.bincount(rows, self.weights[columns], len(offsets) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(f, -40, 40)))

    def columns(self, hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features of each text, once each, with the text's number."""
        if not len(self.features):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.features, hashes), len(self.features) - 1)
        known = self.features[at] == hashes
        pairs = np.unique(rows[known] * np.int64(len(self.features)) + at[known])
        return pairs % len(self.features), pairs // len(self.features)


def distinct(texts: list[str], step: int = 128) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cells of some texts at a time, once for each text, with the text's number."""
    for begin in range(0, len(texts), step):
        encoded = [(t or "").encode() for t in texts[begin : begin + step]]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in encoded])]).astype(np.int64)
        cells, rows = hashed(np.frombuffer(b"".join(encoded), np.uint8), offsets)
        pairs = np.unique(rows * np.int64(CELLS) + cells)
        yield pairs % CELLS, pairs // CELLS + begin


def fit(texts: list[str], positive: np.ndarray, prior: float) -> Model:
    """Train on texts of which ``positive`` are confirmed; the others are unlabelled. Repeatable."""
    confirmed, others = np.zeros(CELLS), np.zeros(CELLS)
    for cells, rows in distinct(texts):
        confirmed += np.bincount(cells[positive[rows]], minlength=CELLS)
        others += np.bincount(cells[~positive[rows]], minlength=CELLS)
    n_p, n_u = max(positive.sum(), 1), max((~positive).sum(), 1)
    share = (confirmed + others + 1) / (n_p + n_u + 2)
    errors = np.abs(confirmed / n_p - others / n_u) / np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u))
    errors[confirmed + others < LEAST_DOCUMENTS] = 0
    chosen = np.flatnonzero(errors >= ERRORS)
    chosen = np.sort(chosen[np.argsort(-errors[chosen], kind="stable")[:FEATURES]])
    model = Model(chosen, np.zeros(len(chosen)), float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))))
    if not positive.any() or positive.all() or not len(chosen):
        return model
    held = [model.columns(cells, rows) for cells, rows in distinct(texts)]
    column, row = (np.concatenate(x) for x in zip(*held))
    p, u = positive / positive.sum(), ~positive / (~positive).sum()
    w = np.append(np.zeros(len(chosen)), model.bias)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, ROUNDS + 1):
        f = np.bincount(row, w[column], len(texts)) + w[-1]
        toxic = 1 / (1 + np.exp(-np.clip(f, -40, 40)))
        # Logistic loss: of f its slope is toxic - 1, of -f it is toxic.
        as_negative = np.logaddexp(0, f)
        kept = (u - prior * p) @ as_negative >= 0
        slope = prior * p * (toxic - 1) + (u - prior * p) * toxic if kept else (prior * p - u) * toxic
        g = np.append(np.bincount(column, slope[row], len(chosen)) + PENALTY * w[:-1], slope.sum())
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(model.features, w[:-1], float(w[-1]))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from; a null id is not one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample of labelled rows, those with the smallest hashes of doc_id.

    Confirmed examples are rows labelled toxic; the unlabelled ones are drawn from all others without a look
    at the label, toxic ones in their share. Of documents that share an id one, by a digest of the text, is learnt from. The prior is that share among all labels to learn from.
    """
    usable = labels.select("doc_id", "toxic").filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    n, toxic = usable.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("toxic") == 1).cast("bigint")), F.lit(0))).first()
    order = lambda salt: F.xxhash64(F.lit(salt), "doc_id")
    confirmed = usable.filter("toxic = 1").orderBy(order(1), "doc_id").limit(POSITIVE_ROWS).select("doc_id", F.lit(True).alias("__p"))
    mixture = usable.orderBy(order(2), "doc_id").limit(UNLABELLED_ROWS).select("doc_id", F.lit(False).alias("__p"))
    # At most the two bounds above: small enough to send to all tasks.
    sample = F.broadcast(confirmed.unionByName(mixture))
    # One row of each drawn id, however many documents have it, so that the sample is no larger than its bound.
    text = F.coalesce("text", F.lit(""))
    drawn = docs.select("doc_id", "text").join(sample, "doc_id").groupBy("doc_id", "__p").agg(F.min_by(text, F.sha2(text, 256)).alias("text"))
    prior = toxic / n if n else 0.0

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"doc_id": [], "text": [], "__p": []}), *batches])
        rows = rows.sort_values(["__p", "doc_id", "text"], ascending=[False, True, True], kind="stable")
        model = fit(rows["text"].tolist(), rows["__p"].to_numpy(bool), prior)
        yield pd.DataFrame({"features": [model.features.tobytes()], "weights": [model.weights.tobytes()], "bias": [model.bias]})

    # The bounded sample meets in one task; the driver gets the model alone.
    row = drawn.repartition(1).mapInPandas(learn, "features binary, weights binary, bias double").first()
    if row is None:
        return fit([], np.zeros(0, bool), prior)
    return Model(np.frombuffer(row["features"], np.int64), np.frombuffer(row["weights"], np.float64), row["bias"])


def scored(docs: DataFrame, model: Model, name: str = "toxicity") -> DataFrame:
    """All columns and the score of each whole text (one named alike is replaced).

    Null text counts as empty; empty texts get the score of the bias alone, repeated rows equal scores, an
    empty table stays empty. Nothing but the text has a part in it. The model is bounded by FEATURES words.
    """
    docs = docs.drop(name)
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, size=SMALL_SLICE_BYTES):
            score = pa.array(broadcast.value.score(data, offsets), pa.float64())
            yield pa.RecordBatch.from_arrays([*rows.columns, score], names=[*rows.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(name, T.DoubleType())]))
