"""Counts and scores against a plain computation; weights by a plain EM; held-out gain."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from siltworks.llm import language_model as lm
from siltworks.llm.queries import QUERIES

from .helpers import SF, documents, empty, needs_tables


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def fold(doc_id):
    return -1 if doc_id is None else zlib.crc32(str(doc_id).encode()) % 7


def plain(rows):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base score and a bigram score, without rounding."""
    def counts(folds):
        one, two = Counter(), Counter()
        for d, t in rows:
            if folds(fold(d)):
                w = ["<s>", *tokens(t)]
                one.update(w)
                two.update(zip(w, w[1:]))
        v = len([w for w in one if w != "<s>"])
        return one, two, sum(n for w, n in one.items() if w != "<s>"), v

    def probabilities(c, before, w):
        one, two, n, v = c
        k = one[before]
        bucket = 0 if not k else 48 + int(math.log2(k))
        return bucket, [1 / (v + 1), one[w] / max(n, 1), two[before, w] / k if k else 0.0]

    kept, every = counts(lambda f: f not in (2, 3)), counts(lambda f: f != 2)
    cells = Counter()
    for d, t in rows:
        if fold(d) == 3:
            w = ["<s>", *tokens(t)]
            cells.update((b, *p) for b, p in (probabilities(kept, x, y) for x, y in zip(w, w[1:])))
    keys = lm.grid(np.array([c[0] for c in cells], np.int64), np.array([c[1:] for c in cells]).T) if cells else np.zeros(0, np.int64)
    weights = lm.learn(keys, np.array(list(cells.values()), float), 1 / (kept[3] + 1), 2)
    out = []
    for d, t in rows:
        w = ["<s>", *tokens(t)]
        each = [probabilities(every, x, y) for x, y in zip(w, w[1:])]
        base = sum(math.log10((every[0][y] + 1) / (every[2] + every[3] + 1)) for y in w[1:])
        score = sum(math.log10(sum(a * b for a, b in zip(weights[b_], p))) for b_, p in each)
        out.append((d, fold(d) == 2, len(w) - 1, sum(every[0][y] > 0 for y in w[1:]), every[2], base, score))
    return out


def check(got, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(map(tuple, got), key=key), sorted(plain(rows), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


@needs_tables
def test_whole_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op5_language_model"](spark, SF).collect()
    check(got, rows)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_awkward_rows_and_small_parts(spark, monkeypatch):
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(lm.scored(docs, blocks=3).collect(), rows)
    assert lm.scored(empty(spark)).count() == 0


def test_parts_follow_the_order_of_rows_alone():
    import pyarrow as pa

    texts = [f"text {i} " * (i % 7 + 1) for i in range(40)]
    rows = pa.RecordBatch.from_pydict({
        "block": pa.array([i // 20 for i in range(40)], pa.int32()), "kind": pa.array([1] * 40, pa.int32()), "doc_id": list(range(40)), "fold": pa.array([0] * 40, pa.int32()),
        "text": texts, "key": list(range(40)), "part": pa.array([None] * 40, pa.int32()), "piece": pa.array([None] * 40, pa.int32()), "counts": pa.array([None] * 40, pa.binary()),
    })
    size, lm.PART_BYTES = lm.PART_BYTES, 100
    try:
        shape = lambda batches: [(p.block, p.number, p.doc_ids) for p in lm.parts(iter(batches))]
        whole = shape([rows])
        assert whole == shape([rows.slice(i, 3) for i in range(0, 40, 3)]) and len(whole) > 6
        assert [p for p in whole if p[0] == 1][0][1] == 0
    finally:
        lm.PART_BYTES = size


