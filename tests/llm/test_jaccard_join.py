"""Components against a comparison of all pairs, and the pigeonhole against sets at the limit."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltworks.llm import jaccard_join
from siltworks.llm.components import components
from siltworks.llm.jaccard_join import signatures, similar_documents
from siltworks.llm.queries import QUERIES

from .helpers import SF, documents, empty, needs_tables


def shingles(text, width):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def plain(rows, width, percent):
    """doc_id -> (set size, component); rows without doc_id have a part in links, not in the least id."""
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def plain_links(rows, width, percent):
    """(doc_id, number of other rows that the row links with)."""
    sets = [shingles(t, width) for _, t in rows]
    alike = lambda x, y: bool(x) and 100 * len(x & y) >= percent * len(x | y)
    return sorted(((d, sum(i != j and alike(x, y) for j, y in enumerate(sets))) for i, ((d, _), x) in enumerate(zip(rows, sets))), key=str)


def counted(df):
    return sorted(map(tuple, df.select("doc_id", "n_links").collect()), key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


@needs_tables
def test_whole_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    result = QUERIES["op6_jaccard_join"](spark, SF).cache()
    assert found(result) == plain(rows, 4, 85)
    assert counted(result) == plain_links(rows, 4, 85)


def test_awkward_rows(spark):
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    result = similar_documents(docs).cache()
    assert found(result) == plain(rows, 5, 80)
    assert counted(result) == plain_links(rows, 5, 80)
    assert similar_documents(empty(spark)).count() == 0


@pytest.mark.parametrize(("least_common", "many"), [(3, 64), (1000, 64), (1000, 2), (3, 2)])
def test_families_around_the_limit(spark, monkeypatch, least_common, many):
    """Chains of edits, shared passages and copies; with and without shingles that count as common, paired or in blocks."""
    monkeypatch.setattr(jaccard_join, "LEAST_COMMON", least_common)
    monkeypatch.setattr(jaccard_join, "MANY", many)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 7)
    rng = random.Random(least_common + many)
    word = lambda: "w%d" % rng.randrange(400)
    passage, texts = [word() for _ in range(30)], []
    for _ in range(12):
        text = [word() for _ in range(rng.choice([6, 20, 60, 150]))] + (passage if rng.random() < 0.6 else [])
        for _ in range(10):
            texts.append(" ".join(text))
            text = list(text)
            for _ in range(rng.randrange(1, 3)):
                at = rng.randrange(len(text))
                text[at : at + rng.randrange(2)] = [word()] * rng.randrange(2)
    texts += [" ".join(passage)] * 5
    rng.shuffle(texts)
    docs = documents(spark, texts, clash=False)
    result = similar_documents(docs, 4, 85).cache()
    assert found(result) == plain(list(enumerate(texts)), 4, 85)
    assert counted(result) == plain_links(list(enumerate(texts)), 4, 85)


@pytest.mark.parametrize("slots", [1 << 14, 1 << 23])
def test_common_shingles_are_counted_over_all_documents(spark, monkeypatch, slots):
    """Of 25,000 documents 25 make a shingle common, wherever they are; copies that a task has met hold none."""
    monkeypatch.setattr(jaccard_join, "MOST_SLOTS", slots)
    own = F.array(*[F.xxhash64("id", F.lit(k)) for k in range(6)])
    shared = F.when(F.col("id") % 1000 == 1, F.array(F.lit(-7).cast("bigint"), F.lit(5).cast("bigint"))).when(F.col("id") % 1042 == 3, F.array(F.lit(9).cast("bigint")))
    sets = spark.range(25_000).repartition(7).select(F.col("id").alias("key"), F.array_union(own, F.coalesce(shared, own)).alias("shingles"))
    copies = spark.range(50).select(F.col("id").alias("key"), F.lit(None).cast("array<bigint>").alias("shingles"))
    mine = sets.union(copies).select("*", F.size("shingles").alias("n_shingles"), F.col("shingles").isNotNull().alias("held"))
    assert sets.filter("array_contains(shingles, 9)").count() == 24
    assert jaccard_join.common_shingles(mine, 25_000).view(np.int64).tolist() == [5, -7]
    assert len(jaccard_join.common_shingles(mine.limit(0), 0)) == 0


def test_blocks_find_all_links():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(60) < 0.93], rng.integers(0, 2**63, rng.integers(0, 5)).astype(np.uint64)])) for _ in range(40)]
    left = np.arange(40) % 2 == 0
    parent = np.arange(40)
    for _ in range(40):
        for i in range(40):
            for j in range(40):
                both = len(np.intersect1d(sets[i], sets[j]))
                if left[i] != left[j] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                    parent[i] = parent[j] = min(parent[i], parent[j])
    assert jaccard_join.similar_in_block(sets, left, ~left, 85).tolist() == parent.tolist()


def test_similar_sets_always_share_a_signature():
    rng = np.random.default_rng(2)
    for trial in range(400):
        percent = int(rng.choice([70, 80, 85, 95]))
        r = int(rng.choice([1, 2, 5, 12, 40, 150]))
        base = rng.integers(0, 2**63, r).astype(np.uint64)
        loss = rng.integers(0, max(1, r // 6) + 1)
        other = np.unique(np.concatenate([base[loss:], rng.integers(0, 2**63, rng.integers(0, max(1, r // 6) + 1)).astype(np.uint64)]))
        base = np.unique(base)
        both = len(np.intersect1d(base, other))
        if not both or 100 * both < percent * (len(base) + len(other) - both):
            continue
        union = np.union1d(base, other)
        common = np.sort(rng.permutation(union)[: int(len(union) * rng.choice([0, 0.3, 0.7, 0.95, 1]))])
        sig, of = signatures([base, other], percent, common)
        assert set(sig[of == 0]) & set(sig[of == 1]), (trial, percent, len(base), len(other), both)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 150)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 150)}}
