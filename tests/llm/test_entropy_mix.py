"""Targets against a plain computation, taken words against targets."""

import re
from collections import defaultdict

import pytest

from siltworks.llm.entropy_mix import mixed, mixture
from siltworks.llm.queries import QUERIES

from .helpers import SF, documents, empty, needs_tables


def plain_targets(rows):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, free, target = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            target.update({s: weight[s] * level for s in free})
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= over
    return sizes, target


def check_mix(rows, got):
    sizes, target = plain_targets(rows)
    source = defaultdict(list)
    for r in rows:
        source[r["doc_id"]].append((r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))))
    taken, largest = defaultdict(int), defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        of = next(s for s in source[r["doc_id"]] if s[1] == r["size"] and sizes[s[0]] == r["source_size"])
        assert r["target"] == pytest.approx(target[of[0]], rel=1e-9)
        assert r["taken"] == r["size"] * r["copies"] <= 2 * r["size"]
        taken[of[0]] += r["taken"]
        largest[of[0]] = max(largest[of[0]], r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] + 1, s


@needs_tables
def test_whole_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = QUERIES["op2_entropy_mix"](spark, SF).collect()
    check_mix(rows, got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, QUERIES["op2_entropy_mix"](spark, SF).collect()))


def test_awkward_rows(spark):
    docs = documents(spark)
    check_mix(docs.collect(), mixed(docs).collect())
    assert mixed(empty(spark)).count() == 0


def test_a_hot_cell_is_counted_through_in_groups(spark):
    docs = spark.range(9000).selectExpr("id AS doc_id", "'same two' AS text", "if(id < 8500, 'hot', 'cold') AS source")
    got = mixed(docs).collect()
    check_mix(docs.collect(), got)


def test_mixture_repeats_documents(spark):
    docs = documents(spark)
    out, want = mixture(docs), mixed(docs).collect()
    assert out.columns == docs.columns
    assert out.count() == sum(r["copies"] for r in want)
    per_id = defaultdict(int)
    for r in want:
        per_id[r["doc_id"]] += r["copies"]
    assert {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()} == {k: v for k, v in per_id.items() if v}
