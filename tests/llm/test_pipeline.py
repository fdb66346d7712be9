"""Each stage on its own input, against plain code; awkward rows through all stages but the labels."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from siltworks.llm.queries import table

from .helpers import SF, documents, empty, needs_tables
from .test_entropy_mix import plain_targets
from .test_jaccard_join import plain
from .test_tokens import plain_encoding

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before and after each stage."""
    docs, out = table(spark, SF), []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF).cache()
        out.append((docs.collect(), after.collect(), after.columns))
        docs = after
    return out


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@needs_tables
def test_toxic_documents_go_and_clean_ones_stay(stages, spark):
    before, after, columns = stages[0]
    assert columns == COLUMNS and set(after) <= set(before)
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    assert sum(1 for d in gone if toxic.get(d) == 0) <= 2


@needs_tables
def test_first_copies_stay(stages):
    before, after, columns = stages[1]
    first = {}
    for r in sorted(before, key=lambda r: r["doc_id"]):
        first.setdefault(normal(r["text"]), r)
    assert columns == COLUMNS and sorted(after) == sorted(first.values())


@needs_tables
def test_one_of_each_near_group_stays(stages):
    before, after, columns = stages[2]
    component = {d: c for d, _, c in plain([(r["doc_id"], r["text"]) for r in before], 5, 80)}
    assert columns == COLUMNS and sorted(after) == sorted(r for r in before if component[r["doc_id"]] == r["doc_id"])


@needs_tables
def test_mix_nears_its_targets(stages):
    before, after, columns = stages[3]
    sizes, target = plain_targets(before)
    words = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    taken, largest = Counter(), Counter()
    for r in after:
        taken[r["source"]] += words(r)
    for r in before:
        largest[r["source"]] = max(largest[r["source"]], words(r))
    assert columns == COLUMNS and set(after) <= set(before) and max(Counter(after).values()) <= 2
    assert all(abs(taken[s] - target[s]) <= largest[s] + 1 for s in sizes)


@needs_tables
def test_tokens_of_the_last_stage(stages):
    before, after, _ = stages[4]
    encoding = plain_encoding()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in after) == sorted((r["doc_id"], len(encoding.encode_ordinary(r["text"] or ""))) for r in before)


def test_awkward_rows(spark):
    for docs in (documents(spark), empty(spark)):
        columns, key = docs.columns, lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "")
        once = corpus_pipeline.without_copies(spark, docs, "")
        texts = {normal(r["text"]) for r in docs.collect()}
        assert once.columns == columns and sorted(normal(r["text"]) for r in once.collect()) == sorted(texts)
        apart = corpus_pipeline.without_near_copies(spark, docs, "")
        assert apart.columns == columns and len(set(map(key, apart.collect()))) == apart.count()
        mixed = corpus_pipeline.mixed_sources(spark, docs, "")
        assert mixed.columns == columns and corpus_pipeline.tokens(spark, mixed, "").count() == mixed.count()


@needs_tables
def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF).select("doc_id", "ids_sha256")
    assert sorted(map(tuple, got.collect())) == sorted((r["doc_id"], r["ids_sha256"]) for r in stages[-1][1])
