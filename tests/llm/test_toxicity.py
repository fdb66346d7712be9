"""Held-out accuracy, scores that depend on nothing but the text, and awkward rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from siltworks.llm.queries import QUERIES
from siltworks.llm.toxicity import Model, fit, held_out, scored, train

from .helpers import documents, empty, needs_tables

SF = "/root/testdata/sf0.1"


@needs_tables
def test_held_out_accuracy(spark):
    got = QUERIES["op8_toxicity"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.join(labels, "doc_id").filter("held_out").select("predicted", "toxic").collect()
    assert got.count() == 10000
    caught = sum(r["predicted"] for r in rows if r["toxic"]) / sum(r["toxic"] for r in rows)
    wrong = sum(r["predicted"] for r in rows if not r["toxic"]) / sum(1 - r["toxic"] for r in rows)
    assert caught >= 0.8 and wrong <= 0.02


def test_held_out_rows_are_those_of_the_checksum(spark):
    rows = spark.range(50).select("id", held_out(F.col("id")).alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


def test_unlabelled_positives_are_not_learnt_as_negative():
    rng = np.random.default_rng(1)
    clean = [" ".join(rng.choice(list("abcdefgh"), 30)) for _ in range(300)]
    toxic = [c + " vile" for c in clean[:100]]
    model = fit(toxic[:50] + clean + toxic[50:], np.arange(400) < 50, 0.15)
    score = lambda t: model.score(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0]
    assert score("a b c Vile! d") > 0.5 > score("a b c d")


def test_awkward_rows(spark):
    docs = documents(spark)
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) AS toxic", "'y' AS text")
    out = scored(docs, train(docs, labels), "score")
    assert sorted(out.columns) == sorted(docs.columns) and out.count() == docs.count()
    assert all(0 <= r["score"] <= 1 for r in out.collect())
    assert out.groupBy("doc_id").agg(F.count_distinct("score").alias("n")).filter("n > 1 and doc_id is not null").count() == 0
    assert scored(empty(spark), train(empty(spark), labels.limit(0))).count() == 0


def test_a_model_without_features_scores_its_bias():
    model = Model(np.zeros(0, np.int64), np.zeros(0), 0.0)
    assert model.score(np.frombuffer(b"any words", np.uint8), np.array([0, 9, 9])).tolist() == [0.5, 0.5]


def test_repeated_ids_count_once(spark, monkeypatch):
    """One id with very many rows neither outgrows the sample's bound nor pushes other rows out of it."""
    monkeypatch.setattr("siltworks.llm.toxicity.POSITIVE_ROWS", 30)
    monkeypatch.setattr("siltworks.llm.toxicity.UNLABELLED_ROWS", 60)
    texts = [f"{'vile ' if i % 4 == 0 else ''}some words of number {i % 7} and more" for i in range(120)]
    docs = documents(spark, texts, clash=False)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)], "doc_id bigint, toxic int")
    heavy = docs.unionByName(spark.range(3000).selectExpr("8L AS doc_id", f"'{texts[8]}' AS text", "'en' AS lang", "'s' AS source", "0L AS n_chars"))
    once, often = train(docs, labels), train(heavy, labels)
    assert len(once.features) and (once.features == often.features).all() and np.allclose(once.weights, often.weights) and once.bias == often.bias


@needs_tables
def test_scores_against_plain_words(spark):
    """The score of each document is the logistic function of the bias and the weights of its distinct features."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = scored(docs.select("doc_id", "text"), model, "score").collect()
    for r in rows[:60]:
        raw = np.frombuffer((r["text"] or "").encode(), np.uint8)
        alone = model.score(raw, np.array([0, len(raw)]))[0]
        assert abs(alone - r["score"]) < 1e-12
