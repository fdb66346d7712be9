"""Benchmark windows in documents against a plain search."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from siltworks.llm import decontamination as dec
from siltworks.llm.queries import ORACLES, QUERIES, table

from .helpers import PROSE, SF, documents, empty, needs_tables

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


def expected(docs, items, width=10):
    windows = {}
    for item, text in items:
        words = plain_words(text)
        k = min(width, len(words))
        for i in range(len(words) - k + 1 if k else 0):
            windows.setdefault(tuple(words[i : i + k]), set()).add("" if item is None else str(item))
    widths = {len(w) for w in windows}
    found = []
    for doc, text in docs:
        words, hits, who = plain_words(text), set(), set()
        for k in widths:
            for i in range(len(words) - k + 1):
                items_of = windows.get(tuple(words[i : i + k]))
                if items_of:
                    hits.update(range(i, i + k))
                    who |= items_of
        found.append((doc, len(words), len(hits), sorted(hits), sorted(who)))
    return sorted(found, key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["hits"], r["items"]) for r in df.collect()), key=str)


def pairs(df):
    return [tuple(r) for r in df.collect()]


@needs_tables
def test_query_and_sql_on_whole_tables(spark):
    from checks.compare import differences, duck

    assert differences(QUERIES["op13_decontamination"](spark, SF), duck(SF), ORACLES["op13_decontamination"]) is None
    docs, items = table(spark, SF), table(spark, SF, "benchmark")
    want = expected(pairs(docs.select("doc_id", "text")), pairs(items.select("item_id", "text")))
    assert got(dec.contamination(docs, items)) == want and any(w[2] for w in want)


def invented(spark):
    rng = random.Random(4)
    words = ["Alpha", "beta", "é", "東京", "x1", "ß", "Z", "0", "[q]", "a\x00b"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", "\n", ", ", "\x7f"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 3, 9, 10, 11, 30]))) for i in range(40)] + [(None, PROSE), (3, text(12)), (3, None), (41, "..."), (42, "e")]
    texts = [text(rng.randint(0, 60)) + (items[i % 40][1] if i % 3 == 0 else "") + text(5) for i in range(60)]
    texts += [None, "", "!!", "word " * 30_000 + PROSE + "a" * 90_000, items[20][1], items[20][1]]
    return documents(spark, texts), spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS hash", "'x' AS width")


@pytest.mark.parametrize("block_bytes, width", [(dec.BLOCK_BYTES, 10), (4000, 10), (dec.BLOCK_BYTES, 3)])
def test_against_plain_search(spark, block_bytes, width):
    docs, items = invented(spark)
    want = expected(pairs(docs.select("doc_id", "text")), pairs(items.select("item_id", "text")), width)
    assert got(dec.contamination(docs, items, width, block_bytes)) == want


def test_repeated_rows_and_blocks(spark):
    docs = documents(spark)
    items = spark.createDataFrame([(1, PROSE), (2, "x"), (3, "lazy dog and"), (4, "nothing of the kind")], "item_id bigint, text string")
    want = expected(pairs(docs.select("doc_id", "text")), pairs(items))
    assert got(dec.contamination(docs, items)) == want == got(dec.contamination(docs, items, block_bytes=100))


def test_colliding_hashes_are_no_hits(spark, monkeypatch):
    windows = dec.WindowSet(dec.item_windows(spark.createDataFrame([(1, PROSE)], "item_id bigint, text string")).toArrow())
    windows.items = {hashlib.sha256(b"other").digest(): ["1"]}
    assert dec.scan(documents(spark).select("doc_id", "text"), windows).filter(F.size("__hits") > 0).count() == 0


def test_cleaned(spark):
    docs = documents(spark, ["Before. The quick, BROWN fox! After.", "clean", None, "the quick brown fox"])
    items = spark.createDataFrame([(1, "the quick brown fox")], "item_id bigint, text string")
    assert [r["text"] for r in dec.cleaned(docs, items).orderBy("doc_id").collect()] == ["Before. ! After.", "clean", None, ""]
    kept = dec.cleaned(docs, items, remove="documents")
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.orderBy("doc_id").collect()] == [1, 2]
    with pytest.raises(ValueError):
        dec.cleaned(docs, items, remove="words")


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, PROSE)], "item_id bigint, text string")
    assert dec.contamination(empty(spark), items).collect() == []
    assert dec.contamination(documents(spark), items.limit(0)).filter("n_hit > 0").collect() == []
    assert dec.cleaned(empty(spark), items).columns == empty(spark).columns
