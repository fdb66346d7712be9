"""Exact dedup and quality rules: against their SQL, against plain code on awkward rows, and their methods."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks.compare import differences, duck
from siltworks.llm import exact_dedup, quality_rules
from siltworks.llm.queries import ORACLES, QUERIES

from .helpers import SF, documents, empty, needs_tables

normal = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@needs_tables
@pytest.mark.parametrize("name", ["op7_quality_rules", "op9_exact_dedup"])
def test_queries_give_the_rows_of_their_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), duck(SF), ORACLES[name]) is None


def test_only_expressible_queries_have_sql():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) == 13


def test_copies_of_awkward_rows(spark):
    docs = documents(spark)
    rows = docs.select("doc_id", "text").collect()
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(normal(text), []).append(doc_id)
    got = exact_dedup.exact_duplicates(docs).collect()
    assert len(got) == len(rows)
    by_text = Counter()
    for r in got:
        (text,) = [t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"]]
        ids = groups[text]
        assert r["group_size"] == len(ids) and r["keep_id"] == min((i for i in ids if i is not None), default=None)
        if r["kept"]:
            by_text[text] += 1
            assert r["doc_id"] == r["keep_id"]
    assert set(by_text.values()) == {1} and set(by_text) == set(groups)
    assert exact_dedup.exact_duplicates(empty(spark)).count() == 0


def test_chunks_are_cut_by_content_and_cover_the_text(spark):
    text = " ".join(f"word{i} and more of it" for i in range(2000))
    chunks = lambda t: [c["id"] for c in exact_dedup.recipes(documents(spark, [t])).first()["chunks"]]
    plain, edited = chunks(text), chunks("something new " + text)
    assert len(plain) > 10 and len(set(plain) & set(edited)) >= len(plain) - 2
    pieces = spark.createDataFrame([(text,)], "t string").select(F.regexp_extract_all("t", F.lit(exact_dedup.CHUNK), F.lit(0)).alias("c")).first()["c"]
    assert "".join(pieces) == text and max(map(len, pieces)) <= 2048


def test_identifiers_of_several_chunks_are_told_apart(spark):
    schema = "doc_id bigint, key bigint, row bigint, text_sha256 string, chunks array<struct<id:bigint,sha:binary>>"
    a, b, c = ((7, b"a"), (7, b"b"), (9, b"c"))
    rows = [(i, i, i, str(i), chunks) for i, chunks in enumerate([[a, c], [b, c], [a, c], [c, b], []])]
    got = {r["doc_id"]: [tuple(x) for x in r["recipe"]] for r in exact_dedup.verified(spark.createDataFrame(rows, schema)).collect()}
    assert got == {0: [(7, 0), (9, 0)], 1: [(7, 1), (9, 0)], 2: [(7, 0), (9, 0)], 3: [(9, 0), (7, 1)], 4: []}


def metrics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    uses = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if uses[w] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
    }


RULES = [
    None, "", "a b c a b c", "a a a a a", "x y", "# $ %%\n# $ %%\n\n \n#", "é 😀 ß\x0bz", ("one line of words\n" * 40), " ".join(map(str, range(60))),
    " ".join(["w"] * 3000), " ".join(f"{i % 50}" for i in range(2000)), "a b c d b c d e",
]


def test_metrics_and_verdicts_of_awkward_rows(spark):
    docs = documents(spark, RULES)
    got = {r["doc_id"]: r for r in quality_rules.measured(docs).collect()}
    for i, text in enumerate(RULES):
        want = metrics(text)
        assert {m: got[i][m] for m in want} == want, text
    condition = " OR ".join(f"({r.sql})" for r in quality_rules.RULES)
    told = quality_rules.measured(docs).filter(F.col("rejected_by").isNotNull() != F.expr(condition))
    assert told.count() == 0
    assert quality_rules.measured(empty(spark)).count() == 0
    awkward = documents(spark)
    assert quality_rules.judged(awkward).count() == awkward.count()


def test_the_order_of_rules_changes_no_verdict(spark):
    docs = documents(spark, RULES)
    text = F.coalesce("text", F.lit(""))
    verdicts = [
        [r[0] is None for r in docs.select(quality_rules.cascade(order, lambda m: quality_rules.METRICS[m](text))).collect()]
        for order in (quality_rules.RULES, quality_rules.RULES[::-1])
    ]
    assert verdicts[0] == verdicts[1]


def test_rules_are_ordered_by_rejection_per_cost():
    found = [{"rule": r, "cost": c, "selectivity": s} for r, c, s in zip(quality_rules.RULES, (1, 1, 4, 2, 1), (0.1, 0.5, 0.9, 0.0, 0.2))]
    assert [r.name for r in quality_rules.ordered(found)] == ["repetitive", "odd_word_length", "same_lines", "too_short", "symbols"]


def test_later_rules_are_not_evaluated(spark):
    fails = F.raise_error(F.lit("evaluated"))
    verdict = quality_rules.cascade(quality_rules.RULES[:2], lambda m: F.lit(3) if m == "n_words" else fails.cast("bigint"))
    assert spark.range(3).select(verdict.alias("v")).distinct().collect()[0]["v"] == "too_short"


def test_documents_leave_the_walk_at_the_first_rule_that_rejects_them(spark, monkeypatch):
    order = [r for name in ("too_short", "symbols", "repetitive") for r in quality_rules.RULES if r.name == name]
    docs = documents(spark, ["# " * 60, "one two", None, " ".join(map(str, range(60)))]).selectExpr("doc_id", "coalesce(text, '') AS __text")
    raised = lambda text: F.when(F.lit(True), F.raise_error(F.lit("evaluated"))).cast("bigint")
    plain = {r["doc_id"]: r for r in quality_rules.walked(docs, order).collect()}
    assert {i: r["__rejected_by"] for i, r in plain.items()} == {0: "symbols", 1: "too_short", 2: "too_short", 3: None}
    assert [(plain[i]["__n_symbols"], plain[i]["__n_repeat_words"]) for i in range(4)] == [(60, None), (None, None), (None, None), (0, 0)]
    monkeypatch.setitem(quality_rules.METRICS, "n_repeat_words", raised)
    assert quality_rules.walked(docs.filter("doc_id < 3"), order).select("__rejected_by").distinct().count() == 2
    with pytest.raises(Exception, match="evaluated"):
        quality_rules.walked(docs, order).collect()


def test_verdicts_are_the_same_with_and_without_the_metrics(spark):
    docs = documents(spark, RULES).selectExpr("*", "'mine' AS rejected_by")
    verdict = lambda df: {r["doc_id"]: r["rejected_by"] is None for r in df.collect()}
    assert verdict(quality_rules.judged(docs)) == verdict(quality_rules.measured(docs))
    assert quality_rules.judged(docs).columns == docs.columns and quality_rules.judged(empty(spark)).count() == 0


def test_estimates_are_of_a_sample_of_bounded_size(spark):
    docs = documents(spark, RULES * 200, clash=False)
    found = quality_rules.estimate(docs, rows=100)
    assert [e["rule"] for e in found] == list(quality_rules.RULES) and all(e["cost"] > 0 for e in found)
    assert 0.5 < found[0]["selectivity"] <= 1.0
