from urllib.parse import parse_qsl, urlparse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from siltworks.functions.web import overlay, query_map, redact, url_host, url_problem
from siltworks.operators import paging
from siltworks.operators.paging import distinct_keys, key_batches, numbered, page_plan, pages_before_first_empty
from siltworks.session import whole_numbers


def expected_map(text):
    parsed = urlparse(text)
    return dict(parse_qsl(parsed.query if parsed.scheme else text, keep_blank_values=True))


@pytest.mark.parametrize(
    "text",
    [
        "https://h/p?a=1&b=2", "a=1&b=2", "https://h/p", "https://h/p?", "https://h/p?a=&b", "a=1&a=2&b=3&a=4",
        "x=a%20b+c%26d", "x=100%&y=%zz%41", "https://h/p?a=1#frag?b=2", "https://h/p?a=b=c&&d=1", "", "page=2",
        "https://h/p?q=x?y", "a=1;b=2", "k%20ey=v", "=novalue&n", "https://h/p?%C3%A9=%C3%A8",
    ],
)
def test_query_map_is_the_standard_one(spark, text):
    df = spark.createDataFrame([(text,)], "u string")
    assert df.select(query_map(F.col("u"))).first()[0] == expected_map(text)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab=&%+1?", max_size=14), min_size=20, max_size=40))
def test_query_map_on_any_text(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "u string")
    got = [r[0] for r in df.select(query_map(F.col("u"))).collect()]
    assert got == [expected_map(t) for t in texts]


def test_null_url(spark):
    df = spark.createDataFrame([(None,)], "u string")
    assert df.select(query_map(F.col("u")), url_problem(F.col("u"))).first() == (None, "empty")


def test_overlay_and_redaction(spark):
    df = spark.sql("select map('page', '1', 'Token', 'x', 'API_KEY', 'y', 'keys', 'z') a, map('page', '2', 'n', null) b")
    assert df.select(overlay(F.col("a"), F.col("b"))).first()[0] == {
        "Token": "x", "API_KEY": "y", "keys": "z", "page": "2", "n": None,
    }
    assert df.select(redact(F.col("a"))).first()[0] == {"page": "1", "Token": "***", "API_KEY": "***", "keys": "z"}


@pytest.mark.parametrize(
    ("url", "problem"),
    [
        ("https://api.example.com/v1", None), ("HTTP://Example.com", None), ("", "empty"), ("ftp://h/x", "scheme"),
        ("example.com/x", "scheme"), ("https://", "no host"), ("https:///path", "no host"), ("http://:80/", "no host"),
        ("http://LOCALHOST/x", "blocked host"), ("http://127.0.0.1:9/x", "blocked host"), ("http://[::1]:8/", "blocked host"),
        ("http://u:p@169.254.169.254/latest", "blocked host"), ("https://metadata.google.internal", "blocked host"),
        ("http://localhost.example.com/", None), ("https://h[x/", "malformed"), ("http://u@h.example:8080?x=1", None),
    ],
)
def test_url_problem(spark, url, problem):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(url_problem(F.col("u"))).first()[0] == problem


@pytest.mark.parametrize("url", ["http://u:p@Host.Example:80/x", "https://a.b?c", "http://[FE80::1]:5/", "https://h#f", "nothing"])
def test_url_host(spark, url):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(url_host(F.col("u"))).first()[0] == (urlparse(url).hostname or "")


def test_distinct_keys(spark):
    df = spark.createDataFrame([([("a",), ("b",), (None,)],), ([("a",), ("",)],), ([],), (None,)], "r array<struct<k:string>>")
    assert rows(distinct_keys(df, F.col("r"), "k")) == [("a",), ("b",)]


@pytest.mark.parametrize(("n", "size"), [(0, 5), (1, 5), (10, 5), (11, 5), (137, 50)])
def test_key_batches(spark, n, size):
    keys = spark.range(n).selectExpr("lpad(cast(id * 7 % 1000 as string), 4, '0') k")
    got = [list(r["keys"]) for r in key_batches(keys, "k", size).orderBy("batch_no").collect()]
    ordered = sorted(f"{i * 7 % 1000:04d}" for i in range(n))
    assert got == [ordered[i : i + size] for i in range(0, n, size)]
    with pytest.raises(ValueError):
        key_batches(keys, "k", 0)


def test_numbers_are_dense_whatever_the_partitions(spark):
    df = spark.range(5000).selectExpr("id * 3 k").repartition(13)
    assert numbered(df, "k").filter("k <> position * 3").count() == 0


@pytest.mark.parametrize("per_block", [1, 2, 10_000])
def test_page_plan(spark, monkeypatch, per_block):
    monkeypatch.setattr(paging, "PAGES_PER_BLOCK", per_block)
    df = spark.createDataFrame([("a", 250), ("b", 200), ("c", 1), ("d", 0), ("e", None), ("f", 101)], "s string, total int")
    plan = {}
    for r in page_plan(df, "total", 100).collect():
        plan.setdefault(r["s"], []).append(r["offset"])
    assert {k: sorted(v) for k, v in plan.items()} == {
        "a": [0, 100, 200], "b": [0, 100], "c": [0], "d": [0], "e": [0], "f": [0, 100],
    }
    with pytest.raises(ValueError):
        page_plan(df, "total", 0)


def test_stop_at_first_empty_page(spark):
    data = [("a", 0, 5), ("a", 10, 0), ("a", 20, 3), ("b", 0, 0), ("b", 10, 1), ("b", 20, 0), (None, 0, 1), (None, 10, 0), ("c", 0, 1)]
    df = spark.createDataFrame(data, "s string, o int, n int")
    out = pages_before_first_empty(df, "s", "o", F.col("n") == 0)
    assert rows(out) == [("a", 0, 5), ("b", 0, 0), ("b", 10, 1), ("c", 0, 1), (None, 0, 1)]


def test_first_positions_start_no_python_workers(spark, monkeypatch):
    made = []
    monkeypatch.setattr(paging, "whole_numbers", lambda *a: made.append(whole_numbers(*a)) or made[-1], raising=False)
    assert rows(numbered(spark.range(10, 15), "id")) == [(i, i - 10) for i in range(10, 15)]
    assert "LocalTableScan" in made[0]._jdf.queryExecution().executedPlan().toString()
    assert whole_numbers(spark, [], "a int, b bigint").collect() == []
    assert whole_numbers(spark, [(1, None), (None, 1 << 40)], "a int, b bigint").collect() == [(1, None), (None, 1 << 40)]
