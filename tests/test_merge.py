import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from siltworks import TableContract
from siltworks.operators.keys import latest_by_contract
from siltworks.operators.merge import (
    matching_rows,
    merge_key,
    repeated_keys,
    upsert,
    upsert_by_contract,
    upsert_small,
)

SCHEMA = "id long, at string, v string"


def upsert_latest(old, rows, contract):
    return upsert_by_contract(old, latest_by_contract(rows, contract, keep_match_columns=True), contract)
BOTH = pytest.mark.parametrize("merge", [upsert, upsert_small])


@BOTH
def test_update_stale_and_insert(spark, merge):
    old = spark.createDataFrame([(1, "2024-01-02", "old"), (2, "2024-01-05", "old"), (3, "2024-01-01", "old"), (5, "2024-01-01", "old")], SCHEMA)
    new = spark.createDataFrame([(1, "2024-01-03", "new"), (2, "2024-01-04", "new"), (4, "2024-01-01", "new"), (5, "2024-01-01", "new")], SCHEMA)
    assert rows(merge(old, new, ["id"], ["at"])) == [
        (1, "2024-01-03", "new"), (2, "2024-01-05", "old"), (3, "2024-01-01", "old"),
        (4, "2024-01-01", "new"), (5, "2024-01-01", "new"),
    ]


@BOTH
def test_null_key_parts_match(spark, merge):
    schema = "id long, sub string, at string, v string"
    old = spark.createDataFrame([(1, None, "1", "old"), (1, "", "1", "old"), (0, None, "1", "old"), (None, None, "1", "old")], schema)
    new = spark.createDataFrame([(1, None, "2", "new"), (None, None, "2", "new"), (0, "", "2", "new")], schema)
    assert rows(merge(old, new, ["id", "sub"], ["at"])) == rows(
        spark.createDataFrame(
            [(1, None, "2", "new"), (1, "", "1", "old"), (0, None, "1", "old"), (None, None, "2", "new"), (0, "", "2", "new")],
            schema,
        )
    )


@BOTH
def test_null_order_values_do_not_replace(spark, merge):
    old = spark.createDataFrame([(1, None, "old"), (2, "1", "old")], SCHEMA)
    new = spark.createDataFrame([(1, "9", "new"), (2, None, "new"), (3, None, "new")], SCHEMA)
    assert rows(merge(old, new, ["id"], ["at"])) == [(1, None, "old"), (2, "1", "old"), (3, None, "new")]


@BOTH
def test_every_order_key_must_not_be_older(spark, merge):
    schema = "id int, a int, b int, v string"
    old = spark.createDataFrame([(1, 1, 5, "old"), (2, 1, 5, "old")], schema)
    new = spark.createDataFrame([(1, 2, 4, "new"), (2, 2, 5, "new")], schema)
    assert rows(merge(old, new, ["id"], ["a", "b"]).select("id", "v")) == [(1, "old"), (2, "new")]


@BOTH
def test_without_order_keys_always_replace(spark, merge):
    old, new = (spark.createDataFrame([(1, "5", v)], SCHEMA) for v in ("old", "new"))
    assert rows(merge(old, new, ["id"])) == [(1, "5", "new")]


@BOTH
def test_columns_of_one_side(spark, merge):
    old = spark.createDataFrame([(1, "1", "o1"), (2, "9", "o2"), (3, "1", "o3")], "id int, at string, only_old string")
    new = spark.createDataFrame([(1, "2", "n1"), (2, "2", "n2"), (4, "2", "n4")], "id int, at string, only_new string")
    out = merge(old, new, ["id"], ["at"])
    assert out.columns == ["id", "at", "only_old", "only_new"]
    assert rows(out) == [(1, "2", "o1", "n1"), (2, "9", "o2", None), (3, "1", "o3", None), (4, "2", None, "n4")]


@BOTH
def test_no_keys(spark, merge):
    df = spark.createDataFrame([(1, "1", "a")], SCHEMA)
    with pytest.raises(ValueError):
        merge(df, df, [], ["at"])
    with pytest.raises(ValueError):
        merge_key([])


def test_one_exchange_per_side_after_latest(spark):
    c = TableContract("t", primary_keys=("id", "sub"), deduplication_keys=("at",))
    schema = "id long, sub string, at timestamp, v string"
    old = spark.createDataFrame([(1, None, dt.datetime(2024, 1, 1), "old")], schema)
    new = spark.createDataFrame(
        [(1, None, dt.datetime(2024, 1, d), f"n{d}") for d in (1, 2)] + [(2, "x", dt.datetime(2024, 1, 1), "n")], schema
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = upsert_latest(old, new, c)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 2
    assert [r[3] for r in rows(out)] == ["n2", "n"]


def test_small_batch_does_not_shuffle_the_table(spark):
    old = spark.range(100000).selectExpr("id", "'1' at", "'o' v")
    new = spark.createDataFrame([(5, "2", "n"), (-1, "2", "n")], SCHEMA)
    out = upsert_small(old, new, ["id"], ["at"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert out.count() == 100001 and out.filter("v = 'n'").count() == 2


row = st.tuples(st.integers(0, 4), st.integers(0, 6).map(str), st.sampled_from("abc"))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(st.lists(row, min_size=1, max_size=6), min_size=1, max_size=3))
def test_result_does_not_depend_on_the_cut_into_batches(spark, batches):
    """With one order key, and equal rows for equal (key, order), any cut gives the same table."""
    c = TableContract("t", primary_keys=("id",), deduplication_keys=("at",))
    whole = [(k, o, f"{k}-{o}") for b in batches for k, o, _ in b]
    expected = {}
    for k, o, v in whole:
        if k not in expected or expected[k][0] <= o:
            expected[k] = (o, v)
    table = spark.createDataFrame([], SCHEMA)
    for b in batches + batches[-1:]:  # the last one twice: an upsert is idempotent
        table = upsert_latest(table, spark.createDataFrame([(k, o, f"{k}-{o}") for k, o, _ in b], SCHEMA), c)
    assert rows(table) == sorted((k, o, v) for k, (o, v) in expected.items())


def test_repeated_keys(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x"), (2, "x")], "id int, sub string")
    assert rows(repeated_keys(df, ["id", "sub"])) == [(1, None, 2)]


def test_null_hashes_never_match(spark):
    df = spark.createDataFrame([(1, "h"), (2, None), (3, "h"), (4, None), (5, "z"), (6, "h")], "id int, h string")
    assert rows(matching_rows(df, "h", "id")) == [("h", 3, 1, 6, 3)]


def test_a_batch_that_measures_large_is_not_broadcast(spark, monkeypatch):
    old = spark.createDataFrame([([1], "1", "old"), (None, "1", "old"), ([2], "5", "old")], "id array<long>, at string, v string")
    new = spark.createDataFrame([([1], "2", "new"), (None, "0", "new"), ([3], "1", "new")], "id array<long>, at string, v string")
    wanted = rows(upsert(old, new, ["id"], ["at"]))
    plans = []
    for limit in (1 << 20, 0):
        monkeypatch.setattr("siltworks.operators.merge.SMALL_TEXT_BYTES", limit)
        merged = upsert_small(old, new, ["id"], ["at"])
        plans.append(merged._jdf.queryExecution().optimizedPlan().toString())
        assert rows(merged) == wanted
    assert "strategy=broadcast" in plans[0] and "strategy=broadcast" not in plans[1]
