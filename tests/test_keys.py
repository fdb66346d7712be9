import datetime as dt

import pytest

from conftest import rows
from siltworks import TableContract
from siltworks.operators.keys import latest_per_key, require_contract_keys, require_keys

ROWS = [("1", "a"), ("2", None), (None, "b"), ("  ", "c"), ("", None), (None, None), ("3", " ")]


def test_or_within_a_group_and_across_groups(spark):
    df = spark.createDataFrame(ROWS, "id string, sub string")
    assert rows(require_keys(df, [["id"]])) == [("1", "a"), ("2", None), ("3", " ")]
    assert rows(require_keys(df, [["id", "sub"]])) == rows(
        spark.createDataFrame([r for r in ROWS if any(v and v.strip() for v in r)], df.schema)
    )
    assert rows(require_keys(df, [["id"], ["sub"]])) == [("1", "a")]
    assert require_keys(df, []) is df
    assert require_keys(df, [[], []]) is df
    assert rows(require_keys(df, [[], ["sub"]])) == rows(df.filter("trim(sub) <> ''"))


def test_numbers_need_only_be_there(spark):
    df = spark.createDataFrame([(0,), (None,), (5,)], "n int")
    assert rows(require_keys(df, [["n"]])) == [(0,), (5,)]


def test_unknown_column(spark):
    with pytest.raises(ValueError, match="nope"):
        require_keys(spark.range(1), [["id", "nope"]])


def test_groups_from_contract(spark):
    df = spark.createDataFrame(
        [("1", None, "x"), (None, None, "x"), ("1", "2", None), ("", "2", "y")], "p string, q string, d string"
    )
    c = TableContract("t", primary_keys=("p", "q"), deduplication_keys=("d",))
    assert rows(require_contract_keys(df, c)) == [("", "2", "y"), ("1", None, "x")]
    assert require_contract_keys(df, TableContract("t")) is df


def at(day):
    return dt.datetime(2024, 1, day)


def test_latest_nulls_last(spark):
    df = spark.createDataFrame(
        [("a", at(1), 1), ("a", at(3), 2), ("a", None, 3), ("b", None, 4), (None, at(2), 5), (None, at(1), 6)],
        "id string, ts timestamp, v int",
    )
    assert rows(latest_per_key(df, ["id"], ["ts"]).select("id", "v")) == [("a", 2), ("b", 4), (None, 5)]


def test_several_order_keys_are_lexicographic(spark):
    df = spark.createDataFrame([(1, 5, 1, "x"), (1, 5, 2, "y"), (1, 4, 9, "z")], "k int, a int, b int, v string")
    assert rows(latest_per_key(df, ["k"], ["a", "b"]).select("v")) == [("y",)]


def test_ties_have_one_winner_whatever_the_order(spark):
    data = [(1, 7, f"v{i}", {"m": str(i)}) for i in range(40)]
    schema = "k int, o int, v string, m map<string,string>"
    winners = {
        tuple(latest_per_key(spark.createDataFrame(d, schema).repartition(p), ["k"], ["o"]).first()["m"].items())
        for d, p in ((data, 1), (data[::-1], 5), (data[7:] + data[:7], 3))
    }
    assert winners == {(("m", "9"),)}


def test_whole_frame_must_be_asked_for(spark):
    df = spark.createDataFrame([(1, 2), (2, 9), (3, 4)], "v int, o int")
    with pytest.raises(ValueError):
        latest_per_key(df, [], ["o"])
    assert rows(latest_per_key(df, [], ["o"], whole_frame=True)) == [(2, 9)]


def test_without_order_keys_the_tie_break_decides(spark):
    df = spark.createDataFrame([(1, "a"), (1, "c"), (1, "b")], "k int, v string")
    assert rows(latest_per_key(df, ["k"], [])) == [(1, "c")]


def test_limit_runs_before_the_exchange(spark):
    df = spark.range(1000).selectExpr("id % 3 k", "id o")
    plan = latest_per_key(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    head, _, below = plan.partition("Exchange hashpartitioning")
    assert "WindowGroupLimit" in head and "WindowGroupLimit" in below and "Partial" in below


def test_match_columns_tell_null_from_its_stand_in(spark):
    df = spark.createDataFrame([(None, 1), ("", 2), (None, 3)], "k string, o int")
    out = latest_per_key(df, ["k"], ["o"], keep_match_columns=True).select("k", "o")
    assert rows(out) == [("", 2), (None, 3)]


def test_rows_sorted_once_give_the_same_latest(spark):
    df = spark.createDataFrame([(None, 1, "a", 2.0), (None, 1, "b", 1.0), (3, 9, None, None), (3, 4, "c", 5.0), (0, 1, "d", 0.0)], "K long, o int, v string, x double")
    for order in (["o"], ["o", "K"], []):
        first = latest_per_key(df, ["k"], order, keep_match_columns=True)
        once = latest_per_key(df, ["k"], order, keep_match_columns=True, limit_first=False)
        assert once.columns == first.columns and rows(once) == rows(first)
        assert "WindowGroupLimit" not in once._jdf.queryExecution().executedPlan().toString()
        assert rows(latest_per_key(df, ["k"], order, limit_first=False)) == rows(latest_per_key(df, ["k"], order))
