import pytest

from conftest import rows
from siltworks.operators.flatten import flatten

ITEM = "struct<id:int,nested:struct<level:string>>"


def test_structs_to_any_depth_in_place(spark):
    df = spark.sql("select 1 a, named_struct('b', named_struct('c', 2, 'd', 'x'), 'e', 3) s, 4 z")
    out = flatten(df)
    assert out.columns == ["a", "s__b__c", "s__b__d", "s__e", "z"]
    assert out.first() == (1, 2, "x", 3, 4)


def test_kept_and_unlisted_columns_pass(spark):
    df = spark.sql(
        """select named_struct('f', 1) meta, array(named_struct('x', 1)) arr, array(1, 2) nums,
                  map('k', 'v') m, named_struct('in', named_struct('y', 1), 'q', 2) s"""
    )
    out = flatten(df, keep=["meta", "s__in"])
    assert out.columns == ["meta", "arr", "nums", "m", "s__in", "s__q"]


def test_explode_in_place_and_vanishing_rows(spark):
    df = spark.createDataFrame(
        [(1, [(10, ("p",)), (11, None)], "t"), (2, [], "u"), (3, None, "v")],
        f"id int, items array<{ITEM}>, tail string",
    )
    out = flatten(df, explode=["items"])
    assert out.columns == ["id", "items__id", "items__nested__level", "tail"]
    assert rows(out) == [(1, 10, "p", "t"), (1, 11, None, "t")]
    assert flatten(df, explode=["items"], outer=True).count() == 4


def test_index_goes_to_the_end(spark):
    df = spark.createDataFrame([(1, [(10, ("p",)), (11, ("q",))], "t")], f"id int, items array<{ITEM}>, tail string")
    out = flatten(df, explode=["items"], with_index=True)
    assert out.columns == ["id", "tail", "items__index", "items__id", "items__nested__level"]
    assert rows(out) == [(1, "t", 0, 10, "p"), (1, "t", 1, 11, "q")]


def test_two_arrays_give_their_product(spark):
    df = spark.sql(
        """select 7 id, array(named_struct('a', 1), named_struct('a', 2), named_struct('a', 3)) l,
                  array(named_struct('b', 'x'), named_struct('b', 'y')) r"""
    )
    out = flatten(df, explode=["l", "r"])
    assert out.columns == ["id", "l__a", "r__b"]
    assert rows(out) == sorted((7, a, b) for a in (1, 2, 3) for b in "xy")


def test_arrays_inside_exploded_structs(spark):
    df = spark.sql(
        """select named_struct('list', array(
                    named_struct('id', 1, 'in', array(named_struct('v', 'a'), named_struct('v', 'b'))),
                    named_struct('id', 2, 'in', array(named_struct('v', 'c'))))) doc"""
    )
    out = flatten(df, explode=["doc__list", "doc__list__in"])
    assert out.columns == ["doc__list__id", "doc__list__in__v"]
    assert rows(out) == [(1, "a"), (1, "b"), (2, "c")]


def test_last_round_array_is_exploded_too(spark):
    df = spark.sql("select array(named_struct('a', array(named_struct('v', 1), named_struct('v', 2)))) l")
    assert rows(flatten(df, explode=["l", "l__a"])) == [(1,), (2,)]


def test_clashing_names(spark):
    with pytest.raises(ValueError, match="a__b"):
        flatten(spark.sql("select named_struct('b', 1) a, 2 a__b"))
    with pytest.raises(ValueError, match="l__index"):
        flatten(spark.sql("select array(named_struct('v', 1)) l, 2 l__index"), explode=["l"], with_index=True)


def test_names_with_dots(spark):
    df = spark.sql("select named_struct('a.b', 1, 'c d', named_struct('e.f', 2)) `s.t`")
    out = flatten(df)
    assert out.columns == ["s.t__a.b", "s.t__c d__e.f"] and out.first() == (1, 2)


def test_empty_array_list_keeps_the_frame(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert rows(flatten(df)) == [(1, "x")]


def test_only_needed_leaves_are_read(spark, tmp_path):
    spark.sql(
        """select id, array(named_struct('v', id, 'wide', 'xxx', 'other', 'yyy')) l,
                  array(named_struct('w', 1)) unused from range(10)"""
    ).write.parquet(str(tmp_path / "t"))
    flat = flatten(spark.read.parquet(str(tmp_path / "t")), explode=["l"]).select("id", "l__v")
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,l:array<struct<v:bigint>>>" in plan
