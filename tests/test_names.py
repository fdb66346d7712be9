import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltworks.functions.names import rename, safe_name, safe_names, with_safe_names


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("plain", "plain"),
        ("Two Words", "Two_Words"),
        ("  padded  ", "padded"),
        ("a.b-c/d", "a_b_c_d"),
        ("tab\tand\nline", "tab_and_line"),
        ("price (£)", "price_"),
        ("_lead", "_lead"),
        ("a__b", "a__b"),
        ("9lives", "9lives"),
        ("ÄÖ", "col"),
        ("???", "col"),
        ("___", "col"),
        ("", "col"),
        (None, "col"),
    ],
)
def test_one_name(name, expected):
    assert safe_name(name) == expected


def test_names_become_unique_without_regard_to_case():
    given_names = ["Net Weight", "net_weight", "NET/WEIGHT", "2nd row", "%", "col", "Net.Weight_1"]
    assert safe_names(given_names) == [
        "Net_Weight", "net_weight_1", "NET_WEIGHT_2", "2nd_row", "col", "col_1", "Net_Weight_1_1"
    ]


def test_suffix_skips_taken_names():
    assert len({n.lower() for n in safe_names(["x_1", "x", "X", "x"])}) == 4


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=6), max_size=12))
def test_names_are_always_safe_and_unique(names):
    out = safe_names(names)
    assert len({n.lower() for n in out}) == len(names)
    assert all(n.replace("_", "").isascii() and n.replace("_", "").isalnum() for n in out)


def test_frame_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`A B` int, `a.b` int, ok int")
    assert with_safe_names(df).columns == ["A_B", "a_b_1", "ok"]
    assert with_safe_names(df).first() == (1, 2, 3)
    clean = spark.createDataFrame([(1,)], "ok int")
    assert with_safe_names(clean) is clean


def test_rename(spark):
    df = spark.createDataFrame([(1, "v")], "id long, val string")
    assert rename(df, {"id": "key", "val": "val"}).columns == ["key", "val"]
    with pytest.raises(ValueError, match=r"\['gone', 'lost'\]"):
        rename(df, {"gone": "x", "id": "y", "lost": "z"})
