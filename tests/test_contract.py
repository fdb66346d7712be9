import pytest

from siltworks import ColumnContract, ContractError, TableContract, contract_from_dict, load_contract
from siltworks.contract import check_expression, check_expression_on
from siltworks.operators.mapping import apply_contract, check_producible

DOCUMENT = """
version: 1.0
table:
  name: people
  description: "People we know"
  tags: {owner__tech: us}
  primary_keys: [id]
  deduplication_keys: [seen]
  clustering_keys: [seen]
  key_buckets: 16
  unknown_key: ignored
  flatten_config:
    cols_to_explode: [list]
    cols_to_exclude: [_metadata]
    explode_with_index_col: true
  columns:
    - {name: id, type: string}
    - {name: email, type: string, source_col_name: mail, create_hashed_col: true, tags: {pii: yes}}
    - {name: seen, type: timestamp, transform: "to_timestamp(seen_text)", description: "Last seen"}
"""


def test_yaml(tmp_path):
    path = tmp_path / "people.yml"
    path.write_text(DOCUMENT)
    c = load_contract(str(path))
    assert c.output_names == ["id", "email", "email_hashed_key", "seen"]
    assert c.hashed_columns == ["email"]
    assert c.key_groups == [["id"], ["seen"]]
    assert c.flatten.explode == ("list",) and c.flatten.keep == ("_metadata",) and c.flatten.with_index
    assert c.columns[2].transform == "to_timestamp(seen_text)" and c.tags == {"owner__tech": "us"}
    assert c.key_buckets == 16


@pytest.mark.parametrize(
    "document",
    [
        {"version": 1.0},
        {"table": {"name": "t"}},
        {"version": "one", "table": {"name": "t"}},
        {"version": 1, "table": {}},
        {"version": 1, "table": {"name": "t", "columns": [{"name": "c"}]}},
        {"version": 1, "table": {"name": "t", "columns": [{"type": "string"}]}},
        {"version": 1, "table": {"name": "t", "columns": [{"name": "c", "type": "int", "transform": ""}]}},
    ],
)
def test_bad_documents(document):
    with pytest.raises(ContractError):
        contract_from_dict(document)


def test_minimal_document():
    c = contract_from_dict({"version": 1, "table": {"name": "t"}})
    assert c.output_names == [] and c.flatten is None and c.key_groups == []


@pytest.mark.parametrize(
    "text",
    [
        "concat(first, ' ', last)",
        "upper(first)",
        "a + b * 2",
        "case when a > 1 then 'x' else first end",
        "transform(array(a, b), v -> v + 1)[0]",
    ],
)
def test_expressions_that_pass(spark, text):
    df = spark.createDataFrame([], "first string, last string, a int, b int")
    assert check_expression(text, "t") == text
    check_expression_on(df, text, "t")


@pytest.mark.parametrize(
    "text",
    [
        "", "   ", None, "a; b", "a -- note", "a /* note */", "a */", "concat(a, ';')",
        "alter view v rename to w", "insert into t values (1)", "refresh everything", "a +",
        "concat(a, b", "a as b", "a, b",
    ],
)
def test_expressions_that_are_refused(spark, text):
    with pytest.raises(ContractError):
        check_expression(text, "t")


@pytest.mark.parametrize(
    "text",
    ["(select 1)", "exists(select 1)", "a in (select 1)", "sum(a)", "explode(array(a))", "missing + 1",
     "no_such_function(a)"],
)
def test_expressions_that_give_no_single_value_per_row(spark, text):
    df = spark.createDataFrame([], "a int")
    with pytest.raises(ContractError):
        check_expression_on(df, text, "t")


def contract(*columns):
    return TableContract("t", columns=columns)


def test_source_target_and_order(spark):
    df = spark.createDataFrame([(1, "x", "keep")], "a int, `B` string, c string")
    c = contract(
        ColumnContract("a2", "long", source="a"),
        ColumnContract("b", "string", source="B"),
        ColumnContract("c", "string", source="absent"),
        ColumnContract("again", "string", source="a2"),
    )
    out = apply_contract(df, c)
    assert out.columns == ["a2", "b", "c", "again"]
    assert out.first() == (1, "x", "keep", "1")


def test_later_columns_see_earlier_results(spark):
    df = spark.createDataFrame([(10, 3)], "a int, b int")
    c = contract(
        ColumnContract("a", "int", transform="a + b"),
        ColumnContract("twice", "int", transform="a * 2"),
        ColumnContract("b", "int", source="a"),
        ColumnContract("last", "int", transform="a + b + twice"),
    )
    assert apply_contract(df, c).first() == (13, 26, 13, 52)


def test_transform_wins_over_source(spark):
    df = spark.createDataFrame([("ann", "lee")], "first string, last string")
    c = contract(
        ColumnContract("name", "string", source="nowhere", transform="concat(first, ' ', upper(last))")
    )
    assert apply_contract(df, c).first() == ("ann LEE",)


def test_a_random_value_and_its_hash_agree(spark):
    from siltworks.functions.columns import pii_hash
    from pyspark.sql import functions as F

    c = contract(ColumnContract("token", "string", transform="uuid()", hashed=True))
    out = apply_contract(spark.range(50), c)
    assert out.filter(pii_hash(F.col("token")) != F.col("token_hashed_key")).count() == 0


def test_number_to_date(spark):
    df = spark.createDataFrame([(20240229,), (None,)], "d int")
    c = contract(ColumnContract("day", "date", transform="to_date(d, 'yyyyMMdd')"))
    assert [str(r[0]) for r in apply_contract(df, c).collect()] == ["2024-02-29", "None"]


def test_hash_follows_cast_and_keeps_null(spark):
    import hashlib

    df = spark.createDataFrame([("007", "a@b"), ("1", None)], "n string, mail string")
    c = contract(
        ColumnContract("n", "int", hashed=True), ColumnContract("mail", "string", hashed=True)
    )
    out = apply_contract(df, c).collect()
    assert out[0]["n_hashed_key"] == hashlib.sha256(b"7").hexdigest()
    assert out[0]["mail_hashed_key"] == hashlib.sha256(b"a@b").hexdigest()
    assert out[1]["mail_hashed_key"] is None
    assert list(out[0].asDict()) == ["n", "n_hashed_key", "mail", "mail_hashed_key"]


def test_missing_source_fails_before_any_job(spark):
    df = spark.createDataFrame([(1,)], "a int")
    c = contract(ColumnContract("x", "int", source="nope"), ColumnContract("y", "int"))
    with pytest.raises(ContractError, match=r"\['x', 'y'\]"):
        check_producible(df, c)
    with pytest.raises(ContractError):
        apply_contract(df, c)


def test_bad_values(spark):
    df = spark.createDataFrame([("12",), ("twelve",)], "v string")
    c = contract(ColumnContract("v", "int"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply_contract(df, c).collect()
    assert [r[0] for r in apply_contract(df, c, on_error="null").collect()] == [12, None]
    with pytest.raises(ValueError):
        apply_contract(df, c, on_error="ignore")


def test_one_projection_for_a_plain_contract(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    c = contract(*[ColumnContract(f"c{i}", "long", source="a" if i % 2 else "b") for i in range(30)])
    plan = apply_contract(df, c)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 1
