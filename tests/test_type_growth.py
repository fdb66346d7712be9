"""Types that grow from batch to batch, columns without values, headers with repeated names."""

import pytest
from pyspark.sql import types as T

from conftest import rows
from siltworks.sources.landing import Landing, infer_schema, is_evident, landing_batch, widened
from siltworks.streaming.ingest import BronzeTarget, bronze_stream, ingest, read_bronze

from test_ingest import drop


@pytest.fixture
def places(tmp_path, table_name):
    def make(file_format, **kw):
        return (
            Landing(str(tmp_path / "land"), file_format, str(tmp_path / "schema"), **kw),
            BronzeTarget(str(tmp_path / "bronze"), str(tmp_path / "ckpt"), table=table_name),
        )

    return make


D = T.DecimalType


@pytest.mark.parametrize(
    "known, seen, grown",
    [
        (T.IntegerType(), T.LongType(), T.LongType()),
        (T.LongType(), T.IntegerType(), T.LongType()),
        (T.IntegerType(), T.DoubleType(), T.DoubleType()),
        (T.FloatType(), T.DoubleType(), T.DoubleType()),
        (T.DoubleType(), T.LongType(), T.DoubleType()),
        (T.LongType(), T.DoubleType(), D(38, 18)),
        (T.LongType(), D(25, 0), D(25, 0)),
        (T.IntegerType(), D(5, 2), D(12, 2)),
        (D(10, 2), D(8, 4), D(12, 4)),
        (D(38, 0), T.DoubleType(), D(38, 0)),
        (D(25, 0), T.DoubleType(), D(38, 13)),
        (T.LongType(), T.StringType(), T.LongType()),
        (T.StringType(), T.LongType(), T.StringType()),
        (T.BooleanType(), T.LongType(), T.BooleanType()),
        (T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType()), T.ArrayType(T.LongType(), True)),
    ],
)
def test_lattice(known, seen, grown):
    assert widened(known, seen) == grown and widened(grown, known) == grown and widened(grown, grown) == grown


def test_header_only_then_small_then_large(spark, places, table_name):
    landing, target = places("csv")
    for name, text in (("a", "id,amount,note\n"), ("b", "id,amount,note\n1,5,\n"), ("c", "id,amount,note\n3000000000,5.75,x\n"), ("d", "id,amount\n2,6\n")):
        drop(landing, f"{name}.csv", text)
        ingest(spark, landing, target)
    out = read_bronze(spark, target).select("id", "amount", "note", "_rescued_data")
    assert rows(out) == [(1, 5.0, None, None), (2, 6.0, None, None), (3000000000, 5.75, "x", None)]
    assert rows(spark.newSession().table(table_name).select("id", "amount", "note")) == rows(out.drop("_rescued_data"))


def test_json_numbers_at_every_depth(spark, places, table_name):
    landing, target = places("json")
    drop(landing, "a.json", '{"n": 9007199254740993, "s": {"x": 1}, "l": [{"p": 1}], "z": null}')
    ingest(spark, landing, target)
    assert "z" in read_bronze(spark, target).columns
    drop(landing, "b.json", '{"n": 5.75, "s": {"x": 2.5}, "l": [{"p": 0.5}], "z": {"deep": true}}')
    drop(landing, "c.json", '{"n": 123456789012345678901234567890, "s": null}', hour="08")
    ingest(spark, landing, target)
    out = read_bronze(spark, target).selectExpr("n", "s.x", "l[0].p", "z.deep", "_rescued_data IS NOT NULL")
    got = rows(out)
    assert [(str(n).rstrip("0").rstrip("."), x and float(x), p and float(p), d) for n, x, p, d, _ in got if n is not None] == [
        ("5.75", 2.5, 0.5, True), ("9007199254740993", 1.0, 1.0, None),
    ]
    assert [r for r in got if r[0] is None] == [(None, None, None, None, True)] or len(got) == 3
    assert spark.newSession().table(table_name).count() == 3


def test_a_stream_over_grown_types(spark, places, tmp_path):
    landing, target = places("csv")
    drop(landing, "a.csv", "id,v\n1,2\n")
    ingest(spark, landing, target)
    drop(landing, "b.csv", "id,v\n3000000000,2.5\n")
    ingest(spark, landing, target)
    seen = []
    query = (
        bronze_stream(spark, target).select("id", "v").writeStream.foreachBatch(lambda df, _: seen.extend(map(tuple, df.collect())))
        .option("checkpointLocation", str(tmp_path / "down")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(seen) == [(1, 2.0), (3000000000, 2.5)]


@pytest.mark.parametrize("header, names", [("id,name,name", ["id", "name", "name_1"]), ("Id,ID,id_1", ["Id", "ID_2", "id_1"]), ('"a,b","a,b"', ["a,b", "a,b_1"])])
def test_repeated_header_names(spark, places, header, names):
    landing, target = places("csv")
    drop(landing, "a.csv", f"{header}\n" + ",".join("123"[: len(names)]) + "\n")
    drop(landing, "b.csv", f"{header}\n" + ",".join("456"[: len(names)]) + "\n")
    assert landing_batch(spark, landing).columns[: len(names)] == names
    ingest(spark, landing, target)
    out = read_bronze(spark, target)
    assert rows(out.select(*out.columns[: len(names)])) == [(1, 2, 3)[: len(names)], (4, 5, 6)[: len(names)]]
    drop(landing, "c.csv", f"{names[0] if ',' not in names[0] else 'other'}\n9\n")
    ingest(spark, landing, target)
    assert read_bronze(spark, target).count() == 3


def test_marks_of_columns_without_values(spark, places):
    landing, target = places("csv")
    drop(landing, "a.csv", "id,empty\n1,\n")
    schema = landing_batch(spark, landing).schema
    assert is_evident(schema["id"]) and not is_evident(schema["empty"])
    ingest(spark, landing, target)
    assert "empty" in read_bronze(spark, target).columns
    plain = Landing(landing.path, "csv", infer_types=False)
    assert all(is_evident(f) for f in landing_batch(spark, plain).schema.fields) and infer_schema(spark, plain).names == ["id", "empty"]
