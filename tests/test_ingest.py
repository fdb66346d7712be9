import json

import pytest

from conftest import rows
from siltworks.functions.columns import with_audit_columns
from siltworks.sources.landing import Landing, infer_schema, landing_batch, remembered_schema
from siltworks.streaming.ingest import (
    BronzeTarget, bronze_frame, bronze_stream, ingest, name_bronze, read_bronze,
)


@pytest.fixture
def places(tmp_path):
    def make(file_format, **kw):
        return (
            Landing(str(tmp_path / "land"), file_format, str(tmp_path / "schema"), **kw),
            BronzeTarget(str(tmp_path / "bronze"), str(tmp_path / "ckpt")),
        )

    return make


def drop(landing, name, text, day="20240101", hour="07"):
    from pathlib import Path

    folder = Path(landing.path) / day / hour
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_each_file_once_and_restart(spark, places):
    landing, target = places("json")
    drop(landing, "a.json", '{"id": 1, "name": "x"}\n{"id": 2, "name": "y"}')
    ingest(spark, landing, target)
    ingest(spark, landing, target)
    assert rows(read_bronze(spark, target).select("id", "name")) == [(1, "x"), (2, "y")]
    drop(landing, "b.json", '{"id": 3, "name": "z", "price": 12.5}', day="20240102")
    ingest(spark, landing, target)
    out = read_bronze(spark, target)
    assert rows(out.select("id", "name", "price")) == [(1, "x", None), (2, "y", None), (3, "z", 12.5)]
    assert rows(out.select("_metadata.file_name").distinct()) == [("a.json",), ("b.json",)]
    assert set(out.columns) >= {"_raw_data", "_ingested_at", "_ingestion_date", "_metadata", "_rescued_data"}
    raw = {r["id"]: json.loads(r["_raw_data"]) for r in out.collect()}
    assert raw[3] == {"id": 3, "name": "z", "price": 12.5}


def test_multi_line_documents(spark, places):
    landing, target = places("json", options={"multiLine": "true"})
    drop(landing, "p1.json", json.dumps({"total": 2, "items": [{"id": "a", "n": {"v": 1}}]}, indent=2))
    drop(landing, "p2.json", json.dumps({"total": 2, "items": []}, indent=2), hour="08")
    ingest(spark, landing, target)
    out = read_bronze(spark, target)
    assert rows(out.selectExpr("total", "size(items)")) == [(2, 0), (2, 1)]


@pytest.mark.parametrize("sep", ["\t", ",", "|"])
def test_csv_separators_and_types(spark, places, sep):
    landing, target = places("csv", options={"sep": sep})
    drop(landing, "a.csv", sep.join(["Line No", "a.b", "Amount"]) + "\n" + sep.join(["1", "x", "2.5"]) + "\n")
    ingest(spark, landing, target)
    out = read_bronze(spark, target)
    assert out.columns[:3] == ["Line_No", "a_b", "Amount"]
    assert rows(out.select("Line_No", "a_b", "Amount")) == [(1, "x", 2.5)]


@pytest.mark.parametrize("file_format", ["csv", "json"])
def test_types_can_be_left_as_text(spark, places, file_format):
    landing, _ = places(file_format, infer_types=False)
    drop(landing, "a", "id,v\n1,2.5\n" if file_format == "csv" else '{"id": 1, "v": 2.5}')
    assert [f.dataType.simpleString() for f in infer_schema(spark, landing).fields] == ["string", "string"]


def test_csv_layouts_are_read_by_name(spark, places):
    """Other orders, more and fewer columns, in one run and in a later one."""
    landing, target = places("csv")
    drop(landing, "a.csv", "id,v\n1,x\n")
    drop(landing, "b.csv", "v,id\ny,2\n")
    drop(landing, "c.csv", "id,v,w\n3,z,7\n")
    drop(landing, "empty.csv", "")
    ingest(spark, landing, target)
    drop(landing, "d.csv", "w,id\n8,4\n")
    ingest(spark, landing, target)
    assert rows(read_bronze(spark, target).select("id", "v", "w")) == [(1, "x", None), (2, "y", None), (3, "z", 7), (4, None, 8)]


def test_late_files_and_their_fields(spark, places):
    import os
    import time

    landing, target = places("json")
    drop(landing, "a.json", '{"a": 1}')
    ingest(spark, landing, target)
    for name, text, hours in (("b.json", '{"a": 2, "new": "x"}', 2), ("c.json", '{"a": 3, "s": {"t": 1}}', 9 * 24)):
        drop(landing, name, text)
        then = time.time() - hours * 3600
        os.utime(f"{landing.path}/20240101/07/{name}", (then, then))
    ingest(spark, landing, target)
    assert rows(read_bronze(spark, target).select("a", "new", "s.t")) == [(1, None, None), (2, "x", None), (3, None, 1)]


def test_fields_that_arrive_while_a_stream_runs(spark, places):
    from siltworks.streaming.ingest import start_ingest

    landing, target = places("json")
    drop(landing, "a.json", '{"a": 1}')
    query = start_ingest(spark, landing, BronzeTarget(target.path, target.checkpoint, available_now=False))
    try:
        query.processAllAvailable()
        drop(landing, "b[1].json", '{"a": 2, "later": true}')
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(read_bronze(spark, target).select("a", "later")) == [(1, None), (2, True)]


def test_bronze_in_the_catalog(spark, places, table_name):
    landing, target = places("json")
    target = BronzeTarget(target.path, target.checkpoint, table=table_name)
    for i, text in enumerate(('{"id": 1, "s": {"x": 1}}', '{"id": 2, "more": "m", "s": {"x": 2}}', '{"id": 3, "s": {"y": "n"}}')):
        drop(landing, f"{i}.json", text)
        ingest(spark, landing, target)
        assert spark.newSession().table(table_name).count() == i + 1
    out = spark.newSession().table(table_name)
    assert rows(out.select("id", "more", "s.x", "s.y")) == [(1, None, 1, None), (2, "m", 2, None), (3, None, None, "n")]


def test_values_that_do_not_fit_are_kept_beside(spark, places):
    landing, target = places("json")
    drop(landing, "a.json", '{"id": 1, "n": 5}')
    ingest(spark, landing, target)
    drop(landing, "b.json", '{"id": 2, "n": "five"}')
    ingest(spark, landing, target)
    assert rows(read_bronze(spark, target).select("id", "n", "_rescued_data")) == [
        (1, 5, None), (2, None, '{"id": 2, "n": "five"}'),
    ]


def test_nested_fields_grow(spark, places):
    landing, target = places("json")
    drop(landing, "a.json", '{"s": {"x": 1}, "l": [{"p": 1}]}')
    ingest(spark, landing, target)
    drop(landing, "b.json", '{"s": {"y": "t"}, "l": [{"q": true}]}')
    ingest(spark, landing, target)
    out = read_bronze(spark, target).selectExpr("s.x", "s.y", "l[0].p", "l[0].q")
    assert rows(out) == [(1, None, 1, None), (None, "t", None, True)]


def test_remembered_schema_and_no_files(spark, places):
    landing, target = places("json")
    drop(landing, "none.json", "")
    ingest(spark, landing, target)
    with pytest.raises(ValueError):
        landing_batch(spark, landing)
    drop(landing, "a.json", '{"id": 1}')
    assert landing_batch(spark, landing).columns == ["id", "_rescued_data"]
    drop(landing, "b.json", '{"other": 1}')
    assert landing_batch(spark, landing).columns == ["id", "other", "_rescued_data"]
    assert remembered_schema(spark, landing, None).names == ["id", "other"]
    assert landing_batch(spark, landing).count() == 2


def test_bad_format():
    with pytest.raises(ValueError, match="xml"):
        Landing("p", "xml")


def test_audit_columns(spark):
    df = spark.createDataFrame([(1, "x", None)], "id int, name string, gone string")
    out = with_audit_columns(df, provenance=False)
    assert out.columns == ["id", "name", "gone", "_raw_data", "_ingested_at", "_ingestion_date"]
    assert out.first()["_raw_data"] == '{"id":1,"name":"x"}'
    kept = with_audit_columns(df.selectExpr("*", "named_struct('file_name', 'f') _metadata"))
    assert kept.first()["_raw_data"] == '{"id":1,"name":"x"}' and kept.first()["_metadata"][0] == "f"


def test_bronze_by_name(spark, places):
    landing, target = places("json")
    drop(landing, "a.json", '{"id": 1}')
    ingest(spark, landing, target)
    name_bronze(spark, target, "bronze_by_name")
    assert rows(spark.table("bronze_by_name").select("id")) == [(1,)]
    drop(landing, "b.json", '{"id": 2, "more": "m"}')
    ingest(spark, landing, target)
    name_bronze(spark, target, "bronze_by_name")
    assert rows(spark.table("bronze_by_name").select("id", "more")) == [(1, None), (2, "m")]


def test_bronze_can_be_streamed_on(spark, places):
    landing, target = places("json")
    drop(landing, "a.json", '{"id": 1}')
    ingest(spark, landing, target)
    assert bronze_stream(spark, target).isStreaming
    assert bronze_frame(landing_batch(spark, landing)).columns[-1] == "_metadata"


def test_keys_that_differ_by_case_only(spark, places):
    landing, target = places("json", case_sensitive=True)
    drop(landing, "a.json", '{"id": 1, "ID": "one", "v": true}')
    ingest(spark, landing, target)
    out = read_bronze(spark, target)
    assert rows(out.select("ID", "id_1", "v")) in ([("one", 1, True)], [(1, "one", True)])
    assert json.loads(out.first()["_raw_data"]) == {"id": 1, "ID": "one", "v": True}


def test_landed_file_names():
    import datetime as dt

    from siltworks.sources.landing import landed_file

    now = dt.datetime(2024, 1, 2, 23, 4, 5, tzinfo=dt.timezone(dt.timedelta(hours=-2)))
    assert landed_file("/land/", "places", 300, now) == "/land/20240103/01/places_20240103010405_300.json"


def test_landed_arrays_stay_small_whatever_the_table(spark, tmp_path, monkeypatch):
    from checks import landing as checks_landing

    docs = spark.range(400).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'en' AS lang", "'web' AS source", "8L AS n_chars")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(checks_landing, "ARRAY_BYTES", 300)
    monkeypatch.setattr(checks_landing, "work_folder", lambda spark, label: f"{tmp_path}/{label}")
    assert rows(checks_landing.ingest_multi_line(spark, str(tmp_path))) == rows(docs)
    landed = list((tmp_path / "q02b/landing/20240101/00").glob("part-*"))
    assert len(landed) > 8
