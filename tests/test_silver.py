import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import rows
from siltworks import ColumnContract, FlattenContract, TableContract
from siltworks.plans.silver import build_fan_out, build_silver, cleaned_rows, fan_out, latest_rows, merged_silver, silver_frame, store_silver
from siltworks.sinks import store as store_module
from siltworks.sinks.store import StoredTable
from siltworks.streaming.silver import start_silver, start_silver_fan_out

PLACES = TableContract(
    "places",
    primary_keys=("place_id",),
    deduplication_keys=("modified_at",),
    flatten=FlattenContract(explode=("places",), keep=("_metadata",)),
    columns=(
        ColumnContract("place_id", "string", source="places__spot__id"),
        ColumnContract("name", "string", source="places__spot__name", hashed=True),
        ColumnContract("country", "string", source="places__spot__land__code"),
        ColumnContract("modified_at", "timestamp", source="places__audit__modified"),
    ),
)


def page(*places):
    return {
        "places": [
            {"spot": {"id": i, "name": n, "land": {"code": c}}, "audit": {"modified": m}} for i, n, c, m in places
        ],
        "total": len(places),
    }


SCHEMA = """places array<struct<spot: struct<id: string, name: string, land: struct<code: string>>,
            audit: struct<modified: string>>>, total bigint, stamp string, _metadata struct<file_name: string>"""


def bronze(spark, *pages):
    data = [
        ([((p["spot"]["id"], p["spot"]["name"], (p["spot"]["land"]["code"],)), (p["audit"]["modified"],)) for p in doc["places"]],
         doc["total"], stamp, (f"f{i}.json",))
        for i, (stamp, doc) in enumerate(pages)
    ]
    df = spark.createDataFrame(data, SCHEMA)
    return df.selectExpr("places", "total", "cast(stamp as timestamp) _ingested_at", "_metadata")


P1 = ("2024-01-01", page(("a", "Alpha", "GB", "2024-01-01T00:00:00Z"), ("b", "Beta", "FR", "2024-01-02T00:00:00Z"),
                         ("", "Blank", "GB", "2024-01-02T00:00:00Z"), ("a", "Alpha 2", "GB", "2024-01-03T00:00:00Z")))
P2 = ("2024-01-05", page(("a", "Alpha 1", "GB", "2024-01-02T00:00:00Z"), ("b", "Beta 2", "FR", "2024-01-04T00:00:00Z"),
                         ("c", "Gamma", "DE", "2024-01-04T00:00:00Z"), ("d", "Dropped", "DE", None)))
AFTER_1 = [("a", "Alpha 2"), ("b", "Beta")]
AFTER_2 = [("a", "Alpha 2"), ("b", "Beta 2"), ("c", "Gamma")]


def test_frame(spark):
    out = silver_frame(bronze(spark, P1), PLACES)
    assert out.columns == ["place_id", "name", "name_hashed_key", "country", "modified_at", "_metadata"]
    assert rows(out.select("place_id", "name")) == AFTER_1
    meta = out.select("_metadata.*")
    assert meta.columns == ["file_name", "bronze_ingested_at", "silver_processed_at"]
    assert rows(meta.selectExpr("string(bronze_ingested_at)").distinct()) == [("2024-01-01 00:00:00",)]


def test_hashes_are_made_after_the_exchange_unless_a_key_needs_them(spark):
    plan = lambda c: silver_frame(bronze(spark, P1), c)._jdf.queryExecution().executedPlan().toString()
    late = plan(PLACES)
    assert "sha2" in late.partition("Exchange")[0] and "sha2" not in late.partition("Exchange")[2]
    by_hash = replace(PLACES, primary_keys=("name_hashed_key",))
    out = silver_frame(bronze(spark, P1), by_hash)
    assert out.columns == silver_frame(bronze(spark, P1), PLACES).columns
    assert rows(out.select("name")) == [("Alpha",), ("Alpha 2",), ("Beta",), ("Blank",)]


@pytest.mark.parametrize("buckets", [0, 3])
def test_job_runs(spark, table_name, tmp_path, buckets):
    contract = replace(PLACES, key_buckets=buckets)
    run = lambda b, **kw: build_silver(spark, b, contract, table_name, base=str(tmp_path), **kw)
    now = lambda: rows(StoredTable(spark, table_name).read().select("place_id", "name"))
    assert run(bronze(spark, P1).limit(0)) == "full_load" and now() == []
    assert run(bronze(spark, P1)) == "full_load" and now() == AFTER_1
    assert run(bronze(spark, P1)) == "incremental" and now() == AFTER_1
    assert run(bronze(spark, P1, P2), start="2023-01-01", end="2023-02-01") == "date_range" and now() == AFTER_1
    assert run(bronze(spark, P1, P2)) == "incremental" and now() == AFTER_2
    assert run(bronze(spark, P1, P2), start="2024-01-01", end="2024-01-05") == "date_range" and now() == AFTER_2


def test_streaming_equals_batch(spark, table_name, tmp_path):
    source, ckpt = str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    target = StoredTable(spark, table_name, base=str(tmp_path / "silver"))
    schema = bronze(spark, P1).schema

    def go():
        start_silver(spark.readStream.schema(schema).parquet(source), PLACES, target, ckpt).awaitTermination()

    bronze(spark, P1).write.parquet(source)
    go()
    go()
    assert rows(target.read().select("place_id", "name")) == AFTER_1
    bronze(spark, P2).write.mode("append").parquet(source)
    go()
    assert rows(target.read().select("place_id", "name")) == AFTER_2
    assert target.last_batch().number == 1
    ckpt = str(tmp_path / "ckpt-2")
    bronze(spark, ("2024-02-01", page(("z", "Zeta", "IT", "2024-02-01T00:00:00Z")))).write.mode("append").parquet(source)
    go()  # a stream that starts anew counts its batches from 0 again
    assert rows(target.read().select("place_id", "name")) == [*AFTER_2, ("z", "Zeta")]


COUNTRIES = TableContract(
    "countries",
    primary_keys=("country",),
    deduplication_keys=("modified_at",),
    flatten=FlattenContract(explode=("places",)),
    columns=(
        ColumnContract("country", "string", source="places__spot__land__code"),
        ColumnContract("modified_at", "timestamp", source="places__audit__modified"),
    ),
)


def test_fan_out(spark, tmp_path):
    frames = fan_out(bronze(spark, P1, P2), [PLACES, COUNTRIES])
    assert rows(frames["countries"].select("country")) == [("DE",), ("FR",), ("GB",)]
    assert frames["places"].count() == 3


@pytest.mark.parametrize("share", [False, True])
def test_fan_out_to_tables(spark, tmp_path, table_name, share):
    targets = {
        c.name: (c, StoredTable(spark, f"{table_name}_{c.name}", base=str(tmp_path / c.name)))
        for c in (PLACES, COUNTRIES)
    }
    build_fan_out(bronze(spark, P1), targets, share_scan=share)
    build_fan_out(bronze(spark, P2), targets, share_scan=share)
    assert rows(targets["places"][1].read().select("place_id", "name")) == AFTER_2
    assert targets["countries"][1].read().count() == 3


def test_streaming_fan_out(spark, tmp_path, table_name):
    source = str(tmp_path / "bronze")
    bronze(spark, P1, P2).write.parquet(source)
    targets = {
        c.name: (c, StoredTable(spark, f"{table_name}_{c.name}", base=str(tmp_path / c.name)))
        for c in (PLACES, COUNTRIES)
    }
    stream = spark.readStream.schema(bronze(spark, P1).schema).parquet(source)
    start_silver_fan_out(stream, targets, str(tmp_path / "ckpt")).awaitTermination()
    assert rows(targets["places"][1].read().select("place_id", "name")) == AFTER_2
    assert targets["countries"][1].read().count() == 3


def test_landing_to_silver(spark, tmp_path, table_name):
    """From JSON documents to silver rows through every stage."""
    from siltworks.sources.landing import Landing
    from siltworks.streaming.ingest import BronzeTarget, ingest, read_bronze

    folder = tmp_path / "land" / "20240101" / "09"
    folder.mkdir(parents=True)
    (folder / "places_20240101090000_0.json").write_text(json.dumps(P1[1], indent=1))
    landing = Landing(str(tmp_path / "land"), "json", str(tmp_path / "schema"), options={"multiLine": "true"})
    target = BronzeTarget(str(tmp_path / "bronze"), str(tmp_path / "ckpt"))
    ingest(spark, landing, target)
    build_silver(spark, read_bronze(spark, target), PLACES, table_name, base=str(tmp_path / "silver"))
    assert rows(spark.table(table_name).select("place_id", "name")) == AFTER_1
    (folder / "places_20240101100000_0.json").write_text(json.dumps(P2[1], indent=1))
    ingest(spark, landing, target)
    assert build_silver(spark, read_bronze(spark, target), PLACES, table_name, base=str(tmp_path / "silver")) == "incremental"
    assert rows(spark.table(table_name).select("place_id", "name")) == AFTER_2
    file_name = spark.table(table_name).filter("place_id = 'c'").first()["_metadata"]["file_name"]
    assert file_name == "places_20240101100000_0.json"


CHARGES = TableContract(
    "charges",
    primary_keys=("doc", "at_index"),
    deduplication_keys=("seen",),
    key_buckets=4,
    flatten=FlattenContract(explode=("body__charges",), keep=("_metadata",), with_index=True),
    columns=(
        ColumnContract("doc", "bigint", source="id", hashed=True),
        ColumnContract("at_index", "bigint", source="body__charges__index"),
        ColumnContract("seen", "timestamp"),
        ColumnContract("kind", "string", transform="upper(body__charges__kind)"),
        ColumnContract("rate", "double", source="body__charges__tax__rate"),
        ColumnContract("zone", "string", source="body__zone"),
    ),
)
CHARGE_SCHEMA = """id string, seen string, body struct<zone: string, charges: array<struct<kind: string, note: string, tax: struct<code: string, rate: string>>>>,
                   stamp string"""


def charge_rows(spark, *data):
    df = spark.createDataFrame(data, CHARGE_SCHEMA)
    return df.selectExpr("id", "seen", "body", "cast(stamp as timestamp) _ingested_at")


CHARGED_1 = [
    ("1", "2024-01-02", ("a", [("x", "n", ("c", "0.5")), ("y", "n", None), None]), "2024-01-02"),
    ("1", "2024-01-01", ("b", [("z", "n", ("c", "0.7")), ("z", "n", ("c", "0.7")), ("z", "n", ("c", None)), ("w", None, ("d", "1"))]), "2024-01-02"),
    ("1", "2024-01-02", ("a", [("x", "n", ("c", "0.6"))]), "2024-01-02"),
    (None, "2024-01-01", ("c", [("o", "n", ("c", "2")), ("p", "n", ("c", "3"))]), "2024-01-01"),
    ("0", "2024-01-01", ("d", [("q", "n", ("c", "2"))]), "2024-01-01"),
    ("3", None, ("e", [("r", "n", ("c", "2"))]), "2024-01-01"),
    ("4", "2024-01-01", ("f", []), "2024-01-01"),
    ("5", "2024-01-01", ("g", None), "2024-01-01"),
    ("6", "2024-01-01", None, "2024-01-01"),
    ("07", "2024-01-01", ("h", [("s", "n", ("c", "5"))]), "2024-01-01"),
]
CHARGED_2 = [
    ("7", "2024-02-01", ("h", [("S", "n", ("c", "6")), ("T", "n", ("c", "7"))]), "2024-02-01"),
    ("1", "2024-01-01", ("i", [("old", "n", ("c", "9"))]), "2024-02-01"),
    (None, "2024-02-01", ("j", [("new", "n", ("c", "9"))]), "2024-02-01"),
    ("8", "2024-02-01", ("k", [("u", "n", ("c", "9"))]), "2024-02-01"),
]
CHARGE_COLUMNS = ["doc", "at_index", "seen", "kind", "rate", "zone", "doc_hashed_key"]


@pytest.mark.parametrize("kept", [False, True])
def test_documents_travel_whole(spark, kept):
    """Elements are made after the exchange, and are those that travelling one by one gives."""
    df = charge_rows(spark, *CHARGED_1)
    whole = silver_frame(df, CHARGES, keep_match_columns=kept)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Generate" in plan.partition("Exchange")[0] and "note" not in plan.partition("Exchange")[0]
    plain = latest_rows(cleaned_rows(df, CHARGES), CHARGES, keep_match_columns=kept)
    assert [c for c in whole.columns if not c.startswith("__")] == [c for c in plain.columns if not c.startswith("__")]
    assert rows(whole.select(CHARGE_COLUMNS)) == rows(plain.select(CHARGE_COLUMNS)) and whole.count() == 8


def test_frames_are_merged_where_documents_lie(spark):
    first, second = charge_rows(spark, *CHARGED_1), charge_rows(spark, *CHARGED_2)
    merge = lambda old: merged_silver(old, second, CHARGES).select(CHARGE_COLUMNS)
    whole = merge(silver_frame(first, CHARGES, keep_match_columns=True))
    assert whole._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
    assert rows(whole) == rows(merge(latest_rows(cleaned_rows(first, CHARGES), CHARGES)))


def test_what_tells_a_document():
    keys = lambda **how: replace(CHARGES, **how).document_keys
    assert keys() == ["doc"] and keys(hot_keys=True) == [] and keys(primary_keys=("at_index",)) == [] and keys(primary_keys=("doc",)) == []
    assert keys(primary_keys=("doc", "at_index", "rate")) == [] and keys(primary_keys=("doc", "at_index", "kind")) == []
    assert keys(primary_keys=("doc_hashed_key", "at_index")) == [] and PLACES.document_keys == []
    assert keys(columns=(ColumnContract("id", "string", transform="upper(zone)"), *CHARGES.columns)) == []


@pytest.mark.parametrize("small", [True, False])
def test_elements_of_a_document_are_stored_together(spark, table_name, tmp_path, monkeypatch, small):
    if not small:
        monkeypatch.setattr(store_module, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(store_module, "GROUP_BYTES", 1)
    run = lambda *data: build_silver(spark, charge_rows(spark, *data), CHARGES, table_name, base=str(tmp_path / "a"))
    run(*CHARGED_1)
    run(*CHARGED_2)
    table = StoredTable(spark, table_name, base=str(tmp_path / "a"))
    assert table.manifest().placed_by == ["doc"]
    assert spark.table(table_name).groupBy("doc").agg(F.countDistinct(store_module.BUCKET).alias("n")).filter("n > 1").isEmpty()
    wanted = rows(merged_silver(latest_rows(cleaned_rows(charge_rows(spark, *CHARGED_1), CHARGES), CHARGES), charge_rows(spark, *CHARGED_2), CHARGES).select(CHARGE_COLUMNS))
    assert rows(table.read().select(CHARGE_COLUMNS)) == wanted
    table.rebucket(3)
    assert table.manifest().placed_by == ["doc"] and rows(table.read().select(CHARGE_COLUMNS)) == wanted
    # A table of an earlier layout keeps it.
    old = StoredTable(spark, f"{table_name}_old", buckets=4, base=str(tmp_path / "b"))
    store_silver(latest_rows(cleaned_rows(charge_rows(spark, *CHARGED_1), CHARGES), CHARGES, target=old), CHARGES, old)
    build_silver(spark, charge_rows(spark, *CHARGED_2), CHARGES, old.name, base=old.base)
    assert old.manifest().placed_by == [] and rows(old.read().select(CHARGE_COLUMNS)) == wanted
