"""Values and rows that a contract turns away."""

import pytest

from conftest import rows
from siltworks import ColumnContract, TableContract
from siltworks.operators.rejects import kept, observed, rejected
from siltworks.plans.silver import build_silver, build_silver_from_batches, cleaned_rows, examined_rows, read_rejects
from siltworks.sinks.store import StoredTable
from siltworks.streaming.ingest import BronzeTarget, put_batch

CONTRACT = TableContract(
    "people", primary_keys=("id", "part"), deduplication_keys=("seen",),
    columns=(
        ColumnContract("id", "int", source="id_text", hashed=True), ColumnContract("part", "string"), ColumnContract("seen", "timestamp", source="at"),
        ColumnContract("twice", "tinyint", transform="id * 2"),
    ),
)
DATA = [("1", "a", "2024-01-01"), ("x", "b", "2024-01-01"), (None, "", None), ("100", "c", "never"), ("", None, "2024-01-01"), ("1", "a", "2024-01-02")]


def bronze(spark, data=DATA):
    df = spark.createDataFrame(data, "id_text string, part string, at string")
    return df.selectExpr("*", "timestamp '2024-03-01 00:00:00' AS _ingested_at")


def test_every_reject_with_its_payload(spark):
    examined = examined_rows(bronze(spark), CONTRACT)
    got = rows(rejected(examined).select("column", "reason", "value"))
    assert got == rows(spark.createDataFrame([
        ("id", "type", "x"), ("id", "type", ""), ("seen", "type", "never"), ("twice", "type", "200"), ("id,part", "no key", None), ("id,part", "no key", None),
        ("seen", "no key", None), ("seen", "no key", None),
    ], "a string, b string, c string"))
    payload = rejected(examined).filter("value = 'never'").first()["payload"]
    assert '"id_text":"100"' in payload and '"at":"never"' in payload
    assert rows(kept(examined).drop("_metadata")) == rows(cleaned_rows(bronze(spark), CONTRACT, "null").drop("_metadata"))
    assert kept(examined).columns == cleaned_rows(bronze(spark), CONTRACT, "null").columns


def test_counts_are_observed_with_the_write(spark):
    examined, note = observed(examined_rows(bronze(spark), CONTRACT), "n")
    assert rejected(examined).count() == 8 and note.get == {"rows": 6, "bad_values": 4, "rows_without_key": 3}


def test_rejects_of_runs(spark, table_name, tmp_path):
    base = str(tmp_path / "silver")
    run = lambda data, when: build_silver(
        spark, bronze(spark, data).selectExpr("id_text", "part", "at", f"timestamp '{when}' AS _ingested_at"), CONTRACT, table_name, on_error="null", base=base, keep_rejects=True
    )
    table = StoredTable(spark, table_name, base=base)
    assert rows(read_rejects(table)) == []
    assert run(DATA, "2024-03-01 00:00:00") == "full_load"
    assert run([("9", "z", "2024-01-01"), ("y", "z", "2024-01-01")], "2024-03-02 00:00:00") == "incremental"
    assert table.manifest().rejects == {"rows": 2, "bad_values": 1, "rows_without_key": 0}
    assert rows(read_rejects(table).groupBy("version").count()) == [(0, 8), (1, 1)]
    assert rows(table.read().selectExpr("id", "part", "string(seen)")) == rows(spark.createDataFrame(
        [(1, "a", "2024-01-02 00:00:00"), (None, "b", "2024-01-01 00:00:00"), (9, "z", "2024-01-01 00:00:00"), (None, "z", "2024-01-01 00:00:00")], "a int, b string, c string"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        build_silver(spark, bronze(spark, [("bad", "q", None)]), CONTRACT, f"{table_name}_f", base=f"{base}_f", keep_rejects=True)


def test_rejects_of_batches(spark, table_name, tmp_path):
    source = BronzeTarget(str(tmp_path / "bronze"), str(tmp_path / "ckpt"))
    put_batch(bronze(spark).selectExpr("*", "date '2024-03-01' AS _ingestion_date"), source, "s-000000000")
    build_silver_from_batches(spark, source, CONTRACT, table_name, on_error="null", base=str(tmp_path / "silver"), keep_rejects=True)
    table = StoredTable(spark, table_name, base=str(tmp_path / "silver"))
    assert read_rejects(table).count() == 8 and table.manifest().ledger == {"s": [[0, 0]]} and table.manifest().rejects["rows"] == 6
