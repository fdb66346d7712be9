"""Micro-batches are read once each, by name."""

import pytest

from conftest import rows
from siltworks import ColumnContract, TableContract
from siltworks.operators.ledger import noted, unread
from siltworks.plans.silver import build_silver, build_silver_from_batches
from siltworks.sinks import files
from siltworks.sinks.store import StoredTable
from siltworks.streaming.ingest import BronzeTarget, put_batch, read_bronze

CONTRACT = TableContract(
    "people", primary_keys=("id",), deduplication_keys=("seen",),
    columns=(ColumnContract("id", "bigint"), ColumnContract("seen", "timestamp"), ColumnContract("name", "string")),
)


def test_ledger_is_kept_as_ranges():
    ledger = noted({}, ["a-000000002", "a-000000000", "b-x-000000007", "a-000000001"])
    assert ledger == {"a": [[0, 2]], "b-x": [[7, 7]]}
    assert noted(ledger, ["a-000000004", "a-000000001"])["a"] == [[0, 2], [4, 4]]
    assert noted(ledger, ["a-000000003"])["a"] == [[0, 3]]
    assert unread(ledger, ["a-000000003", "a-000000001", "b-x-000000006", "c-000000000", "c-000000000"]) == ["a-000000003", "b-x-000000006", "c-000000000"]


def batch(spark, target, name, *data, ingested):
    df = spark.createDataFrame(list(data), "id bigint, seen string, name string").selectExpr(
        "id", "CAST(seen AS timestamp) AS seen", "name", f"timestamp '{ingested}' AS _ingested_at", f"date '{ingested[:10]}' AS _ingestion_date"
    )
    put_batch(df, target, name)


@pytest.mark.parametrize("delta_runs", [False, True])
def test_late_and_unfinished_batches(spark, tmp_path, table_name, delta_runs):
    target = BronzeTarget(str(tmp_path / "bronze"), str(tmp_path / "ckpt"))
    run = lambda: build_silver_from_batches(spark, target, CONTRACT, table_name, base=str(tmp_path / "silver"), delta_runs=delta_runs)
    silver = StoredTable(spark, table_name, base=str(tmp_path / "silver"))
    show = lambda: rows(silver.read().select("id", "name"))
    batch(spark, target, "s-000000000", (1, "2024-01-01", "a"), (2, "2024-01-01", "b"), ingested="2024-03-02 10:00:00")
    assert run() == "full_load" and show() == [(1, "a"), (2, "b")]
    # A writer that is late: earlier times than the mark, and one row newer by its own column.
    batch(spark, target, "t-000000000", (1, "2024-01-02", "late"), (3, "2024-01-01", "c"), ingested="2024-03-01 10:00:00")
    batch(spark, target, "s-000000001", (9, "2024-01-01", "unfinished"), ingested="2024-03-03 10:00:00")
    marker = f"{target.path}/_batch=s-000000001/_SUCCESS"
    files.move(spark, marker, f"{marker}.away")
    assert run() == "incremental" and show() == [(1, "late"), (2, "b"), (3, "c")]
    version = silver.manifest().version
    assert run() == "incremental" and silver.manifest().version == version
    files.move(spark, f"{marker}.away", marker)
    run()
    assert show() == [(1, "late"), (2, "b"), (3, "c"), (9, "unfinished")]
    assert silver.manifest().ledger == {"s": [[0, 1]], "t": [[0, 0]]}
    silver.compact()
    silver.rebucket(2)
    assert silver.manifest().ledger == {"s": [[0, 1]], "t": [[0, 0]]}


def test_a_table_without_ledger_goes_on_from_its_mark(spark, tmp_path, table_name):
    target = BronzeTarget(str(tmp_path / "bronze"), str(tmp_path / "ckpt"))
    batch(spark, target, "s-000000000", (1, "2024-01-01", "a"), ingested="2024-03-02 10:00:00")
    build_silver(spark, read_bronze(spark, target), CONTRACT, table_name, base=str(tmp_path / "silver"))
    batch(spark, target, "s-000000001", (2, "2024-01-01", "b"), ingested="2024-03-03 10:00:00")
    assert build_silver_from_batches(spark, target, CONTRACT, table_name, base=str(tmp_path / "silver")) == "incremental"
    assert rows(StoredTable(spark, table_name, base=str(tmp_path / "silver")).read().select("id")) == [(1,), (2,)]
