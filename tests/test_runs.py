"""Merge on read against upserts that rewrite the table."""

import json
import random

import pytest

from conftest import rows
from siltworks.operators.versions import Run, thinned
from siltworks.sinks import files
from siltworks.sinks import store as store_module
from siltworks.sinks.export import export_table
from siltworks.sinks.store import Batch, StoredTable
from siltworks.sources.tables import read_table

SCHEMA = "id int, at int, v string"


def frame(spark, *data, schema=SCHEMA):
    return spark.createDataFrame(list(data), schema)


def pair(spark, table_name, tmp_path, buckets):
    rewritten = StoredTable(spark, table_name, buckets=buckets, base=str(tmp_path / "rewritten"))
    runs = StoredTable(spark, f"{table_name}_r", buckets=buckets, base=str(tmp_path / "runs"), delta_runs=True)
    return rewritten, runs


@pytest.mark.parametrize("buckets, broadcast", [(0, True), (4, False)])
def test_same_rows_as_rewriting(spark, table_name, tmp_path, monkeypatch, buckets, broadcast):
    monkeypatch.setattr(store_module, "RUNS_PER_TIER", 3)
    monkeypatch.setattr(store_module, "FOLD_SHARE", 1e9)
    if not broadcast:
        monkeypatch.setattr(store_module, "BROADCAST_BYTES", -1)
    rng = random.Random(buckets)
    both = pair(spark, table_name, tmp_path, buckets)
    orders = [["at"], ["at"], [], ["at", "v"], ["at"]]
    for i in range(11):
        ids = rng.sample([None, *range(12)], rng.randint(0 if i else 4, 8))
        value = lambda: rng.choice([None, *range(6)])
        if i in (4, 7):
            batch = frame(spark, *[(k, value(), rng.random()) for k in ids], schema="ID bigint, at int, extra double")
        else:
            batch = frame(spark, *[(k, value(), rng.choice(["a", "b", None])) for k in ids])
        order = orders[i % len(orders)] if i not in (4, 7) else ["at"]
        for table in both:
            table.upsert(batch, ["id"], order)
        assert both[1].read().columns == both[0].read().columns
        assert rows(both[1].read()) == rows(both[0].read()), i
    assert both[1].pending_runs and len(both[1].manifest().runs) < 9
    wanted = rows(both[0].read())
    both[1].compact()
    assert both[1].pending_runs == 0 and rows(both[1].read()) == wanted == rows(spark.table(both[1].name).select(*both[0].read().columns))


def test_a_batch_writes_its_own_rows_only(spark, table_name, tmp_path):
    table = StoredTable(spark, table_name, buckets=8, base=str(tmp_path / "base"), delta_runs=True)
    table.upsert(spark.range(200_000).selectExpr("CAST(id AS int) AS id", "1 AS at", "sha2(CAST(id AS string), 256) AS v"), ["id"], ["at"], keys_are_unique=True)
    base = files.total_bytes(spark, table.base_folder)
    before = {f.path for f in _data(spark, table)}
    for i in range(3):
        table.upsert(spark.range(50).selectExpr("CAST(id * 4000 AS int) AS id", f"{i + 2} AS at", "'new' AS v"), ["id"], ["at"])
    fresh = [f for f in _data(spark, table) if f.path not in before]
    assert sum(f.size for f in fresh) < base / 100 and before <= {f.path for f in _data(spark, table)}
    assert table.read().filter("v = 'new' AND at = 4").count() == 50 and table.read().count() == 200_000


def _data(spark, table):
    found = []
    for top in files.listing(spark, table.base_folder):
        for f in files.listing(spark, top.path) if top.is_dir else []:
            found += files.listing(spark, f.path) if f.is_dir else [f]
    return [f for f in found if f.name.endswith(".parquet")]


def test_an_insert_opens_no_old_file(spark, table_name, tmp_path):
    """Old data may even be unreadable while a batch is committed beside it."""
    table = StoredTable(spark, table_name, buckets=2, base=str(tmp_path / "base"), delta_runs=True)
    table.upsert(frame(spark, (1, 1, "a"), (2, 1, "b")), ["id"], ["at"])
    hidden = {f: f"{f}.away" for f in table.manifest().folders.values()}
    for a, b in hidden.items():
        files.move(spark, f"{table.base_folder}/{a}", f"{table.base_folder}/{b}")
    table.upsert(frame(spark, (3, 1, "c")), ["id"], ["at"])
    for a, b in hidden.items():
        files.move(spark, f"{table.base_folder}/{b}", f"{table.base_folder}/{a}")
    assert rows(table.read()) == [(1, 1, "a"), (2, 1, "b"), (3, 1, "c")]


def test_base_columns_are_pruned(spark, table_name, tmp_path):
    table = StoredTable(spark, table_name, base=str(tmp_path / "base"), delta_runs=True)
    table.upsert(frame(spark, (1, 1, "a", 2.0), schema=SCHEMA + ", wide double"), ["id"], ["at"])
    table.upsert(frame(spark, (1, 2, "b", 3.0), schema=SCHEMA + ", wide double"), ["id"], ["at"])
    plan = table.read().select("v")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    assert any("ReadSchema: struct<id:int,at:int,v:string>" in line for line in scans) and len(scans) >= 2


def test_ids_repeats_marks_and_empty_batches(spark, table_name, tmp_path):
    table = StoredTable(spark, table_name, base=str(tmp_path / "base"), delta_runs=True)
    table.upsert(frame(spark, (1, 1, "a")), ["id"], ["at"], batch=Batch("s", 0))
    table.upsert(frame(spark, (1, 2, "b")), ["id"], ["at"], batch=Batch("s", 1))
    table.upsert(frame(spark, (1, 3, "again")), ["id"], ["at"], batch=Batch("s", 1))
    with pytest.raises(ValueError, match="same key"):
        table.upsert(frame(spark, (7, 1, "a"), (7, 2, "b")), ["id"], ["at"])
    with pytest.raises(ValueError, match="is kept by"):
        table.upsert(frame(spark, (7, 1, "a")), ["v"], ["at"])
    table.upsert(frame(spark, schema=SCHEMA + ", more int"), ["id"], ["at"])
    assert rows(table.read()) == [(1, 2, "b", None)] and table.pending_runs == 1


def test_readers_by_name_expiry_and_rewriting(spark, table_name, tmp_path):
    table = StoredTable(spark, table_name, buckets=2, base=str(tmp_path / "base"), delta_runs=True)
    for i in range(4):
        table.upsert(frame(spark, (i, 1, "a"), (0, i, "z")) if i else frame(spark, (0, 0, "a")), ["id"], ["at"])
    table.expire(1)
    assert rows(read_table(spark, table_name)) == rows(table.read()) == [(0, 3, "z"), (1, 1, "a"), (2, 1, "a"), (3, 1, "a")]
    path = export_table(spark, table_name, str(tmp_path / "out"), "x", file_format="json", single_file=False)
    assert spark.read.json(path).count() == 4
    # A writer that rewrites folds what lies beside the table first.
    StoredTable(spark, table_name, base=table.base).upsert(frame(spark, (9, 1, "n")), ["id"], ["at"])
    assert table.pending_runs == 0 and spark.table(table_name).count() == 5
    table.expire(1)
    assert table.read().count() == 5
    table.upsert(frame(spark, (9, 2, "m")), ["id"], ["at"])
    table.rebucket(0)
    assert table.pending_runs == 0 and table.read().filter("id = 9 AND v = 'm'").count() == 1


def test_runs_fold_at_a_share_of_the_base(spark, table_name, tmp_path, monkeypatch):
    monkeypatch.setattr(store_module, "RUNS_PER_TIER", 2)
    monkeypatch.setattr(store_module, "FOLD_SHARE", 0)
    table = StoredTable(spark, table_name, buckets=2, base=str(tmp_path / "base"), delta_runs=True)
    seen = []
    for i in range(5):
        table.upsert(frame(spark, (i, 1, "a")), ["id"], ["at"])
        seen.append(table.pending_runs)
    assert seen == [0, 1, 0, 1, 0] and table.read().count() == 5


def test_gathered_runs_lose_only_what_is_never_seen(spark):
    runs = [Run(i, ("at",), frozenset({"id", "at"})) for i in (1, 2, 3)]
    df = frame(spark, (1, 5, 1), (1, 4, 2), (1, 5, 3), (2, None, 1), (2, 7, 3), schema="id int, at int, __run bigint")
    assert rows(thinned(df, ["id"], runs)) == [(1, 5, 3), (2, 7, 3), (2, None, 1)]
    other = [*runs[:2], Run(3, (), frozenset({"id", "at"}))]
    assert thinned(df, ["id"], other).count() == 5


def test_manifests_of_before_are_read(spark, table_name, tmp_path):
    table = StoredTable(spark, table_name, base=str(tmp_path / "base"))
    table.upsert(frame(spark, (1, 1, "a")), ["id"], ["at"])
    path = f"{table.base_folder}/manifest.json"
    old = {k: v for k, v in json.loads(files.read_text(spark, path)).items() if k not in ("runs", "base_bytes")}
    files.write_text(spark, path, json.dumps(old))
    assert rows(table.read()) == [(1, 1, "a")]
