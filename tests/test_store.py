import pytest

from conftest import rows
from siltworks.operators.keys import latest_per_key
from siltworks.operators.merge import upsert
from siltworks.session import shuffles_deleted
from siltworks.sinks import files
from siltworks.sinks import store as store_module
from siltworks.sinks.store import Batch, StoredTable, clustered

SCHEMA = "id int, at int, v string"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


@pytest.fixture(params=[0, 4], ids=["plain", "buckets"])
def stored(request, spark, table_name, tmp_path):
    return StoredTable(spark, table_name, buckets=request.param, base=str(tmp_path / "base"))


def test_create_then_upsert(spark, stored):
    assert not stored.exists and stored.last_batch() is None
    stored.upsert(frame(spark, (1, 1, "a"), (2, 5, "b")), ["id"], ["at"])
    assert rows(stored.read()) == [(1, 1, "a"), (2, 5, "b")]
    stored.upsert(frame(spark, (1, 2, "A"), (2, 4, "B"), (3, 0, "C")), ["id"], ["at"])
    assert rows(stored.read()) == [(1, 2, "A"), (2, 5, "b"), (3, 0, "C")]


def test_large_batches_take_the_join_without_broadcast(spark, stored, monkeypatch):
    monkeypatch.setattr(store_module, "BROADCAST_BYTES", -1)
    stored.upsert(frame(spark, (1, 1, "a"), (2, 5, "b"), (None, 1, "n")), ["id"], ["at"])
    stored.upsert(frame(spark, (1, 2, "A"), (2, 4, "B"), (3, 0, "C"), (None, 1, "N")), ["id"], ["at"])
    assert rows(stored.read()) == rows(frame(spark, (1, 2, "A"), (2, 5, "b"), (3, 0, "C"), (None, 1, "N")))


def test_batch_ids_are_committed_once(spark, stored):
    stored.upsert(frame(spark, (1, 1, "a")), ["id"], [], batch=Batch("s-1", 0))
    stored.upsert(frame(spark, (1, 1, "b")), ["id"], [], batch=Batch("s-1", 1))
    stored.upsert(frame(spark, (1, 1, "again")), ["id"], [], batch=Batch("s-1", 1))
    stored.upsert(frame(spark, (1, 1, "older")), ["id"], [], batch=Batch("s-1", 0))
    assert rows(stored.read()) == [(1, 1, "b")] and stored.last_batch() == ("s-1", 1)
    stored.upsert(frame(spark, (1, 1, "new stream")), ["id"], [], batch=Batch("s-2", 0))
    assert rows(stored.read()) == [(1, 1, "new stream")] and stored.last_batch() == ("s-2", 0)


def test_evolving_columns(spark, stored):
    stored.upsert(frame(spark, (1, 1, "a"), (2, 1, "b")), ["id"], ["at"])
    stored.upsert(spark.createDataFrame([(2, 2, 0.5), (3, 1, 1.5)], "id int, at int, extra double"), ["id"], ["at"])
    assert stored.read().columns == ["id", "at", "v", "extra"]
    assert rows(stored.read()) == [(1, 1, "a", None), (2, 2, "b", 0.5), (3, 1, None, 1.5)]


def test_repeated_keys_in_a_batch_are_refused(spark, stored):
    with pytest.raises(ValueError, match="same key"):
        stored.upsert(frame(spark, (1, 1, "a"), (1, 2, "b")), ["id"], ["at"])
    stored.upsert(frame(spark, (1, 1, "a")), ["id"], ["at"])
    with pytest.raises(ValueError, match="same key"):
        stored.upsert(frame(spark, (7, 1, "a"), (7, 2, "b")), ["id"], ["at"])
    assert rows(stored.read()) == [(1, 1, "a")]


def test_empty_first_load_and_empty_batch(spark, stored):
    stored.upsert(frame(spark), ["id"], ["at"])
    assert stored.exists and stored.read().columns == ["id", "at", "v"] and stored.read().isEmpty()
    stored.upsert(frame(spark, (1, 1, "a")), ["id"], ["at"])
    stored.upsert(frame(spark), ["id"], ["at"])
    assert rows(stored.read()) == [(1, 1, "a")]


def test_only_touched_buckets_are_rewritten(spark, table_name, tmp_path):
    t = StoredTable(spark, table_name, buckets=8, base=str(tmp_path / "base"))
    t.upsert(spark.range(1000).selectExpr("cast(id as int) id", "1 at", "'a' v"), ["id"], ["at"])
    first = {f.path for f in files.listing(spark, str(tmp_path / "base"))}
    t.upsert(frame(spark, (5, 2, "b")), ["id"], ["at"])
    (second,) = [f.path for f in files.listing(spark, str(tmp_path / "base")) if f.is_dir and f.path not in first]
    assert len([f for f in files.listing(spark, second) if f.is_dir]) == 1
    assert t.read().count() == 1000 and t.read().filter("v = 'b'").count() == 1


def test_a_reader_keeps_its_version(spark, table_name, tmp_path):
    t = StoredTable(spark, table_name, base=str(tmp_path / "base"))
    t.upsert(frame(spark, (1, 1, "a")), ["id"], ["at"])
    before = t.read()
    before_location = t.location
    t.upsert(frame(spark, (1, 2, "b")), ["id"], ["at"])
    assert rows(spark.read.parquet(before_location)) == [(1, 1, "a")]
    assert rows(before) in ([(1, 1, "a")], [(1, 2, "b")])
    assert rows(t.read()) == [(1, 2, "b")]


def test_overwrite_with_and_without_new_columns(spark, stored):
    stored.overwrite(frame(spark, (1, 1, "a")), ["id"])
    stored.overwrite(stored.read().selectExpr("id", "at + 1 at", "v"), ["id"])
    assert rows(stored.read()) == [(1, 2, "a")]
    stored.overwrite(stored.read().selectExpr("id", "'x' w"), ["id"])
    assert stored.read().columns == ["id", "w"] and rows(stored.read()) == [(1, "x")]


def test_database_is_made(spark, tmp_path):
    t = StoredTable(spark, f"db_{tmp_path.name.replace('-', '_')}.t", base=str(tmp_path / "b"))
    t.create(frame(spark, (1, 1, "a")))
    assert rows(spark.table(t.name)) == [(1, 1, "a")]


def test_old_versions_expire(spark, table_name, tmp_path):
    t = StoredTable(spark, table_name, base=str(tmp_path / "base"))
    for i in range(4):
        t.upsert(frame(spark, (1, i, "a")), ["id"], ["at"])
    t.expire(keep=2)
    kept = [f.name for f in files.listing(spark, str(tmp_path / "base")) if f.is_dir]
    assert kept == ["snap-000002", "snap-000003"] and rows(t.read()) == [(1, 3, "a")]


def test_replaced_buckets_expire(spark, table_name, tmp_path):
    t = StoredTable(spark, table_name, buckets=3, base=str(tmp_path / "base"))
    t.upsert(spark.range(60).selectExpr("cast(id as int) id", "0 at", "'a' v"), ["id"], ["at"])
    for i in range(3):
        t.upsert(frame(spark, (7, i, "b")), ["id"], ["at"])
    t.expire(keep=1)
    left = [d.name for f in files.listing(spark, t.base_folder) if f.is_dir for d in files.listing(spark, f.path) if d.is_dir]
    assert len(left) == 3 and t.read().count() == 60 and t.read().filter("at = 2").count() == 1


def test_leftovers_of_a_broken_run_do_not_matter(spark, stored):
    stored.upsert(frame(spark, (1, 1, "a")), ["id"], ["at"])
    for leftover in ("snap-000001", "snap-000002-staged"):
        frame(spark, (9, 9, "junk")).write.parquet(f"{stored.base_folder}/{leftover}")
    stored.upsert(frame(spark, (2, 1, "b")), ["id"], ["at"])
    assert rows(stored.read()) == [(1, 1, "a"), (2, 1, "b")]


def test_a_hot_clustering_value_is_spread(spark):
    df = spark.range(20000).selectExpr("id", "if(id % 3 > 0, 'hot', cast(id as string)) k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        from pyspark.sql import functions as F

        sizes = [r[1] for r in clustered(df, ["k"]).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 2 * 20000 / 8


@pytest.mark.parametrize("step", ["data", "manifest", "catalog"])
def test_a_commit_that_breaks_is_all_or_nothing(spark, stored, monkeypatch, step):
    """Broken after the data, at the manifest, or between it and the catalog; then run again."""
    stored.upsert(spark.range(40).selectExpr("cast(id as int) id", "0 at", "'a' v"), ["id"], ["at"], batch=Batch("s", 0))
    new = spark.range(20, 60).selectExpr("cast(id as int) id", "1 at", "'b' v")
    target, name = {"data": (StoredTable, "_commit"), "manifest": (files, "replace"), "catalog": (StoredTable, "_point_buckets" if stored.buckets else "publish")}[step]
    original, calls = getattr(target, name), []

    def broken(*args, **kwargs):
        calls.append(1)
        if name != "publish" or len(calls) > 1:
            raise OSError("gone")
        return original(*args, **kwargs)

    monkeypatch.setattr(target, name, broken)
    with pytest.raises(OSError):
        stored.upsert(new, ["id"], ["at"], batch=Batch("s", 1))
    monkeypatch.undo()
    committed = stored.read().filter("at = 1").count()
    assert committed == (40 if step == "catalog" else 0) and stored.read().count() == (60 if step == "catalog" else 40)
    stored.upsert(new, ["id"], ["at"], batch=Batch("s", 1))
    stored.upsert(frame(spark, (99, 1, "c")), ["id"], ["at"], batch=Batch("s", 2))
    want = [(i, 0 if i < 20 else 1) for i in range(60)] + [(99, 1)]
    assert rows(stored.read().select("id", "at")) == rows(spark.createDataFrame(want, "id int, at int"))
    assert rows(spark.newSession().table(stored.name).select("id", "at")) == rows(spark.createDataFrame(want, "id int, at int"))


def test_the_layout_belongs_to_the_table(spark, table_name, tmp_path):
    base = str(tmp_path / "base")
    make = lambda n: StoredTable(spark, table_name, buckets=n, base=base)
    make(8).upsert(spark.range(100).selectExpr("cast(id as int) id", "0 at"), ["id"], ["at"])
    for n in (16, 0):
        make(n).upsert(spark.range(50).selectExpr("id", f"{n + 1} at"), ["id"], ["at"])
    out = make(8).read()
    assert out.count() == out.select("id").distinct().count() == 100 and out.schema["id"].dataType.simpleString() == "int"
    with pytest.raises(ValueError, match="kept by"):
        make(8).upsert(spark.range(1).selectExpr("id", "1 at"), ["at"], [])
    for n in (3, 0):
        make(8).rebucket(n)
        make(8).upsert(spark.range(99, 101).selectExpr("id", "50 at"), ["id"], ["at"])
        assert make(8).read().count() == 101 == spark.table(table_name).count()


@pytest.mark.parametrize("limit", [-1, 1 << 30])
def test_both_forms_take_the_same_keys(spark, stored, monkeypatch, limit):
    monkeypatch.setattr(store_module, "BROADCAST_BYTES", limit)
    old = spark.createDataFrame([([1, 2], ("a", 1), "x"), (None, ("b", 2), "y")], "Id array<int>, s struct<p:string,q:int>, v string")
    new = spark.createDataFrame([([1, 2], ("a", 1), "X"), (None, None, "Z")], "id array<int>, s struct<p:string,q:int>, v string")
    stored.upsert(old, ["Id", "s"])
    stored.upsert(new, ["id", "s"])
    assert sorted(r["v"] for r in stored.read().collect()) == ["X", "Z", "y"]


def test_descriptions_survive_another_schema(spark, stored):
    stored.create(frame(spark, (1, 1, "a")), ["id"])
    spark.sql(f"COMMENT ON TABLE {stored.name} IS 'it''s a table'")
    spark.sql(f"ALTER TABLE {stored.name} ALTER COLUMN v COMMENT 'a value'")
    spark.sql(f"ALTER TABLE {stored.name} SET TBLPROPERTIES ('owner__tech' = 'me')")
    stored.overwrite(spark.createDataFrame([(1, "w", 2.0)], "id int, v string, at double"), ["id"])
    assert spark.catalog.getTable(stored.name).description == "it's a table"
    assert {c.name: c.description for c in spark.catalog.listColumns(stored.name)}["v"] == "a value"
    assert stored._properties()["owner__tech"] == "me" and rows(spark.table(stored.name).select("v", "at")) == [("w", 2.0)]


def test_the_mark_is_part_of_the_commit(spark, stored):
    rows_at = lambda *times: spark.createDataFrame(
        [(i, t) for i, t in enumerate(times)], "id int, t string"
    ).selectExpr("id", "1 at", "named_struct('bronze_ingested_at', timestamp(t)) _metadata")
    stored.upsert(rows_at("2024-01-01", "2024-01-03"), ["id"], ["at"])
    assert stored.manifest().mark == 1704240000000000
    stored.upsert(rows_at("2024-01-02"), ["id"], ["at"])
    assert stored.manifest().mark == 1704240000000000


@pytest.mark.parametrize("placed", [True, False], ids=["placed", "as it comes"])
def test_large_batches_are_merged_by_groups_of_buckets(spark, table_name, tmp_path, monkeypatch, placed):
    monkeypatch.setattr(store_module, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(store_module, "GROUP_BYTES", 1)
    merged = []
    monkeypatch.setattr(store_module, "upsert", lambda old, new, *how: merged.append(1) or upsert(old, new, *how))
    target = StoredTable(spark, table_name, buckets=16, base=str(tmp_path / "base"))
    first, second = ([(i if i % 10 else None if i == lo else -i, v, f"{v}{i}") for i in range(lo, lo + 200)] for lo, v in ((0, 1), (100, 2)))
    for data in (first, second):
        df = frame(spark, *data)
        df = df.repartition(target.place_of(df, ["id"])) if placed else df
        target.upsert(df, ["id"], ["at"], keys_are_unique=True, placed=placed)
    wanted = {r[0]: r for r in first} | {r[0]: r for r in second}
    assert rows(target.read()) == rows(frame(spark, *wanted.values())) and len(merged) > 3
    assert rows(spark.table(table_name).drop(store_module.BUCKET)) == rows(target.read())
    assert not [f for f in files.listing(spark, target.base_folder) if f.name.endswith("-staged")]


def test_placed_rows_are_not_moved_again(spark, table_name, tmp_path):
    target = StoredTable(spark, table_name, buckets=4, base=str(tmp_path / "base"))
    df = frame(spark, *[(i % 50, i, str(i)) for i in range(400)])
    latest = latest_per_key(df, ["id"], ["at"], limit_first=False, place=target.place_of(df, ["id"]))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "WindowGroupLimit" not in plan
    writes = []
    hinted = type(df).hint
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(df), "hint", lambda self, *a: writes.append(a) or hinted(self, *a))
        target.upsert(latest, ["id"], ["at"], keys_are_unique=True, placed=True)
    assert not writes and rows(target.read()) == [(i, 350 + i, str(350 + i)) for i in sorted(range(50), key=str)]


def test_a_large_merge_moves_rows_once(spark, table_name, tmp_path, monkeypatch):
    """Both sides are joined where the buckets need them, and the result is written from there."""
    monkeypatch.setattr(store_module, "BROADCAST_BYTES", -1)
    plans, hinted = [], type(frame(spark, (1, 1, "a"))).hint
    monkeypatch.setattr(store_module, "upsert", lambda old, new, *how: plans.append(upsert(old, new, *how)) or plans[-1])
    target = StoredTable(spark, table_name, buckets=4, base=str(tmp_path / "base"))
    target.upsert(frame(spark, *[(i, 1, "a") for i in range(100)]), ["id"], ["at"])
    writes = []
    monkeypatch.setattr(type(target.read()), "hint", lambda self, *a: writes.append(a) or hinted(self, *a))
    target.upsert(frame(spark, *[(i, 2, "b") for i in range(50, 150)]), ["id"], ["at"])
    assert not writes and plans[0]._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
    assert rows(target.read()) == rows(frame(spark, *[(i, 1 + (i > 49), "ab"[i > 49]) for i in range(150)]))


def test_shuffle_files_go_with_their_query(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with shuffles_deleted(spark), shuffles_deleted(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == before


def test_what_a_dead_run_left_is_deleted_by_the_next(spark, stored, monkeypatch):
    stored.upsert(frame(spark, (1, 1, "a"), (2, 5, "b")), ["id"], ["at"])
    for method, kept in (("_commit", "b"), ("_point_buckets" if stored.buckets else "publish", "c")):
        with monkeypatch.context() as patch:
            # The commit itself dies, then what comes after it.
            calls = iter([None] * (method == "publish"))
            whole = getattr(StoredTable, method)

            def gone(self, *args, calls=calls, whole=whole):
                if next(calls, 0) is None:
                    return whole(self, *args)
                raise OSError("gone")

            patch.setattr(StoredTable, method, gone)
            with pytest.raises(OSError):
                stored.upsert(frame(spark, (2, 6, "c")), ["id"], ["at"])
        assert rows(stored.read()) == [(1, 1, "a"), (2, 5 + (kept == "c"), kept)]
    files.make_dirs(spark, f"{stored.base_folder}/snap-000009-staged")
    before = stored.read()
    stored.upsert(frame(spark, (3, 1, "d")), ["id"], ["at"])
    assert rows(before) == [(1, 1, "a"), (2, 6, "c")]
    assert rows(stored.read()) == [(1, 1, "a"), (2, 6, "c"), (3, 1, "d")]
    # The first load, the commit that reached the manifest and the last one; nothing of the run that did not.
    assert len([f for f in files.listing(spark, stored.base_folder) if f.name.startswith("snap-")]) == 3


def test_stored_hashes_take_about_their_own_bytes(spark, table_name, tmp_path):
    stored = StoredTable(spark, table_name, buckets=2, base=str(tmp_path / "base"))
    stored.upsert(spark.range(20000).selectExpr("id", "sha2(string(id), 256) v"), ["id"], [])
    assert files.total_bytes(spark, stored.base_folder) < 20000 * 50
