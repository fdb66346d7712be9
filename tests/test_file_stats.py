"""Files that a range does not meet are not opened."""

import json

import pytest

from conftest import rows
from siltworks.sinks import files
from siltworks.sinks.store import StoredTable


def numbers(spark, n=4000, parts=8):
    return spark.range(n).selectExpr("CAST(id AS int) AS id", "CAST(id AS double) / 10 AS at", "concat('v', id % 7) AS v").repartition(parts)


@pytest.fixture
def plain(spark, table_name, tmp_path, request):
    previous = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield StoredTable(spark, table_name, clustering=("at",), base=str(tmp_path / "base"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", previous)


def test_ranges_open_matching_files_only(spark, plain):
    plain.create(numbers(spark), ["id"])
    everything = len(plain.read().inputFiles())
    found = plain.read_where({"at": (10.0, 12.5)})
    assert len(found.inputFiles()) < everything and everything >= 4
    assert rows(found.select("id")) == [(i,) for i in range(100, 126)]
    assert len(plain.read_where({"AT": (None, 1.0)}).inputFiles()) == 1 and plain.read_where({"at": (None, 1.0)}).count() == 11
    assert plain.read_where({"at": (399.0, None)}).count() == 10
    assert plain.read_where({"id": (5, 5), "at": (0.5, 0.5), "v": ("v5", "v5")}).count() == 1
    assert plain.read_where({"at": (1e6, None)}).count() == 0 and plain.read_where({}).count() == 4000


def test_upserts_keep_statistics_of_untouched_files(spark, table_name, tmp_path):
    table = StoredTable(spark, table_name, clustering=("at",), buckets=4, base=str(tmp_path / "base"))
    table.create(numbers(spark), ["id"])
    table.upsert(spark.createDataFrame([(7, 5000.0, "new"), (None, None, "null")], "id int, at double, v string"), ["id"], [])
    known = table.manifest()
    assert len(known.stats) == 2 and {s["of"] for s in known.stats} == {f.split("/")[0] for f in known.folders.values()}
    assert rows(table.read_where({"at": (4000.0, None)}).select("id", "v")) == [(7, "new")]
    assert len(table.read_where({"at": (4000.0, None)}).inputFiles()) == 1
    assert table.read_where({"id": (0, 9)}).count() == 10
    table.expire(1)
    assert table.read_where({"at": (1.0, 2.0)}).count() == 11
    table.overwrite(numbers(spark, 10), ["id"])
    table.expire(1)
    assert len(table.manifest().stats) == 1 and len([f for f in files.listing(spark, table.base_folder) if f.name.endswith("-stats")]) == 1


def test_pending_runs_limit_what_chooses_files(spark, plain, table_name):
    table = StoredTable(spark, table_name, clustering=("at",), base=plain.base, delta_runs=True)
    table.create(numbers(spark), ["id"])
    table.upsert(spark.createDataFrame([(3, 399.5, "moved"), (9000, 0.2, "fresh")], "id int, at double, v string"), ["id"], ["at"])
    assert rows(table.read_where({"at": (399.5, None)}).select("id")) == [(3,), (3995,), (3996,), (3997,), (3998,), (3999,)]
    assert rows(table.read_where({"at": (0.2, 0.3)}).select("id", "v")) == [(2, "v2"), (9000, "fresh")]
    assert rows(table.read_where({"id": (3, 3)}).select("at")) == [(399.5,)]
    table.compact()
    assert rows(table.read_where({"at": (0.2, 0.3)}).select("id")) == [(2,), (9000,)]


def test_folders_without_statistics_are_read(spark, plain):
    plain.create(numbers(spark, 100), ["id"])
    path = f"{plain.base_folder}/manifest.json"
    files.write_text(spark, path, json.dumps({k: v for k, v in json.loads(files.read_text(spark, path)).items() if k != "stats"}))
    assert plain.read_where({"at": (1.0, 2.0)}).count() == 11
