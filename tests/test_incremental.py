import datetime as dt

import pytest

from conftest import rows
from siltworks.operators.incremental import (
    DATE_RANGE, FULL_LOAD, INCREMENTAL, above, choose_reading, high_water_mark, in_range,
)

UTC = dt.timezone.utc


def bronze(spark, *stamps):
    return spark.createDataFrame([(s, i) for i, s in enumerate(stamps)], "s string, id int").selectExpr(
        "cast(s as timestamp) _ingested_at", "id"
    )


def silver(spark, *stamps):
    df = spark.createDataFrame([(s,) for s in stamps], "s string")
    return df.selectExpr("1 id", "named_struct('bronze_ingested_at', cast(s as timestamp)) _metadata")


def ids(df):
    return [r[0] for r in rows(df.select("id"))]


def test_range_is_inclusive_and_a_date_means_midnight(spark):
    b = bronze(spark, "2024-01-01", "2024-01-02 00:00:00", "2024-01-02 00:00:01", "2023-12-31 23:59:59")
    assert ids(in_range(b, "2024-01-01", "2024-01-02")) == [0, 1]


def test_mark_is_strict(spark):
    b = bronze(spark, "2024-01-01 10:00:00", "2024-01-01 10:00:00.000001", "2024-01-01 09:59:59")
    mark = high_water_mark(silver(spark, "2024-01-01 10:00:00", "2023-01-01", None))
    assert mark == dt.datetime(2024, 1, 1, 10, tzinfo=UTC)
    assert ids(above(b, mark)) == [1]


def test_mark_does_not_depend_on_the_session_zone(spark):
    s = silver(spark, "2024-07-01 10:00:00").cache()
    s.count()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert high_water_mark(s) == dt.datetime(2024, 7, 1, 10, tzinfo=UTC)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_text_stamps(spark):
    b = spark.createDataFrame([("2024-01-01T00:00:00Z", 0), ("2024-02-01T00:00:00Z", 1)], "_ingested_at string, id int")
    s = spark.sql("select named_struct('bronze_ingested_at', '2024-01-15T00:00:00Z') _metadata")
    assert ids(choose_reading(b, s).rows) == [1]


def test_modes(spark):
    b = bronze(spark, "2024-01-01", "2024-01-03")
    s = silver(spark, "2024-01-01")
    assert choose_reading(b, None).mode == FULL_LOAD
    assert choose_reading(b, s.limit(0)).mode == FULL_LOAD
    r = choose_reading(b, s)
    assert (r.mode, ids(r.rows), r.nothing_to_do) == (INCREMENTAL, [1], False)
    r = choose_reading(b, s, "2024-01-01", "2024-01-01")
    assert (r.mode, ids(r.rows)) == (DATE_RANGE, [0])
    assert choose_reading(b, s, start="2024-01-01").mode == INCREMENTAL
    assert choose_reading(b, s, end="2024-01-01").mode == INCREMENTAL


def test_empty_input_policy(spark):
    b, s = bronze(spark, "2024-01-01"), silver(spark, "2024-01-01")
    assert choose_reading(b, s).nothing_to_do
    assert choose_reading(b, s, "2020-01-01", "2020-01-02").nothing_to_do
    assert not choose_reading(b.limit(0), None).nothing_to_do


def test_no_mark(spark):
    b = bronze(spark, "2024-01-01")
    with pytest.raises(ValueError):
        choose_reading(b, spark.range(1))
    with pytest.raises(ValueError):
        choose_reading(b, silver(spark, None))


def test_days_are_pruned(spark, tmp_path):
    b = spark.sql("select id, timestamp'2024-01-01' + make_dt_interval(id) _ingested_at from range(5)")
    path = str(tmp_path / "b")
    b.selectExpr("*", "date(_ingested_at) _ingestion_date").write.partitionBy("_ingestion_date").parquet(path)
    out = above(spark.read.parquet(path), dt.datetime(2024, 1, 4, tzinfo=UTC))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_ingestion_date" in plan and ">= 2024-01-03" in plan
    assert "PushedFilters: [IsNotNull(_ingested_at), GreaterThan(_ingested_at" in plan
    assert ids(out) == [4]
