"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# UTC throughout; adaptive execution sizes partitions and splits skewed joins at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}

_SOME_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
SETTINGS[_SOME_KEYS] = "false"

SHUFFLE_BYTES_PER_PARTITION = 200 << 20


def build_session(app: str = "siltworks", input_bytes: int | None = None, **conf) -> SparkSession:
    """A session with the settings above; ``input_bytes`` sizes the shuffle for the data at hand."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    if input_bytes is not None:
        builder = builder.config(
            "spark.sql.shuffle.partitions", max(8, input_bytes // SHUFFLE_BYTES_PER_PARTITION)
        )
    return builder.getOrCreate()


def join_where_rows_lie(spark: SparkSession) -> None:
    """Rows that both sides of a join have brought together by some of its keys are joined there, in sessions built elsewhere too.

    The setting decides how rows are moved, not what comes out; it stays, as frames are planned when they are run.
    """
    if spark.conf.get(_SOME_KEYS) != "false":
        spark.conf.set(_SOME_KEYS, "false")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning, _was, _cleaning_lock = Counter(), {}, threading.Lock()


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Queries that run in here delete their shuffle files when they end, not when the driver collects garbage.

    Several threads may be in here for one session; the setting is as before when the last has left.
    """
    session = spark._jsparkSession.hashCode()
    with _cleaning_lock:
        if not _cleaning[session]:
            _was[session] = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _cleaning[session] += 1
    try:
        yield
    finally:
        with _cleaning_lock:
            _cleaning[session] -= 1
            if not _cleaning[session]:
                before = _was.pop(session)
                spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)


def whole_numbers(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the driver, with columns int or bigint, as a frame.

    They go as Arrow: a frame made of a list of tuples starts Python workers of its own on each executor, which stay there.
    """
    names, kinds = zip(*(column.split() for column in schema.split(", ")))
    types = [{"int": pa.int32(), "bigint": pa.int64()}[kind] for kind in kinds]
    columns = list(zip(*rows)) or [()] * len(names)
    return spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(names)), schema)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by the cluster.

    Where none is named, a run on one machine gets one folder of its own for all of its life; on a
    cluster that is an error, as executors would write to disks that the driver cannot see.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("name a folder that all executors see in spark.checkpoint.dir")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="siltworks-")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; every call gets another one."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
