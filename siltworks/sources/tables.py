"""Catalog tables as frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sinks.store import StoredTable


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A named table with all its commits, those that are not folded into it yet included; a missing one is an error."""
    stored = StoredTable.by_name(spark, name)
    return stored.read() if stored is not None and stored.pending_runs else spark.read.table(name)


def table_if_exists(spark: SparkSession, name: str) -> DataFrame | None:
    return read_table(spark, name) if spark.catalog.tableExists(name) else None
