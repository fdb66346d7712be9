"""Column expressions shared by the bronze and silver steps. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import quoted

HASH_SUFFIX = "_hashed_key"
METADATA = "_metadata"
INGESTED_AT = "_ingested_at"
INGESTION_DATE = "_ingestion_date"
RAW_DATA = "_raw_data"


def ref(name: str) -> Column:
    return F.col(quoted(name))


def pii_hash(value: Column) -> Column:
    """Lower-case hex SHA-256 of the value's text; null stays null, so it never joins."""
    return F.sha2(value.cast("string"), 256)


def populated(name: str, dtype: T.DataType) -> Column:
    """Not null and, for text, not blank."""
    there = ref(name).isNotNull()
    return there & (F.trim(ref(name)) != "") if isinstance(dtype, T.StringType) else there


def raw_payload(df: DataFrame) -> Column:
    """JSON text of all data columns; columns named ``_metadata*`` are left out, null fields omitted."""
    return F.to_json(F.struct(*[ref(c) for c in df.columns if not c.startswith(METADATA)]))


def with_audit_columns(df: DataFrame, provenance: bool = True) -> DataFrame:
    """Add raw payload, ingestion time and date and, for file sources, the file provenance struct.

    ``_metadata`` is a hidden column of file sources: it becomes a stored one only by naming it.
    """
    added = [
        raw_payload(df).alias(RAW_DATA),
        F.current_timestamp().alias(INGESTED_AT),
        F.current_date().alias(INGESTION_DATE),
    ]
    if provenance and METADATA not in df.columns:
        added.append(F.col(METADATA))
    return df.select("*", *added)


def with_lineage(df: DataFrame) -> DataFrame:
    """Put bronze ingestion and silver processing times into ``_metadata`` (made when absent)."""
    bronze_at, silver_at = ref(INGESTED_AT), F.current_timestamp()
    if METADATA in df.columns:
        struct = (
            F.col(METADATA)
            .withField("bronze_ingested_at", bronze_at)
            .withField("silver_processed_at", silver_at)
        )
    else:
        struct = F.struct(
            bronze_at.alias("bronze_ingested_at"), silver_at.alias("silver_processed_at")
        )
    return df.withColumn(METADATA, struct)
