"""What a contract turns away: values that do not fit their type, and rows without keys.

An examined frame carries, row by row, what is wrong with it; the rows that silver keeps are its rows without
``no key``. Rejects are told one per row and column, with the payload they came from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import METADATA, populated, ref
from ..functions.names import quoted

REJECTS, PAYLOAD = "__rejects", "__payload"
BAD_TYPE, NO_KEY = "type", "no key"
KIND = "struct<column:string,reason:string,value:string>"
NOTHING = f"array<{KIND}>"


def reject(column: str, reason: str, value: Column) -> Column:
    return F.struct(F.lit(column).alias("column"), F.lit(reason).alias("reason"), value.alias("value")).cast(KIND)


def misfit(name: str, value: Column, made: Column) -> Column:
    """An array of one reject where a value was given and nothing came of it, else an empty one."""
    text = F.coalesce(value.try_cast("string"), F.lit(""))
    return F.when(value.isNotNull() & made.isNull(), F.array(reject(name, BAD_TYPE, text))).otherwise(F.array().cast(NOTHING))


def with_key_rejects(df: DataFrame, groups: Sequence[Sequence[str]]) -> DataFrame:
    """Add a reject for each group of key columns of which none is populated."""
    found = F.col(REJECTS)
    for group in (g for g in groups if g):
        anything = F.lit(False)
        for name in group:
            anything |= populated(name, df.schema[name].dataType)
        missing = F.array(reject(",".join(group), NO_KEY, F.lit(None).cast("string")))
        found = F.concat(found, F.when(~F.coalesce(anything, F.lit(False)), missing).otherwise(F.array().cast(NOTHING)))
    return df.withColumn(REJECTS, found)


def kept(examined: DataFrame) -> DataFrame:
    """The rows that have their keys, without the notes."""
    return examined.filter(~F.exists(REJECTS, lambda r: r["reason"] == NO_KEY)).drop(REJECTS, PAYLOAD)


def rejected(examined: DataFrame) -> DataFrame:
    """column, reason, value, payload, and where the row came from: a row for each reject."""
    names = getattr(examined.schema[METADATA].dataType, "names", []) if METADATA in examined.columns else []
    origin = [
        (F.col(f"{quoted(METADATA)}.{n}") if n in names else F.lit(None)).cast(t).alias(n)
        for n, t in (("file_path", "string"), ("bronze_ingested_at", "timestamp"))
    ]
    return examined.filter(F.size(REJECTS) > 0).select(F.explode(REJECTS).alias("r"), PAYLOAD, *origin).select(
        "r.*", F.col(PAYLOAD).alias("payload"), "file_path", "bronze_ingested_at"
    )


def observed(examined: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame, and an observation of rows examined and turned away, filled by whatever action runs over it."""
    note = Observation(name)
    bad = F.size(F.filter(REJECTS, lambda r: r["reason"] == BAD_TYPE)).cast("bigint")
    lost = F.exists(REJECTS, lambda r: r["reason"] == NO_KEY).cast("bigint")
    return examined.observe(note, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(bad), F.lit(0)).alias("bad_values"), F.coalesce(F.sum(lost), F.lit(0)).alias("rows_without_key")), note


def payload_of(df: DataFrame) -> Column:
    """The raw payload where bronze kept it, else all columns as JSON."""
    if "_raw_data" in df.columns:
        return ref("_raw_data")
    return F.to_json(F.struct(*[ref(c) for c in df.columns if c != METADATA]))
