"""What to read from bronze: date range, everything, or rows above the high-water mark."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import INGESTED_AT, INGESTION_DATE, METADATA, ref

DATE_RANGE = "date_range"
FULL_LOAD = "full_load"
INCREMENTAL = "incremental"


def in_range(df: DataFrame, start, end, column: str = INGESTED_AT) -> DataFrame:
    """Both ends inclusive. A date alone means its midnight, so the rest of that day is out."""
    kept = df.filter((ref(column) >= F.lit(start)) & (ref(column) <= F.lit(end)))
    return _prune_days(kept, column, low=start, high=end)


def above(df: DataFrame, mark: dt.datetime, column: str = INGESTED_AT) -> DataFrame:
    """Strictly newer than the mark. The mark is a literal, so the scan gets the filter."""
    return _prune_days(df.filter(ref(column) > F.lit(mark)), column, low=mark)


def _prune_days(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Bronze is partitioned by ingestion day: add the implied day filter, so old days are not opened.

    A day more on either side covers bronze that was written under another time zone.
    """
    if column != INGESTED_AT or INGESTION_DATE not in df.columns:
        return df
    day = lambda end, shift: F.date_add(F.lit(end).cast("timestamp").cast("date"), shift)
    if low is not None:
        df = df.filter(ref(INGESTION_DATE) >= day(low, -1))
    if high is not None:
        df = df.filter(ref(INGESTION_DATE) <= day(high, 1))
    return df


def high_water_mark(silver: DataFrame) -> dt.datetime:
    """Greatest bronze ingestion time in silver: one value, pre-aggregated in every task.

    It travels as microseconds, so the driver's own time zone plays no part.
    """
    micros = None
    if METADATA in silver.columns:
        ingested = F.col(f"{METADATA}.bronze_ingested_at").cast("timestamp")
        micros = silver.agg(F.unix_micros(F.max(ingested))).first()[0]
    if micros is None:
        raise ValueError(f"silver has no {METADATA}.bronze_ingested_at; cannot read incrementally")
    return moment(micros)


@dataclass(frozen=True)
class Reading:
    mode: str
    rows: DataFrame

    @property
    def nothing_to_do(self) -> bool:
        """No rows end a range or incremental run; a full load still creates the empty table."""
        return self.mode != FULL_LOAD and self.rows.isEmpty()


def moment(micros: int) -> dt.datetime:
    return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=micros)


def choose_reading(
    bronze: DataFrame, silver: DataFrame | None, start=None, end=None, mark: dt.datetime | None = None
) -> Reading:
    """Both dates: range. No silver, or an empty one: everything. Else: above the mark.

    A ``mark`` that was kept with the last commit spares a look at silver.
    """
    if start and end:
        return Reading(DATE_RANGE, in_range(bronze, start, end))
    if silver is not None and mark is not None:
        return Reading(INCREMENTAL, above(bronze, mark))
    if silver is None or silver.isEmpty():
        return Reading(FULL_LOAD, bronze)
    return Reading(INCREMENTAL, above(bronze, high_water_mark(silver)))
