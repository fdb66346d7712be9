"""Planning of paged extraction from landed pages: distinct keys, key batches, page offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ref
from ..session import ensure_checkpoint_dir, shuffle_partitions, whole_numbers

# Rows that one task makes from one block of a page plan.
PAGES_PER_BLOCK = 10_000


def distinct_keys(pages: DataFrame, elements: Column, field: str, name: str = "key") -> DataFrame:
    """Non-empty keys of all elements of all pages, once each (combined in every task first)."""
    return (
        pages.select(F.explode(elements).alias("__element"))
        .select(F.col("__element").getField(field).alias(name))
        .filter(F.col(name).isNotNull() & (F.col(name) != ""))
        .distinct()
    )


def numbered(df: DataFrame, order_by: str, name: str = "position") -> DataFrame:
    """Positions 0, 1, 2 … in the order of a unique column, without a global window.

    The frame is range-partitioned, sorted and checkpointed, so that counts and rows come from the
    same partitions even when executors are lost. Each partition's first position follows from
    the counts of the earlier ones: one row per partition, whatever the data size.
    """
    low_bits = (1 << 33) - 1
    ensure_checkpoint_dir(df.sparkSession)
    parts = shuffle_partitions(df.sparkSession)
    placed = (
        df.repartitionByRange(parts, ref(order_by))
        .sortWithinPartitions(ref(order_by))
        .withColumn("__mid", F.monotonically_increasing_id())
        .checkpoint()
    )
    part = F.shiftright("__mid", 33).cast("int")
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n")).collect()
    first, total = [], 0
    for row in sorted(counts, key=lambda r: r["__part"]):
        first.append((row["__part"], total))
        total += row["__n"]
    starts = F.broadcast(whole_numbers(df.sparkSession, first, "__part int, __first bigint"))
    return (
        placed.withColumn("__part", part)
        .join(starts, "__part")
        .withColumn(name, F.col("__first") + F.col("__mid").bitwiseAND(F.lit(low_bits)))
        .drop("__part", "__first", "__mid")
    )


def key_batches(keys: DataFrame, key: str, size: int) -> DataFrame:
    """Batches of ``size`` keys in key order, the last one may be shorter; numbered from 1."""
    if size < 1:
        raise ValueError("the batch size must be at least 1")
    batch = F.floor(F.col("position") / F.lit(size)).cast("bigint") + 1
    return (
        numbered(keys.select(ref(key)), key)
        .groupBy(batch.alias("batch_no"))
        .agg(F.array_sort(F.collect_list(ref(key))).alias("keys"))
    )


def page_plan(sources: DataFrame, total: str, limit: int) -> DataFrame:
    """Offsets 0, limit, 2·limit … below the total, page 0 always.

    Long plans are cut into blocks that are spread over the cluster before they are expanded, so a
    source with a third of all pages is not expanded by one task, nor held as one array.
    """
    if limit < 1:
        raise ValueError("the page limit must be at least 1")
    last = F.greatest(F.coalesce(ref(total).cast("bigint"), F.lit(0)) - 1, F.lit(0).cast("bigint"))
    step = F.lit(limit * PAGES_PER_BLOCK).cast("bigint")
    zero = F.lit(0).cast("bigint")
    blocks = sources.withColumn("__last", last).withColumn(
        "__start", F.explode(F.sequence(zero, F.col("__last"), step))
    )
    end = F.least(F.col("__last"), F.col("__start") + step - 1)
    return (
        blocks.repartition(shuffle_partitions(sources.sparkSession))
        .withColumn("offset", F.explode(F.sequence(F.col("__start"), end, F.lit(limit).cast("bigint"))))
        .drop("__last", "__start")
    )


def pages_before_first_empty(
    pages: DataFrame, source: str, offset: str, is_empty: Column
) -> DataFrame:
    """Pages that a reader sees who stops at the first empty page; page 0 always stays.

    The stop offset is one small aggregate per source. It is joined back rather than computed in
    a window, so a source with very many pages is neither sorted nor held by one task: adaptive
    execution splits its join partition.
    """
    stops = (
        pages.filter(is_empty & (ref(offset) > 0))
        .groupBy(ref(source).alias("__source"))
        .agg(F.min(ref(offset)).alias("__stop"))
    )
    return (
        pages.join(stops, ref(source).eqNullSafe(F.col("__source")), "left")
        .filter(F.col("__stop").isNull() | (ref(offset) < F.col("__stop")))
        .drop("__source", "__stop")
    )
