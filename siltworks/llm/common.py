"""What several operators on documents share: white space, row keys, stored intermediate tables."""

from __future__ import annotations

import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import work_folder

# The six characters that separate words, as a class of Java, Python and RE2 patterns.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def text_of(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for an empty text."""
    return F.array_remove(F.split(text, SPACE + "+"), "")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame, written once to the cluster's shared folder and read back.

    It is computed once, however often it is used, and survives lost executors; lineage ends here.
    """
    path = work_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key() -> Column:
    """A 64-bit number of (doc_id, text), by which decisions about documents are carried back to them."""
    return F.xxhash64("doc_id", text_of())


def without(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The documents that stay, all columns, given (key, kept) of every row.

    Documents meet only the keys that go, and those that several rows share, of which one row stays.
    """
    counts = stored(decided.groupBy(F.col("key").alias("__key")).agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n")), "decided")
    gone, shared = counts.filter("NOT stays").select("__key"), counts.filter("stays AND n > 1").select("__key")
    own = docs.withColumn("__key", row_key())
    single = own.join(gone.union(shared), "__key", "left_anti")
    one = own.join(shared, "__key", "left_semi").dropDuplicates(["__key"])
    return single.unionByName(one).select(*docs.columns)


def prefix_sums(values: Column, block: int = 256, combine: Callable[[Column, Column], Column] = operator.add) -> Column:
    """Sums of all *earlier* elements of an array of longs, one for each element; 0 for the first.

    ``combine`` may be another associative function to which 0 means nothing, such as the greater of natural numbers.

    An accumulating array is copied at every step, so sums are formed in blocks: the work is n * block
    rather than n * n for the arrays of very long texts.
    """
    zero = F.lit(0).cast("bigint")

    def running(array: Column, start: Column) -> Column:
        """start, start + a1, start + a1 + a2 …: one more element than the array."""
        return F.aggregate(
            array,
            F.array(start),
            lambda acc, x: F.concat(acc, F.array(combine(F.element_at(acc, -1), x))),
        )

    def total(array: Column) -> Column:
        return F.aggregate(array, zero, lambda acc, x: combine(acc, x))

    def blocks_of(array: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(array) - 1) / block).cast("int"))
        return F.transform(starts, lambda b: F.slice(array, b * block + 1, block))

    def blocked(array: Column) -> Column:
        return bind(
            blocks_of(array),
            lambda blocks: F.flatten(
                F.zip_with(
                    blocks,
                    F.slice(running(F.transform(blocks, total), zero), 1, F.size(blocks)),
                    lambda b, start: F.slice(running(b, start), 1, F.size(b)),
                )
            ),
        )

    return bind(
        values,
        lambda v: F.when(F.size(v) == 0, F.array().cast("array<bigint>"))
        .when(F.size(v) <= block, F.slice(running(v, zero), 1, F.size(v)))
        .otherwise(blocked(v)),
    )


def bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row, where a lambda would compute it per element."""
    return F.element_at(F.transform(F.array(value), body), 1)
