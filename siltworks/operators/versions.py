"""Merge on read: the state of a keyed table from its base rows and later runs of rows.

A *run* is what one commit brought: at most one row per key, numbered in the order of commits. The state of a key is what
upserting the runs one after another into the base gives: a row is taken when every ordering column of its commit
is not older than the state's; a column that its commit did not have keeps its value. Which runs are taken follows from
the ordering columns alone, so the other columns of the base are read only where they are asked for.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ref
from ..functions.names import quoted
from .merge import merge_key

RUN = "__run"
_VERSIONS, _OLD, _TAKEN = "__versions", "__in_old", "__taken"


class Run(NamedTuple):
    """A commit's number, the columns that decided about its rows, and the columns it had (lower case)."""

    number: int
    order_by: tuple[str, ...]
    columns: frozenset[str]


def _by_run(versions: Column) -> Column:
    return F.array_sort(versions, lambda a, b: F.signum(a[RUN] - b[RUN]).cast("int"))


def versions_of(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with its versions, oldest first: no more of them than there are runs."""
    whole = F.struct(*[ref(c) for c in runs.columns])
    names = [F.col(quoted(k)).alias(f"__key{i}") for i, k in enumerate(keys)]
    return runs.groupBy(*names).agg(_by_run(F.collect_list(whole)).alias(_VERSIONS))


def _taken(schema: T.StructType, runs: Sequence[Run]) -> Column:
    """Numbers of the runs whose rows were taken, in order, from the base row (if any) and the versions."""
    orders = {tuple(c.lower() for c in r.order_by) for r in runs}
    columns = {f.name.lower(): f for f in schema.fields}
    used = sorted({c for o in orders for c in o})
    slot = {c: f"o{i}" for i, c in enumerate(used)}

    def state(row, taken: Column) -> Column:
        return F.struct(*[row(c).cast(columns[c].dataType).alias(slot[c]) for c in used], taken.alias("taken"))

    def newer(acc: Column, x: Column) -> Column:
        def by(order: tuple[str, ...]) -> Column:
            return F.coalesce(reduce(and_, [acc[slot[c]] <= x[columns[c].name] for c in order]), F.lit(False)) if order else F.lit(True)

        cases = None
        for order in sorted(orders):
            numbers = [r.number for r in runs if tuple(c.lower() for c in r.order_by) == order]
            cases = (F if cases is None else cases).when(x[RUN].isin(numbers), by(order))
        return cases.otherwise(F.lit(False))

    def step(acc: Column, x: Column) -> Column:
        def value(c: str) -> Column:
            without = [r.number for r in runs if c not in r.columns]
            own = x[columns[c].name]
            return F.when(x[RUN].isin(without), acc[slot[c]]).otherwise(own) if without else own

        return F.when(newer(acc, x), state(value, F.array_append(acc["taken"], x[RUN]))).otherwise(acc)

    versions, first = F.col(_VERSIONS), F.get(F.col(_VERSIONS), 0)
    nothing = F.array().cast("array<bigint>")
    old = F.aggregate(versions, state(lambda c: ref(columns[c].name), nothing), step)["taken"]
    fresh = F.aggregate(F.slice(versions, 2, F.size(versions)), state(lambda c: first[columns[c].name], F.array(first[RUN])), step)["taken"]
    return F.when(F.col(_VERSIONS).isNull(), nothing).when(F.col(_OLD), old).otherwise(fresh)


def merged(base: DataFrame, runs_frame: DataFrame, keys: Sequence[str], runs: Sequence[Run], small: bool) -> DataFrame:
    """The table's rows. ``runs_frame`` has the base's columns and ``RUN``; ``small``: the runs' *measured* size fits memory.

    Small runs are broadcast and the base is not shuffled; else both sides are shuffled once by their keys.
    """
    versions = versions_of(runs_frame, keys)
    own = base.withColumn(_OLD, F.lit(True))
    same = reduce(and_, [ref(k).eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(keys)])
    if small:
        both = own.join(F.broadcast(versions), same, "left")
        names = [quoted(k) for k in keys]
        wanted = versions.select(*[F.col(f"__key{i}").alias(k) for i, k in enumerate(keys)])
        known = base.select(*names).alias("old").join(F.broadcast(wanted).alias("new"), merge_key(keys), "left_semi")
        renamed = known.select(*[F.col(n).alias(f"__old{i}") for i, n in enumerate(names)])
        unseen = reduce(and_, [F.col(f"__key{i}").eqNullSafe(F.col(f"__old{i}")) for i in range(len(keys))])
        fresh = versions.join(F.broadcast(renamed), unseen, "left_anti")
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in base.schema.fields]
        both = both.unionByName(fresh.select(*empty, F.lit(None).cast("boolean").alias(_OLD), "*"))
    else:
        both = own.join(versions, same, "full_outer")
    told = both.withColumn(_TAKEN, _taken(base.schema, runs))

    def value(field: T.StructField) -> Column:
        without = [r.number for r in runs if field.name.lower() not in r.columns]
        taken = F.filter(_TAKEN, lambda r: ~r.isin(without)) if without else F.col(_TAKEN)
        last = F.get(taken, F.size(taken) - 1)
        row = F.get(F.filter(_VERSIONS, lambda v: v[RUN] == last), 0)
        return F.when(F.size(taken) == 0, ref(field.name)).otherwise(row[field.name]).alias(field.name)

    return told.select(*[value(f) for f in base.schema.fields])


def thinned(runs_frame: DataFrame, keys: Sequence[str], runs: Sequence[Run]) -> DataFrame:
    """Rows of several runs without those that can never be seen; all rows where that cannot be told.

    It can where all runs had the same columns and at most one and the same ordering column: then the newest version of a
    key decides whatever the base has, unless a version has no value to compare.
    """
    if len({(r.order_by, r.columns) for r in runs}) > 1 or len(runs[0].order_by) > 1:
        return runs_frame
    versions = F.col(_VERSIONS)
    rest, first = F.slice(versions, 2, F.size(versions)), F.get(versions, 0)
    if runs[0].order_by:
        name = next(c for c in runs_frame.columns if c.lower() == runs[0].order_by[0].lower())
        best = F.aggregate(rest, first, lambda acc, x: F.when(acc[name] <= x[name], x).otherwise(acc))
        kept = F.when(F.exists(versions, lambda v: v[name].isNull()), versions).otherwise(F.array(best))
    else:
        kept = F.array(F.get(versions, F.size(versions) - 1))
    return versions_of(runs_frame, keys).select(F.inline(kept)).select(*[ref(c) for c in runs_frame.columns])


def run_of(entry: Collection) -> Run:
    """A run as the manifest has it."""
    number, order_by, columns = entry
    return Run(number, tuple(order_by), frozenset(columns))
