"""Upsert of a batch into a table, as frames. Storing the result is the sink's work.

Between batches a row is replaced when *every* ordering column is at most the new one (a
conjunction); within a batch the winner is the lexicographically greatest. With two or more
ordering columns the final table can therefore depend on how rows were cut into batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import TableContract
from ..functions.columns import ref
from ..functions.names import quoted
from ..session import join_where_rows_lie
from .keys import match_columns, with_match_columns

_OLD, _NEW, _PLACE = "__in_old", "__in_new", "__place"
# A batch that nobody has measured is broadcast if its rows, as text, take no more than this.
SMALL_TEXT_BYTES = 32 << 20


def _side(alias: str, name: str) -> Column:
    return F.col(f"{alias}.{quoted(name)}")


def merge_key(keys: Sequence[str], old: str = "old", new: str = "new") -> Column:
    """Null-safe equality on every key; Spark still plans it as an equi-join."""
    if not keys:
        raise ValueError("an upsert needs at least one key")
    return reduce(and_, [_side(old, k).eqNullSafe(_side(new, k)) for k in keys])


def may_replace(order_by: Sequence[str], old: str = "old", new: str = "new") -> Column:
    """True when every ordering column is not older. Ties replace; a null on either side does not."""
    if not order_by:
        return F.lit(True)
    return F.coalesce(
        reduce(and_, [_side(old, c) <= _side(new, c) for c in order_by]), F.lit(False)
    )


def _union_fields(old: DataFrame, new: DataFrame) -> list[tuple[str, T.DataType]]:
    fields = {f.name.lower(): (f.name, f.dataType) for f in old.schema.fields}
    for f in new.schema.fields:
        fields.setdefault(f.name.lower(), (f.name, f.dataType))
    return list(fields.values())


def _merged_columns(old: DataFrame, new: DataFrame, take_new: Column) -> list[Column]:
    """All columns of both sides: new values where ``take_new``, columns of one side only survive."""
    in_old, in_new = ({c.lower() for c in df.columns} for df in (old, new))
    result = []
    for name, dtype in _union_fields(old, new):
        key = name.lower()
        if key in in_old and key in in_new:
            value = F.when(take_new, _side("new", name).cast(dtype)).otherwise(_side("old", name))
        elif key in in_new:
            value = F.when(take_new, _side("new", name))
        else:
            value = _side("old", name)
        result.append(value.alias(name))
    return result


def upsert(
    old: DataFrame, new: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), place: Column | None = None
) -> DataFrame:
    """Any sizes: one full outer join on the keys, null equal to null, both sides shuffled once.

    Keys are unique on both sides, so no key is hot. A side that comes from ``latest_per_key`` with
    its match columns kept is joined where it lies, without another exchange or sort. Matched and not older: new values. Matched
    and older: old ones. Rows of one side only are kept or inserted. ``place``, an expression of keys that have one type on
    both sides, says which rows are brought together, as a writer needs them: the result is not moved again.
    """
    if not keys:
        raise ValueError("an upsert needs at least one key")
    prepared_old, prepared_new = with_match_columns(old, keys), with_match_columns(new, keys)
    if place is not None:
        join_where_rows_lie(old.sparkSession)
        prepared_old, prepared_new = (df.withColumn(_PLACE, place).repartition(_PLACE) for df in (prepared_old, prepared_new))
    o = prepared_old.withColumn(_OLD, F.lit(True)).alias("old")
    n = prepared_new.withColumn(_NEW, F.lit(True)).alias("new")
    alike = [*([] if place is None else [_PLACE]), *match_columns(keys)]
    same_key = reduce(and_, [_side("old", m) == _side("new", m) for m in alike])
    matched = _side("old", _OLD).isNotNull() & _side("new", _NEW).isNotNull()
    take_new = _side("new", _NEW).isNotNull() & (~matched | may_replace(order_by))
    helpers = match_columns(keys)
    return o.join(n, same_key, "full_outer").select(
        *_merged_columns(old.drop(*helpers), new.drop(*helpers), take_new)
    )


def text_bytes(rows: DataFrame) -> Column:
    """Bytes of a row as text."""
    return F.octet_length(F.to_json(F.struct(*[ref(c) for c in rows.columns]), {"ignoreNullFields": "false"}))


def upsert_small(
    old: DataFrame, new: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), measured: bool = False
) -> DataFrame:
    """For a small ``new``: ``old`` is not shuffled.

    Gives what ``upsert`` gives. A full outer join cannot broadcast, so it is split in two. Updates: ``old`` left join
    broadcast ``new``. Inserts: ``new`` minus the old keys that occur in ``new``, of which there
    are no more than rows in ``new``. ``measured`` tells that the caller has found ``new`` to fit in memory; else its rows are
    measured here, by one job, and joined without a broadcast where they take too much.
    """
    small = measured or (new.agg(F.sum(text_bytes(new))).first()[0] or 0) <= SMALL_TEXT_BYTES
    sent = F.broadcast if small else (lambda df: df.hint("merge"))
    hinted = sent(new.withColumn(_NEW, F.lit(True))).alias("new")
    take_new = _side("new", _NEW).isNotNull() & may_replace(order_by)
    updated = old.alias("old").join(hinted, merge_key(keys), "left").select(
        *_merged_columns(old, new, take_new)
    )
    key_columns = [quoted(k) for k in keys]
    known = (
        old.select(*key_columns)
        .alias("old")
        .join(sent(new.select(*key_columns)).alias("new"), merge_key(keys), "left_semi")
    )
    fresh = new.alias("new").join(sent(known).alias("old"), merge_key(keys), "left_anti")
    inserted = fresh.select(
        *[
            (_side("new", name).cast(dtype) if name.lower() in {c.lower() for c in new.columns}
             else F.lit(None).cast(dtype)).alias(name)
            for name, dtype in _union_fields(old, new)
        ]
    )
    return updated.unionByName(inserted)


def upsert_by_contract(old: DataFrame, new: DataFrame, contract: TableContract) -> DataFrame:
    return upsert(old, new, contract.primary_keys, contract.deduplication_keys)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; an upsert of such a batch has no defined result."""
    return (
        df.groupBy(*[quoted(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1")
    )


def matching_rows(df: DataFrame, key: str, row_id: str) -> DataFrame:
    """Self-join ``key = key and id < id``, told per key instead of per pair.

    Gives, for every non-null key that several rows share, how many rows and ordered pairs there
    are and the first and last row. Listing the pairs grows with the square of a hot key; this is
    one aggregate with map-side combine. Null keys never match, as in the join.
    """
    return (
        df.filter(F.col(quoted(key)).isNotNull())
        .groupBy(F.col(quoted(key)).alias(key))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min(quoted(row_id)).alias("first_id"),
            F.max(quoted(row_id)).alias("last_id"),
        )
        .filter("n_rows > 1")
        .withColumn("n_pairs", F.expr("n_rows * (n_rows - 1) div 2"))
    )
