"""Key filter and latest row per key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import TableContract
from ..functions.columns import populated, ref


def require_keys(df: DataFrame, groups: Iterable[Sequence[str]]) -> DataFrame:
    """Keep rows in which every group has at least one populated column. Empty groups are skipped."""
    groups = [list(g) for g in groups if g]
    absent = sorted({c for g in groups for c in g} - set(df.columns))
    if absent:
        raise ValueError(f"cannot filter on columns that do not exist: {absent}")
    for group in groups:
        anything = F.lit(False)
        for name in group:
            anything |= populated(name, df.schema[name].dataType)
        df = df.filter(anything)
    return df


def require_contract_keys(df: DataFrame, contract: TableContract) -> DataFrame:
    return require_keys(df, contract.key_groups)


def _stand_in(dtype: T.DataType) -> Column:
    """Any non-null constant of the type."""
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.NumericType):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.BinaryType):
        return F.lit(b"")
    if isinstance(dtype, T.ArrayType):
        return F.array().cast(dtype)
    if isinstance(dtype, T.StructType):
        return F.struct(*[_stand_in(f.dataType).alias(f.name) for f in dtype.fields]).cast(dtype)
    return F.lit("1970-01-01").cast(dtype)


def match_columns(keys: Sequence[str]) -> list[str]:
    """Names of the columns that stand for the keys where null must equal null."""
    return [n for i in range(len(keys)) for n in (f"__key_{i}", f"__key_{i}_null")]


def match_values(key: Column, dtype: T.DataType) -> tuple[Column, Column]:
    """What the match columns of a key hold."""
    return F.coalesce(key, _stand_in(dtype)), key.isNull()


def with_match_columns(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add, per key, its value (a constant for null) and whether it is null.

    Two keys are null-safe equal exactly when these columns are equal. As plain columns they also
    carry the partitioning and sort order of one step to the next: a join on them after a window
    over them needs no second exchange, which null-safe equality on the keys would cause.
    """
    names = match_columns(keys)
    if set(names) <= set(df.columns):
        return df
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    values = [c for k in keys for c in match_values(ref(k), types[k.lower()])]
    return df.select("*", *[v.alias(n) for v, n in zip(values, names) if n not in df.columns])


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _tie_break(df: DataFrame, used: set[str]) -> list[Column]:
    """Order by everything else too, so equal keys have one winner on every run."""
    return [
        (ref(f.name) if _orderable(f.dataType) else F.to_json(ref(f.name))).desc_nulls_last()
        for f in df.schema.fields
        if f.name not in used
    ]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    whole_frame: bool = False,
    break_ties: bool = True,
    keep_match_columns: bool = False,
    limit_first: bool = True,
    place: Column | None = None,
    lies: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the greatest by ``order_by``, nulls last. A null key is a value.

    Catalyst turns ``row_number() = 1`` into a group limit that runs *before* the exchange too:
    each task forwards one row per key, so a key that holds a third of all rows costs the reducer
    no more than one row per map task. That limit sorts what each task has read, on disk where it is much;
    without ``limit_first`` rows are sorted once, after the exchange: for keys that are seldom repeated.
    ``keep_match_columns`` prepares the result for an upsert that reuses this exchange. ``place``, an expression of
    the keys, says which rows are brought together (without ``limit_first``), as a writer needs them. ``lies`` names columns,
    made of keys, by which rows have been brought together before; they go, but for match columns that are kept.
    """
    if not keys and not whole_frame:
        raise ValueError("no keys: one row of the whole frame would survive; ask for it with whole_frame")
    if not keys:
        return _latest_of_all(df, order_by, break_ties)
    order = [ref(c).desc_nulls_last() for c in order_by]
    if break_ties or not order:
        # Keys are equal among the rows compared, however they are spelled.
        order += _tie_break(df, {*order_by, *lies, *(f.name for f in df.schema.fields if f.name.lower() in {k.lower() for k in keys})})
    order = order or [F.lit(1).asc()]
    partition, columns, fields = [ref(k) for k in keys], df.columns, {f.name.lower(): f for f in df.schema.fields}
    if lies and not keep_match_columns:
        partition = [*map(F.col, lies), *partition]
    elif place is not None and not limit_first:
        df, partition = df.withColumn("__place", place), [F.col("__place"), *partition]
        df = df.repartition("__place")
    elif keep_match_columns:
        df, partition = with_match_columns(df, keys), [F.col(n) for n in match_columns(keys)]
        if not limit_first:
            # The keys do not travel beside the columns that stand for them.
            ordering = {c.lower() for c in order_by}
            df = df.drop(*[fields[k.lower()].name for k in keys if k.lower() not in ordering])
    window = Window.partitionBy(*partition).orderBy(*order)
    # A rank is limited on both sides of the exchange, a look at the row before is not.
    place_in_key = F.row_number().over(window) if limit_first else F.lag(F.lit(1)).over(window)
    found = F.col("__rank") == 1 if limit_first else F.col("__rank").isNull()
    latest = df.withColumn("__rank", place_in_key).filter(found).drop("__rank", "__place")
    if not keep_match_columns:
        return latest.drop(*lies)
    back = {fields[k.lower()].name: i for i, k in enumerate(keys)}
    whole = [
        F.when(~F.col(f"__key_{i}_null"), F.col(f"__key_{i}")).alias(c) if c not in latest.columns and (i := back.get(c)) is not None else ref(c)
        for c in columns
    ]
    return latest.select(*whole, *[m for m in match_columns(keys) if m not in columns])


def _latest_of_all(df: DataFrame, order_by: Sequence[str], break_ties: bool) -> DataFrame:
    """Top row of the frame: a top-1 per task, then one over the tasks, never a global window."""
    order = [ref(c).desc_nulls_last() for c in order_by]
    if break_ties or not order:
        order += _tie_break(df, set(order_by))
    return df.orderBy(*order).limit(1)


def latest_by_contract(df: DataFrame, contract: TableContract, keep_match_columns=False, **how) -> DataFrame:
    return latest_per_key(
        df,
        contract.primary_keys,
        contract.deduplication_keys,
        keep_match_columns=keep_match_columns,
        **how,
    )
