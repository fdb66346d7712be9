"""Flatten structs and explode arrays of structs.

The whole shape is worked out on the schema: column expressions are gathered symbolically and
a ``select`` is made only where a generator needs one, plus a last one. Catalyst then prunes
the leaves nobody asks for, down to the nested columns read by the scan. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Collection
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import FlattenContract
from ..functions.columns import ref

INDEX_SUFFIX = "__index"
SEPARATOR = "__"


class _Leaf(NamedTuple):
    name: str
    dtype: T.DataType
    value: Column


def _is_struct_array(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)


def _leaves(df: DataFrame) -> list[_Leaf]:
    return [_Leaf(f.name, f.dataType, ref(f.name)) for f in df.schema.fields]


def _select(df: DataFrame, leaves: list[_Leaf], *extra: Column) -> DataFrame:
    return df.select(*[leaf.value.alias(leaf.name) for leaf in leaves], *extra)


def _open_structs(leaves: list[_Leaf], keep: Collection[str]) -> list[_Leaf]:
    """One level of struct fields, each in the place of its parent."""
    opened = []
    for leaf in leaves:
        if isinstance(leaf.dtype, T.StructType) and leaf.name not in keep:
            opened += [
                _Leaf(leaf.name + SEPARATOR + f.name, f.dataType, leaf.value.getField(f.name))
                for f in leaf.dtype.fields
            ]
        else:
            opened.append(leaf)
    return opened


def _refuse_collisions(leaves: list[_Leaf]) -> None:
    seen: set[str] = set()
    for leaf in leaves:
        if leaf.name.lower() in seen:
            raise ValueError(f"flattening gives the column name {leaf.name!r} twice")
        seen.add(leaf.name.lower())


def _exploded(
    df: DataFrame, leaves: list[_Leaf], target: _Leaf, with_index: bool, outer: bool
) -> DataFrame:
    if with_index:
        generate = F.posexplode_outer if outer else F.posexplode
        others = [leaf for leaf in leaves if leaf is not target]
        index = target.name + INDEX_SUFFIX
        if any(leaf.name.lower() == index.lower() for leaf in others):
            raise ValueError(f"the index column {index!r} already exists")
        return _select(df, others, generate(target.value).alias(index, target.name))
    generate = F.explode_outer if outer else F.explode
    in_place = [
        leaf._replace(value=generate(leaf.value)) if leaf is target else leaf for leaf in leaves
    ]
    return _select(df, in_place)


def flatten(
    df: DataFrame,
    explode: Collection[str] = (),
    keep: Collection[str] = (),
    with_index: bool = False,
    outer: bool = False,
) -> DataFrame:
    """Turn nested columns into flat ones named ``parent__child``.

    * Listed arrays of structs give one row per element; several listed arrays give their cross
      product. Without ``outer`` a row with a null or empty array vanishes.
    * With an index, ``<name>__index`` (from 0) and the element go to the end of the row.
    * ``explode`` and ``keep`` hold *flattened* names, so they also reach inner fields.
    * Other arrays, maps and kept columns pass through.

    Runs until no listed array and no open struct is left.
    """
    leaves = _leaves(df)
    while True:
        _refuse_collisions(leaves)
        target = next(
            (
                leaf
                for leaf in leaves
                if leaf.name in explode and leaf.name not in keep and _is_struct_array(leaf.dtype)
            ),
            None,
        )
        if target is not None:
            df = _exploded(df, leaves, target, with_index, outer)
            leaves = _leaves(df)
        elif any(isinstance(x.dtype, T.StructType) and x.name not in keep for x in leaves):
            leaves = _open_structs(leaves, keep)
        else:
            return _select(df, leaves)


def flatten_by_contract(df: DataFrame, contract: FlattenContract | None) -> DataFrame:
    c = contract or FlattenContract()
    return flatten(df, c.explode, c.keep, c.with_index)
