"""Contract columns: source or transform, cast, hash and final projection in one ``select``.

Contract columns apply in order and later ones see earlier results. Most contracts need a single
projection; a further one is opened only when a column reads something that an earlier transform
of the same projection has made. Spark's lateral column alias is no substitute: a name that the
input already has would win over the alias.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import ColumnContract, ContractError, TableContract, check_expression_on
from ..functions.columns import HASH_SUFFIX, METADATA, pii_hash, ref
from .rejects import NOTHING, PAYLOAD, REJECTS, misfit, payload_of

_WORD = re.compile(r"\w+")


def check_producible(df: DataFrame, contract: TableContract) -> None:
    """Fail before any data is touched when a contract column cannot be made. No job runs."""
    available = {c.lower() for c in df.columns}
    missing = []
    for c in contract.columns:
        if c.transform is None and (c.source or c.name).lower() not in available:
            if c.name.lower() not in available:
                missing.append(c.name)
        available.update(n.lower() for n in c.output_names)
    if missing:
        raise ContractError(
            f"table {contract.name!r}: no source column for {missing}; give each a source or a transform"
        )


class _Projection:
    """The columns of one ``select``: what the frame has, and what was (re)defined on top."""

    def __init__(self, df: DataFrame):
        self._open(df)

    def _open(self, df: DataFrame) -> None:
        self.df = df
        self.names = {c.lower(): c for c in df.columns}
        self.defined: dict[str, Column] = {}
        self.derived: set[str] = set()

    def value(self, name: str) -> Column:
        key = name.lower()
        return self.defined[key] if key in self.defined else ref(self.names[key])

    def define(self, name: str, value: Column, derived: bool) -> None:
        key = name.lower()
        self.names[key] = name
        self.defined[key] = value
        (self.derived.add if derived else self.derived.discard)(key)

    def frame(self) -> DataFrame:
        return self.df.select(*[self.value(k).alias(n) for k, n in self.names.items()])

    def settle(self) -> None:
        """Put everything defined so far into a select of its own (Catalyst merges what it may)."""
        if self.defined:
            self._open(self.frame())


def cast_by_contract(value: Column, c: ColumnContract, on_error: str) -> Column:
    return value.try_cast(c.type) if on_error == "null" else value.cast(c.type)


def apply_contract(
    df: DataFrame, contract: TableContract, on_error: str = "fail", hashes: bool = True, notes: bool = False, carried: Sequence[str] = ()
) -> DataFrame:
    """Contract columns in contract order, each hashed column after its base, ``_metadata`` last.

    ``hashes=False`` leaves the hashed columns to ``with_hash_columns``. ``carried`` columns of ``df`` stay, at the end.

    ``on_error``: ``fail`` lets a value that does not fit its type end the job (ANSI cast),
    ``null`` turns it into null. ``notes`` adds what did not fit, and the payload, as ``operators.rejects`` has them.
    """
    if on_error not in ("fail", "null"):
        raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")
    check_producible(df, contract)
    if notes:
        df = df.select("*", F.array().cast(NOTHING).alias(REJECTS), payload_of(df).alias(PAYLOAD))
    todo = _Projection(df)

    def made(c: ColumnContract, value: Column, derived: bool) -> None:
        cast = cast_by_contract(value, c, on_error)
        if notes:
            todo.define(REJECTS, F.concat(todo.value(REJECTS), misfit(c.name, value, cast)), derived=False)
        todo.define(c.name, cast, derived)

    for c in contract.columns:
        if c.transform is not None:
            words = {w.lower() for w in _WORD.findall(c.transform)}
            if any(set(_WORD.findall(name)) <= words for name in todo.defined):
                todo.settle()
            check_expression_on(todo.df, c.transform, c.name)
            made(c, F.expr(c.transform), derived=True)
        else:
            source = c.source if c.source and c.source.lower() in todo.names else c.name
            if source.lower() in todo.derived:
                todo.settle()
            made(c, todo.value(source), derived=False)
        if c.hashed and hashes:
            if c.name.lower() in todo.derived:
                todo.settle()
            todo.define(c.name + HASH_SUFFIX, pii_hash(todo.value(c.name)), derived=False)
    wanted = contract.output_names if hashes else [c.name for c in contract.columns]
    if METADATA.lower() in todo.names:
        wanted = [*wanted, METADATA]
    if notes:
        wanted = [*wanted, REJECTS, PAYLOAD]
    wanted = [*wanted, *carried]
    return todo.df.select(*[todo.value(n).alias(n) for n in wanted])


def with_hash_columns(df: DataFrame, contract: TableContract) -> DataFrame:
    """Add each hashed column after its base; everything else keeps its place."""
    hashed = set(contract.hashed_columns)
    return df.select(
        *[
            value
            for name in df.columns
            for value in (
                [ref(name), pii_hash(ref(name)).alias(name + HASH_SUFFIX)]
                if name in hashed
                else [ref(name)]
            )
        ]
    )


def hashes_can_wait(contract: TableContract) -> bool:
    """Hashes are made after the exchange, of the surviving rows, unless a key or a column reads one."""
    hashed = {(name + HASH_SUFFIX).lower() for name in contract.hashed_columns}
    read = {k.lower() for k in (*contract.primary_keys, *contract.deduplication_keys)}
    for c in contract.columns:
        read.add((c.source or c.name).lower())
        read.update(w.lower() for w in _WORD.findall(c.transform or ""))
    return not any(read & {h, *_WORD.findall(h)} for h in hashed)
