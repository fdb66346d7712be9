"""Declarative table contracts: frozen dataclasses, YAML loading and the expression guard."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

import yaml
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.columns import HASH_SUFFIX


class ContractError(ValueError):
    """The contract itself is wrong, or the input cannot satisfy it."""


# Text that may not occur anywhere in a transform, even inside a literal.
FORBIDDEN_TEXT = (";", "--", "/*", "*/")


def check_expression(text: str | None, target: str) -> str:
    """Refuse a transform that is blank, carries separators or comments, or is no bare expression.

    Spark's own parser decides, without a frame or an analysis. The text is parsed alone and inside
    brackets: brackets admit no alias, and two bare words parse only as a column with an alias.
    Without a running session the parser's part waits until the transform is put to use.
    """
    if text is None or not text.strip():
        raise ContractError(f"column {target!r}: the transform is blank")
    found = [bad for bad in FORBIDDEN_TEXT if bad in text]
    if found:
        raise ContractError(f"column {target!r}: the transform may not contain {found}")
    spark = SparkSession.getActiveSession()
    if spark is None:
        return text
    parser = spark._jsparkSession.sessionState().sqlParser()
    try:
        for form in (text, f"({text})"):
            parser.parseExpression(form)
    except ParseException as e:
        raise ContractError(f"column {target!r}: the transform is no SQL expression: {text!r}") from e
    return text


def check_expression_on(df: DataFrame, text: str, target: str) -> None:
    """Let the analyzer accept a transform against a real schema; no job runs.

    Inside a lambda the analyzer refuses subqueries, generators and aggregates, which leaves
    expressions that give one value per row.
    """
    check_expression(text, target)
    probe = F.transform(F.array(F.lit(0)), lambda _: F.expr(f"({text})"))
    try:
        df.select("*", probe.alias("__probe"))
    except AnalysisException as e:
        raise ContractError(f"column {target!r}: the transform cannot be analysed: {e}") from e


@dataclass(frozen=True)
class ColumnContract:
    name: str
    type: str
    source: str | None = None
    transform: str | None = None
    description: str | None = None
    tags: Mapping[str, str] = field(default_factory=dict)
    hashed: bool = False

    def __post_init__(self):
        if self.transform is not None:
            check_expression(self.transform, self.name)

    @property
    def output_names(self) -> list[str]:
        return [self.name, self.name + HASH_SUFFIX] if self.hashed else [self.name]


@dataclass(frozen=True)
class FlattenContract:
    explode: tuple[str, ...] = ()
    keep: tuple[str, ...] = ()
    with_index: bool = False


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: tuple[ColumnContract, ...] = ()
    description: str | None = None
    tags: Mapping[str, str] = field(default_factory=dict)
    primary_keys: tuple[str, ...] = ()
    deduplication_keys: tuple[str, ...] = ()
    clustering_keys: tuple[str, ...] = ()
    flatten: FlattenContract | None = None
    key_buckets: int | None = None
    # A key can hold a large share of all rows: tasks limit their rows per key before they send them, which costs a sort.
    hot_keys: bool = False

    @property
    def output_names(self) -> list[str]:
        """Contract order; a hashed column follows its base."""
        return [n for c in self.columns for n in c.output_names]

    @property
    def hashed_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.hashed]

    @property
    def document_keys(self) -> list[str]:
        """The primary keys beside the index of the one array that is exploded: they tell whose elements a document's are.

        None where another key comes from an element, or from another column of the contract.
        """
        flat, names = self.flatten, [c.name.lower() for c in self.columns]
        if flat is None or not flat.with_index or len(flat.explode) != 1 or self.hot_keys or len({*names}) < len(names):
            return []
        array, found, index = flat.explode[0].lower(), [], 0
        for key in self.primary_keys:
            at = names.index(key.lower()) if key.lower() in names else None
            if at is None or self.columns[at].transform is not None:
                return []
            source = (self.columns[at].source or key).lower()
            if source == f"{array}__index":
                index += 1
            elif source.startswith(f"{array}__") or source in {n.lower() for c in self.columns[:at] for n in c.output_names}:
                return []
            else:
                found.append(key)
        return found if index == 1 else []

    @property
    def key_groups(self) -> list[list[str]]:
        return [list(g) for g in (self.primary_keys, self.deduplication_keys) if g]


def _required(raw: Mapping, key: str, where: str):
    value = raw.get(key)
    if value in (None, ""):
        raise ContractError(f"{where}: {key!r} is missing")
    return value


def contract_from_dict(document: Mapping) -> TableContract:
    """Build a contract from a parsed document ``{version, table: {...}}``; unknown keys are ignored."""
    if "version" not in document or "table" not in document:
        raise ContractError("a contract needs 'version' and 'table'")
    try:
        float(document["version"])
    except (TypeError, ValueError) as e:
        raise ContractError("'version' must be a number") from e
    table = document["table"]
    name = _required(table, "name", "table")
    columns = tuple(
        ColumnContract(
            name=_required(c, "name", f"table {name!r}, a column"),
            type=_required(c, "type", f"table {name!r}, column {c.get('name')!r}"),
            source=c.get("source_col_name"),
            transform=c.get("transform"),
            description=c.get("description"),
            tags=dict(c.get("tags") or {}),
            hashed=bool(c.get("create_hashed_col")),
        )
        for c in table.get("columns") or ()
    )
    flat = table.get("flatten_config")
    return TableContract(
        name=name,
        columns=columns,
        description=table.get("description"),
        tags=dict(table.get("tags") or {}),
        primary_keys=tuple(table.get("primary_keys") or ()),
        deduplication_keys=tuple(table.get("deduplication_keys") or ()),
        clustering_keys=tuple(table.get("clustering_keys") or ()),
        key_buckets=None if table.get("key_buckets") is None else int(table["key_buckets"]),
        hot_keys=bool(table.get("hot_keys")),
        flatten=None
        if flat is None
        else FlattenContract(
            explode=tuple(flat.get("cols_to_explode") or ()),
            keep=tuple(flat.get("cols_to_exclude") or ()),
            with_index=bool(flat.get("explode_with_index_col")),
        ),
    )


def load_contract(path: str) -> TableContract:
    with open(path, encoding="utf-8") as f:
        return contract_from_dict(yaml.safe_load(f) or {})
