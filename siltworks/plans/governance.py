"""Contract inventory, documentation compliance, and documentation of stored tables."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from pathlib import Path

import yaml
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..contract import TableContract
from ..functions.names import quoted

log = logging.getLogger(__name__)

# Tags that every table must carry.
REQUIRED_TAGS = (
    "owner__tech", "data__supplier", "data__domain", "pii__exists", "pii__classification",
)
SILVER, GOLD = "silver", "gold"

INVENTORY_SCHEMA = """
    table_name string, qualified_name string, description string, tags map<string, string>,
    columns array<struct<name: string, description: string, tags: map<string, string>>>
"""


def _tags(entry: Mapping) -> dict[str, str]:
    tags = entry.get("tags")
    if tags is None:
        tags = (entry.get("config") or {}).get("meta")
    return {str(k): None if v is None else str(v) for k, v in (tags or {}).items()}


def _entry(table: Mapping, schema_name: str) -> Row:
    columns = [
        Row(
            name=c.get("name") or c["target_name"],
            description=c.get("description"),
            tags=_tags(c),
        )
        for c in table.get("columns") or ()
    ]
    return Row(
        table_name=table["name"],
        qualified_name=f"{schema_name}.{table['name']}",
        description=table.get("description"),
        tags=_tags(table),
        columns=columns,
    )


def entries_of(document: Mapping, schema_name: str, layer: str) -> list[Row]:
    """Inventory rows of one parsed document: ``table`` (silver) or ``models`` (gold)."""
    if layer == SILVER:
        return [_entry(document["table"], schema_name)]
    if layer == GOLD:
        return [_entry(m, schema_name) for m in document.get("models") or ()]
    raise ValueError(f"unknown layer {layer!r}")


def contract_files(root: str, layer: str) -> list[tuple[str, str]]:
    """Contract files below a folder with their schema, which is the folder they lie in. Gold model
    files that lie in the root itself describe no schema and are passed over."""
    found = sorted(p for p in Path(root).rglob("*.yml"))
    return [
        (str(p), p.parent.name) for p in found if layer != GOLD or p.parent != Path(root)
    ]


def read_inventory(
    spark: SparkSession, files_by_schema: Iterable[tuple[str, str]], layer: str
) -> DataFrame:
    """Inventory of contract files given as ``(path, schema name)``; an unreadable one is logged
    and left out."""
    if layer not in (SILVER, GOLD):
        raise ValueError(f"unknown layer {layer!r}")
    rows: list[Row] = []
    for path, schema_name in files_by_schema:
        try:
            with open(path, encoding="utf-8") as f:
                rows += entries_of(yaml.safe_load(f) or {}, schema_name, layer)
        except Exception:
            log.exception("contract file %s cannot be read", path)
    return spark.createDataFrame(rows, INVENTORY_SCHEMA)


def compliance_report(
    inventory: DataFrame, required_tags: Sequence[str] = REQUIRED_TAGS
) -> DataFrame:
    """One row per table and problem: no description, or a required tag without a value. No shuffle."""

    def blank(c):
        return c.isNull() | (F.trim(c) == "")

    tags = F.coalesce(F.col("tags"), F.create_map().cast("map<string,string>"))
    no_description = F.when(blank(F.col("description")), F.array(F.lit("description")))
    missing = F.filter(
        F.array(*[F.lit(t) for t in required_tags]),
        lambda t: ~F.map_contains_key(tags, t) | blank(F.try_element_at(tags, t)),
    )
    found = F.concat(
        F.coalesce(no_description, F.array().cast("array<string>")),
        F.transform(missing, lambda t: F.concat(F.lit("tag "), t)),
    )
    return inventory.select("qualified_name", F.explode(found).alias("missing"))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def documentation_statements(entry: Row) -> list[str]:
    """Statements that store one table's descriptions as comments and its tags as properties."""
    table = entry.qualified_name
    out = []
    if entry.description:
        out.append(f"COMMENT ON TABLE {table} IS {_literal(entry.description)}")
    properties = {f"tag.{k}": v for k, v in (entry.tags or {}).items() if v is not None}
    for c in entry.columns or ():
        if c.description:
            out.append(
                f"ALTER TABLE {table} ALTER COLUMN {quoted(c.name)} COMMENT {_literal(c.description)}"
            )
        properties |= {f"tag.{c.name}.{k}": v for k, v in (c.tags or {}).items() if v is not None}
    if properties:
        listed = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in properties.items())
        out.append(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")
    return out


def document_tables(spark: SparkSession, inventory: DataFrame) -> list[str]:
    """Apply the inventory to the catalog. The first failing statement ends that table, is logged,
    and the next table follows. Gives the names of the tables that failed."""
    failed = []
    for entry in inventory.toLocalIterator():
        try:
            for statement in documentation_statements(entry):
                spark.sql(statement)
        except PySparkException as e:
            log.error("table %s could not be documented: %s", entry.qualified_name, e)
            failed.append(entry.qualified_name)
    return failed


def document_by_contract(spark: SparkSession, contract: TableContract, table: str) -> None:
    """Store the descriptions and tags of a contract with the table that was made from it."""
    columns = [Row(name=c.name, description=c.description, tags=dict(c.tags)) for c in contract.columns]
    entry = Row(
        qualified_name=table,
        description=contract.description,
        tags=dict(contract.tags),
        columns=columns,
    )
    for statement in documentation_statements(entry):
        spark.sql(statement)
