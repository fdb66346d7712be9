"""Bronze to silver: flatten, lineage, contract columns, key filter, latest per key, upsert."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import TableContract
from ..functions.columns import ref, with_lineage
from ..operators.flatten import SEPARATOR, flatten, flatten_by_contract
from ..operators.incremental import FULL_LOAD, INCREMENTAL, choose_reading, moment
from ..operators.keys import latest_by_contract, match_columns, match_values, require_contract_keys
from ..operators.ledger import noted, unread
from ..operators.mapping import apply_contract, cast_by_contract, hashes_can_wait, with_hash_columns
from ..operators.merge import upsert_by_contract
from ..operators.rejects import kept, observed, rejected, with_key_rejects
from ..session import join_where_rows_lie
from ..sinks import files
from ..sinks.store import Batch, StoredTable
from ..streaming.ingest import BronzeTarget, bronze_batches, is_complete, read_bronze
from .governance import document_by_contract

_WORD = re.compile(r"\w+")


def documents_together(
    bronze: DataFrame, contract: TableContract, on_error: str = "fail", keep_match_columns: bool = False, target: StoredTable | None = None
) -> tuple[DataFrame, list[str]]:
    """Bronze rows whose exploded array is still whole, brought together by ``document_keys``; the columns that they lie by.

    What a document's elements have in common travels once, and of the elements only leaves that the contract names. Where its
    keys do not tell the document, bronze is given as it is, and no columns.
    """
    by_name, keys = {c.name.lower(): c for c in contract.columns}, contract.document_keys
    if not keys:
        return bronze, []
    array, keep = contract.flatten.explode[0], contract.flatten.keep
    flat = flatten(bronze, keep=keep)
    names, columns = {c.lower(): c for c in flat.columns}, [by_name[k.lower()] for k in keys]
    sources = [c.source if c.source and c.source.lower() in names else c.name for c in columns]
    dtype = flat.schema[array].dataType if array in flat.columns else None
    if array in keep or not isinstance(dtype, T.ArrayType) or not isinstance(dtype.elementType, T.StructType) or not all(s.lower() in names for s in sources):
        return bronze, []
    values = {k: cast_by_contract(ref(names[s.lower()]), c, on_error) for k, s, c in zip(keys, sources, columns, strict=True)}
    if keep_match_columns:
        types = flat.select(*[v.alias(k) for k, v in values.items()]).schema
        at = {k.lower(): i for i, k in enumerate(contract.primary_keys)}
        own = {f"__key_{at[k.lower()]}{end}": x for k, v in values.items() for end, x in zip(("", "_null"), match_values(v, types[k].dataType))}
    else:
        own = {"__place": F.xxhash64(*values.values()) if target is None else target.place_of(flat, contract.primary_keys, values)}
    if own.get("__place", True) is None:
        return bronze, []
    leaves = _named_leaves(dtype.elementType, array, contract)
    others = [ref(c) for c in flat.columns if c != array or not leaves]
    inside = {f"__leaf_{i}": reduce(Column.getField, path, ref(array)) for i, path in enumerate(leaves.values())}
    # The elements' leaves travel as arrays of their own, which take less room than an array of structs.
    by = [n for n in own if not n.endswith("_null")]  # a flag of a key that is never null is a constant, which no plan can match
    placed = flat.filter(F.size(ref(array)) > 0).select(*others, *[v.alias(n) for n, v in {**inside, **own}.items()]).repartition(*by)
    if leaves:
        placed = placed.withColumn(array, F.arrays_zip(*[F.col(n).alias(leaf) for n, leaf in zip(inside, leaves, strict=True)])).drop(*inside)
    return placed, list(own)


def _named_leaves(element: T.StructType, array: str, contract: TableContract) -> dict[str, tuple[str, ...]]:
    """Leaves of an array's elements that the contract names, by their name below the array; none where an element has to stay whole."""
    if any(n.startswith(array + SEPARATOR) for n in contract.flatten.keep):
        return {}
    words = {w.lower() for c in contract.columns for text in (c.transform, c.source, c.name) for w in _WORD.findall(text or "")}
    found, todo = {}, [((f.name,), f.dataType) for f in reversed(element.fields)]
    while todo:
        path, dtype = todo.pop()
        if isinstance(dtype, T.StructType):
            todo += [((*path, f.name), f.dataType) for f in reversed(dtype.fields)]
            continue
        name = SEPARATOR.join(path)
        if name in found:
            return {}
        if {w.lower() for w in _WORD.findall(array + SEPARATOR + name)} <= words:
            found[name] = path
    return found


def cleaned_rows(bronze: DataFrame, contract: TableContract, on_error: str = "fail", carried: Sequence[str] = ()) -> DataFrame:
    """Flat, typed rows with lineage and populated keys: narrow work only, no shuffle."""
    flat = flatten_by_contract(bronze, contract.flatten)
    rows = apply_contract(
        with_lineage(flat), contract, on_error, hashes=not hashes_can_wait(contract), carried=carried
    )
    return require_contract_keys(rows, contract)


def examined_rows(bronze: DataFrame, contract: TableContract, on_error: str = "null") -> DataFrame:
    """The rows of ``cleaned_rows`` and those it turns away, each with what is wrong with it."""
    flat = with_lineage(flatten_by_contract(bronze, contract.flatten))
    rows = apply_contract(flat, contract, on_error, hashes=not hashes_can_wait(contract), notes=True)
    return with_key_rejects(rows, contract.key_groups)


def latest_rows(
    rows: DataFrame, contract: TableContract, keep_match_columns: bool = False, target: StoredTable | None = None, lies: Sequence[str] = ()
) -> DataFrame:
    """Latest row per key, then the hashed columns: they neither travel nor are made for rows that
    do not survive. With ``target`` rows are brought together as its layout needs them, so that writing moves none again.
    ``lies`` names the columns by which ``documents_together`` has done so."""
    place = target.place_of(rows, contract.primary_keys) if target is not None and not lies else None
    latest = latest_by_contract(rows, contract, keep_match_columns, limit_first=contract.hot_keys, place=place, lies=lies)
    return with_hash_columns(latest, contract) if hashes_can_wait(contract) else latest


def silver_frame(
    bronze: DataFrame, contract: TableContract, on_error: str = "fail", keep_match_columns: bool = False, target: StoredTable | None = None
) -> DataFrame:
    """One row per primary key; the only shuffle is by that key. ``keep_match_columns`` prepares it for ``merged_silver``, ``target`` for being stored."""
    bronze, lies = documents_together(bronze, contract, on_error, keep_match_columns, target)
    return latest_rows(cleaned_rows(bronze, contract, on_error, lies), contract, keep_match_columns, target, lies)


def merged_silver(
    old: DataFrame, bronze: DataFrame, contract: TableContract, on_error: str = "fail"
) -> DataFrame:
    """Silver after this bronze has been upserted, as a frame: two exchanges, one per side, since
    the one of the latest-row step serves the join too, for ``old`` where its match columns are kept."""
    if set(match_columns(contract.primary_keys)) <= set(old.columns):
        join_where_rows_lie(bronze.sparkSession)
        new = silver_frame(bronze, contract, on_error, keep_match_columns=True)
    else:  # the join brings both sides together by whole keys
        new = latest_rows(cleaned_rows(bronze, contract, on_error), contract, keep_match_columns=True)
    return upsert_by_contract(old, new, contract)


def rejects_folder(target: StoredTable) -> str:
    return f"{target.base_folder}-rejects"


def store_with_rejects(rows: DataFrame, contract: TableContract, target: StoredTable, on_error: str = "null", batch: Batch | None = None, ledger: dict | None = None) -> dict[str, int]:
    """Upsert what a contract keeps of bronze rows and store what it turns away; the counts of both.

    Rejects are written first, under the version that the commit will have: a run that dies in between writes them anew.
    The manifest keeps the counts, which are observed while rejects are written: no row is counted by a job of its own.
    """
    if target.has(batch):
        return {}
    examined, note = observed(examined_rows(rows, contract, on_error), f"rejects-{uuid.uuid4().hex}")
    version = target.next_version()
    rejected(examined).write.mode("overwrite").parquet(f"{rejects_folder(target)}/version={version}")
    counts = dict(note.get)
    latest = latest_rows(kept(examined_rows(rows, contract, on_error)), contract, target=target)
    store_silver(latest, contract, target, batch, ledger, counts)
    return counts


def read_rejects(target: StoredTable) -> DataFrame:
    """version, column, reason, value, payload, file_path and bronze_ingested_at of all that commits turned away."""
    known = target.manifest()
    schema = "column string, reason string, value string, payload string, file_path string, bronze_ingested_at timestamp, version bigint"
    if known is None or not files.exists(target.spark, rejects_folder(target)):
        return target.spark.createDataFrame([], schema)
    return target.spark.read.schema(schema).parquet(rejects_folder(target)).filter(F.col("version") <= known.version)


def build_silver(
    spark: SparkSession,
    bronze: DataFrame,
    contract: TableContract,
    table: str,
    start=None,
    end=None,
    on_error: str = "fail",
    base: str | None = None,
    keep_rejects: bool = False,
) -> str:
    """One run of the silver job; gives the reading mode that was used.

    ``keep_rejects`` stores values and rows that the contract turns away beside the table. The first load also stores the contract's descriptions and tags with the table.
    """
    target = StoredTable.of_contract(spark, contract, table, base)
    known = target.manifest()
    first_load = known is None
    mark = moment(known.mark) if known and known.mark is not None else None
    reading = choose_reading(bronze, None if first_load else target.read(), start, end, mark)
    if not reading.nothing_to_do:
        if keep_rejects:
            store_with_rejects(reading.rows, contract, target, on_error)
        else:
            store_silver(silver_frame(reading.rows, contract, on_error, target=target), contract, target)
        if first_load:
            document_by_contract(spark, contract, table)
    return reading.mode


def build_silver_from_batches(
    spark: SparkSession,
    source: BronzeTarget,
    contract: TableContract,
    table: str,
    on_error: str = "fail",
    base: str | None = None,
    delta_runs: bool = False,
    keep_rejects: bool = False,
) -> str:
    """One run over the micro-batches of bronze that silver has not read, whatever times their rows carry.

    The high-water mark skips rows of a writer that is late with earlier times; here the names of the batches read are
    committed together with the rows, so each complete batch is read exactly once. A silver table that
    was built without this ledger goes on from its mark.
    """
    target = StoredTable.of_contract(spark, contract, table, base, delta_runs)
    known = target.manifest()
    if known is not None and not known.ledger:
        return build_silver(spark, read_bronze(spark, source), contract, table, on_error=on_error, base=base, keep_rejects=keep_rejects)
    ledger = known.ledger if known else {}
    fresh = [b for b in unread(ledger, bronze_batches(spark, source)) if is_complete(spark, source, b)]
    if fresh:
        rows, read = read_bronze(spark, source, fresh), noted(ledger, fresh)
        if keep_rejects:
            store_with_rejects(rows, contract, target, on_error, ledger=read)
        else:
            store_silver(silver_frame(rows, contract, on_error, target=target), contract, target, ledger=read)
        if known is None:
            document_by_contract(spark, contract, table)
    return FULL_LOAD if known is None else INCREMENTAL


def store_silver(
    rows: DataFrame,
    contract: TableContract,
    target: StoredTable,
    batch: Batch | None = None,
    ledger: dict | None = None,
    rejects: dict | None = None,
) -> None:
    """``rows`` were made for this target (``silver_frame``)."""
    target.upsert(
        rows,
        contract.primary_keys,
        contract.deduplication_keys,
        batch=batch,
        keys_are_unique=True,
        ledger=ledger,
        rejects=rejects,
        placed=not contract.hot_keys,
    )


def _store_and_document(
    rows: DataFrame, contract: TableContract, target: StoredTable, batch: Batch | None
) -> None:
    first_load = not target.exists
    store_silver(rows, contract, target, batch)
    if first_load:
        document_by_contract(target.spark, contract, target.name)


def fan_out(bronze: DataFrame, contracts: Sequence[TableContract]) -> dict[str, DataFrame]:
    """Silver frames of several contracts over one source, by table name.

    Over a columnar source each frame reads only its own leaves, so separate scans cost no more
    than one; pass a persisted frame when the source is expensive to read again (JSON, CSV).
    """
    return {c.name: silver_frame(bronze, c) for c in contracts}


def build_fan_out(
    bronze: DataFrame,
    targets: Mapping[str, tuple[TableContract, StoredTable]],
    batch: Batch | None = None,
    share_scan: bool = False,
    on_error: str = "fail",
) -> None:
    """Upsert several silver tables from one source, side by side so that the cluster stays busy.

    A table's first load stores its contract's descriptions and tags, as a single build does.
    """
    source = bronze.persist(StorageLevel.MEMORY_AND_DISK) if share_scan else bronze
    try:
        with ThreadPoolExecutor(max_workers=max(1, len(targets))) as pool:
            jobs = [
                pool.submit(
                    # The jobs keep the caller's pool, group and description.
                    inheritable_thread_target(bronze.sparkSession)(_store_and_document),
                    silver_frame(source, contract, on_error, target=table), contract, table, batch,
                )
                for contract, table in targets.values()
            ]
            for job in jobs:
                job.result()
    finally:
        if share_scan:
            source.unpersist()
