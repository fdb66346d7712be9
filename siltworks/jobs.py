"""Jobs from settings: ``spark-submit -m siltworks.jobs settings.yml job_name``.

A settings file maps job names to their settings; each has a ``kind``:

* ``bronze``: landing, format, bronze, checkpoint, bronze_table, schema_folder, infer_column_types,
  reader_options, write_options, available_now, max_files_per_batch
* ``silver``: bronze + checkpoint (or bronze_table), contract, silver_table, start_date, end_date,
  on_error, keep_versions, delta_runs, keep_rejects. From bronze + checkpoint each micro-batch is read once, by its name; with both dates,
  or from a bronze_table, rows are chosen by their ingestion time
* ``silver_stream``: bronze + checkpoint, silver_checkpoint, contracts (contract -> table), on_error, share_scan, keep_versions,
  delta_runs (true unless given), compact (fold what lies beside the tables when the stream ends; true unless given)
* ``export``: table, output, prefix, format, options, mode, single_file
* ``document``: root, layer
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Mapping

import yaml
from pyspark.sql import DataFrame, SparkSession

from .contract import load_contract
from .plans.governance import contract_files, document_tables, read_inventory
from .plans.silver import build_silver, build_silver_from_batches
from .session import build_session
from .sinks.export import export_table
from .sinks.store import StoredTable
from .sources.landing import Landing
from .sources.tables import read_table
from .streaming.ingest import BronzeTarget, bronze_stream, ingest, read_bronze
from .streaming.silver import start_silver_fan_out

Settings = Mapping[str, object]


def _given(settings: Settings, *names: str) -> dict:
    return {n: settings[n] for n in names if n in settings}


def _target(settings: Settings) -> BronzeTarget:
    return BronzeTarget(
        settings["bronze"],
        settings["checkpoint"],
        available_now=bool(settings.get("available_now", True)),
        write_options=settings.get("write_options") or {},
        table=settings.get("bronze_table"),
    )


def _bronze(spark: SparkSession, settings: Settings) -> None:
    landing = Landing(
        settings["landing"],
        str(settings["format"]).lower(),
        settings.get("schema_folder"),
        infer_types=bool(settings.get("infer_column_types", True)),
        options=settings.get("reader_options") or {},
        **_given(settings, "case_sensitive", "rescue_column"),
    )
    ingest(spark, landing, _target(settings), **_given(settings, "max_files_per_batch"))


def _bronze_rows(spark: SparkSession, settings: Settings) -> DataFrame:
    if "bronze_table" in settings:
        return read_table(spark, settings["bronze_table"])
    return read_bronze(spark, _target(settings))


def _silver(spark: SparkSession, settings: Settings) -> str:
    contract, name = load_contract(settings["contract"]), settings["silver_table"]
    start, end = settings.get("start_date"), settings.get("end_date")
    if "bronze_table" in settings or (start and end):
        mode = build_silver(spark, _bronze_rows(spark, settings), contract, name, start=start, end=end, **_given(settings, "on_error", "base", "keep_rejects"))
    else:
        mode = build_silver_from_batches(spark, _target(settings), contract, name, **_given(settings, "on_error", "base", "delta_runs", "keep_rejects"))
    table = StoredTable.of_contract(spark, contract, name, settings.get("base"))
    if "keep_versions" in settings and table.exists:
        table.expire(int(settings["keep_versions"]))
    return mode


def _silver_stream(spark: SparkSession, settings: Settings) -> None:
    targets = {}
    for path, table in settings["contracts"].items():
        contract = load_contract(path)
        targets[table] = (contract, StoredTable.of_contract(spark, contract, table))
    start_silver_fan_out(
        bronze_stream(spark, _target(settings)),
        targets,
        settings["silver_checkpoint"],
        keep_versions=int(settings["keep_versions"]) if "keep_versions" in settings else None,
        delta_runs=settings.get("delta_runs", True),
        **_given(settings, "available_now", "on_error", "share_scan"),
    ).awaitTermination()
    # A stream that was drained leaves the catalog with all rows: one fold, however many micro-batches there were.
    for _, table in targets.values():
        if settings.get("compact", True) and table.exists:
            table.compact()
        if "keep_versions" in settings and table.exists:
            table.expire(int(settings["keep_versions"]))


def _export(spark: SparkSession, settings: Settings) -> str:
    return export_table(
        spark,
        settings["table"],
        settings["output"],
        settings["prefix"],
        file_format=settings.get("format", "csv"),
        **_given(settings, "options", "mode", "single_file"),
    )


def _document(spark: SparkSession, settings: Settings) -> list[str]:
    layer = settings["layer"]
    return document_tables(
        spark, read_inventory(spark, contract_files(settings["root"], layer), layer)
    )


KINDS: dict[str, Callable] = {
    "bronze": _bronze,
    "silver": _silver,
    "silver_stream": _silver_stream,
    "export": _export,
    "document": _document,
}


def run_job(spark: SparkSession, settings: Settings):
    kind = settings.get("kind")
    if kind not in KINDS:
        raise ValueError(f"a job's kind is one of {', '.join(sorted(KINDS))}, not {kind!r}")
    return KINDS[kind](spark, settings)


def main(argv: list[str]) -> None:
    path, job = argv
    with open(path, encoding="utf-8") as f:
        settings = yaml.safe_load(f)[job]
    run_job(build_session(job), settings)


if __name__ == "__main__":
    main(sys.argv[1:])
