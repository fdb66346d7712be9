"""Export of a table to CSV, JSON, JSON Lines or Parquet under a dated folder."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Mapping
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import files

# Export format -> (Spark data source, extension of the exported file).
FORMATS = {
    "csv": ("csv", ".csv"),
    "json": ("json", ".json"),
    "jsonl": ("json", ".jsonl"),
    "parquet": ("parquet", ".parquet"),
}
# Bytes that one task puts into its place of a single file.
PIECE_BYTES = 64 << 20
MODES = ("overwrite", "append", "ignore", "error", "errorifexists")


def export_frame(
    df: DataFrame,
    output: str,
    prefix: str,
    file_format: str = "csv",
    options: Mapping[str, str] | None = None,
    mode: str = "overwrite",
    single_file: bool = True,
    now: dt.datetime | None = None,
) -> str:
    """Write ``<output>/<yyyymmdd>/<prefix>_<yyyymmddHHMMSS>`` and return its path.

    ``single_file`` alone decides the form: one file with the format's extension, whose rows keep their order, or a
    folder of that name whose parts are written in parallel. Plain text in a folder that is mounted everywhere (``file:``) is written in
    parts and put together by tasks that each fill a piece of the file; any other single file is written by one task, with
    all work before it parallel. The mode concerns a target of the same name and is looked at
    first: ``overwrite`` replaces it once the new one is complete, ``append`` adds parts to the folder or
    another file with the next free number, ``ignore`` leaves it, ``error`` refuses. Files of other runs are
    not touched.
    """
    try:
        source, extension = FORMATS[file_format.lower()]
    except KeyError:
        raise ValueError(
            f"cannot export as {file_format!r}; the formats are {', '.join(sorted(FORMATS))}"
        ) from None
    if mode not in MODES:
        raise ValueError(f"a write mode is one of {', '.join(MODES)}, not {mode!r}")
    spark = df.sparkSession
    now = now or dt.datetime.now(dt.timezone.utc)
    folder = f"{output.rstrip('/')}/{now:%Y%m%d}"
    stem = f"{folder}/{prefix}_{now:%Y%m%d%H%M%S}"
    target = stem + extension if single_file else stem
    there = files.exists(spark, target)
    if there and mode == "ignore":
        return target
    if there and mode in ("error", "errorifexists"):
        raise FileExistsError(f"{target} exists (write mode {mode!r})")
    if there and mode == "append" and single_file:
        target = next(t for i in count(1) if not files.exists(spark, t := f"{stem}_{i}{extension}"))
    given = {k.lower(): str(v) for k, v in dict(options or {}).items()}
    if single_file and _can_be_joined(spark, folder, source, given):
        return _export_joined(df, source, dict(options or {}), given, f"{folder}/_writing_{prefix}_{uuid.uuid4().hex}", target)
    writer = (_in_one_task(df) if single_file else df).write.format(source).options(**dict(options or {}))
    if there and mode == "append" and not single_file:
        writer.mode("append").save(target)
        return target
    # Written beside the target, on the same file system, and renamed when complete.
    parts = f"{folder}/_writing_{prefix}_{uuid.uuid4().hex}"
    try:
        writer.save(parts)
        if single_file:
            (part,) = [f for f in files.listing(spark, parts) if f.name.startswith("part-")]
            files.replace(spark, part.path, target)
        else:
            if there:
                files.delete(spark, target)
            files.move(spark, parts, target)
    finally:
        files.delete(spark, parts)
    return target


def _can_be_joined(spark: SparkSession, folder: str, source: str, given: Mapping[str, str]) -> bool:
    """Whether parts put one after the other make the file, and every task can open it at any place."""
    plain = given.get("compression", given.get("codec", "none")).lower() in ("none", "uncompressed")
    utf8 = given.get("encoding", given.get("charset", "utf-8")).lower() in ("utf-8", "utf8")
    return source in ("csv", "json") and plain and utf8 and files.local_path(spark, folder) is not None


def _export_joined(df: DataFrame, source: str, options: dict, given: Mapping[str, str], parts: str, target: str) -> str:
    """Parts are written in parallel, without headers, then each piece of them is put in its place of the one file."""
    spark = df.sparkSession
    headed = source == "csv" and given.get("header", "false").lower() == "true"
    bare = {k: v for k, v in options.items() if k.lower() != "header"}
    try:
        if headed:
            df.limit(0).write.format(source).options(**options).save(f"{parts}/head")
        df.write.format(source).options(**bare).save(f"{parts}/rows")
        pieces, end = [], 0
        for folder in (["head"] if headed else []) + ["rows"]:
            found = [f for f in files.listing(spark, f"{parts}/{folder}") if f.name.startswith("part-")]
            for f in sorted(found, key=lambda f: (int(re.match(r"part-(\d+)", f.name)[1]), f.name)):
                for at in range(0, f.size, PIECE_BYTES):
                    pieces.append((files.local_path(spark, f.path), at, min(PIECE_BYTES, f.size - at), end + at))
                end += f.size
        files.make_dirs(spark, parts)
        whole = files.local_path(spark, f"{parts}/whole")
        with open(whole, "wb") as draft:
            draft.truncate(end)

        def put(piece: tuple[str, int, int, int]) -> None:
            path, at, size, place = piece
            with open(path, "rb") as part, open(whole, "r+b") as draft:
                part.seek(at)
                draft.seek(place)
                while size:
                    taken = part.read(min(size, 1 << 20))
                    if not taken:
                        raise EOFError(f"{path} is shorter than it was")
                    draft.write(taken)
                    size -= len(taken)

        if pieces:
            spark.sparkContext.parallelize(pieces, len(pieces)).foreach(put)
        name = target.rpartition("/")[2]
        files.delete(spark, f"{target[: -len(name)]}.{name}.crc")  # the sums of an earlier file of this name
        files.replace(spark, f"{parts}/whole", target)
    finally:
        files.delete(spark, parts)
    return target


def _in_one_task(df: DataFrame) -> DataFrame:
    """The rows in one partition, in the order they have, behind an exchange: what made them is not drawn into that task."""
    place = "__place"
    return df.withColumn(place, F.monotonically_increasing_id()).repartition(1).sortWithinPartitions(place).drop(place)


def export_table(spark: SparkSession, table: str, output: str, prefix: str, **kwargs) -> str:
    """Export a table or view by name."""
    return export_frame(read_table(spark, table), output, prefix, **kwargs)
