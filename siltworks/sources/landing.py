"""Incremental JSON and CSV sources over a landing tree ``<root>/<yyyymmdd>/<HH>/<file>``.

Structured Streaming's file source lists each file once per checkpoint, whatever its time. Each micro-batch is
then read as a batch of exactly its own files: column types are inferred over those, and added to what is
remembered in a folder. CSV files are read by the names in their own headers, one reader per layout.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections import defaultdict
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ref
from ..sinks import files

JSON, CSV = "json", "csv"
# Spark's file source drops files that are older than its newest one by more than this; so: never.
MAX_FILE_AGE = "36500d"
# Files that one micro-batch takes at most, unless it is told otherwise; the driver holds their names.
FILES_PER_BATCH = 5_000
# Metadata of a field of which no value was seen yet.
EVIDENCE = "evidence"
# Options of the file source itself, the others are for the reader.
SOURCE_OPTIONS = ("pathGlobFilter", "modifiedAfter", "modifiedBefore", "cleanSource", "sourceArchiveDir", "latestFirst")


@dataclass(frozen=True)
class Landing:
    """Where files land and how to read them; ``options`` reach the reader as they are.

    ``case_sensitive`` is for documents whose keys differ by case only: they are read in a session
    of their own, and safe naming then makes the names unique.
    """

    path: str
    format: str
    schema_folder: str | None = None
    infer_types: bool = True
    options: Mapping[str, str] = field(default_factory=dict)
    rescue_column: str | None = "_rescued_data"
    case_sensitive: bool = False

    def __post_init__(self):
        if self.format not in (JSON, CSV):
            raise ValueError(f"a landing folder holds json or csv files, not {self.format!r}")

    def reader_options(self) -> dict[str, str]:
        own = {"recursiveFileLookup": "true"}
        if self.format == CSV:
            # Names in each file's header are checked against the schema it is read with.
            own |= {"header": "true", "enforceSchema": "false"}
        if self.rescue_column:
            own["columnNameOfCorruptRecord"] = self.rescue_column
        return own | {k: v for k, v in self.options.items() if k not in SOURCE_OPTIONS}


def landed_file(root: str, name: str, number: int, now: dt.datetime) -> str:
    """Path of one landed document: day folder, hour folder, name with time and number (UTC)."""
    at = now.astimezone(dt.timezone.utc)
    return f"{root.rstrip('/')}/{at:%Y%m%d}/{at:%H}/{name}_{at:%Y%m%d%H%M%S}_{number}.json"


def reading_session(spark: SparkSession, landing: Landing) -> SparkSession:
    if not landing.case_sensitive:
        return spark
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set("spark.sql.caseSensitive", "true")
    return session


def _configured(spark: SparkSession, landing: Landing) -> DataFrameReader:
    return spark.read.format(landing.format).options(**landing.reader_options())


def literal_path(path: str) -> str:
    """The path as a pattern that means this file alone."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def infer_schema(
    spark: SparkSession, landing: Landing, paths: Sequence[str] | None = None
) -> T.StructType | None:
    """Schema of all rows of the landed files, or of the given ones; None when there is nothing to tell it from."""
    reader = _configured(spark, landing)
    if landing.format == CSV:
        reader = reader.option("inferSchema", str(landing.infer_types).lower())
    else:
        reader = reader.option("primitivesAsString", str(not landing.infer_types).lower())
    try:
        schema = reader.load(list(map(literal_path, paths)) if paths else landing.path).schema
    except Exception as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise
    fields = [f for f in schema.fields if f.name != landing.rescue_column]
    return T.StructType(fields) if fields else None


def is_evident(f: T.StructField) -> bool:
    """Whether any value has been seen: the type of a column without values is a mere placeholder."""
    return (f.metadata or {}).get(EVIDENCE, True)


def with_evidence(spark: SparkSession, landing: Landing, seen: T.StructType, paths: Sequence[str]) -> T.StructType:
    """``seen`` with a mark on columns that inference calls text because they hold nothing at all.

    Only text columns of which no value was seen in earlier batches either are looked at.
    """
    known = _kept_schema(spark, landing)
    sure = {f.name for f in known.fields if is_evident(f)} if known else set()
    doubtful = [f.name for f in seen.fields if isinstance(f.dataType, T.StringType) and f.name not in sure]
    if not landing.infer_types or not doubtful:
        return seen
    reader = _configured(spark, landing).schema(seen).option("enforceSchema", "true")
    rows = reader.load(list(map(literal_path, paths)))
    found = rows.agg(*[F.max(ref(n).isNotNull()) for n in doubtful]).first()
    empty = {n for n, any_value in zip(doubtful, found) if not any_value}
    return T.StructType([T.StructField(f.name, f.dataType, True, {EVIDENCE: False} if f.name in empty else {}) for f in seen.fields])


def widened(known: T.DataType, seen: T.DataType) -> T.DataType:
    """The least type that holds what both hold, of those that files of either type can be read with.

    Fields are added at every depth. A column of which no value was seen takes any type. Numbers grow:
    int < bigint < decimal, int < double, float < double; bigint and double meet in a decimal. Between other types the known one
    stays, and a value that does not fit it becomes null and its record is kept in the rescue column.
    """
    if isinstance(known, T.StructType) and isinstance(seen, T.StructType):
        have, others = {f.name for f in known.fields}, {s.name: s for s in seen.fields}
        fields = []
        for f in known.fields:
            other = others.get(f.name)
            if other is None or not is_evident(other):
                fields.append(_plain_field(f))
            elif not is_evident(f):
                fields.append(_plain_field(other))
            else:
                fields.append(T.StructField(f.name, widened(f.dataType, other.dataType), True))
        return T.StructType(fields + [_plain_field(s) for s in seen.fields if s.name not in have])
    if isinstance(known, T.ArrayType) and isinstance(seen, T.ArrayType):
        return T.ArrayType(widened(known.elementType, seen.elementType), True)
    return _grown(known, seen)


def _plain_field(f: T.StructField) -> T.StructField:
    return T.StructField(f.name, f.dataType, True, {} if is_evident(f) else {EVIDENCE: False})


def _grown(known: T.DataType, seen: T.DataType) -> T.DataType:
    whole = {T.IntegerType: 10, T.LongType: 20}
    real = (T.FloatType, T.DoubleType)
    kinds = {type(known), type(seen)}
    if kinds == {T.IntegerType, T.LongType}:
        return T.LongType()
    if isinstance(seen, T.DoubleType) and isinstance(known, (T.IntegerType, T.FloatType)):
        return T.DoubleType()
    if isinstance(known, real) or not kinds <= {*whole, *real, T.DecimalType}:
        return known  # files of doubles cannot be read as anything wider
    if kinds <= set(whole):
        return known

    def digits(t: T.DataType) -> tuple[int, int]:
        """Digits before and after the point."""
        return (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (whole[type(t)], 0) if type(t) in whole else (20, 18)

    (a, b), (c, d) = digits(known), digits(seen)
    before = max(a, c)
    return T.DecimalType(min(38, before + max(b, d)), min(max(b, d), max(b, 38 - before)))


def _kept_schema(spark: SparkSession, landing: Landing) -> T.StructType | None:
    if landing.schema_folder is None:
        return None
    text = files.read_text(spark, f"{landing.schema_folder.rstrip('/')}/schema.json")
    return None if text is None else T.StructType.fromJson(json.loads(text)["schema"])


def remembered_schema(spark: SparkSession, landing: Landing, seen: T.StructType | None) -> T.StructType | None:
    """What is kept in the schema folder, widened by what was seen now."""
    if landing.schema_folder is None:
        return seen
    known = _kept_schema(spark, landing)
    schema = seen if known is None else known if seen is None else widened(known, seen)
    if schema is not None and schema != known:
        files.write_text(spark, f"{landing.schema_folder.rstrip('/')}/schema.json", json.dumps({"schema": schema.jsonValue()}))
    return schema


def _with_rescue(schema: T.StructType, landing: Landing) -> T.StructType:
    if not landing.rescue_column or landing.rescue_column in schema.names:
        return schema
    return T.StructType([*schema.fields, T.StructField(landing.rescue_column, T.StringType())])


def layouts(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """CSV files by their header lines. Only first lines are fetched, of the files of one micro-batch."""
    by_header = defaultdict(list)
    with ThreadPoolExecutor(max_workers=16) as pool:
        for path, line in zip(paths, pool.map(lambda p: files.first_line(spark, p), paths)):
            if line is not None:
                by_header[line].append(path)
    return dict(by_header)


def header_names(spark: SparkSession, landing: Landing, line: str, paths: Sequence[str], seen: T.StructType) -> T.StructType:
    """The columns of one layout under the names of its header; of equal names the later ones get ``_1``, ``_2`` …

    The reader numbers *all* columns of a name that occurs twice, by their place; such a header is split once more as it stands.
    """
    if all(f.name in line for f in seen.fields):
        return seen
    head = _configured(spark, landing).option("header", "false").load(literal_path(paths[0])).first()
    taken: set[str] = set()
    names = []
    own = [n if n is not None else f.name for n, f in zip(head, seen.fields)]
    reserved = {n.lower() for n in own}
    for name in own:
        free = name if name.lower() not in taken else next(t for i in count(1) if (t := f"{name}_{i}").lower() not in taken | reserved)
        taken.add(free.lower())
        names.append(free)
    return T.StructType([T.StructField(n, f.dataType, True, f.metadata) for n, f in zip(names, seen.fields)])


def read_files(
    spark: SparkSession, landing: Landing, paths: Sequence[str], schema: T.StructType | None = None
) -> DataFrame | None:
    """The rows of these files, under the remembered schema and what they add to it.

    ``schema`` skips inference altogether. None when no file holds anything. Columns of which no value was seen
    carry a mark in their metadata.
    """
    if landing.format == JSON:
        if schema is None:
            seen = infer_schema(spark, landing, paths)
            schema = remembered_schema(spark, landing, seen and with_evidence(spark, landing, seen, paths))
        if schema is None:
            return None
        reader = _configured(spark, landing).schema(_with_rescue(schema, landing))
        rows = reader.load(list(map(literal_path, paths)))
        return rows.select(*_marked(_with_rescue(schema, landing)))
    groups = layouts(spark, paths)
    own = []
    for line, group in groups.items():
        seen = infer_schema(spark, landing, group)
        if seen is not None:
            if schema is None:
                seen = with_evidence(spark, landing, seen, group)
            own.append((header_names(spark, landing, line, group, seen), group, seen))
    if schema is None:
        for named, _, _ in own:
            schema = remembered_schema(spark, landing, named if schema is None else widened(schema, named))
    if schema is None or not own:
        return None
    types = {f.name: f.dataType for f in schema.fields}
    frames = []
    for named, group, seen in own:
        ordered = T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in named.fields])
        reader = _configured(spark, landing).schema(_with_rescue(ordered, landing))
        if named.names != seen.names:  # one header for all files of the group, so columns are known by their place
            reader = reader.option("enforceSchema", "true")
        frames.append(reader.load(list(map(literal_path, group))).select("*", "_metadata"))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    for f in schema.fields:
        if f.name not in rows.columns:
            rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
    return rows.select(*_marked(_with_rescue(schema, landing)), "_metadata")


def _marked(schema: T.StructType) -> list[Column]:
    return [ref(f.name) if is_evident(f) else ref(f.name).alias(f.name, metadata={EVIDENCE: False}) for f in schema.fields]


def landed_files(
    spark: SparkSession, landing: Landing, max_files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the paths of landed files, each once; their contents are not opened."""
    own = {k: v for k, v in landing.options.items() if k in SOURCE_OPTIONS}
    options = {"recursiveFileLookup": "true", "maxFileAge": MAX_FILE_AGE, "maxFilesPerTrigger": max_files_per_batch or FILES_PER_BATCH} | own
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return spark.readStream.format("binaryFile").schema(schema).options(**options).load(landing.path).select("path")


def landing_batch(
    spark: SparkSession, landing: Landing, schema: T.StructType | None = None
) -> DataFrame:
    """All landed files as one batch."""
    spark = reading_session(spark, landing)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing.path).select("path")
    paths = [r["path"] for r in listed.toLocalIterator()]
    rows = read_files(spark, landing, paths, schema) if paths else None
    if rows is None:
        raise ValueError(f"no files with rows in {landing.path}")
    return rows
