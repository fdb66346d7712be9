"""Bronze: landing files -> audit columns -> safe names -> append, once per file.

Every micro-batch writes a folder of its own, so one that is run again replaces what it wrote before, and
registers its partitions in the catalog, where there is a table. Nothing that grows with the history is kept
but Spark's own list of files seen.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import INGESTION_DATE, with_audit_columns
from ..functions.names import quoted, with_safe_names
from ..sinks import files
from ..sinks.store import ddl, ensure_database
from ..sources.landing import MAX_FILE_AGE, Landing, is_evident, landed_files, read_files, reading_session, widened

BATCH = "_batch"


@dataclass(frozen=True)
class BronzeTarget:
    """A Parquet folder partitioned by micro-batch and ingestion day, with its checkpoint.

    With ``table`` the folder is a catalog table too: other sessions read bronze by that name.
    """

    path: str
    checkpoint: str
    available_now: bool = True
    write_options: Mapping[str, str] = field(default_factory=dict)
    table: str | None = None

    @property
    def schema_file(self) -> str:
        return f"{self.checkpoint.rstrip('/')}-schema/bronze.json"


def bronze_frame(landed: DataFrame) -> DataFrame:
    return with_safe_names(with_audit_columns(landed))


def _remember(spark: SparkSession, target: BronzeTarget, schema: T.StructType) -> T.StructType:
    """Keep the union of all schemas written, so readers need not open any file footer for it."""
    text = files.read_text(spark, target.schema_file)
    known = None if text is None else T.StructType.fromJson(json.loads(text))
    union = widened(T.StructType([]) if known is None else known, schema)
    if union != known:
        files.write_text(spark, target.schema_file, json.dumps(union.jsonValue()))
    return union


def _register(spark: SparkSession, target: BronzeTarget, schema: T.StructType, folder: str) -> None:
    """Add the partitions of one batch to the catalog table; it is made, or widened, where needed.

    The table is external: to widen a nested column its entry is made anew over the same files.
    """
    if target.table is None:
        return
    name, batch = target.table, folder.rsplit("=", 1)[-1]
    whole = T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])
    create = (
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl(spark, whole)}) USING parquet "
        f"PARTITIONED BY ({BATCH}, {INGESTION_DATE}) LOCATION '{target.path}'"
    )
    ensure_database(spark, name)
    if spark.catalog.tableExists(name):
        have = {f.name: f.dataType for f in spark.table(name).schema.fields}
        fresh = T.StructType([f for f in schema.fields if f.name not in have])
        if all(have.get(f.name, f.dataType) == f.dataType for f in schema.fields):
            if fresh.fields:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({ddl(spark, fresh)})")
        else:
            spark.sql(f"DROP TABLE {name}")
    if not spark.catalog.tableExists(name):
        spark.sql(create)
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    days = [f.name.split("=", 1)[1] for f in files.listing(spark, folder) if f.is_dir and "=" in f.name]
    for day in days:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({BATCH} = '{batch}', {INGESTION_DATE} = DATE '{day}')")
    spark.catalog.refreshTable(name)


def put_batch(bronze: DataFrame, target: BronzeTarget, name: str, catalog: SparkSession | None = None) -> None:
    """Write one micro-batch of bronze rows, ``<stream>-<number>``; one of that name is replaced."""
    spark = bronze.sparkSession
    folder = f"{target.path.rstrip('/')}/{BATCH}={name}"
    # A column without values takes no place in files, so it may still take any type.
    valued = bronze.select(*[quoted(f.name) for f in bronze.schema.fields if is_evident(f)])
    valued.write.mode("overwrite").options(**dict(target.write_options)).partitionBy(INGESTION_DATE).parquet(folder)
    _register(catalog or spark, target, _remember(spark, target, bronze.schema), folder)


def start_ingest(
    spark: SparkSession,
    landing: Landing,
    target: BronzeTarget,
    schema: T.StructType | None = None,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        session = reading_session(batch.sparkSession, landing)
        paths = [r["path"] for r in batch.collect()]
        landed = read_files(session, landing, paths, schema) if paths else None
        if landed is None:
            return
        bronze = bronze_frame(landed)
        stream = json.loads(files.read_text(session, f"{target.checkpoint.rstrip('/')}/metadata"))["id"]
        put_batch(bronze, target, f"{stream}-{batch_id:09d}", batch.sparkSession)

    writer = (
        landed_files(spark, landing, max_files_per_batch)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", target.checkpoint)
    )
    if target.available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def ingest(spark: SparkSession, landing: Landing, target: BronzeTarget, **kwargs) -> None:
    """Run until the source is drained (or for ever, without ``available_now``)."""
    start_ingest(spark, landing, target, **kwargs).awaitTermination()


def bronze_schema(spark: SparkSession, target: BronzeTarget) -> T.StructType:
    text = files.read_text(spark, target.schema_file)
    if text is None:
        raise ValueError(f"nothing was ingested yet for {target.path}")
    return T.StructType.fromJson(json.loads(text))


def _whole_schema(spark: SparkSession, target: BronzeTarget) -> T.StructType:
    return T.StructType([*bronze_schema(spark, target).fields, T.StructField(BATCH, T.StringType())])


def bronze_batches(spark: SparkSession, target: BronzeTarget) -> list[str]:
    """Names of all micro-batches; one listing of one folder."""
    return [f.name.split("=", 1)[1] for f in files.listing(spark, target.path) if f.is_dir and f.name.startswith(BATCH + "=")]


def is_complete(spark: SparkSession, target: BronzeTarget, batch: str) -> bool:
    """Whether the micro-batch has been written to its end."""
    return files.exists(spark, f"{target.path.rstrip('/')}/{BATCH}={batch}/_SUCCESS")


def read_bronze(spark: SparkSession, target: BronzeTarget, batches: Sequence[str] | None = None) -> DataFrame:
    """All bronze rows, or those of some micro-batches, under the union schema; rows written before a column existed read null."""
    names = [quoted(n) for n in bronze_schema(spark, target).names]
    reader = spark.read.schema(_whole_schema(spark, target))
    if batches is None:
        return reader.parquet(target.path).select(*names)
    root = target.path.rstrip("/")
    return reader.option("basePath", root).parquet(*[f"{root}/{BATCH}={b}" for b in batches]).select(*names)


def bronze_stream(
    spark: SparkSession, target: BronzeTarget, max_files_per_batch: int | None = None
) -> DataFrame:
    """Bronze as a stream for downstream jobs with checkpoints of their own."""
    reader = spark.readStream.schema(_whole_schema(spark, target)).option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.parquet(target.path).drop(BATCH)


def name_bronze(spark: SparkSession, target: BronzeTarget, view: str) -> None:
    """Make bronze readable by name in this session, under the union schema."""
    read_bronze(spark, target).createOrReplaceTempView(view)
