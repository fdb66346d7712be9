"""Streaming ingest and exports."""

from __future__ import annotations

import time
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.session import work_folder
from siltworks.sinks import files
from siltworks.sinks.export import export_frame
from siltworks.sources.landing import Landing
from siltworks.streaming.ingest import BronzeTarget, ingest, read_bronze

from .registry import check, stamp, table


def landing_and_bronze(spark: SparkSession, label: str, file_format: str, **options):
    home = work_folder(spark, label)
    return (
        Landing(f"{home}/landing", file_format, f"{home}/schema", **options),
        BronzeTarget(f"{home}/bronze", f"{home}/checkpoint", table=f"default.{label}_{uuid.uuid4().hex}"),
    )


@check(
    "q02_ingest_json",
    """SELECT event_id, ts, user_id, event_type, value, props, true AS has_audit,
              '{"event_id":' || event_id || ',"event_type":"' || event_type || '"' AS raw_start FROM events""",
)
def ingest_json(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines in a tree of days, drained by one run, read by name in another session."""
    landing, target = landing_and_bronze(spark, "q02", "json")
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("string"))
    day = F.regexp_replace(F.substring("ts", 1, 10), "-", "")
    events.withColumn("day", day).write.partitionBy("day").json(landing.path)
    ingest(spark, landing, target)
    bronze = spark.newSession().table(target.table)
    audit = (
        F.col("_ingested_at").isNotNull()
        & (F.col("_ingestion_date") == F.to_date("_ingested_at"))
        & F.col("_metadata.file_name").endswith(".json")
        & F.col("_rescued_data").isNull()
    )
    return bronze.select(
        "event_id", stamp("ts").alias("ts"), "user_id", "event_type", "value", "props",
        audit.alias("has_audit"),
        F.regexp_extract("_raw_data", r'^(\{"event_id":[0-9]+,"event_type":"[a-z]+")', 1).alias("raw_start"),
    )


# Bytes of documents, as Parquet, in one landed array.
ARRAY_BYTES = 8 << 20


def json_array_lines(batches):
    """Lines of one indented JSON array per task, written as they come."""
    opening = "["
    for batch in batches:
        yield pd.DataFrame({"line": [(opening if i == 0 else ",") + doc for i, doc in enumerate(batch["doc"])]})
        opening = "," if len(batch) else opening
    yield pd.DataFrame({"line": ["[]" if opening == "[" else "]"]})


@check("q02b_ingest_multi_line", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def ingest_multi_line(spark: SparkSession, sf: str) -> DataFrame:
    """Each landed file is one indented document, an array of whole texts."""
    landing, target = landing_and_bronze(spark, "q02b", "json", options={"multiLine": "true"})
    # A document of many lines is read by one task: files stay small however large the table is.
    n_files = max(8, -(-files.total_bytes(spark, f"{sf}/documents.parquet") // ARRAY_BYTES))
    documents = table(spark, sf, "documents").repartition(n_files)
    indented = documents.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("doc"))
    lines = indented.mapInPandas(json_array_lines, "line string")
    lines.write.text(f"{landing.path}/20240101/00")
    ingest(spark, landing, target)
    return read_bronze(spark, target).select("doc_id", "text", "lang", "source", "n_chars")


@check(
    "q03_ingest_csv",
    """SELECT c_custkey AS "Cust_Key", c_name AS "Name", c_nationkey AS nation_key, c_acctbal AS "Acct_Bal_",
              c_mktsegment AS "Market_Segment" FROM customer""",
)
def ingest_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Pipe-separated files whose headers need cleaning, with inferred types."""
    landing, target = landing_and_bronze(spark, "q03", "csv", options={"sep": "|"})
    messy = table(spark, sf, "customer").toDF("Cust Key", " Name ", "nation_key", "Acct-Bal!", "Market.Segment")
    messy.write.option("header", True).option("sep", "|").csv(f"{landing.path}/20240101/05")
    ingest(spark, landing, target)
    return read_bronze(spark, target).select(
        F.col("Cust_Key").cast("bigint").alias("Cust_Key"), "Name", "nation_key", "Acct_Bal_", "Market_Segment"
    )


@check(
    "q04_ingest_evolving",
    """SELECT o_orderkey, o_totalprice,
              CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN NULL ELSE o_orderpriority END AS o_orderpriority
       FROM orders""",
)
def ingest_evolving(spark: SparkSession, sf: str) -> DataFrame:
    """The second drop has one more column; rows of the first read null."""
    landing, target = landing_and_bronze(spark, "q04", "json")
    orders = table(spark, sf, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp")
    orders.filter(early).select("o_orderkey", "o_totalprice").write.json(f"{landing.path}/20240101/00")
    ingest(spark, landing, target)
    later = orders.filter(~early).select("o_orderkey", "o_totalprice", "o_orderpriority")
    later.write.json(f"{landing.path}/20240102/00")
    ingest(spark, landing, target)
    return read_bronze(spark, target).select("o_orderkey", "o_totalprice", "o_orderpriority")


@check("q03b_csv_layouts", "SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS c_mktsegment FROM customer")
def ingest_csv_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """Three layouts in one run: fewer columns, more columns, another order."""
    landing, target = landing_and_bronze(spark, "q03b", "csv")
    customer = table(spark, sf, "customer")
    for rest, columns in enumerate((("c_mktsegment", "c_name", "c_custkey"), ("c_custkey", "c_name"), ("c_name", "c_custkey"))):
        own = customer.filter(F.col("c_custkey") % 3 == rest).select(*columns)
        own.write.option("header", True).csv(f"{landing.path}/20240101/0{rest}")
    ingest(spark, landing, target)
    return read_bronze(spark, target).select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "c_mktsegment")


@check(
    "q04b_late_fields",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS o_orderpriority,
              CASE WHEN o_orderkey % 3 = 2 THEN o_totalprice END AS o_totalprice FROM orders""",
)
def ingest_late_fields(spark: SparkSession, sf: str) -> DataFrame:
    """The second run finds files whose times lie two hours and nine days back, with columns of their own."""
    landing, target = landing_and_bronze(spark, "q04b", "json")
    orders = table(spark, sf, "orders")
    drops = ((0, ("o_orderkey",)), (1, ("o_orderkey", "o_orderpriority")), (2, ("o_orderkey", "o_orderpriority", "o_totalprice")))
    for rest, columns in drops:
        folder = f"{landing.path}/2024010{rest + 1}/00"
        orders.filter(F.col("o_orderkey") % 3 == rest).select(*columns).write.json(folder)
        for f in files.listing(spark, folder) if rest else []:
            files.set_time(spark, f.path, time.time() - (2, 9 * 24)[rest - 1] * 3600)
        if rest != 1:
            ingest(spark, landing, target)
    return read_bronze(spark, target).select("o_orderkey", "o_orderpriority", "o_totalprice")


@check(
    "q03c_repeated_headers",
    """SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS name_1,
              CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS balance FROM customer""",
)
def ingest_repeated_headers(spark: SparkSession, sf: str) -> DataFrame:
    """A file of nothing but a header, files whose header has a name twice, and files without it."""
    landing, target = landing_and_bronze(spark, "q03c", "csv")
    customer = table(spark, sf, "customer")
    twice = ("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    drops = (
        ("id,name,name,balance", None),
        ("id,name,name,balance", customer.filter("c_custkey % 2 = 0").select(*twice)),
        ("name,id", customer.filter("c_custkey % 2 = 1").select("c_name", "c_custkey")),
    )
    for hour, (header, rows) in enumerate(drops):
        headed_lines(spark, header, rows).write.text(f"{landing.path}/20240101/0{hour}")
        ingest(spark, landing, target)
    return read_bronze(spark, target).select(F.col("id").cast("bigint").alias("id"), "name", "name_1", "balance")


def headed_lines(spark: SparkSession, header: str, rows: DataFrame | None) -> DataFrame:
    """Lines of comma-separated files, each task's file with the header; the writer of such files refuses repeated names."""
    if rows is None:
        return spark.range(1, numPartitions=1).select(F.lit(header).alias("value"))
    line, first = F.concat_ws(",", *rows.columns), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    return rows.select(F.when(first, F.concat(F.lit(header + "\n"), line)).otherwise(line).alias("value"))


@check(
    "q04c_growing_types",
    """SELECT form, CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey + 3000000000 ELSE o_orderkey END AS id,
              CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice ELSE floor(o_totalprice) END AS amount,
              CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey % 3 = 0 END AS flag, true AS fits
       FROM orders, (VALUES ('csv'), ('json')) AS f(form)""",
)
def ingest_growing_types(spark: SparkSession, sf: str) -> DataFrame:
    """Nothing but names, then small whole numbers, then large and broken ones, and a column whose first values come last."""
    orders = table(spark, sf, "orders")
    late = F.col("o_orderkey") % 2 == 1
    whole = orders.filter(~late).select(F.col("o_orderkey").alias("id"), F.floor("o_totalprice").alias("amount"), F.lit(None).cast("string").alias("flag"))
    broken = orders.filter(late).select((F.col("o_orderkey") + 3000000000).alias("id"), F.col("o_totalprice").alias("amount"), (F.col("o_orderkey") % 3 == 0).alias("flag"))
    found = []
    for form in ("csv", "json"):
        landing, target = landing_and_bronze(spark, f"q04c_{form}", form)
        for hour, rows in enumerate((whole.limit(0).coalesce(1), whole, broken)):
            writer = rows.write.options(header="true", ignoreNullFields="false")
            getattr(writer, form)(f"{landing.path}/20240101/0{hour}")
            ingest(spark, landing, target)
        bronze = read_bronze(spark, target)
        fits = F.col("_rescued_data").isNull().alias("fits")
        found.append(bronze.select(F.lit(form).alias("form"), F.col("id").cast("bigint").alias("id"), F.col("amount").cast("double").alias("amount"), "flag", fits))
    return found[0].unionByName(found[1])


def exported(spark: SparkSession, sf: str, label: str, file_format: str, **kwargs) -> tuple[DataFrame, str]:
    part = table(spark, sf, "part")
    path = export_frame(part, work_folder(spark, label), "parts", file_format, **kwargs)
    return part, path


@check("q06_export_csv", "SELECT * FROM part")
def export_csv(spark: SparkSession, sf: str) -> DataFrame:
    options = {"header": "true", "sep": "|", "quoteAll": "true"}
    part, path = exported(spark, sf, "q06", "csv", options=options)
    return spark.read.schema(part.schema).options(**options).csv(path)


@check("q06b_single_file_any_size", "SELECT * FROM lineitem")
def export_single_file(spark: SparkSession, sf: str) -> DataFrame:
    """One file is asked for, and one file it is, whatever the size."""
    lineitem = table(spark, sf, "lineitem")
    path = export_frame(lineitem, work_folder(spark, "q06b"), "lines", "csv")
    (only,) = files.listing(spark, path)
    assert not only.is_dir
    return spark.read.schema(lineitem.schema).csv(path)


@check("q07_export_json", "SELECT * FROM part")
def export_json(spark: SparkSession, sf: str) -> DataFrame:
    part, path = exported(spark, sf, "q07", "json")
    return spark.read.schema(part.schema).json(path)


@check("q08_export_jsonl", "SELECT * FROM part")
def export_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    part, path = exported(spark, sf, "q08", "JSONL")
    return spark.read.schema(part.schema).json(path)


@check("q09_export_parquet", "SELECT * FROM part")
def export_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """In parts, written in parallel."""
    part, path = exported(spark, sf, "q09", "parquet", single_file=False)
    return spark.read.schema(part.schema).parquet(path)
