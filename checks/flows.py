"""Upserts, stored tables, silver flows and governance."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from unittest import mock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks import ColumnContract, FlattenContract, TableContract
from siltworks.operators.merge import upsert, upsert_by_contract, upsert_small
from siltworks.operators.keys import latest_by_contract
from siltworks.plans.governance import compliance_report
from siltworks.plans.silver import build_silver, build_silver_from_batches, fan_out, merged_silver, read_rejects, silver_frame
from siltworks.session import work_folder
from siltworks.sinks.store import StoredTable
from siltworks.sources.tables import read_table
from siltworks.streaming.ingest import BronzeTarget, put_batch
from siltworks.streaming.silver import start_silver, start_silver_fan_out

from .registry import check, line_events, stamp, stored, table

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")

# Second load of the whole table: F orders change later, P orders carry an older date, and O orders
# come back under new keys.
SECOND_LOAD = """
    SELECT CASE WHEN o_orderstatus = 'O' THEN -1 - o_orderkey ELSE o_orderkey END AS o_orderkey,
           o_custkey + 1 AS o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice,
           CASE WHEN o_orderstatus = 'P' THEN o_orderdate - INTERVAL 1 DAY
                WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate
    FROM orders"""

UPSERTED = f"""
    WITH n AS ({SECOND_LOAD})
    SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey,
           CASE WHEN take THEN n.o_custkey ELSE o.o_custkey END AS o_custkey,
           CASE WHEN take THEN n.o_orderstatus ELSE o.o_orderstatus END AS o_orderstatus,
           CASE WHEN take THEN n.o_totalprice ELSE o.o_totalprice END AS o_totalprice,
           CASE WHEN take THEN n.o_orderdate ELSE o.o_orderdate END AS o_orderdate
    FROM (SELECT o.o_orderkey AS ok, n.o_orderkey AS nk,
                 n.o_orderkey IS NOT NULL AND (o.o_orderkey IS NULL OR o.o_orderdate <= n.o_orderdate) AS take
          FROM orders o FULL JOIN n ON o.o_orderkey = n.o_orderkey) k
    LEFT JOIN orders o ON o.o_orderkey = ok LEFT JOIN n ON n.o_orderkey = nk"""


def loads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf, "orders").select(*ORDER_COLUMNS)
    orders = orders.withColumn("o_orderdate", stamp("o_orderdate"))
    status, day = F.col("o_orderstatus"), F.expr("INTERVAL 1 DAY")
    second = orders.select(
        F.when(status == "O", -1 - F.col("o_orderkey")).otherwise(F.col("o_orderkey")).alias("o_orderkey"),
        (F.col("o_custkey") + 1).alias("o_custkey"),
        "o_orderstatus",
        (F.col("o_totalprice") * 2).alias("o_totalprice"),
        F.when(status == "P", F.col("o_orderdate") - day)
        .when(status == "F", F.col("o_orderdate") + day)
        .otherwise(F.col("o_orderdate"))
        .alias("o_orderdate"),
    )
    return orders, second


@check("q21_upsert", UPSERTED)
def upsert_frames(spark: SparkSession, sf: str) -> DataFrame:
    return upsert(*loads(spark, sf), ["o_orderkey"], ["o_orderdate"])


@check("q21b_upsert_small_batch", UPSERTED)
def upsert_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    """Stored table; the batch is written first, and broadcast only if it measures small enough."""
    old, new = loads(spark, sf)
    target = stored(spark, "q21b")
    target.upsert(old, ["o_orderkey"], ["o_orderdate"], keys_are_unique=True)
    target.upsert(new, ["o_orderkey"], ["o_orderdate"])
    return target.read()


@check("q21c_upsert_in_buckets", UPSERTED)
def upsert_buckets(spark: SparkSession, sf: str) -> DataFrame:
    old, new = loads(spark, sf)
    target = stored(spark, "q21c", buckets=8)
    target.upsert(old, ["o_orderkey"], ["o_orderdate"], keys_are_unique=True)
    target.upsert(new, ["o_orderkey"], ["o_orderdate"])
    return target.read()


@check("q21g_ten_batches_as_runs", UPSERTED)
def upsert_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Merge on read: ten batches, each written as rows of its own; eight are gathered on the way."""
    old, new = loads(spark, sf)
    target = stored(spark, "q21g", buckets=8, delta_runs=True)
    target.upsert(old, ["o_orderkey"], ["o_orderdate"], keys_are_unique=True)
    for i in range(10):
        target.upsert(new.filter(F.pmod(F.col("o_custkey"), F.lit(10)) == i), ["o_orderkey"], ["o_orderdate"], keys_are_unique=True)
    return target.read()


@check(
    "q21d_upsert_array_key",
    f"SELECT form, u.* FROM ({UPSERTED}) u, (VALUES ('joined'), ('broadcast')) AS f(form)",
)
def upsert_array_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Both forms take the same keys: here an array, named in another case by the batch."""
    old, new = (df.withColumn(k, F.array("o_orderkey")).drop("o_orderkey") for df, k in zip(loads(spark, sf), ("Keys", "keys")))
    both = [
        form(old, new, ["keys"], ["o_orderdate"]).withColumn("form", F.lit(name))
        for name, form in (("joined", upsert), ("broadcast", upsert_small))
    ]
    return both[0].unionByName(both[1]).select("form", F.col("Keys")[0].alias("o_orderkey"), *ORDER_COLUMNS[1:])


@check("q21e_bucket_count_changes", UPSERTED)
def upsert_other_bucket_count(spark: SparkSession, sf: str) -> DataFrame:
    """The batch comes through an object that has another number of buckets than the table."""
    old, new = loads(spark, sf)
    target = stored(spark, "q21e", buckets=8)
    target.upsert(old, ["o_orderkey"], ["o_orderdate"], keys_are_unique=True)
    for buckets in (16, 0):
        half = new.filter(F.col("o_custkey") % 2 == int(buckets > 0))
        StoredTable(spark, target.name, buckets=buckets, base=target.base).upsert(half, ["o_orderkey"], ["o_orderdate"])
    return target.read()


@check("q21f_key_widens", UPSERTED)
def upsert_wider_key(spark: SparkSession, sf: str) -> DataFrame:
    """The table has int keys, the batch bigint ones."""
    old, new = loads(spark, sf)
    target = stored(spark, "q21f", buckets=8)
    target.upsert(old.withColumn("o_orderkey", F.col("o_orderkey").cast("int")), ["o_orderkey"], ["o_orderdate"], keys_are_unique=True)
    target.upsert(new.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint")), ["o_orderkey"], ["o_orderdate"])
    return target.read().withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@check(
    "q14c_hash_as_source",
    """SELECT c_custkey, c_name AS name, sha256(c_name) AS name_hashed_key, sha256(c_name) AS who,
              upper(sha256(c_name)) AS loud FROM customer""",
)
def hash_as_source(spark: SparkSession, sf: str) -> DataFrame:
    """Later columns read a hashed one, by source and in a transform; the input has a column of such a name too."""
    contract = TableContract(
        "customers",
        primary_keys=("c_custkey",),
        columns=(
            ColumnContract("c_custkey", "bigint"),
            ColumnContract("name", "string", source="c_name", hashed=True),
            ColumnContract("who", "string", source="name_hashed_key"),
            ColumnContract("loud", "string", transform="upper(name_hashed_key)"),
        ),
    )
    customer = table(spark, sf, "customer").withColumn("who", F.lit("raw")).withColumn("_metadata", F.lit(None).cast("struct<file_name:string>"))
    return silver_frame(customer.withColumn("_ingested_at", F.lit("2024-01-01").cast("timestamp")), contract).drop("_metadata")


@check(
    "q22_upsert_null_key",
    """WITH o AS (SELECT user_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS kind,
                         max(ts) AS seen, count(*) AS n FROM events GROUP BY ALL),
            n AS (SELECT user_id + 1 AS user_id, kind, seen, n + 1000 AS n FROM o)
       SELECT coalesce(o.user_id, n.user_id) AS user_id,
              CASE WHEN o.user_id IS NULL THEN n.kind ELSE o.kind END AS kind,
              CASE WHEN o.user_id IS NULL OR (n.user_id IS NOT NULL AND o.seen <= n.seen) THEN n.seen ELSE o.seen END AS seen,
              CASE WHEN o.user_id IS NULL OR (n.user_id IS NOT NULL AND o.seen <= n.seen) THEN n.n ELSE o.n END AS n
       FROM o FULL JOIN n ON o.user_id = n.user_id AND o.kind IS NOT DISTINCT FROM n.kind""",
)
def upsert_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    old = (
        table(spark, sf, "events")
        .withColumn("kind", F.expr("nullif(event_type, 'error')"))
        .groupBy("user_id", "kind")
        .agg(F.max(stamp("ts")).alias("seen"), F.count(F.lit(1)).alias("n"))
    )
    new = old.select((F.col("user_id") + 1).alias("user_id"), "kind", "seen", (F.col("n") + 1000).alias("n"))
    return upsert(old, new, ["user_id", "kind"], ["seen"])


EVOLVED = f"""
    WITH o AS (SELECT o_orderkey, o_orderdate, 'kept' AS only_old FROM orders),
         n AS (SELECT o_orderkey, o_orderdate, o_totalprice AS only_new FROM ({SECOND_LOAD}))
    SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey,
           CASE WHEN o.o_orderkey IS NULL OR (n.o_orderkey IS NOT NULL AND o.o_orderdate <= n.o_orderdate)
                THEN n.o_orderdate ELSE o.o_orderdate END AS o_orderdate,
           o.only_old,
           coalesce(CASE WHEN o.o_orderkey IS NULL OR (n.o_orderkey IS NOT NULL AND o.o_orderdate <= n.o_orderdate)
                THEN n.only_new END, -1.0) AS only_new
    FROM o FULL JOIN n ON o.o_orderkey = n.o_orderkey"""


@check("q23_upsert_evolving", EVOLVED)
def upsert_evolving(spark: SparkSession, sf: str) -> DataFrame:
    old, new = loads(spark, sf)
    merged = upsert(
        old.select("o_orderkey", "o_orderdate", F.lit("kept").alias("only_old")),
        new.select("o_orderkey", "o_orderdate", F.col("o_totalprice").alias("only_new")),
        ["o_orderkey"], ["o_orderdate"],
    )
    return merged.withColumn("only_new", F.coalesce("only_new", F.lit(-1.0)))


@check("q23b_upsert_evolving_stored", EVOLVED)
def upsert_evolving_stored(spark: SparkSession, sf: str) -> DataFrame:
    old, new = loads(spark, sf)
    target = stored(spark, "q23b")
    target.create(old.select("o_orderkey", "o_orderdate", F.lit("kept").alias("only_old")))
    target.upsert(
        new.select("o_orderkey", "o_orderdate", F.col("o_totalprice").alias("only_new")),
        ["o_orderkey"], ["o_orderdate"],
    )
    return target.read().withColumn("only_new", F.coalesce("only_new", F.lit(-1.0)))


LINES = TableContract(
    "lines",
    primary_keys=("l_orderkey", "l_linenumber"),
    deduplication_keys=("l_shipdate",),
    clustering_keys=("l_shipdate",),
)
_LATEST_LINES = """
    SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_quantity DESC) = 1"""


@check(
    "q24_contract_upsert",
    f"""WITH o AS ({_LATEST_LINES}),
             n AS (SELECT l_orderkey, l_linenumber + 1 AS l_linenumber, l_shipdate, l_quantity + 100 AS l_quantity FROM o)
        SELECT coalesce(o.l_orderkey, n.l_orderkey) AS l_orderkey,
               coalesce(o.l_linenumber, n.l_linenumber) AS l_linenumber,
               CASE WHEN o.l_orderkey IS NULL OR o.l_shipdate <= n.l_shipdate THEN n.l_shipdate ELSE o.l_shipdate END AS l_shipdate,
               CASE WHEN o.l_orderkey IS NULL OR o.l_shipdate <= n.l_shipdate THEN n.l_quantity ELSE o.l_quantity END AS l_quantity
        FROM o FULL JOIN n ON o.l_orderkey = n.l_orderkey AND o.l_linenumber = n.l_linenumber""",
)
def contract_upsert(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", stamp("l_shipdate").alias("l_shipdate"), "l_quantity"
    )
    old = latest_by_contract(lines, LINES, keep_match_columns=True)
    new = old.select(
        "l_orderkey", (F.col("l_linenumber") + 1).alias("l_linenumber"), "l_shipdate",
        (F.col("l_quantity") + 100).alias("l_quantity"),
    )
    return upsert_by_contract(old, new, LINES)


@check("q20_create_on_first_load", "SELECT * FROM customer")
def create_clustered(spark: SparkSession, sf: str) -> DataFrame:
    target = stored(spark, "q20", clustering=("c_mktsegment", "c_acctbal"))
    target.upsert(table(spark, sf, "customer"), ["c_custkey"])
    return target.read()


@check(
    "q20b_files_are_skipped",
    """SELECT form, o.* FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
         WHERE o_orderdate BETWEEN TIMESTAMP '1995-03-01' AND TIMESTAMP '1995-03-31' AND o_orderkey >= 100) o,
         (VALUES ('plain'), ('buckets')) AS f(form)""",
)
def read_few_files(spark: SparkSession, sf: str) -> DataFrame:
    """A range of the clustering column opens the files whose ends, kept in the table's statistics, meet it."""
    orders, _ = loads(spark, sf)
    march = (dt.datetime(1995, 3, 1, tzinfo=dt.timezone.utc), dt.datetime(1995, 3, 31, tzinfo=dt.timezone.utc))
    found = []
    for form, buckets in (("plain", 0), ("buckets", 4)):
        target = stored(spark, f"q20b_{form}", buckets=buckets, clustering=("o_orderdate",))
        target.create(orders, ["o_orderkey"])
        rows = target.read_where({"o_orderdate": march, "o_orderkey": (100, None)})
        found.append(rows.select(F.lit(form).alias("form"), *ORDER_COLUMNS))
    return found[0].unionByName(found[1])


@check(
    "q05_overwrite_table",
    "SELECT s_suppkey, s_name, s_acctbal + 2 AS s_acctbal, s_nationkey % 5 AS zone FROM supplier",
)
def overwrite_table(spark: SparkSession, sf: str) -> DataFrame:
    """Overwritten twice by a query that reads the table itself, the second time with other columns."""
    target = stored(spark, "q05", clustering=("s_acctbal",))
    target.overwrite(table(spark, sf, "supplier"))
    for _ in range(2):
        target.overwrite(target.read().withColumn("s_acctbal", F.col("s_acctbal") + 1))
    target.overwrite(
        target.read().select("s_suppkey", "s_name", "s_acctbal", (F.col("s_nationkey") % 5).alias("zone"))
    )
    return target.read()


CHARGES = TableContract(
    "line_charges",
    primary_keys=("event_id", "charge_index"),
    deduplication_keys=("event_time",),
    flatten=FlattenContract(explode=("chargeList",), keep=("_metadata",), with_index=True),
    columns=(
        ColumnContract("event_id", "string", source="eventId", hashed=True),
        ColumnContract("charge_index", "bigint", source="chargeList__index"),
        ColumnContract("event_time", "timestamp", source="eventTime"),
        ColumnContract("kind", "string", transform="upper(chargeList__kind)"),
        ColumnContract("amount", "double", source="chargeList__amount"),
        ColumnContract("tax_rate", "double", source="chargeList__tax__rate"),
        ColumnContract("part_key", "bigint", source="header__item__partKey"),
        ColumnContract("supplier_key", "bigint", source="header__item__suppKey"),
    ),
)

_EXPLODED = """
    SELECT concat_ws('-', l_orderkey, l_linenumber) AS event_id, l_shipdate AS event_time,
           {kind} AS kind, {amount} AS amount, {rate} AS tax_rate, {pos} AS charge_index,
           l_partkey AS part_key, l_suppkey AS supplier_key
    FROM lineitem WHERE {amount} <> 0"""
CHARGE_ROWS = " UNION ALL ".join(
    _EXPLODED.format(kind=k, amount=a, rate=r, pos=p)
    for k, a, r, p in (
        ("'BASE'", "l_extendedprice", "l_tax", "cast(0 AS bigint)"),
        ("'DISCOUNT'", "-(l_extendedprice * l_discount)", "l_discount", "1"),
        ("'TAX'", "l_extendedprice * l_tax", "l_tax", "CASE WHEN l_discount <> 0 THEN 2 ELSE 1 END"),
    )
)
# The tie-break is every other column in contract order, greatest first.
_CHARGE_ORDER = """event_time DESC, sha256(event_id) DESC, kind DESC, amount DESC, tax_rate DESC,
    part_key DESC, supplier_key DESC"""
CHARGE_SILVER = f"""
    SELECT event_id, sha256(event_id) AS event_id_hashed_key, charge_index, event_time, kind, amount,
           tax_rate, part_key, supplier_key
    FROM ({{rows}}) QUALIFY row_number() OVER (PARTITION BY event_id, charge_index ORDER BY {_CHARGE_ORDER}) = 1"""


@check(
    "q32_silver_build",
    f"""WITH early AS ({CHARGE_SILVER.format(rows=f"SELECT * FROM ({CHARGE_ROWS}) WHERE event_time < TIMESTAMP '1998-01-01'")}),
             whole AS ({CHARGE_SILVER.format(rows=CHARGE_ROWS)})
        SELECT w.*, w.event_time AS ingested_at, e.event_id IS NOT NULL AS was_there
        FROM whole w LEFT JOIN early e ON e.event_id = w.event_id AND e.charge_index = w.charge_index""",
)
def silver_build(spark: SparkSession, sf: str) -> DataFrame:
    """Rows shipped before 1998 are there from an earlier load; then all rows arrive."""
    bronze = line_events(table(spark, sf, "lineitem"))
    early = silver_frame(bronze.filter("_ingested_at < timestamp '1998-01-01 00:00:00'"), CHARGES, keep_match_columns=True)
    merged = merged_silver(early.withColumn("was_there", F.lit(True)), bronze, CHARGES)
    return merged.select(
        *CHARGES.output_names,
        F.col("_metadata.bronze_ingested_at").alias("ingested_at"),
        F.coalesce("was_there", F.lit(False)).alias("was_there"),
    )


@check("q32b_silver_job_runs", CHARGE_SILVER.format(rows=CHARGE_ROWS))
def silver_job_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs of the job: full load, increment above the mark, nothing new."""
    bronze = line_events(table(spark, sf, "lineitem"))
    target = stored(spark, "q32b")
    early = bronze.filter("_ingested_at < timestamp '1998-01-01 00:00:00'")
    modes = [
        build_silver(spark, rows, CHARGES, target.name, base=target.base)
        for rows in (early, bronze, bronze)
    ]
    assert modes == ["full_load", "incremental", "incremental"], modes
    return target.read().select(*CHARGES.output_names)


@check("q32c_interrupted_run", CHARGE_SILVER.format(rows=CHARGE_ROWS))
def silver_job_interrupted(spark: SparkSession, sf: str) -> DataFrame:
    """The second run dies between its commit and the catalog, the third before its commit; the fourth goes on."""
    bronze = line_events(table(spark, sf, "lineitem"))
    target = stored(spark, "q32c")
    run = lambda rows: build_silver(spark, rows, CHARGES, target.name, base=target.base)
    run(bronze.filter("_ingested_at < timestamp '1996-01-01 00:00:00'"))
    for broken, rows in (("_point_buckets", bronze.filter("_ingested_at < timestamp '1998-01-01 00:00:00'")), ("_commit", bronze)):
        with mock.patch.object(StoredTable, broken, side_effect=OSError("gone")):
            try:
                run(rows)
                raise AssertionError("the run should have been interrupted")
            except OSError:
                pass
    run(bronze)
    return spark.newSession().table(target.name).select(*CHARGES.output_names)


QUANTITIES = TableContract(
    "line_quantities",
    primary_keys=("event_id", "step"),
    deduplication_keys=("event_time",),
    flatten=FlattenContract(explode=("quantityList",)),
    columns=(
        ColumnContract("event_id", "string", source="eventId"),
        ColumnContract("step", "bigint", source="quantityList__step"),
        ColumnContract("event_time", "timestamp", source="eventTime"),
        ColumnContract("amount", "double", source="quantityList__amount"),
    ),
)
HEADERS = TableContract(
    "line_headers",
    primary_keys=("event_id",),
    deduplication_keys=("event_time",),
    flatten=FlattenContract(),
    columns=(
        ColumnContract("event_id", "string", source="eventId"),
        ColumnContract("event_time", "timestamp", source="eventTime"),
        ColumnContract("part_key", "bigint", source="header__item__partKey"),
    ),
)


FAN_OUT = f"""WITH q AS (SELECT concat_ws('-', l_orderkey, l_linenumber) AS event_id, s AS step,
                          l_shipdate AS event_time, least(20.0, l_quantity - s * 20) AS amount
                   FROM lineitem, (SELECT unnest(range(0, 3)) AS s) WHERE s < ceil(l_quantity / 20))
        SELECT 'line_charges' AS label, event_id, charge_index AS position, amount
        FROM ({CHARGE_SILVER.format(rows=CHARGE_ROWS)})
        UNION ALL
        SELECT 'line_quantities', event_id, step, amount FROM q
        QUALIFY row_number() OVER (PARTITION BY event_id, step ORDER BY event_time DESC, amount DESC) = 1
        UNION ALL
        SELECT 'line_headers', concat_ws('-', l_orderkey, l_linenumber), 0, cast(l_partkey AS double)
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC) = 1"""


def shown_together(frames: Mapping[str, DataFrame]) -> DataFrame:
    shown = {
        "line_charges": ("charge_index", "amount"),
        "line_quantities": ("step", "amount"),
        "line_headers": ("CAST(0 AS BIGINT)", "CAST(part_key AS DOUBLE)"),
    }
    parts = [
        frames[label].select(
            F.lit(label).alias("label"), "event_id", F.expr(pos).alias("position"), F.expr(amount).alias("amount")
        )
        for label, (pos, amount) in shown.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@check("q33_fan_out", FAN_OUT)
def one_source_three_tables(spark: SparkSession, sf: str) -> DataFrame:
    return shown_together(fan_out(line_events(table(spark, sf, "lineitem")), [CHARGES, QUANTITIES, HEADERS]))


@check("q33b_stored_fan_out", FAN_OUT)
def one_stream_three_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Two drops, streamed into three stored tables, each read back by name."""
    home = work_folder(spark, "q33b")
    bronze = line_events(table(spark, sf, "lineitem"))
    targets = {
        c.name: (c, StoredTable.of_contract(spark, c, f"default.{c.name}_{uuid.uuid4().hex}", f"{home}/{c.name}"))
        for c in (CHARGES, QUANTITIES, HEADERS)
    }
    for part in ("_ingested_at >= timestamp '1998-01-01 00:00:00'", "_ingested_at < timestamp '1998-01-01 00:00:00'"):
        bronze.filter(part).write.mode("append").parquet(f"{home}/bronze")
        stream = spark.readStream.schema(bronze.schema).parquet(f"{home}/bronze")
        start_silver_fan_out(stream, targets, f"{home}/checkpoint", on_error="null").awaitTermination()
    return shown_together({name: spark.newSession().table(t.name) for name, (_, t) in targets.items()})


EVENT_SILVER = TableContract(
    "events_silver",
    primary_keys=("user_id", "event_type"),
    deduplication_keys=("seen_at",),
    columns=(
        ColumnContract("user_id", "bigint"),
        ColumnContract("event_type", "string"),
        ColumnContract("seen_at", "timestamp", source="ts"),
        ColumnContract("value", "double"),
        ColumnContract("event_id", "bigint"),
    ),
)


@check(
    "q34_streaming_silver",
    """SELECT user_id, event_type, ts AS seen_at, value, event_id FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, value DESC, event_id DESC) = 1""",
)
def streaming_silver(spark: SparkSession, sf: str) -> DataFrame:
    return _two_drops(spark, sf, "q34", delta_runs=False)


@check(
    "q34b_streaming_silver_as_runs",
    """SELECT user_id, event_type, ts AS seen_at, value, event_id FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, value DESC, event_id DESC) = 1""",
)
def streaming_silver_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The second drop lies beside the table and is merged when it is read."""
    return _two_drops(spark, sf, "q34b", delta_runs=True)


@check(
    "q19b_late_writer",
    """SELECT mode, e.* FROM (
         SELECT user_id, event_type, ts AS seen_at, value, event_id FROM events
         QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, value DESC, event_id DESC) = 1) e,
       (VALUES ('full_load incremental incremental')) AS m(mode)""",
)
def late_writer(spark: SparkSession, sf: str) -> DataFrame:
    """The second batch of bronze becomes visible after silver has read later times, and is read all the same; a third run finds nothing."""
    home = work_folder(spark, "q19b")
    bronze = BronzeTarget(f"{home}/bronze", f"{home}/checkpoint")
    events = table(spark, sf, "events").withColumn("ts", stamp("ts")).withColumn("_ingested_at", F.col("ts"))
    name, modes = f"default.q19b_{uuid.uuid4().hex}", []
    for writer, part in (("early", "ts >= timestamp '2024-01-12 00:00:00'"), ("late", "ts < timestamp '2024-01-12 00:00:00'"), (None, None)):
        if writer:
            put_batch(events.filter(part).withColumn("_ingestion_date", F.to_date("_ingested_at")), bronze, f"{writer}-000000000")
        modes.append(build_silver_from_batches(spark, bronze, EVENT_SILVER, name, base=f"{home}/silver"))
    return read_table(spark, name).drop("_metadata", "_key_bucket").withColumn("mode", F.lit(" ".join(modes)))


MESSY_ORDERS = TableContract(
    "messy_orders",
    primary_keys=("order_key",),
    deduplication_keys=("ordered_at",),
    columns=(
        ColumnContract("order_key", "bigint", source="key_text"),
        ColumnContract("price", "double", source="price_text"),
        ColumnContract("ordered_at", "timestamp", source="at_text"),
        ColumnContract("half", "int", transform="CASE WHEN price > 100000 THEN 'much' ELSE '1' END"),
    ),
)


@check(
    "q13b_rejects",
    """WITH o AS (SELECT o_orderkey AS k, o_orderkey % 11 = 0 AS no_key, o_orderkey % 7 = 0 AS no_price, o_orderkey % 5 = 0 AS no_time, o_totalprice AS p FROM orders)
       SELECT * FROM (
         SELECT 'price' AS "column", 'type' AS reason, 'n/a' AS value, count(*) AS n FROM o WHERE no_price
         UNION ALL SELECT 'ordered_at', 'type', 'soon', count(*) FROM o WHERE no_time
         UNION ALL SELECT 'half', 'type', 'much', count(*) FROM o WHERE NOT no_price AND p > 100000
         UNION ALL SELECT 'order_key', 'type', CASE WHEN k % 2 = 0 THEN 'x' ELSE '' END AS v, count(*) FROM o WHERE no_key GROUP BY v
         UNION ALL SELECT 'order_key', 'no key', NULL, count(*) FROM o WHERE no_key
         UNION ALL SELECT 'ordered_at', 'no key', NULL, count(*) FROM o WHERE no_time
         UNION ALL SELECT 'silver', 'rows', NULL, count(*) FROM o WHERE NOT (no_key OR no_time)
         UNION ALL SELECT 'observed', 'bad_values', NULL, (SELECT sum(no_price::INT + no_time::INT + (NOT no_price AND p > 100000)::INT + no_key::INT)::BIGINT FROM o)
         UNION ALL SELECT 'observed', 'rows', NULL, count(*) FROM o
         UNION ALL SELECT 'observed', 'rows_without_key', NULL, count(*) FROM o WHERE no_key OR no_time) WHERE n > 0""",
)
def rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Values that do not fit and rows without keys are told beside the table, and counted while they are written."""
    key = F.col("o_orderkey")
    bad = lambda n, instead, value: F.when(key % n == 0, F.lit(instead)).otherwise(value.cast("string"))
    bronze = table(spark, sf, "orders").select(
        F.when((key % 11 == 0) & (key % 2 == 0), "x").otherwise(bad(11, "", key)).alias("key_text"),
        bad(7, "n/a", F.col("o_totalprice")).alias("price_text"), bad(5, "soon", F.col("o_orderdate")).alias("at_text"),
        F.lit("2024-01-01").cast("timestamp").alias("_ingested_at"),
    )
    name, base = f"default.q13b_{uuid.uuid4().hex}", f"{work_folder(spark, 'q13b')}/silver"
    build_silver(spark, bronze, MESSY_ORDERS, name, on_error="null", base=base, keep_rejects=True)
    target = StoredTable(spark, name, base=base)
    told = read_rejects(target).groupBy("column", "reason", "value").agg(F.count(F.lit(1)).alias("n"))
    counts = [("silver", "rows", None, target.read().count()), *[("observed", k, None, n) for k, n in target.manifest().rejects.items()]]
    return told.unionByName(spark.createDataFrame(counts, told.schema)).filter("n > 0")


def _two_drops(spark: SparkSession, sf: str, label: str, delta_runs: bool) -> DataFrame:
    """Two drops, the later rows first; the second start finds the checkpoint of the first."""
    home = work_folder(spark, label)
    events = table(spark, sf, "events").withColumn("ts", stamp("ts"))
    bronze = events.withColumn("_ingested_at", F.col("ts"))
    target = stored(spark, label)
    for part in ("ts >= timestamp '2024-01-12 00:00:00'", "ts < timestamp '2024-01-12 00:00:00'"):
        bronze.filter(part).write.mode("append").parquet(f"{home}/bronze")
        stream = spark.readStream.schema(bronze.schema).parquet(f"{home}/bronze")
        start_silver(stream, EVENT_SILVER, target, f"{home}/checkpoint", delta_runs=delta_runs).awaitTermination()
    return target.read().drop("_metadata")


@check(
    "q35_compliance",
    """WITH t AS (SELECT 'lake.parts.part_' || p_partkey AS qualified_name, p_partkey, p_size, p_name,
                         p_brand, p_type FROM part)
       SELECT qualified_name, 'description' AS missing FROM t WHERE p_size % 10 = 0 OR p_size % 10 = 1
       UNION ALL SELECT qualified_name, 'tag owner__tech' FROM t WHERE p_brand = 'Brand#2'
       UNION ALL SELECT qualified_name, 'tag data__supplier' FROM t WHERE p_type = 'ECONOMY'
       UNION ALL SELECT qualified_name, 'tag pii__classification' FROM t""",
)
def compliance(spark: SparkSession, sf: str) -> DataFrame:
    """Every part is taken for a table; its description and tags have gaps."""
    inventory = table(spark, sf, "part").select(
        F.col("p_name").alias("table_name"),
        F.concat(F.lit("lake.parts.part_"), F.col("p_partkey").cast("string")).alias("qualified_name"),
        F.expr("CASE p_size % 10 WHEN 0 THEN NULL WHEN 1 THEN '   ' ELSE p_name END").alias("description"),
        F.expr(
            """map('owner__tech', CASE WHEN p_brand = 'Brand#2' THEN ' ' ELSE p_brand END,
                   'data__supplier', nullif(p_type, 'ECONOMY'), 'data__domain', p_type, 'pii__exists', 'false')"""
        ).alias("tags"),
    )
    return compliance_report(inventory)


@check(
    "q35b_documented_table",
    """SELECT c_nationkey, count(*) AS n_rows, 'One row per customer' AS about, 'it''s the key' AS about_key,
              'sales' AS owner, 'none' AS key_pii FROM customer GROUP BY c_nationkey""",
)
def documented_table(spark: SparkSession, sf: str) -> DataFrame:
    """What the contract says of table and columns is in the catalog, also after an overwrite with another schema."""
    contract = TableContract(
        "customers",
        description="One row per customer",
        tags={"owner__tech": "sales"},
        primary_keys=("c_custkey",),
        columns=(
            ColumnContract("c_custkey", "bigint", description="it's the key", tags={"pii__classification": "none"}),
            ColumnContract("c_nationkey", "int"),
        ),
    )
    target = StoredTable.of_contract(spark, contract, f"default.q35b_{uuid.uuid4().hex}", work_folder(spark, "q35b"))
    bronze = table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", F.lit("2024-01-01").cast("timestamp").alias("_ingested_at"),
        F.lit(None).cast("struct<file_name:string>").alias("_metadata"),
    )
    build_silver(spark, bronze, contract, target.name, base=target.base)
    target.overwrite(target.read().withColumn("c_nationkey", F.col("c_nationkey").cast("bigint")))
    catalog = spark.newSession().catalog
    comments = {c.name: c.description for c in catalog.listColumns(target.name)}
    tags = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {target.name}").collect()}
    return spark.table(target.name).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "c_nationkey", "n_rows", F.lit(catalog.getTable(target.name).description).alias("about"),
        F.lit(comments["c_custkey"]).alias("about_key"), F.lit(tags["tag.owner__tech"]).alias("owner"),
        F.lit(tags["tag.c_custkey.pii__classification"]).alias("key_pii"),
    )
