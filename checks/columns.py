"""Scans, names, mapping, hashing, audit columns and filters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks import ColumnContract, TableContract
from siltworks.functions.columns import pii_hash, raw_payload, with_lineage
from siltworks.functions.names import rename, with_safe_names
from siltworks.operators.incremental import choose_reading, in_range
from siltworks.operators.keys import latest_per_key, require_keys
from siltworks.operators.mapping import apply_contract
from siltworks.operators.merge import matching_rows
from siltworks.sources.tables import read_table

from .registry import check, stamp, table


@check("q01_table_scan", "SELECT * FROM orders")
def table_scan(spark: SparkSession, sf: str) -> DataFrame:
    name = f"q01_{uuid.uuid4().hex}"
    table(spark, sf, "orders").createOrReplaceTempView(name)
    return read_table(spark, name)


@check(
    "q10_safe_names",
    """SELECT c_custkey AS "Cust_No", c_name AS "cust_no_1", c_nationkey AS "CUST_NO_2",
              c_acctbal AS "2nd_amount", c_mktsegment AS "col" FROM customer""",
)
def safe_column_names(spark: SparkSession, sf: str) -> DataFrame:
    return with_safe_names(table(spark, sf, "customer").toDF("Cust No", "cust_no", "CUST/NO", "2nd amount", "%"))


@check(
    "q11_rename",
    """SELECT p_partkey AS part_key, p_name AS part_name, p_brand, p_type,
              p_size AS size_class, p_retailprice FROM part""",
)
def rename_columns(spark: SparkSession, sf: str) -> DataFrame:
    names = {"p_partkey": "part_key", "p_name": "part_name", "p_size": "size_class", "p_type": "p_type"}
    return rename(table(spark, sf, "part"), names)


MAPPED = TableContract(
    "orders_mapped",
    columns=(
        ColumnContract("order_id", "string", source="o_orderkey"),
        ColumnContract("customer_id", "long", source="o_custkey"),
        ColumnContract("amount", "decimal(18,8)", source="o_totalprice"),
        ColumnContract("amount_whole", "integer", source="amount"),
        ColumnContract("order_day", "date", source="o_orderdate"),
        ColumnContract("ordered_at", "timestamp", source="ordered_text"),
        ColumnContract("is_open", "boolean", source="open_text"),
        ColumnContract("codes", "array<string>", source="code_list"),
        ColumnContract("O_ORDERSTATUS", "string", source="o_orderstatus"),
        ColumnContract("o_orderpriority", "string", source="no_such_column"),
    ),
)


@check(
    "q12_map_and_cast",
    """SELECT cast(o_orderkey AS varchar) AS order_id, o_custkey AS customer_id,
              cast(cast(o_totalprice AS decimal(18,8)) AS varchar) AS amount,
              cast(trunc(cast(o_totalprice AS decimal(18,8))) AS integer) AS amount_whole,
              cast(cast(o_orderdate AS date) AS varchar) AS order_day,
              o_orderdate AS ordered_at, o_orderstatus = 'O' AS is_open,
              concat_ws('|', cast(o_custkey AS varchar), cast(o_orderkey AS varchar)) AS codes,
              o_orderstatus AS "O_ORDERSTATUS", o_orderpriority
       FROM orders""",
)
def map_and_cast(spark: SparkSession, sf: str) -> DataFrame:
    source = table(spark, sf, "orders").select(
        "*",
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ordered_text"),
        F.when(F.col("o_orderstatus") == "O", "true").otherwise("false").alias("open_text"),
        F.array("o_custkey", "o_orderkey").alias("code_list"),
    )
    # Dates and decimals are shown as text: clients of the two engines give them other types.
    return apply_contract(source, MAPPED).select(
        "order_id", "customer_id", F.col("amount").cast("string").alias("amount"), "amount_whole",
        F.col("order_day").cast("string").alias("order_day"), "ordered_at", "is_open",
        F.concat_ws("|", "codes").alias("codes"), "O_ORDERSTATUS", "o_orderpriority",
    )


DERIVED = TableContract(
    "lines_derived",
    columns=(
        ColumnContract("ship_day", "date", transform="to_date(ship_number, 'yyyyMMdd')"),
        ColumnContract("flag", "string", transform="upper(concat(l_returnflag, '/', l_linestatus))"),
        ColumnContract("net", "double", transform="l_extendedprice * (1 - l_discount)"),
        ColumnContract("gross", "double", transform="net * (1 + l_tax)"),
        ColumnContract("l_quantity", "double", transform="l_quantity + 1"),
        ColumnContract("quantity_again", "double", source="l_quantity"),
        ColumnContract("l_orderkey", "bigint"),
    ),
)


@check(
    "q13_transforms",
    """SELECT strftime(l_shipdate, '%Y-%m-%d') AS ship_day,
              upper(l_returnflag || '/' || l_linestatus) AS flag,
              l_extendedprice * (1 - l_discount) AS net,
              l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross,
              l_quantity + 1 AS l_quantity, l_quantity + 1 AS quantity_again, l_orderkey
       FROM lineitem""",
)
def transforms(spark: SparkSession, sf: str) -> DataFrame:
    source = table(spark, sf, "lineitem").withColumn(
        "ship_number", F.date_format("l_shipdate", "yyyyMMdd").cast("int")
    )
    return apply_contract(source, DERIVED).withColumn("ship_day", F.col("ship_day").cast("string"))


HASHED = TableContract(
    "customers_hashed",
    columns=(
        ColumnContract("customer", "bigint", source="c_custkey", hashed=True),
        ColumnContract("name", "string", source="c_name", hashed=True),
        ColumnContract("segment", "string", transform="nullif(c_mktsegment, 'BUILDING')", hashed=True),
    ),
)


@check(
    "q14_pii_hash",
    """SELECT c_custkey AS customer, sha256(cast(c_custkey AS varchar)) AS customer_hashed_key,
              c_name AS name, sha256(c_name) AS name_hashed_key,
              nullif(c_mktsegment, 'BUILDING') AS segment,
              sha256(nullif(c_mktsegment, 'BUILDING')) AS segment_hashed_key
       FROM customer""",
)
def hash_columns(spark: SparkSession, sf: str) -> DataFrame:
    return apply_contract(table(spark, sf, "customer"), HASHED)


@check(
    "q14b_hash_matches",
    """WITH h AS (SELECT event_id, CASE WHEN event_type <> 'error'
                                   THEN sha256(cast(user_id AS varchar)) END AS user_hash FROM events)
       SELECT user_hash, count(*) AS n_rows, min(event_id) AS first_id, max(event_id) AS last_id,
              cast(count(*) * (count(*) - 1) // 2 AS bigint) AS n_pairs
       FROM h WHERE user_hash IS NOT NULL GROUP BY user_hash HAVING count(*) > 1""",
)
def hash_matches(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", pii_hash(F.col("user_id"))).alias("user_hash"),
    )
    return matching_rows(events, "user_hash", "event_id")


@check(
    "q15_raw_payload",
    """SELECT c_custkey,
              '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey
              || CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE ',"segment":"' || c_mktsegment || '"' END
              || '}' AS _raw_data
       FROM customer""",
)
def raw_json(spark: SparkSession, sf: str) -> DataFrame:
    source = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey",
        F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"),
        F.lit("left out").alias("_metadata_note"),
    )
    return source.select("c_custkey", raw_payload(source).alias("_raw_data"))


@check(
    "q16_lineage",
    """SELECT event_id, 'f-' || user_id AS file_name, ts AS with_struct, ts AS without_struct,
              true AS processed FROM events""",
)
def lineage(spark: SparkSession, sf: str) -> DataFrame:
    bronze = table(spark, sf, "events").select("event_id", "user_id", stamp("ts").alias("_ingested_at"))
    file_name = F.concat(F.lit("f-"), F.col("user_id").cast("string")).alias("file_name")
    extended = with_lineage(bronze.withColumn("_metadata", F.struct(file_name)))
    both = with_lineage(extended.withColumnRenamed("_metadata", "first"))
    return both.select(
        "event_id",
        F.col("first.file_name"),
        F.col("first.bronze_ingested_at").alias("with_struct"),
        F.col("_metadata.bronze_ingested_at").alias("without_struct"),
        (F.col("first.silver_processed_at") == F.col("_metadata.silver_processed_at")).alias("processed"),
    )


@check(
    "q17_key_filter",
    """WITH e AS (SELECT event_id, ts,
                 CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN '  ' ELSE event_type END AS kind,
                 CASE WHEN value > 20 THEN NULL ELSE user_id END AS uid,
                 CASE WHEN value < 5 THEN '' ELSE props END AS payload FROM events)
       SELECT * FROM e
       WHERE ((kind IS NOT NULL AND trim(kind) <> '') OR uid IS NOT NULL)
         AND (payload IS NOT NULL AND trim(payload) <> '')""",
)
def key_filter(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(
        "event_id",
        stamp("ts").alias("ts"),
        F.expr("CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN '  ' ELSE event_type END").alias("kind"),
        F.expr("CASE WHEN value > 20 THEN NULL ELSE user_id END").alias("uid"),
        F.expr("CASE WHEN value < 5 THEN '' ELSE props END").alias("payload"),
    )
    return require_keys(e, [["kind", "uid"], [], ["payload"]])


@check(
    "q18_date_range",
    """SELECT event_id, ts AS _ingested_at, user_id FROM events
       WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'""",
)
def date_range(spark: SparkSession, sf: str) -> DataFrame:
    bronze = table(spark, sf, "events").select("event_id", stamp("ts").alias("_ingested_at"), "user_id")
    return in_range(bronze, "2024-01-05", "2024-01-20")


@check(
    "q19_incremental_read",
    """SELECT 'incremental' AS mode, event_id, ts AS _ingested_at FROM events
       WHERE ts > (SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00')""",
)
def incremental_read(spark: SparkSession, sf: str) -> DataFrame:
    bronze = table(spark, sf, "events").select("event_id", stamp("ts").alias("_ingested_at"))
    loaded = bronze.filter("_ingested_at <= timestamp '2024-01-15 12:00:00'")
    silver = loaded.select(F.struct(F.col("_ingested_at").alias("bronze_ingested_at")).alias("_metadata"))
    reading = choose_reading(bronze, silver)
    return reading.rows.select(F.lit(reading.mode).alias("mode"), "event_id", "_ingested_at")


@check(
    "q25_latest_per_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
       FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
           l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST,
           l_extendedprice DESC NULLS LAST) = 1""",
)
def latest(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        stamp("l_shipdate").alias("l_shipdate"),
    )
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@check(
    "q25b_latest_null_keys",
    """WITH e AS (SELECT CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS uid,
                         CASE WHEN event_type = 'view' THEN NULL ELSE ts END AS seen_at, event_id FROM events)
       SELECT coalesce(uid, -1) AS uid, seen_at, event_id FROM e
       QUALIFY row_number() OVER (PARTITION BY uid ORDER BY seen_at DESC NULLS LAST, event_id DESC NULLS LAST) = 1""",
)
def latest_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(
        F.expr("CASE WHEN event_type = 'error' THEN NULL ELSE user_id END").alias("uid"),
        F.when(F.col("event_type") != "view", stamp("ts")).alias("seen_at"),
        "event_id",
    )
    return latest_per_key(e, ["uid"], ["seen_at"]).withColumn("uid", F.coalesce("uid", F.lit(-1)))


@check(
    "q25c_latest_of_the_frame",
    """SELECT o_orderkey, o_custkey, o_orderdate FROM orders
       ORDER BY o_orderdate DESC, o_orderkey DESC, o_custkey DESC LIMIT 1""",
)
def latest_of_the_frame(spark: SparkSession, sf: str) -> DataFrame:
    """No key: one row of the whole table, found as a top-1 per task."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", stamp("o_orderdate").alias("o_orderdate")
    )
    return latest_per_key(orders, [], ["o_orderdate"], whole_frame=True)


@check(
    "q25d_latest_without_order",
    """SELECT user_id, event_type, value, event_id FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_type DESC, value DESC, event_id DESC) = 1""",
)
def latest_without_order(spark: SparkSession, sf: str) -> DataFrame:
    """No deduplication key: the other columns decide."""
    events = table(spark, sf, "events").select("user_id", "event_type", "value", "event_id")
    return latest_per_key(events, ["user_id"], [])


@check(
    "q26_empty_input_policy",
    """SELECT 'nothing newer' AS situation, 'incremental' AS mode, true AS stops, count(*) AS bronze_rows FROM events
       UNION ALL SELECT 'empty range', 'date_range', true, count(*) FROM events
       UNION ALL SELECT 'empty bronze', 'full_load', false, 0
       UNION ALL SELECT 'no silver', 'full_load', false, count(*) FROM events
       UNION ALL SELECT 'empty silver', 'full_load', false, count(*) FROM events
       UNION ALL SELECT 'newer rows', 'incremental', false, count(*) FROM events""",
)
def empty_input_policy(spark: SparkSession, sf: str) -> DataFrame:
    bronze = table(spark, sf, "events").select("event_id", stamp("ts").alias("_ingested_at"))
    silver = bronze.select(F.struct(F.col("_ingested_at").alias("bronze_ingested_at")).alias("_metadata"))
    half = silver.filter("_metadata.bronze_ingested_at < timestamp '2024-01-15 00:00:00'")
    nothing = bronze.filter("_ingested_at is null")
    situations = {
        "nothing newer": (bronze, choose_reading(bronze, silver)),
        "empty range": (bronze, choose_reading(bronze, silver, "1999-01-01", "1999-12-31")),
        "empty bronze": (nothing, choose_reading(nothing, None)),
        "no silver": (bronze, choose_reading(bronze, None)),
        "empty silver": (bronze, choose_reading(bronze, silver.filter("_metadata is null"))),
        "newer rows": (bronze, choose_reading(bronze, half)),
    }
    result = None
    for name, (rows, reading) in situations.items():
        line = rows.agg(F.count(F.lit(1)).alias("bronze_rows")).select(
            F.lit(name).alias("situation"), F.lit(reading.mode).alias("mode"),
            F.lit(reading.nothing_to_do).alias("stops"), "bronze_rows",
        )
        result = line if result is None else result.unionByName(line)
    return result
