
from __future__ import annotations

import statistics
import sys
import time

from pyspark import StorageLevel
from pyspark.sql import functions as F

from checks.flows import CHARGES, HEADERS, ORDER_COLUMNS, QUANTITIES
from checks.registry import line_events, stamp, stored, table
from siltworks.operators.flatten import flatten
from siltworks.operators.keys import latest_per_key
from siltworks.operators.merge import merge_key, upsert, upsert_small
from siltworks.plans.silver import build_fan_out, cleaned_rows, latest_rows, merged_silver, silver_frame
from siltworks.session import build_session, work_folder
from siltworks.sinks.export import export_frame
from siltworks.sources.landing import Landing
from siltworks.streaming.ingest import BronzeTarget, ingest

RUNS = 3


def timed(label: str, action) -> None:
    action()
    seconds = []
    for _ in range(RUNS):
        began = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - began)
    print(f"{label:48s} {statistics.median(seconds):7.2f} s", flush=True)


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main(sf: str) -> None:
    spark = build_session(
        "variants",
        **{"spark.master": "local[8]", "spark.driver.memory": "16g", "spark.sql.shuffle.partitions": "8",
           "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("OFF")
    # Several files per table, as on a cluster: one file is one task.
    home = work_folder(spark, "variants")
    for name in ("lineitem", "orders"):
        table(spark, sf, name).repartition(16).write.parquet(f"{home}/{name}.parquet")
    lines = table(spark, home, "lineitem").withColumn("l_shipdate", stamp("l_shipdate"))
    orders = table(spark, home, "orders").select(*ORDER_COLUMNS).withColumn("o_orderdate", stamp("o_orderdate"))

    keys = ["l_orderkey", "l_linenumber"]
    timed("latest per key, window with tie-break", lambda: noop(latest_per_key(lines, keys, ["l_shipdate"])))
    timed("latest per key, window without tie-break",
          lambda: noop(latest_per_key(lines, keys, ["l_shipdate"], break_ties=False)))
    timed("latest per key, max_by aggregate", lambda: noop(
        lines.groupBy(*keys).agg(F.max_by(F.struct("*"), F.struct("l_shipdate")).alias("r")).select("r.*")))
    hot = lines.withColumn("l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_orderkey")))
    timed("latest per key, one key holds a third", lambda: noop(latest_per_key(hot, ["l_orderkey"], ["l_shipdate"])))

    for share, modulus in (("1 %", 100), ("50 %", 2)):
        new = orders.filter(F.col("o_orderkey") % modulus == 0).withColumn("o_totalprice", F.col("o_totalprice") + 1)
        timed(f"upsert of {share} into orders, full outer", lambda: noop(upsert(orders, new, ["o_orderkey"], ["o_orderdate"])))  # noqa: B023
        timed(f"upsert of {share} into orders, broadcast", lambda: noop(upsert_small(orders, new, ["o_orderkey"], ["o_orderdate"])))  # noqa: B023

    line_events(lines).write.parquet(f"{home}/events.parquet")
    nested = spark.read.parquet(f"{home}/events.parquet")
    flat = flatten(nested, explode=["chargeList"], with_index=True)
    timed("flatten with index, all leaves", lambda: noop(flat))
    timed("flatten with index, leaves of one contract",
          lambda: noop(flat.select("eventId", "chargeList__index", "chargeList__amount")))

    contracts = [CHARGES, QUANTITIES, HEADERS]

    def separate():
        for c in contracts:
            noop(silver_frame(nested, c))

    def shared():
        cached = nested.persist(StorageLevel.MEMORY_AND_DISK)
        for c in contracts:
            noop(silver_frame(cached, c))
        cached.unpersist(blocking=True)

    timed("fan-out to three frames, one scan each", separate)
    timed("fan-out to three frames, persisted source", shared)
    timed("fan-out to three stored tables, side by side",
          lambda: build_fan_out(nested, {c.name: (c, stored(spark, c.name)) for c in contracts}))

    half = lines.filter("l_shipdate < timestamp '1998-01-01 00:00:00'")
    old = silver_frame(line_events(half.withColumn("_x", F.lit(1)).drop("_x")), CHARGES)
    old.write.parquet(f"{home}/old.parquet")
    old = spark.read.parquet(f"{home}/old.parquet")
    timed("silver rows upserted, exchange shared", lambda: noop(merged_silver(old, nested, CHARGES)))

    def apart():
        new = latest_rows(cleaned_rows(nested, CHARGES), CHARGES).alias("new")
        noop(old.alias("old").join(new, merge_key(CHARGES.primary_keys), "full_outer"))

    timed("silver rows joined null-safe, exchanges apart", apart)

    for file_format in ("json", "csv"):
        landing_home = work_folder(spark, f"landing-{file_format}")
        source = lines.withColumn("l_shipdate", F.col("l_shipdate").cast("string")).repartition(100)
        source.write.option("header", True).format(file_format).save(f"{landing_home}/land/20240101/00")

        def drain():
            run = work_folder(spark, "drain")
            landing = Landing(f"{landing_home}/land", file_format, f"{run}/schema")  # noqa: B023
            ingest(spark, landing, BronzeTarget(f"{run}/bronze", f"{run}/ckpt"))

        timed(f"streaming ingest of 100 {file_format} files", drain)

    timed("export of lineitem to csv, single file", lambda: export_frame(lines, work_folder(spark, "ex"), "l"))
    timed("export of lineitem to csv, parallel parts",
          lambda: export_frame(lines, work_folder(spark, "ex"), "l", single_file=False))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
