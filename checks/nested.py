"""Flattening of nested columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.operators.flatten import flatten

from .registry import check, line_events, table

# One row per line and charge, as the nested input has them; ``pos`` counts from 0.
CHARGES = """
    SELECT concat_ws('-', l_orderkey, l_linenumber) AS ev, l_partkey AS part, 'base' AS kind,
           l_extendedprice AS amount, l_tax AS rate, cast(0 AS bigint) AS pos,
           cast(ceil(l_quantity / 20) AS bigint) AS n_steps, l_quantity AS qty
    FROM lineitem WHERE l_extendedprice <> 0
    UNION ALL
    SELECT concat_ws('-', l_orderkey, l_linenumber), l_partkey, 'discount',
           -(l_extendedprice * l_discount), l_discount, 1, cast(ceil(l_quantity / 20) AS bigint), l_quantity
    FROM lineitem WHERE l_extendedprice * l_discount <> 0
    UNION ALL
    SELECT concat_ws('-', l_orderkey, l_linenumber), l_partkey, 'tax', l_extendedprice * l_tax, l_tax,
           CASE WHEN l_discount <> 0 THEN 2 ELSE 1 END, cast(ceil(l_quantity / 20) AS bigint), l_quantity
    FROM lineitem WHERE l_extendedprice * l_tax <> 0
"""


@check(
    "q27_flatten_structs",
    """SELECT o_orderkey AS id, c_name AS buyer__name, n_name AS buyer__home__nation,
              n_regionkey AS buyer__home__region, c_mktsegment AS kept_segment,
              o_orderstatus || o_orderpriority AS codes
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def flatten_structs(spark: SparkSession, sf: str) -> DataFrame:
    joined = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    nested = joined.select(
        F.col("o_orderkey").alias("id"),
        F.struct(
            F.col("c_name").alias("name"),
            F.struct(F.col("n_name").alias("nation"), F.col("n_regionkey").alias("region")).alias("home"),
            F.struct(F.col("c_mktsegment").alias("segment")).alias("kept"),
        ).alias("buyer"),
        F.array("o_orderstatus", "o_orderpriority").alias("codes"),
    )
    flat = flatten(nested, keep=["buyer__kept"])
    return flat.select(
        "id", "buyer__name", "buyer__home__nation", "buyer__home__region",
        F.col("buyer__kept.segment").alias("kept_segment"), F.concat_ws("", "codes").alias("codes"),
    )


@check(
    "q28_explode",
    """SELECT l_orderkey AS id, 'discount' AS parts__kind, l_discount AS parts__rate
       FROM lineitem WHERE l_discount > 0.02
       UNION ALL SELECT l_orderkey, 'tax', l_tax FROM lineitem WHERE l_tax > 0.02""",
)
def explode_arrays(spark: SparkSession, sf: str) -> DataFrame:
    rate = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.col(c).alias("rate"))
    both = F.array(rate("discount", "l_discount"), rate("tax", "l_tax"))
    nested = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.filter(both, lambda r: r["rate"] > 0.02).alias("parts")
    )
    return flatten(nested, explode=["parts"])


@check(
    "q29_explode_with_index",
    f"""SELECT ev AS "eventId", pos AS "chargeList__index", kind AS "chargeList__kind",
               amount AS "chargeList__amount", 'T-' || kind AS "chargeList__tax__code",
               rate AS "chargeList__tax__rate"
        FROM ({CHARGES})""",
)
def explode_with_index(spark: SparkSession, sf: str) -> DataFrame:
    flat = flatten(line_events(table(spark, sf, "lineitem")), explode=["chargeList"], with_index=True)
    return flat.select(
        "eventId", F.col("chargeList__index").cast("bigint").alias("chargeList__index"),
        "chargeList__kind", "chargeList__amount", "chargeList__tax__code", "chargeList__tax__rate",
    )


@check(
    "q30_two_arrays",
    f"""SELECT ev AS "eventId", kind AS "chargeList__kind", s AS "quantityList__step",
               least(20.0, qty - s * 20) AS "quantityList__amount"
        FROM ({CHARGES}) c, (SELECT unnest(range(0, 3)) AS s) WHERE s < n_steps""",
)
def two_arrays(spark: SparkSession, sf: str) -> DataFrame:
    flat = flatten(line_events(table(spark, sf, "lineitem")), explode=["chargeList", "quantityList"])
    return flat.select(
        "eventId", "chargeList__kind",
        F.col("quantityList__step").cast("bigint").alias("quantityList__step"), "quantityList__amount",
    )


@check(
    "q31_nested_arrays",
    f"""SELECT ev AS "doc__events__id", part AS doc__events__part, kind AS doc__events__charges__kind,
               amount AS doc__events__charges__amount
        FROM ({CHARGES})""",
)
def nested_arrays(spark: SparkSession, sf: str) -> DataFrame:
    event = F.struct(
        F.col("eventId").alias("id"), F.col("header.item.partKey").alias("part"),
        F.col("chargeList").alias("charges"),
    )
    nested = line_events(table(spark, sf, "lineitem")).select(
        F.struct(F.array(event).alias("events")).alias("doc")
    )
    flat = flatten(nested, explode=["doc__events", "doc__events__charges"])
    return flat.drop("doc__events__charges__tax__code", "doc__events__charges__tax__rate")
