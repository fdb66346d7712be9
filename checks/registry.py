"""Registry of queries and of the SQL they are compared with, and helpers to build inputs."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.session import work_folder
from siltworks.sinks.store import StoredTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stamp(column: str):
    """Timestamps of the given tables carry no zone; the engine works with UTC instants."""
    return F.col(column).cast("timestamp")


def stored(spark: SparkSession, label: str, **kwargs) -> StoredTable:
    """A table of a name and folder of its own, so a query may run many times."""
    name = f"default.{label}_{uuid.uuid4().hex}"
    return StoredTable(spark, name, base=work_folder(spark, label), **kwargs)


def line_events(lineitem: DataFrame) -> DataFrame:
    """Nested bronze rows, one per line: arrays are made from the row itself, so they stay small."""
    charge = "struct<kind:string,amount:double,tax:struct<code:string,rate:double>>"

    def one(kind, amount, rate):
        """No element, or one: plain conditional arrays stay in generated code, lambdas do not."""
        tax = F.struct(F.lit(f"T-{kind}").alias("code"), rate.alias("rate"))
        element = F.struct(F.lit(kind).alias("kind"), amount.alias("amount"), tax.alias("tax"))
        return F.when(amount != 0, F.array(element)).otherwise(F.array().cast(f"array<{charge}>"))

    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    charges = F.concat(
        one("base", price, tax), one("discount", -(price * discount), discount), one("tax", price * tax, tax)
    )
    steps = F.sequence(F.lit(0), F.ceil(F.col("l_quantity") / 20).cast("int") - 1)
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("eventId"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("eventTime"),
        F.struct(
            F.col("l_orderkey").alias("orderKey"),
            F.struct(
                F.col("l_partkey").alias("partKey"), F.col("l_suppkey").alias("suppKey")
            ).alias("item"),
        ).alias("header"),
        charges.alias("chargeList"),
        F.transform(
            steps,
            lambda i: F.struct(
                i.alias("step"), F.least(F.lit(20.0), F.col("l_quantity") - i * 20).alias("amount")
            ),
        ).alias("quantityList"),
        F.array("l_returnflag", "l_linestatus").alias("flags"),
        stamp("l_shipdate").alias("_ingested_at"),
    )
