"""Exact duplicates by content-defined chunk recipes.

A text is cut where its *content* says so, each chunk gets a 64-bit identifier, and the text is then
stood for by its ordered list of identifiers: its recipe. Texts move through no exchange; what moves are
recipes of a few identifiers per kilobyte. A dictionary of distinct chunks verifies the identifiers: it
pairs each with the SHA-256 of its chunk, and where one identifier stands for several chunks they are told
apart by an ordinal. Two texts are equal when their lists are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, row_key, stored, text_of, without

# A chunk ends after 512 characters at the next word that ends in one of eight letters, 2,048 at most.
CHUNK = r"(?s).{512,2048}?(?<=[aeknorst]\x20)|.{1,2048}"


def recipes(docs: DataFrame, chunk: str = CHUNK) -> DataFrame:
    """doc_id, a row number, the SHA-256 of the normalised text, and its chunks (identifier, SHA-256)."""
    normal = F.regexp_replace(text_of(), SPACE + "+", " ")
    return (
        docs.select("doc_id", row_key().alias("key"), normal.alias("text"))
        .select(
            "doc_id",
            "key",
            F.monotonically_increasing_id().alias("row"),
            F.sha2("text", 256).alias("text_sha256"),
            F.transform(
                F.regexp_extract_all("text", F.lit(chunk), F.lit(0)),
                lambda c: F.struct(F.xxhash64(c).alias("id"), F.unhex(F.sha2(c, 256)).alias("sha")),
            ).alias("chunks"),
        )
    )


def verified(plain: DataFrame) -> DataFrame:
    """Recipes whose identifiers stand for one chunk each: (identifier, ordinal) in text order.

    The dictionary holds each distinct chunk once, combined in every task first. Only recipes that hold an
    identifier of several chunks are looked up again; that is none, or a handful among very many.
    """
    placed = plain.select("row", F.posexplode("chunks").alias("pos", "chunk")).select(
        "row", "pos", "chunk.id", "chunk.sha"
    )
    distinct = placed.groupBy("id", "sha").agg(F.count(F.lit(1)).alias("uses"))
    several = distinct.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id")
    ordinals = distinct.join(several, "id").select(
        "id", "sha", (F.row_number().over(Window.partitionBy("id").orderBy("sha")) - 1).alias("ordinal")
    )
    looked_up = (
        placed.join(ordinals.filter("ordinal > 0"), ["id", "sha"])
        .groupBy("row")
        .agg(F.map_from_entries(F.collect_list(F.struct("pos", "ordinal"))).alias("ordinals"))
    )
    ordinal = lambda i: F.coalesce(F.try_element_at("ordinals", i), F.lit(0))
    return plain.join(looked_up, "row", "left").select(
        "doc_id",
        "key",
        "row",
        "text_sha256",
        F.transform("chunks", lambda c, i: F.struct(c["id"].alias("id"), ordinal(i).alias("ordinal"))).alias("recipe"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, its row key, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after replacing each run of white space by one space; null counts as
    empty. Of equal texts the row with the smallest doc_id stays (null ids last; of repeated rows one
    stays). Other columns are ignored. An empty table gives an empty result. Groups are combined in every
    task before they meet, so a group with a third of all rows is one row per task; the join that carries
    the result back is an inner join of two plain exchanges, which adaptive execution splits where it is
    skewed.
    """
    # Written once: the text is read a single time, and row numbers stay as they are.
    ready = verified(stored(recipes(docs), "recipes"))
    groups = ready.groupBy("recipe").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first"),
        F.count(F.lit(1)).alias("group_size"),
    )
    return ready.join(groups, "recipe").select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
        "key",
    )


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of :func:`deduplicated`."""
    return deduplicated(docs).drop("key")


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, all columns; decisions are as in :func:`deduplicated`.

    Only keys of rows come back to the documents; texts move where Spark joins them to a long list of keys.
    """
    return without(docs, deduplicated(docs).select("key", "kept"))
