"""From documents to token ids: five stages, each applied to all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm import byte_bpe, entropy_mix, exact_dedup, jaccard_join, toxicity
from siltworks.llm.queries import table, tokenizer_file
from siltworks.session import work_folder


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, does not hold for toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, "__toxicity").filter(F.col("__toxicity") < 0.5).select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shingles of five words with a similarity of 0.8 or more link."""
    return jaccard_join.without_similar(docs, width=5, percent=80)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return entropy_mix.mixture(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), and digests of the ids and of what they decode to."""
    path = tokenizer_file("byte_bpe_50k.tiktoken")
    return byte_bpe.encode(docs, path, decoded=True).select(
        "doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("jaccard_join", without_near_copies),
    ("entropy_mix", mixed_sources),
    ("byte_bpe", tokens),
]

# SQL has no expression for a trained classifier, Newton iterations or merges; tests compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; what a stage returns is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir)
    for name, stage in STAGES:
        path = work_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
