"""Small documents with awkward rows, and the queries over them."""

import os

import pytest

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not there")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PROSE = "the quick brown fox jumps over a lazy dog and runs along the river bank until the evening comes "
TEXTS = [
    PROSE, PROSE, PROSE.replace(" ", "\t "), None, "", " \n ", "x", "It's we'll 'S  ''s don't\n\n stop",
    "Grüße, 東京 😀 naïve Ω ß", "word " * 5000, "z" * 3000, "a\x1cb \x0b c\x85d", PROSE + "ends differently", "<|endoftext|> $$ ##",
]


def documents(spark, texts=None, clash=True):
    """Rows with repeated, null and tied values; with ``clash`` extra columns of names that operators use."""
    texts = TEXTS if texts is None else texts
    rows = [(i, t, "en", f"src{i % 3}" if i % 4 else None, len(t or "")) for i, t in enumerate(texts)]
    if texts is TEXTS:
        rows += [rows[0], rows[0], rows[3], (None, PROSE, None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    if clash:
        for name in ("row", "ids", "id", "shard", "kept", "size", "recipe", "start", "n", "score", "block"):
            df = df.selectExpr("*", f"'extra' AS {name}")
    return df


def empty(spark):
    return documents(spark).limit(0)


def save(df, path):
    df.write.parquet(f"{path}/documents.parquet")
    return str(path)
