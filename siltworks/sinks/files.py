"""A few file-system calls through the session's Hadoop configuration (local, HDFS, object store)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import SparkSession


class FileInfo(NamedTuple):
    path: str
    name: str
    size: int
    is_dir: bool


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def listing(spark: SparkSession, path: str) -> list[FileInfo]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(
        FileInfo(s.getPath().toString(), s.getPath().getName(), s.getLen(), s.isDirectory())
        for s in fs.listStatus(p)
    )


def total_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, s = _fs(spark, source)
    if not fs.rename(s, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not rename {source} to {target}")


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Rename over what is there: readers find the old file or the new one."""
    fs, s = _fs(spark, source)
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(s), fs.makeQualified(hadoop.Path(target)), options)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path as a mounted file system has it (``file:``); None elsewhere."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def set_time(spark: SparkSession, path: str, seconds: float) -> None:
    fs, p = _fs(spark, path)
    fs.setTimes(p, int(seconds * 1000), -1)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, unpacked where its name says that it is packed; None for an empty file."""
    fs, p = _fs(spark, path)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(p)
    stream = fs.open(p)
    try:
        source = codec.createInputStream(stream) if codec is not None else stream
        return spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(source, "UTF-8")).readLine()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Written beside and renamed over the old file, so a reader finds one text or the other."""
    fs, p = _fs(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    replace(spark, f"{path}.draft", path)
