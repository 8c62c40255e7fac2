"""Directory-level calls on whatever file system a path names."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import SparkSession


class Entry(NamedTuple):
    name: str
    path: str
    modified_ms: int
    is_dir: bool


def _locate(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = _locate(spark, path)
    return fs.exists(location)


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """Direct children of a folder; empty when the folder does not exist."""
    fs, location = _locate(spark, path)
    if not fs.exists(location):
        return []
    base = path.rstrip("/")
    found = [(s, s.getPath().getName()) for s in fs.listStatus(location)]
    return [Entry(n, f"{base}/{n}", s.getModificationTime(), s.isDirectory()) for s, n in found]


def ensure_folder(spark: SparkSession, path: str) -> None:
    fs, location = _locate(spark, path)
    fs.mkdirs(location)


def delete(spark: SparkSession, path: str) -> bool:
    fs, location = _locate(spark, path)
    return fs.delete(location, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; an error if the file system refuses."""
    fs, location = _locate(spark, source)
    if not fs.rename(location, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot rename {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str:
    """One small text file (a contract or a rename map), whole."""
    row = spark.read.text(path, wholetext=True).first()
    return "" if row is None else row[0]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small text file, in place of an earlier one; no Spark job."""
    fs, location = _locate(spark, path)
    out = fs.create(location, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
