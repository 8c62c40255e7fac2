"""Compaction of closed bronze days: which days are worth it, and rewriting one folder for many.

Batches own a leaf folder per day, so folders grow with batches. A day is closed when no batch will write to
it any more, apart from late rows, which simply make it worth compacting again.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.bronze import PARTITIONS
from tidemark.operators.sinks import BATCH_KEY
from tidemark.sources import files

TARGET_BYTES = 256 << 20
COMPACTED = "compacted"


def file_sizes(table: DataFrame) -> DataFrame:
    """(year, month, day, batch_key, file, bytes) of the files behind rows of a table, from Spark's metadata column."""
    return table.select(
        *PARTITIONS, BATCH_KEY, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).distinct()


def compaction_plan(sizes: DataFrame, before: date, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Days before a date with more files than their bytes need: (year, month, day, n_files, bytes, n_target).

    Rows of NULL days have no clock and belong to no closed day.
    """
    on = F.make_date(*PARTITIONS)
    days = sizes.where(on < F.lit(before)).groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("bytes"))
    needed = F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_bytes)).cast("int")
    return days.withColumn("n_target", needed).where("n_files > n_target")


def day_folder(path: str, day: Mapping) -> str:
    return f"{path}/" + "/".join(f"{c}={day[c]}" for c in PARTITIONS)


def leaf_files(spark: SparkSession, folder: str) -> set[str]:
    """Files of a day, with the folder of their batch."""
    leaves = [e for e in files.entries(spark, folder) if e.is_dir]
    return {f"{leaf.name}/{e.name}" for leaf in leaves for e in files.entries(spark, leaf.path) if not e.name.startswith(("_", "."))}


def compact_day(spark: SparkSession, path: str, schema, day: Mapping, n_files: int) -> bool:
    """Rewrite one day as one batch folder; False if the day changed meanwhile and was left as it is.

    The rows are written beside the table. The day's folder is then put aside and the new one in its place:
    two renames, of which recover() undoes the first should the second not come.
    """
    folder, aside = day_folder(path, day), f"{path}_aside/{day_folder('', day).strip('/').replace('/', ',')}"
    found = leaf_files(spark, folder)
    staged = f"{path}_staged/{uuid.uuid4().hex}"
    rows = spark.read.schema(schema).option("basePath", path).parquet(folder).drop(*PARTITIONS, BATCH_KEY)
    rows.repartition(n_files).write.parquet(f"{staged}/{BATCH_KEY}={COMPACTED}-{uuid.uuid4().hex[:12]}")
    files.delete(spark, f"{staged}/_SUCCESS")
    if leaf_files(spark, folder) != found:
        files.delete(spark, staged)
        return False
    files.ensure_folder(spark, f"{path}_aside")
    files.rename(spark, folder, aside)
    files.rename(spark, staged, folder)
    files.delete(spark, aside)
    return True


def recover(spark: SparkSession, path: str) -> int:
    """Put back days that were put aside by a compaction that ended between its two renames; returns their number."""
    restored = 0
    for entry in files.entries(spark, f"{path}_aside"):
        folder = f"{path}/{entry.name.replace(',', '/')}"
        if files.exists(spark, folder):
            files.delete(spark, entry.path)  # the new folder is there, only the clean-up is missing
        else:
            files.rename(spark, entry.path, folder)
            restored += 1
    files.delete(spark, f"{path}_staged")
    return restored


def compact(spark: SparkSession, path: str, schema, before: date, target_bytes: int = TARGET_BYTES) -> int:
    """Compact all closed days that are worth it, each by jobs of its own; returns the number of days rewritten."""
    recover(spark, path)
    table = spark.read.schema(schema).option("basePath", path).parquet(path)
    days = compaction_plan(file_sizes(table), before, target_bytes).orderBy(*PARTITIONS).collect()  # one row a day
    done = sum(compact_day(spark, path, schema, d.asDict(), d.n_target) for d in days)
    files.delete(spark, f"{path}_staged")
    return done
