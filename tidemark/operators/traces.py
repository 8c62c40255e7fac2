"""Error records that span several lines: a head line, stack frames, and a chain of causes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.opslog import ERROR_CLASS, LINE_LEVEL, LINE_TIME

# How a record starts, and the lines below it that name a class.
HEAD = r"^\d{2,4}[-/]\d{2}[-/]\d{2}[ T]\d{2}:\d{2}:\d{2}"
NAMED = r"^(?:Caused by: |Exception in thread \S+ )?([A-Za-z_][A-Za-z0-9_.$]*(?:Error|Exception|Failure|Exit|Interrupt))(?::|$)"
CAUSE = "Caused by: "
FRAME = r"^\s+(?:at |File \")"


def read_ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, line, text): log lines with their place. line rises along a split of a file, split along the file."""
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").alias("text"))
    return rows.withColumn("line", F.monotonically_increasing_id())


def with_heads(lines: DataFrame) -> DataFrame:
    """lines with `head`, the (split, line) of the record each belongs to; NULL before the first record of a file.

    Inside a split that is the newest head so far. Lines at the beginning of a split belong to the last head of
    an earlier one, found among rows that stand for whole splits. No task gets more than a split's lines.
    """
    mark = F.when(F.col("text").rlike(HEAD), F.struct("split", "line"))
    upto = Window.partitionBy("file", "split").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    inside = lines.withColumn("_inside", F.max(mark).over(upto))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    borders = lines.groupBy("file", "split").agg(F.max(mark).alias("_last")).select(
        F.col("file").alias("_file"), F.col("split").alias("_split"), F.max("_last").over(before).alias("_carried"))
    joined = inside.join(borders, F.col("file").eqNullSafe(F.col("_file")) & (F.col("split") == F.col("_split")))
    return joined.select(*lines.columns, F.coalesce("_inside", "_carried").alias("head"))


def _if_any(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def error_traces(lines: DataFrame) -> DataFrame:
    """One row for each record that names an error: time, level, number of lines and frames, and its causes.

    error_class is the class the head line names, else the first one below it; causes are the classes of the
    lines that say so, from the outermost to the root. A record's lines meet as counts; only lines that name
    a class are gathered. Lines before the first record of a file are a record without time and level.
    """
    text, at = F.col("text"), F.struct("split", "line")
    is_head = at == F.col("head")
    in_head = _if_any(F.regexp_extract(text, ERROR_CLASS, 1))
    below = _if_any(F.regexp_extract(text, NAMED, 1))
    named = F.when(F.coalesce(is_head, F.lit(False)), in_head).otherwise(below)
    records = with_heads(lines).select("file", "head", "text", at.alias("at"), is_head.alias("is_head"), named.alias("named"))
    gathered = records.groupBy("file", "head").agg(
        F.max(F.when(F.col("is_head"), text)).alias("first_line"),
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(text.rlike(FRAME)).alias("n_frames"),
        F.sort_array(F.collect_list(F.when(F.col("named").isNotNull(), F.struct("at", text.startswith(CAUSE).alias("is_cause"), "named")))).alias("classes"),
    ).where(F.size("classes") > 0)
    causes = F.transform(F.filter("classes", lambda c: c["is_cause"]), lambda c: c["named"])
    stamp = F.to_timestamp(_if_any(F.regexp_extract("first_line", LINE_TIME, 1)), "yyyy-MM-dd HH:mm:ss,SSS")
    return gathered.select(
        "file",
        stamp.alias("logged_at"),
        _if_any(F.regexp_extract("first_line", LINE_LEVEL, 1)).alias("level"),
        F.col("classes")[0]["named"].alias("error_class"),
        F.array_join(causes, " < ").alias("causes"),
        F.coalesce(F.try_element_at(causes, F.lit(-1)), F.col("classes")[0]["named"]).alias("root_class"),
        "n_lines",
        "n_frames",
    )
