"""Runs of a job as its log shows them: from the first line after a stop or a long silence to the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.opslog import LINE_TIME, classify_exits
from tidemark.operators.ordered import BUCKET_WIDTHS, running_total, with_previous

# How an exit code shows in a log, and how long a running job may say nothing.
EXIT_LINE = r"exit code:? (\d+)"
SILENCE_MS = 1_800_000


def parse_exits(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Lines that report an exit: logged_at and code, with the columns to keep."""
    code = F.nullif(F.regexp_extract("text", EXIT_LINE, 1), F.lit("")).cast("int")
    at = F.to_timestamp(F.nullif(F.regexp_extract("text", LINE_TIME, 1), F.lit("")), "yyyy-MM-dd HH:mm:ss,SSS")
    return lines.where(F.col("text").contains("exit code")).select(*keep, at.alias("logged_at"), code.alias("code")).where("code IS NOT NULL")


def run_summary(
    batches: DataFrame,
    exits: DataFrame,
    series: str,
    silence_ms: int = SILENCE_MS,
    widths: Sequence[int] = BUCKET_WIDTHS,
) -> DataFrame:
    """Each run with its first and last time and batch, length in seconds, and how it ended.

    batches: (series, logged_at, batch_id); exits: (series, logged_at, code). A run ends with an exit, or when
    nothing is logged for longer than silence_ms; its code is then NULL. At equal times batches come before an
    exit. Both rules become running totals, exits before a row and silences up to it, whose sum numbers
    the runs without bringing a series into one task. Rows without a time are left out.
    """
    none = F.lit(None)
    rows = batches.select(series, "logged_at", F.col("batch_id").cast("long").alias("batch_id"), none.cast("int").alias("code")).unionByName(
        exits.select(series, "logged_at", none.cast("long").alias("batch_id"), F.col("code").cast("int").alias("code")))
    timed = rows.where("logged_at IS NOT NULL").withColumn("_ms", F.unix_millis("logged_at")).withColumn("_rank", F.col("code").isNotNull())
    order = ["_rank", "batch_id", "code"]
    gaps = with_previous(timed, series, "_ms", order, widths)
    silent = (F.col("_ms") - F.col("_previous")) > silence_ms
    numbered = running_total(
        gaps, [series], "_ms", order,
        {"_silences": F.coalesce(silent, F.lit(False)).cast("int"), "_exits": F.col("_rank").cast("int")}, widths)
    run = F.col("_silences") + F.col("_exits") - F.col("_rank").cast("int")
    runs = numbered.groupBy(series, run.alias("_run")).agg(
        F.min("logged_at").alias("started_at"),
        F.max("logged_at").alias("ended_at"),
        F.count("batch_id").alias("n_lines"),
        F.min_by("batch_id", F.when(F.col("batch_id").isNotNull(), F.struct("_ms", "batch_id"))).alias("first_batch"),
        F.max_by("batch_id", F.when(F.col("batch_id").isNotNull(), F.struct("_ms", "batch_id"))).alias("last_batch"),
        F.max("code").alias("code"),
    )
    seconds = (F.unix_millis("ended_at") - F.unix_millis("started_at")) / F.lit(1000.0)
    return classify_exits(runs.drop("_run").withColumn("length_s", seconds))
