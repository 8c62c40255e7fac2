"""Job logs as data: batch progress lines, batch times and their trend, errors, exit codes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import BUCKET_WIDTHS, running_total, with_previous

# Shapes of the progress lines, the error filter, and exit codes.
TRIGGER_MS = 30_000
LINE_TIME = r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3})"
LINE_LEVEL = r" - (DEBUG|INFO|WARNING|ERROR|CRITICAL) - "
LINE_STAGE = r"\[(Bronze|Silver|Expire)\] Batch [0-9]+"
LINE_BATCH = r"Batch ([0-9]+)"
LINE_DETAIL = r"Batch [0-9]+[: ]\s*(.*)$"
ERROR_WORDS = ("Error", "Exception", "Fail")
ERROR_CLASS = r"([A-Za-z0-9_.$]*(?:Error|Exception|Fail)[A-Za-z]*)"

EXIT_CODES = (
    (0, "Completed", "clean shutdown"),
    (137, "OOMKilled", "container exceeded its memory limit"),
    (143, "Error", "container received SIGTERM"),
    (11, "Error", "driver application exit"),
)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Log files, plain or compressed, one row per line."""
    return spark.read.text(path).withColumnRenamed("value", "text")


def parse_batches(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Batch progress lines: time, level, stage, batch, outcome, detail, after the columns to keep.

    The colon after the batch number and the stage are optional in the input.
    """
    text = F.col("text")

    def part(pattern: str):
        return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))

    detail = F.col("detail")
    # the plain search drops most lines of a log before any pattern is tried
    progress = lines.where(text.contains("Batch ") & text.rlike(LINE_BATCH))
    parsed = progress.select(
        *keep,
        F.to_timestamp(part(LINE_TIME), "yyyy-MM-dd HH:mm:ss,SSS").alias("logged_at"),
        part(LINE_LEVEL).alias("level"),
        part(LINE_STAGE).alias("stage"),
        part(LINE_BATCH).cast("long").alias("batch_id"),
        part(LINE_DETAIL).alias("detail"),
    )
    outcome = (
        F.when(detail.startswith("written"), "written")
        .when(detail.startswith("upserted"), "upserted")
        .when(detail.startswith("skipped"), "skipped")
        .when(detail.startswith("empty"), "empty")
        .when(detail.startswith("transient commit conflict"), "conflict")
        .when(detail.startswith("FAILED"), "failed")
        .when(detail.startswith("expire_snapshots OK"), "expired")
        .otherwise("other")
    )
    return parsed.select(*keep, "logged_at", "level", "stage", "batch_id", outcome.alias("outcome"), "detail")


# Spark's warnings about slow batches and large tasks, as its log prints them.
BEHIND_TIME = r"^(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})"
BEHIND_BATCH = r"falling behind\. The trigger interval is \{?(\d+)\}? milliseconds, but spent \{?(\d+)\}? milliseconds"
BEHIND_TASK = r"contains a task of very large size \((\d+) KiB\)"


def parse_behind(lines: DataFrame) -> DataFrame:
    """Warnings of batches slower than their trigger and of large tasks: time, kind, trigger, time taken, task size.

    The time taken is what the batch spent, which the distance of two batches cannot tell from waiting.
    """
    text = F.col("text")

    def number(pattern: str, group: int = 1):
        return F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).cast("long")

    warnings = lines.where(text.contains("falling behind") | text.contains("very large size"))
    parsed = warnings.select(
        F.to_timestamp(F.nullif(F.regexp_extract(text, BEHIND_TIME, 1), F.lit("")), "yy/MM/dd HH:mm:ss").alias("logged_at"),
        number(BEHIND_BATCH).alias("trigger_ms"),
        number(BEHIND_BATCH, 2).alias("took_ms"),
        number(BEHIND_TASK).alias("task_kib"),
    ).where("took_ms IS NOT NULL OR task_kib IS NOT NULL")
    kind = F.when(F.col("took_ms").isNotNull(), "behind").otherwise("task size")
    return parsed.select("logged_at", kind.alias("kind"), "trigger_ms", "took_ms", "task_kib")


def behind_trend(behind: DataFrame) -> DataFrame:
    """Per hour: slow batches, how long they took, the largest task, and whether the mean time rose.

    The window runs over one row per hour of a day, so the first hour of a day never counts as rising; whether
    the times rise over all hours is trend_verdict's question.
    """
    hourly = behind.groupBy(F.date_trunc("hour", "logged_at").alias("hour")).agg(
        F.count("took_ms").alias("n_behind"),
        F.sum("took_ms").alias("_took"),
        F.max("took_ms").alias("max_took_ms"),
        F.max("task_kib").alias("max_task_kib"),
    )
    mean = F.when(F.col("n_behind") > 0, F.col("_took") / F.col("n_behind"))
    by_day = Window.partitionBy(F.to_date("hour")).orderBy("hour")
    return hourly.select(
        "hour", "n_behind", mean.alias("avg_took_ms"), "max_took_ms", "max_task_kib",
        F.coalesce(mean > F.lag(mean).over(by_day), F.lit(False)).alias("rising"),
    )


def batch_gaps(
    batches: DataFrame, series: str, clock_ms: str, batch: str, widths: Sequence[int] = BUCKET_WIDTHS
) -> DataFrame:
    """Milliseconds since the previous batch of the same series.

    A window over a series would sort all of it in one task. By default no task
    gets more of a series than the rows of an hour, or its hours. Give a series of
    many rows a second more levels, such as (1_000, 60_000, 86_400_000): then it is
    the rows of a second, the seconds of a minute, the minutes of a day, the days.
    """
    previous = with_previous(batches, series, clock_ms, [batch], widths)
    return previous.select(*batches.columns, (F.col(clock_ms) - F.col("_previous")).alias("gap_ms"))


def lag_trend(
    gaps: DataFrame,
    series: str,
    clock_ms: str,
    period_ms: int = 3_600_000,
    trailing: int = 3,
    trigger_ms: int = TRIGGER_MS,
) -> DataFrame:
    """Batch times per series and period against the trigger, and whether they creep up.

    trailing_gap_ms averages the batches of the last periods; the windows run
    over one row per series and period.
    """
    per_period = (
        gaps.where(F.col("gap_ms").isNotNull())
        .groupBy(series, F.floor(F.col(clock_ms) / period_ms).alias("period"))
        .agg(
            F.count("*").alias("n_batches"),
            F.sum("gap_ms").alias("_gap_sum"),
            F.max("gap_ms").alias("max_gap_ms"),
            F.count_if(F.col("gap_ms") > trigger_ms).alias("n_behind"),
        )
    )
    ordered = Window.partitionBy(series).orderBy("period")
    recent = ordered.rowsBetween(-(trailing - 1), 0)
    average = F.col("_gap_sum") / F.col("n_batches")
    trailing_average = F.sum("_gap_sum").over(recent) / F.sum("n_batches").over(recent)
    return per_period.select(
        series,
        "period",
        "n_batches",
        "n_behind",
        "max_gap_ms",
        average.alias("avg_gap_ms"),
        trailing_average.alias("trailing_gap_ms"),
        F.coalesce(average > F.lag(average).over(ordered), F.lit(False)).alias("creeping"),
    )


def error_summary(lines: DataFrame) -> DataFrame:
    """Lines matching the error filter, counted by the class they name."""
    text = F.col("text")
    matching = reduce(lambda a, b: a | b, [text.contains(word) for word in ERROR_WORDS])
    return (
        lines.where(matching)
        .groupBy(F.regexp_extract("text", ERROR_CLASS, 1).alias("error_class"))
        .agg(F.count("*").alias("n_lines"))
    )


def classify_exits(exits: DataFrame, code: str = "code") -> DataFrame:
    """Exit codes with reason and meaning; unknown codes keep NULLs.

    The dimension has four rows, so broadcasting it is safe at any input size.
    """
    values = ", ".join(f"({c}, '{reason}', '{meaning}')" for c, reason, meaning in EXIT_CODES)
    known = exits.sparkSession.sql(f"SELECT * FROM VALUES {values} AS d(`{code}`, reason, meaning)")
    return exits.join(F.broadcast(known), code, "left")
