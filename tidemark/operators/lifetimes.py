"""How long snapshots live under an expiry rule, and how many are retained at any time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.maintenance import OLDER_THAN_HOURS, RETAIN_LAST
from tidemark.operators.ordered import BUCKET_WIDTHS, running_total

_TIME = "_time"


def _timed(history: DataFrame) -> DataFrame:
    return history.withColumn(_TIME, F.unix_micros("committed_at"))


def _micros(widths: Sequence[int]) -> list[int]:
    return [1000 * w for w in widths]


def snapshot_lifetimes(
    history: DataFrame,
    retain_last: int = RETAIN_LAST,
    older_than_hours: int = OLDER_THAN_HOURS,
    widths: Sequence[int] = BUCKET_WIDTHS,
) -> DataFrame:
    """history (table, snapshot_id, committed_at) with expires_at and whether age or number kept it longest.

    A snapshot can expire when it is older than the hours and no longer among the newest ones: at the later
    of its commit plus the hours and the commit of its retain_last-th successor. Without that successor it
    stays, and expires_at is NULL. The k-th successor is the snapshot whose number in the table is larger by
    k, and the numbers come from prefix sums over buckets of time, so that no task gets a table's history.
    Snapshots without a commit time are left out.
    """
    timed = _timed(history.where("committed_at IS NOT NULL"))
    numbered = running_total(timed, ["table"], _TIME, ["snapshot_id"], {"_number": F.lit(1)}, _micros(widths))
    later = numbered.select(
        F.col("table").alias("_table"), (F.col("_number") - retain_last).alias("_of"), F.col("committed_at").alias("_pushed_out"))
    aged = F.col("committed_at") + F.make_dt_interval(hours=F.lit(older_than_hours))
    pushed_out = F.col("_pushed_out")
    followed = numbered.join(later, F.col("table").eqNullSafe(F.col("_table")) & (F.col("_number") == F.col("_of")), "left")
    return followed.select(
        *history.columns,
        F.when(pushed_out.isNotNull(), F.greatest(aged, pushed_out)).alias("expires_at"),
        F.when(pushed_out.isNull(), "newest").when(pushed_out > aged, "number").otherwise("age").alias("kept_by"),
    )


def retained_curve(lifetimes: DataFrame, widths: Sequence[int] = BUCKET_WIDTHS) -> DataFrame:
    """(table, at, retained): how many snapshots there are from each moment at which the number may change.

    A sweep over the ends of all lifetimes: each moment's commits less its expiries, summed along time.
    """
    def ends(column: str, step: int) -> DataFrame:
        return lifetimes.where(F.col(column).isNotNull()).select("table", F.col(column).alias("at"), F.lit(step).alias("step"))

    moments = ends("committed_at", 1).unionByName(ends("expires_at", -1)).groupBy("table", "at").agg(F.sum("step").alias("step"))
    timed = moments.withColumn(_TIME, F.unix_micros("at"))
    return running_total(timed, ["table"], _TIME, [], {"retained": F.col("step")}, _micros(widths)).select("table", "at", "retained")


def largest_retained(curve: DataFrame, period: Column) -> DataFrame:
    """Per table and period: the most snapshots after any change in it."""
    return curve.groupBy("table", period.alias("period")).agg(F.max("retained").alias("most_retained"))
