"""Calculations along the time of a series, none of which sorts a whole series in one task.

Rows are put in order inside buckets of time; what a bucket needs from the ones before it is carried over
rows that stand for whole buckets, and those may be bucketed again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_WIDTHS = (3_600_000,)


def _bucket(clock: str, width: int) -> Column:
    """Floor of clock / width, in whole numbers."""
    return F.expr(f"`{clock}` div {width} - int(`{clock}` % {width} < 0)")


def with_previous(
    rows: DataFrame, series: str, clock: str, ties: Sequence[str], widths: Sequence[int]
) -> DataFrame:
    """rows with `_previous`, the clock of the row before in the same series.

    Rows are compared inside time buckets of the first width. A bucket's first
    row takes the last clock of the nearest earlier bucket, found the same way
    among the last clocks of all buckets, with the next width.
    """
    width, *wider = widths
    bucket = f"_bucket{len(wider)}"
    placed = rows.withColumn(bucket, _bucket(clock, width))
    inside = Window.partitionBy(series, bucket).orderBy(clock, *ties)
    ends = placed.groupBy(series, bucket).agg(F.max(clock).alias("_end"))
    if wider:
        before = with_previous(ends, series, "_end", [], wider)
    else:
        across = Window.partitionBy(series).orderBy(bucket)
        before = ends.withColumn("_previous", F.lag("_end").over(across))
    carried = before.select(
        F.col(series).alias("_series"), F.col(bucket).alias("_in_bucket"), F.col("_previous").alias("_carried")
    )
    # rows without a series are one series too
    same = F.col(series).eqNullSafe(F.col("_series")) & F.col(bucket).eqNullSafe(F.col("_in_bucket"))
    return (
        placed.withColumn("_inside", F.lag(clock).over(inside))
        .join(carried, same, "left")
        .select(*rows.columns, F.coalesce("_inside", "_carried").alias("_previous"))
    )


def running_total(
    rows: DataFrame,
    series: Sequence[str],
    clock: str,
    ties: Sequence[str],
    values: Mapping[str, Column],
    widths: Sequence[int] = BUCKET_WIDTHS,
) -> DataFrame:
    """rows with a column for each of values: its sum over the rows of the same series up to and including the row.

    Rows are in the order of the clock, a whole number, and of the ties, which should make it total. A value
    that is NULL counts as zero. Rows without a clock come before all others; rows without a series are one too.
    """
    width, *wider = widths
    bucket = f"_bucket{len(wider)}"
    named = {f"_v{len(wider)}_{i}": value for i, value in enumerate(values.values())}
    placed = rows.withColumn(bucket, _bucket(clock, width)).withColumns(named)
    totals = placed.groupBy(*series, bucket).agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(v) for v in named])
    if wider:
        upto = running_total(totals, series, bucket, [], {f"_u{v}": F.col(v) for v in named}, [w // width for w in wider])
    else:
        along = Window.partitionBy(*series).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
        upto = totals.withColumns({f"_u{v}": F.sum(v).over(along) for v in named})
    carried = upto.select(
        *[F.col(c).alias(f"_s_{c}") for c in (*series, bucket)], *[(F.col(f"_u{v}") - F.col(v)).alias(f"_b{v}") for v in named])
    same = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in (*series, bucket)]
    inside = Window.partitionBy(*series, bucket).orderBy(clock, *ties).rowsBetween(Window.unboundedPreceding, 0)
    sums = [(F.coalesce(F.sum(v).over(inside), F.lit(0)) + F.col(f"_b{v}")).alias(name) for name, v in zip(values, named)]
    return placed.join(carried, same, "left").select(*rows.columns, *sums)
