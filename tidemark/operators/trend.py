"""Does a measure creep up, stay flat or fall? A rank test over the points of a series, and its slope."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import BUCKET_WIDTHS, running_total

# Fixed value: two-sided 5 % point of the normal distribution.
SIGNIFICANT = 1.959964
VALUE_BITS = 40


def bucket_means(rows: DataFrame, series: str, at: Column, value: Column, unit: str = "hour") -> DataFrame:
    """One point (series, at, value) for each unit of time: the mean value, rounded down to a whole number."""
    return (
        rows.where(at.isNotNull() & value.isNotNull())
        .groupBy(series, F.date_trunc(unit, at).alias("at"))
        .agg(F.floor(F.sum(value) / F.count(value)).alias("value"))
    )


def _rises_less_falls(points: DataFrame, series: str, clock: str, widths: Sequence[int], bits: int) -> DataFrame:
    """Per series: pairs of points whose later value is larger, less those whose later value is smaller.

    Two values first differ in one bit, below a prefix they share. Among the points of one prefix, in the
    order of time, each one-bit counts the zero-bits before it as rises and each zero-bit the one-bits as
    falls. Every pair is thus counted once, at one of the bits, from running totals rather than pair by pair.
    """
    digits = points.select(series, clock, F.col("value"), F.explode(F.sequence(F.lit(0), F.lit(bits - 1))).alias("_bit"))
    split = digits.select(
        series, clock, "_bit",
        F.expr("shiftright(value, _bit + 1)").alias("_prefix"),
        F.expr("shiftright(value, _bit) & 1").alias("_one"),
    )
    ones, zeros = F.col("_one"), 1 - F.col("_one")
    counted = running_total(split, [series, "_bit", "_prefix"], clock, [], {"_ones": ones, "_zeros": zeros}, widths)
    pairs = F.when(F.col("_one") == 1, F.col("_zeros")).otherwise(-F.col("_ones"))
    return counted.groupBy(F.col(series).alias("_series")).agg(F.sum(pairs).alias("s"))


def trend_verdict(
    points: DataFrame, series: str, widths: Sequence[int] = BUCKET_WIDTHS, bits: int = VALUE_BITS, significant: float = SIGNIFICANT
) -> DataFrame:
    """Per series: number of points, the rank statistic s and its z, the least-squares slope an hour, and a verdict.

    points: (series, at, value), one value below 2^bits, not negative, for each time. The statistic counts
    rising pairs less falling ones; z divides it by its deviation under no trend, with equal values taken
    into account. A series is creeping or falling if z is significant, else flat. Fewer than two points, or
    values that are all equal, have z 0 and are flat. Points with a NULL are left out.
    """
    known = points.where(F.col("at").isNotNull() & F.col("value").isNotNull()).select(
        series, F.unix_millis("at").alias("_ms"), F.col("value").cast("long").alias("value"))
    # running sums as whole numbers, so the slope does not depend on the order of adding
    x, y = F.expr("_ms div 1000").cast("decimal(38,0)"), F.col("value").cast("decimal(38,0)")
    sums = known.groupBy(series).agg(
        F.count(F.lit(1)).alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
        F.sum((x * y).cast("decimal(38,0)")).alias("sxy"), F.sum((x * x).cast("decimal(38,0)")).alias("sxx"))
    over, under = (F.expr(f"cast(cast(n * {a} as decimal(38,0)) - cast({b} as decimal(38,0)) as double)") for a, b in (("sxy", "sx * sy"), ("sxx", "sx * sx")))
    line = sums.select(series, "n", F.round(F.when(under != 0, over / under * 3600), 6).alias("slope_per_hour"))
    ties = known.groupBy(series, "value").agg(F.count(F.lit(1)).alias("t")).groupBy(F.col(series).alias("_tied")).agg(
        F.sum(F.col("t") * (F.col("t") - 1) * (2 * F.col("t") + 5)).alias("tied"))
    ranks = _rises_less_falls(known, series, "_ms", widths, bits)
    n, s = F.col("n"), F.col("s")
    variance = ((n * (n - 1) * (2 * n + 5) - F.col("tied")) / F.lit(18.0)).alias("variance")
    z = F.when(F.col("variance") > 0, (s - F.signum(s)) / F.sqrt("variance")).otherwise(F.lit(0.0))
    verdict = F.when(F.col("z") > significant, "creeping").when(F.col("z") < -significant, "falling").otherwise("flat")
    joined = line.join(ties, F.col(series).eqNullSafe(F.col("_tied"))).join(ranks, F.col(series).eqNullSafe(F.col("_series")))
    return joined.select(series, "n", "slope_per_hour", "s", variance).withColumn("z", z).select(
        series, F.col("n").alias("n_points"), "s", F.round("z", 6).alias("z"), "slope_per_hour", verdict.alias("verdict"))
