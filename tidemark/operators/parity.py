"""Comparing a table with a copy of it, and rebuilding silver from bronze."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import ColumnGroup, Contract
from tidemark.operators.bronze import bronze_to_events
from tidemark.operators.latest import combine_one_pass


def row_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows one side holds more often than the other, with the surplus of each side.

    Both directions of EXCEPT ALL from one aggregate: equal rows cancel on the
    map side as far as they meet there.
    """
    columns = left.columns
    both = left.withColumn("_n", F.lit(1)).unionByName(right.select(*columns).withColumn("_n", F.lit(-1)))
    surplus = both.groupBy(*columns).agg(F.sum("_n").alias("_surplus")).where("_surplus != 0")
    return surplus.select(
        *columns,
        F.greatest(F.col("_surplus"), F.lit(0)).alias("n_left_only"),
        F.greatest(-F.col("_surplus"), F.lit(0)).alias("n_right_only"),
    )


def _paired(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    rest = [c for c in left.columns if c not in keys]
    row = F.struct(*rest)
    both = left.withColumn("_side", F.lit("l")).unionByName(
        right.select(*left.columns).withColumn("_side", F.lit("r"))
    )
    on_left, on_right = F.col("_side") == "l", F.col("_side") == "r"
    pairs = both.groupBy(*keys).agg(
        F.count_if(on_left).alias("_n_left"),
        F.count_if(on_right).alias("_n_right"),
        F.first(F.when(on_left, row), ignorenulls=True).alias("_l"),
        F.first(F.when(on_right, row), ignorenulls=True).alias("_r"),
    )
    return pairs, rest


def column_diff(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per column, how many keys present once on each side disagree in it.

    Keys found on one side only, or several times on a side, are counted in rows
    of their own; which rows differ there is answered by row_diff.
    """
    pairs, rest = _paired(left, right, keys)
    n_left, n_right = F.col("_n_left"), F.col("_n_right")
    comparable = (n_left == 1) & (n_right == 1)
    counts = pairs.agg(
        F.count_if(n_right == 0).alias("(left only)"),
        F.count_if(n_left == 0).alias("(right only)"),
        F.count_if((n_left > 1) | (n_right > 1)).alias("(repeated key)"),
        *[
            F.count_if(comparable & ~F.col("_l").getField(c).eqNullSafe(F.col("_r").getField(c))).alias(c)
            for c in rest
        ],
    )
    return counts.unpivot([], counts.columns, "column_name", "n_keys")


def rebuild_latest(bronze: DataFrame, contract: Contract, groups: Sequence[ColumnGroup]) -> DataFrame:
    """A latest-state table computed from the whole of bronze."""
    return combine_one_pass(bronze_to_events(bronze, contract), contract.key, groups)
