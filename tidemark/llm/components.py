"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Join each node's larger (or smaller) neighbours to the least node it knows.

    The least neighbour is a partial aggregate and the join has one row per node on its small side, so
    the hub of a star may be split over tasks.
    """
    both = edges.union(edges.select("b", "a")) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(least, "a")
    moved = joined.where("b > a").select("b", "m") if large else joined.select("b", "m").union(least.select("a", "m"))
    return moved.toDF("a", "b").where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in an edge (a, b): root is the least node of its component.

    Each round is written to the shared folder; the number of rounds grows with the logarithm of the
    longest path. NULL ends and loops are ignored, so an empty table gives no rows.
    """
    edges = stored(edges.toDF("a", "b").where("a <> b").distinct(), "edges")
    before = _state(edges)
    while before[0]:
        edges = stored(_star(_star(edges, large=True), large=False), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select("b", "b").distinct()).distinct()
