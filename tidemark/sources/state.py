"""Keyed streaming state as a table, read back from the checkpoint of a query that need not run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a checkpoint: id, name, partitions, first and last batch whose state can be read."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        "operatorId", "operatorName", "numPartitions", "minBatchId", "maxBatchId")


def read_state(
    spark: SparkSession, checkpoint: str, names: Sequence[str], batch_id: int | None = None, operator_id: int = 0
) -> DataFrame:
    """Keys and values of an aggregation's state after a batch, by default the last one committed.

    Spark calls every buffer after its function, so a query with several maxima has several fields of one name;
    names are given to them in the order of the aggregates.
    """
    reader = spark.read.format("statestore").option("operatorId", operator_id)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    fields = state.schema["value"].dataType.fields
    if len(fields) != len(names):
        raise ValueError(f"the state has {len(fields)} values, not {len(names)}")
    named = T.StructType([T.StructField(n, f.dataType, True) for n, f in zip(names, fields)])
    return state.select("key.*", F.col("value").cast(named).alias("value")).select("*", "value.*").drop("value")
