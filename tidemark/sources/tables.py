"""Catalog reads: table listings, table history, row inventories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_tables(spark: SparkSession, namespace: str | None = None) -> DataFrame:
    """SHOW TABLES as a DataFrame: namespace, tableName, isTemporary."""
    return spark.sql("SHOW TABLES" + (f" IN {namespace}" if namespace else ""))


def table_history(spark: SparkSession, table: str) -> DataFrame:
    """Snapshots of a catalog table that exposes them as a metadata table."""
    return spark.table(f"{table}.snapshots").select(
        F.lit(table).alias("table"), "snapshot_id", "committed_at"
    )


def table_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Row and column counts of several tables, each counted by its own aggregate."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in sorted(tables.items())
    ]
    return reduce(DataFrame.unionAll, counts)
