"""What the operators share: reading tables, tables written to cut lineage, names that cannot clash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written as Parquet below the shared folder and read back: survives lost executors."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df does not use, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
