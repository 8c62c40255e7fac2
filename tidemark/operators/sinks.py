"""Table writes: replayable append, bucketed state tables, catalog tables."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import ColumnGroup
from tidemark.operators.merge import SEQUENCE, changed_rows, merge_by_join, merge_latest, merge_sql
from tidemark.sources import files

BATCH_KEY = "batch_key"

# Properties of the catalog tables.
COMMIT_RETRIES = {
    "commit.retry.num-retries": "10",
    "commit.retry.min-wait-ms": "2000",
    "commit.retry.max-wait-ms": "60000",
    "commit.retry.total-timeout-ms": "1800000",
}
BRONZE_PROPERTIES = {
    "format-version": "2",
    "write.merge.mode": "merge-on-read",
    # batch keys share a long prefix; a format that truncates column bounds could not tell files apart
    "write.metadata.metrics.column.batch_key": "full",
    **COMMIT_RETRIES,
}
SILVER_PROPERTIES = {
    "format-version": "2",
    "write.merge.mode": "merge-on-read",
    "write.update.mode": "merge-on-read",
    "write.delete.mode": "merge-on-read",
    **COMMIT_RETRIES,
    "write.merge.isolation-level": "snapshot",
}


def sized_files(df: DataFrame, columns: Sequence[str] = (), n_files: int | None = None) -> DataFrame:
    """Control the number of output files without narrowing the work above.

    By default Spark rebalances the rows by partition columns to files of the
    advisory size, splitting a partition that is too large and merging small ones.
    That shuffles the batch once; 0 files means to write the partitions as they
    are, for bulk loads whose partitions already have a good size.
    """
    if n_files == 0:
        return df
    if n_files is not None:
        return df.repartition(n_files)
    return df.hint("rebalance", *columns)


def append_batch(
    df: DataFrame,
    path: str,
    batch_key: str,
    partitions: Sequence[str] = (),
    n_files: int | None = None,
) -> None:
    """Append one batch to a partitioned folder; writing it again replaces it.

    Each batch owns its partitions below the given ones, and only partitions
    present in the batch are overwritten.
    """
    layout = [*partitions, BATCH_KEY]
    rows = df.withColumn(BATCH_KEY, F.lit(batch_key))
    (
        sized_files(rows, layout, n_files)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*layout)
        .parquet(path)
    )


def file_schema(schema: T.StructType, partitions: Sequence[str] = ()) -> T.StructType:
    """Schema of rows written by append_batch, as a reader sees it."""
    layout = [*partitions, BATCH_KEY]
    fields = {f.name: T.StructField(f.name, f.dataType, True) for f in schema.fields}
    fields.setdefault(BATCH_KEY, T.StructField(BATCH_KEY, T.StringType()))
    return T.StructType([*[f for n, f in fields.items() if n not in layout], *[fields[n] for n in layout]])


class BucketedTable:
    """A keyed table, bucketed on the key, for places without a catalog table that supports MERGE.

    Each merge writes all rows to a fresh folder, which readers see once Spark has marked it complete; the
    folder before it stays for queries that still read it, older ones go. It has one writer, as a streaming
    query is. More than that, such as versions, concurrent commits or row-level deletes, is what a table
    format is for (CatalogLake).
    """

    _FOLDER = re.compile(r"base=(\d+)-buckets=(\d+)$")

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 8):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.buckets = buckets

    def bound(self, spark: SparkSession) -> BucketedTable:
        """The same table seen from another session, such as a micro-batch's own."""
        return BucketedTable(spark, self.path, self.key, self.buckets)

    def _folders(self) -> list[tuple[int, str]]:
        """Number and path of every folder, complete or not, oldest first."""
        named = [(self._FOLDER.match(e.name), e.path) for e in files.entries(self.spark, self.path)]
        return sorted((int(m[1]), path) for m, path in named if m)

    def current(self) -> str | None:
        """The newest complete folder."""
        return next((path for _, path in reversed(self._folders()) if files.exists(self.spark, f"{path}/_SUCCESS")), None)

    def _table_name(self, folder: str) -> str:
        # named in full, since the session's default catalog may be another one
        return f"spark_catalog.default.tidemark_{hashlib.sha1(folder.encode()).hexdigest()[:16]}"

    def read(self) -> DataFrame | None:
        """The current rows, or None before the first merge."""
        folder = self.current()
        if folder is None:
            return None
        name = self._table_name(folder)
        if not self.spark.catalog.tableExists(name):
            columns = self.spark.read.parquet(folder).schema.toDDL()
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                f"CLUSTERED BY (`{self.key}`) INTO {self._FOLDER.search(folder)[2]} BUCKETS LOCATION '{folder}'"
            )
        return self.spark.table(name)

    def align(self, rows: DataFrame) -> DataFrame:
        """Rows hash partitioned the way the table is bucketed."""
        return rows.repartition(self.buckets, self.key)

    def replace(self, df: DataFrame) -> None:
        """Write df as the table's rows; df may read the current ones."""
        before, folders = self.current(), self._folders()
        number = folders[-1][0] + 1 if folders else 0
        folder = f"{self.path}/base={number:012d}-buckets={self.buckets}"
        df.write.format("parquet").bucketBy(self.buckets, self.key).option("path", folder).saveAsTable(self._table_name(folder))
        for _, path in folders:
            if path != before:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table_name(path)}")
                files.delete(self.spark, path)


def upsert_table(table: BucketedTable, incoming: DataFrame, groups: Sequence[ColumnGroup]) -> bool:
    """Merge incoming rows, of one batch or several, into a bucketed table; False if that changes nothing.

    Only incoming rows are shuffled: the stored ones are met bucket by bucket, without exchange or sort. Both
    sides hold one row per key, so no key can make a task larger than its bucket.
    """
    folded = merge_latest(None, incoming, table.key, groups) if SEQUENCE in incoming.columns else incoming
    rows = table.align(folded)
    stored = table.read()
    if stored is None:
        table.replace(merge_latest(None, rows, table.key, groups))
        return True
    if changed_rows(stored, rows, table.key, groups).isEmpty():
        return False
    table.replace(merge_by_join(stored, rows.hint("shuffle_hash"), table.key, groups))
    return True


def ensure_namespace(spark: SparkSession, namespace: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether the table exists; failures other than absence are raised."""
    return spark.catalog.tableExists(name)


def create_table(
    df: DataFrame,
    name: str,
    partitions: Sequence[str] = (),
    properties: Mapping[str, str] | None = None,
    provider: str | None = None,
) -> None:
    """Create a catalog table from rows, partitioned or not, with its properties."""
    writer = df.writeTo(name)
    if provider:
        writer = writer.using(provider)
    if partitions:
        writer = writer.partitionedBy(*[F.col(c) for c in partitions])
    for key, value in (properties or {}).items():
        writer = writer.tableProperty(key, value)
    writer.create()


def append_table(
    df: DataFrame,
    name: str,
    partitions: Sequence[str] = (),
    properties: Mapping[str, str] | None = None,
    provider: str | None = None,
) -> None:
    """Append to a catalog table by column name, creating it the first time."""
    if not table_exists(df.sparkSession, name):
        create_table(df, name, partitions, properties, provider)
        return
    writer = df.write.mode("append")
    if provider:
        writer = writer.format(provider)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.saveAsTable(name)


def batch_condition(batch_key: str, days: Sequence[tuple[int, int, int]]) -> Column:
    """The rows of one batch, limited to its days so that planning is pruned to their partitions."""
    on_days = [(F.col("year") == y) & (F.col("month") == m) & (F.col("day") == d) for y, m, d in days]
    this = F.col(BATCH_KEY) == batch_key
    return this & reduce(lambda a, b: a | b, on_days) if on_days else this


def replace_batch(df: DataFrame, name: str, batch_key: str) -> None:
    """Append one batch to a catalog table so that writing it again replaces it.

    Needs a table format that can overwrite the rows matching a condition, and that can prove from file
    metadata that files match it wholly: see BRONZE_PROPERTIES.
    """
    days = [tuple(r) for r in df.select("year", "month", "day").distinct().collect()]  # the days of one batch
    df.writeTo(name).overwrite(batch_condition(batch_key, [d for d in days if None not in d]))


def merge_table(
    df: DataFrame,
    name: str,
    key: str,
    groups: Sequence[ColumnGroup],
    view: str = "tidemark_merge_source",
) -> None:
    """Run the generated MERGE against a catalog table that supports row-level operations.

    The source is registered globally because a micro-batch frame belongs to a
    session of its own.
    """
    df.createOrReplaceGlobalTempView(view)
    df.sparkSession.sql(merge_sql(name, f"global_temp.{view}", key, groups))
