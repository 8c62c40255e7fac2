"""The tables a telemetry stream writes, and the steps that write them per micro-batch."""

from __future__ import annotations

import json
import logging
import threading
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone
from typing import ClassVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import LATEST_VALID_GROUPS, ColumnGroup, Contract, whole_row_group
from tidemark.operators import compaction
from tidemark.operators.bronze import PARTITIONS, bronze_to_events, to_bronze, with_local_clocks
from tidemark.operators.decode import OUTCOMES, REFUSALS, good_rows, outcome_counts, refused_rows
from tidemark.operators.latest import latest_per_key, newest_structs
from tidemark.operators.maintenance import (
    OLDER_THAN_HOURS,
    RETAIN_LAST,
    expire_call,
)
from tidemark.operators.merge import SEQUENCE, fold_structs, merge_latest
from tidemark.operators.sinks import (
    BATCH_KEY,
    BRONZE_PROPERTIES,
    SILVER_PROPERTIES,
    BucketedTable,
    append_batch,
    append_table,
    create_table,
    ensure_namespace,
    file_schema,
    merge_table,
    replace_batch,
    sized_files,
    table_exists,
    upsert_table,
)
from tidemark.sources import files
from tidemark.sources.state import read_state
from tidemark.streaming import seeded

logger = logging.getLogger("tidemark")

# Fixed value: how long a pending row may wait for silver, as the separate silver trigger has it.
SILVER_INTERVAL_S = 300
# The outcomes are a struct, since maps have no order by which the last of several lines could be found.
PROGRESS = T.StructType([
    *[T.StructField(n, t) for n, t in (("batch_key", T.StringType()), ("batch_id", T.LongType()), ("day", T.DateType()),
                                       ("started_ms", T.LongType()), ("took_ms", T.LongType()), ("silver", T.BooleanType()))],
    T.StructField("outcomes", T.StructType([T.StructField(o, T.LongType()) for o in OUTCOMES])),
])


def batch_key(spark: SparkSession, batch_id: int) -> str:
    """Names a micro-batch for good: batch ids restart when a checkpoint is replaced."""
    query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "manual"
    return f"{query_id}-{batch_id:09d}"


@dataclass
class Lake:
    """Bronze history, quarantine, pending silver input and the two silver tables below one root."""

    spark: SparkSession
    root: str
    contract: Contract
    valid_groups: Sequence[ColumnGroup] = LATEST_VALID_GROUPS
    buckets: int = 8
    bronze_files: int | None = None
    retain_last: int = RETAIN_LAST
    older_than_hours: int = OLDER_THAN_HOURS
    silver_interval_s: int = SILVER_INTERVAL_S
    observes: ClassVar[bool] = True
    latest_groups: Sequence[ColumnGroup] = field(init=False)
    lock: threading.RLock = field(init=False, repr=False, compare=False, default_factory=threading.RLock)

    def __post_init__(self):
        self.root = self.root.rstrip("/")
        self.latest_groups = (whole_row_group(self.contract),)

    @property
    def bronze_path(self) -> str:
        return f"{self.root}/bronze/iot"

    @property
    def quarantine_path(self) -> str:
        return f"{self.root}/bronze/refused"

    @property
    def pending_path(self) -> str:
        return f"{self.root}/silver/pending"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    @property
    def latest(self) -> BucketedTable:
        return BucketedTable(self.spark, f"{self.root}/silver/latest", self.contract.key, self.buckets)

    @property
    def latest_valid(self) -> BucketedTable:
        return BucketedTable(
            self.spark, f"{self.root}/silver/latest_valid", self.contract.key, self.buckets
        )

    # ---- bronze

    def bronze_schema(self) -> T.StructType:
        rows = self.spark.createDataFrame([], self.contract.schema)
        stored = to_bronze(rows, self.contract).select(
            "*", F.lit(0).cast("long").alias("batch_id"), F.current_timestamp().alias("ingest_ts")
        )
        return file_schema(stored.schema, PARTITIONS)

    def read_bronze(self, first_day: date | None = None, last_day: date | None = None) -> DataFrame:
        """Bronze rows, of all time or of a range of local days.

        A range is read from its own folders, so the cost of listing does not
        grow with the age of the table.
        """
        reader = self.spark.read.schema(self.bronze_schema()).option("basePath", self.bronze_path)
        if first_day is None or last_day is None:
            return reader.parquet(self.bronze_path)
        days = [first_day + timedelta(n) for n in range((last_day - first_day).days + 1)]
        folders = [f"{self.bronze_path}/year={d.year}/month={d.month}/day={d.day}" for d in days]
        present = [f for f in folders if files.exists(self.spark, f)]
        if not present:
            return self.spark.createDataFrame([], self.bronze_schema())
        return reader.parquet(*present)

    def compact_bronze(self, before: date, target_bytes: int = compaction.TARGET_BYTES) -> int:
        """Rewrite closed days, those before a date, to files of a good size; returns how many.

        It takes turns with the batches of this process. Another process must not write those days meanwhile.
        """
        with self.lock:
            return compaction.compact(self.spark, self.bronze_path, self.bronze_schema(), before, target_bytes)

    def count_batch(self, decoded: DataFrame) -> dict[str, int]:
        """Rows of a batch by outcome, in a job of their own."""
        return decoded.agg(*outcome_counts(self.contract)).first().asDict()

    def write_bronze(self, decoded: DataFrame, batch_id: int) -> dict[str, int]:
        """Append a decoded micro-batch; refused payloads go to quarantine. Returns its rows by outcome.

        They are counted while bronze is written, which also fills the cache of a persisted batch. A batch
        without a good row is planned away together with its counters, and counted afterwards. A stage that
        runs again after a lost executor may be counted again; that a count is zero stays right.
        """
        key = batch_key(decoded.sparkSession, batch_id)
        seen = Observation() if self.observes else None
        counts = self.count_batch(decoded) if seen is None else {}
        good = good_rows(decoded if seen is None else decoded.observe(seen, *outcome_counts(self.contract)))
        stored = to_bronze(good, self.contract).select(
            "*", F.lit(batch_id).cast("long").alias("batch_id"), F.current_timestamp().alias("ingest_ts")
        )
        if seen is not None or any(n for o, n in counts.items() if o not in REFUSALS):
            self._store_bronze(stored, key)
        if seen is not None:
            counts = seen.get or self.count_batch(decoded)
        if any(counts[r] for r in REFUSALS):
            append_batch(refused_rows(decoded), self.quarantine_path, key)
        if any(counts.values()):
            logger.info("[Bronze] Batch %d: written (%s)", batch_id, counts)
        return counts

    def _store_bronze(self, rows: DataFrame, key: str) -> None:
        append_batch(rows, self.bronze_path, key, PARTITIONS, self.bronze_files)

    # ---- progress

    @property
    def progress_path(self) -> str:
        return f"{self.root}/progress"

    def record_progress(
        self, spark: SparkSession, batch_id: int, counts: Mapping[str, int], started_ms: int, silver: bool
    ) -> None:
        """Keep what a batch did as one line in a file of its own, written without a Spark job.

        A batch that is replayed leaves another line if the day has changed since; read_progress takes the last.
        """
        key, now_ms = batch_key(spark, batch_id), int(time.time() * 1000)
        line = {"batch_key": key, "batch_id": batch_id, "started_ms": started_ms, "took_ms": now_ms - started_ms,
                "silver": silver, "outcomes": dict(counts)}
        day = datetime.fromtimestamp(started_ms / 1000, timezone.utc).date()
        files.write_text(spark, f"{self.progress_path}/day={day}/{key}.json", json.dumps(line) + "\n")

    def read_progress(self) -> DataFrame:
        """One row per batch: its key and number, the day, start and duration, rows by outcome, and whether silver ran."""
        if not files.exists(self.spark, self.progress_path):
            return self.spark.createDataFrame([], PROGRESS)
        return latest_per_key(self.spark.read.schema(PROGRESS).json(self.progress_path), "batch_key", "started_ms")

    # ---- silver

    def newest(self, events: DataFrame) -> DataFrame:
        """One row per key: the newest row and the newest columns of each group, as structs."""
        named = {"row": self.latest_groups[0]}
        named.update({f"g{i}": g for i, g in enumerate(self.valid_groups)})
        return newest_structs(events, self.contract.key, named)

    def read_state(self, checkpoint: str = "stateful", batch_id: int | None = None) -> DataFrame:
        """Newest structs per key as the stateful query holds them after a batch: what upsert can write to silver."""
        names = ["row", *[f"g{i}" for i in range(len(self.valid_groups))]]
        return read_state(self.spark, self.checkpoint(checkpoint), names, batch_id)

    def clocks(self) -> dict[str, str]:
        """Struct of newest columns to the clock that it advances on."""
        return {"row": self.latest_groups[0].clock, **{f"g{i}": g.clock for i, g in enumerate(self.valid_groups)}}

    def read_seeded(self, checkpoint: str = "seeded", batch_id: int | None = None) -> DataFrame:
        """Newest structs per key as the seeded query holds them after a batch."""
        schema = T.StructType([f for f in self.pending_schema() if f.name != SEQUENCE])
        return seeded.read_states(self.spark, self.checkpoint(checkpoint), schema, self.contract.key, batch_id)

    def stored_structs(self) -> DataFrame:
        """What both silver tables hold, as newest structs per key; no rows before the first merge."""
        valid, latest = self.latest_valid.read(), self.latest.read()
        schema = T.StructType([f for f in self.pending_schema() if f.name != SEQUENCE])
        if valid is None or latest is None:
            return self.spark.createDataFrame([], schema)
        key = self.contract.key
        both = latest.select(key, F.struct(*self.latest_groups[0].outputs).alias("row")).join(
            valid.select(key, *[F.struct(*g.outputs).alias(f"g{i}") for i, g in enumerate(self.valid_groups)]), key, "full")
        return both.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])

    def upsert(self, structs: DataFrame) -> None:
        """Merge newest structs (one row per key and `_seq`) into both silver tables."""
        order = [SEQUENCE] if SEQUENCE in structs.columns else []
        valid_columns = [f"g{i}.*" for i in range(len(self.valid_groups))]
        for table, columns, groups in (
            ("latest_valid", valid_columns, self.valid_groups),
            ("latest", ["row.*"], self.latest_groups),
        ):
            self._store_silver(table, structs.select(self.contract.key, *columns, *order), groups)

    def _store_silver(self, table: str, incoming: DataFrame, groups: Sequence[ColumnGroup]) -> None:
        stored: BucketedTable = getattr(self, table)
        upsert_table(stored.bound(incoming.sparkSession), incoming, groups)

    def upsert_decoded(self, decoded: DataFrame) -> None:
        """Merge the rows of one decoded batch directly."""
        self.upsert(self.newest(with_local_clocks(good_rows(decoded), self.contract)))

    def upsert_bronze(self, bronze: DataFrame) -> None:
        """Merge bronze rows; alarms are then the renamed struct."""
        rows = bronze_to_events(bronze, self.contract)
        self.upsert(self.newest(rows))

    def pending_schema(self) -> T.StructType:
        rows = with_local_clocks(self.spark.createDataFrame([], self.contract.schema), self.contract)
        schema = self.newest(rows).schema
        return T.StructType([T.StructField(f.name, f.dataType) for f in schema]).add(SEQUENCE, T.LongType())

    def add_pending(self, decoded: DataFrame, batch_id: int, started_s: int = 0) -> None:
        """Keep a batch's newest rows, one per key, until silver merges them.

        The folder is flat and holds only what is not merged yet. A batch kept
        twice after a restart is harmless: merging rows again changes nothing.
        Batches are in the order of the start of their query, then of their
        numbers, which begin again at 0 with a fresh checkpoint.
        """
        structs = self.newest(with_local_clocks(good_rows(decoded), self.contract))
        numbered = structs.withColumn(SEQUENCE, F.lit((started_s << 31) + batch_id).cast("long"))
        sized_files(numbered).write.mode("append").parquet(self.pending_path)

    def _waiting(self, spark: SparkSession) -> list[files.Entry]:
        return [e for e in files.entries(spark, self.pending_path) if e.name.endswith(".parquet")]

    def pending_since(self) -> float | None:
        """When the oldest pending file was written, in epoch seconds."""
        return min((e.modified_ms / 1000 for e in self._waiting(self.spark)), default=None)

    def pending_is_old(self) -> bool:
        since = self.pending_since()
        return since is not None and time.time() - since > self.silver_interval_s

    def merge_pending(self, spark: SparkSession | None = None) -> int:
        """Merge everything kept since the last successful run; returns the number of files.

        Kept rows are removed only after both tables are written. A failure in
        between merges them again.
        """
        spark = spark or self.spark
        waiting = [e.path for e in self._waiting(spark)]
        if waiting:
            rows = fold_structs(
                spark.read.schema(self.pending_schema()).parquet(*waiting),
                self.contract.key,
                {"row": self.latest_groups[0], **{f"g{i}": g for i, g in enumerate(self.valid_groups)}},
            ).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                self.upsert(rows)
            finally:
                rows.unpersist()
            for path in waiting:
                files.delete(spark, path)
        return len(waiting)

    def expire(self) -> int:
        """Folders keep no history; tables of a catalog do."""
        return 0


@dataclass
class CatalogLake(Lake):
    """The same steps on tables of a catalog whose format has transactions and MERGE.

    root still holds checkpoints, quarantine and pending rows. replayable makes a
    bronze batch replace itself when it is written again; without it a batch
    that is replayed after a failure appears twice, as in a plain append.
    """

    # commands of a catalog run their rows in a query of their own, whose counters never reach the batch's
    observes: ClassVar[bool] = False
    catalog: str = "spark_catalog"
    bronze_namespace: str = "bronze"
    silver_namespace: str = "silver"
    provider: str | None = None
    replayable: bool = True

    def _name(self, namespace: str, table: str) -> str:
        return f"`{self.catalog}`.{namespace}.{table}"

    @property
    def bronze_table(self) -> str:
        return self._name(self.bronze_namespace, "iot")

    def silver_table(self, table: str) -> str:
        return self._name(self.silver_namespace, f"iot_events_{table}")

    def prepare(self) -> None:
        """Create both namespaces; once per start, not per batch."""
        for namespace in (self.bronze_namespace, self.silver_namespace):
            ensure_namespace(self.spark, f"`{self.catalog}`.{namespace}")

    def read_bronze(self, first_day: date | None = None, last_day: date | None = None) -> DataFrame:
        rows = self.spark.table(self.bronze_table)
        if first_day is None or last_day is None:
            return rows
        on_day = F.make_date("year", "month", "day")
        months = F.col("year") * 12 + F.col("month")
        return rows.where(
            on_day.between(first_day, last_day)
            & months.between(first_day.year * 12 + first_day.month, last_day.year * 12 + last_day.month)
            & F.col("year").between(first_day.year, last_day.year)
        )

    def _store_bronze(self, rows: DataFrame, key: str) -> None:
        keyed = sized_files(rows.withColumn(BATCH_KEY, F.lit(key)), PARTITIONS, self.bronze_files)
        if self.replayable and table_exists(rows.sparkSession, self.bronze_table):
            replace_batch(keyed, self.bronze_table, key)
        else:
            append_table(keyed, self.bronze_table, PARTITIONS, BRONZE_PROPERTIES, self.provider)

    def _store_silver(self, table: str, incoming: DataFrame, groups: Sequence[ColumnGroup]) -> None:
        name, key = self.silver_table(table), self.contract.key
        folded = merge_latest(None, incoming, key, groups)  # one row per key, over all batches
        if table_exists(incoming.sparkSession, name):
            merge_table(folded, name, key, groups, f"tidemark_{table}_source")
        else:
            create_table(folded, name, properties=SILVER_PROPERTIES, provider=self.provider)

    def expire(self) -> int:
        for table in ("latest", "latest_valid"):
            call = expire_call(
                self.catalog,
                f"{self.silver_namespace}.iot_events_{table}",
                self.older_than_hours,
                self.retain_last,
            )
            self.spark.sql(call).collect()
        return 2
