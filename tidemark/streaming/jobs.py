"""Streaming queries: one query feeding all tables, two queries in a chain, or keyed state."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.contracts import check_drift
from tidemark.operators.bronze import with_local_clocks
from tidemark.operators.decode import decode, good_rows
from tidemark.operators.maintenance import SILVER_EVERY
from tidemark.sources.files import ensure_folder
from tidemark.sources.streams import file_options, file_stream
from tidemark.streaming import seeded
from tidemark.streaming.lake import Lake
from tidemark.streaming.policy import expiry_due, is_transient, silver_due

logger = logging.getLogger("tidemark")

# Batch trigger of the ingest query, and of a separate silver query.
INGEST_TRIGGER = {"processingTime": "30 seconds"}
SILVER_TRIGGER = {"processingTime": "5 minutes"}


def _start(
    stream: DataFrame,
    callback: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: Mapping,
    name: str,
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(callback)
        .queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def ingest_batch(
    lake: Lake, silver_every: int | None, pending: bool = True
) -> Callable[[DataFrame, int], None]:
    """One decoded micro-batch to bronze and, if silver is wanted, on to silver.

    Bronze goes first and its failure ends the query; its rows are counted on the
    way, and kept as progress once the batch is done. The batch then leaves its
    newest row per key behind as pending. With silver_every, silver runs on every
    nth batch over all that is pending, and earlier once the oldest pending row has
    waited longer than the lake's silver interval. An empty batch merges on the same
    terms. While nothing arrives Spark starts no batch, so it is quiet_merge, called
    by supervise, that bounds the wait then. A lost commit race leaves the rows for
    the next run, any other failure ends the query.
    """
    started_s = int(time.time())

    def process(decoded: DataFrame, batch_id: int) -> None:
        decoded.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            began_ms = int(time.time() * 1000)
            counts = lake.write_bronze(decoded, batch_id)
            if not any(counts.values()):
                logger.info("Batch %d: empty, skipping.", batch_id)
                if silver_every is not None and lake.pending_since() is not None and (
                    silver_due(batch_id, silver_every) or lake.pending_is_old()
                ):
                    merge_silver(lake, decoded, batch_id)
                return
            if pending:
                lake.add_pending(decoded, batch_id, started_s)
            due = silver_every is not None and (silver_due(batch_id, silver_every) or lake.pending_is_old())
            if due:
                merge_silver(lake, decoded, batch_id)
                if expiry_due(batch_id, silver_every):
                    expire_silver(lake, batch_id)
            elif silver_every is not None:
                logger.info("[Silver] Batch %d: skipped (cadence 1-in-%d)", batch_id, silver_every)
            lake.record_progress(decoded.sparkSession, batch_id, counts, began_ms, due)
        finally:
            decoded.unpersist()

    def alone(decoded: DataFrame, batch_id: int) -> None:
        with lake.lock:
            process(decoded, batch_id)

    return alone


def quiet_merge(lake: Lake) -> Callable[[], None]:
    """A call for supervise to repeat: merges pending rows that have waited too long while no batch runs."""

    def tick() -> None:
        if lake.lock.acquire(blocking=False):  # a running batch looks after the pending rows itself
            try:
                if lake.pending_is_old():
                    merged = lake.merge_pending()
                    logger.info("[Silver] quiet source: upserted (%d pending files)", merged)
            except Exception as e:
                if not is_transient(e):
                    raise
                logger.warning("[Silver] quiet source: transient commit conflict, kept for the next run: %s", e)
            finally:
                lake.lock.release()

    return tick


def merge_silver(lake: Lake, decoded: DataFrame, batch_id: int) -> None:
    try:
        merged = lake.merge_pending(decoded.sparkSession)
        logger.info("[Silver] Batch %d: upserted (%d pending files)", batch_id, merged)
    except Exception as e:
        if not is_transient(e):
            logger.error("[Silver] Batch %d FAILED (bronze succeeded): %s", batch_id, e)
            raise
        logger.warning("[Silver] Batch %d: transient commit conflict, kept for the next run: %s", batch_id, e)


def expire_silver(lake: Lake, batch_id: int) -> None:
    """Upkeep never ends the query."""
    try:
        logger.info("[Expire] Batch %d: expire_snapshots OK (%d versions)", batch_id, lake.expire())
    except Exception as e:
        logger.warning("[Expire] Batch %d: failed (continuing): %s", batch_id, e)


def start_ingest(
    lake: Lake,
    raw: DataFrame,
    payload_format: str = "json",
    silver_every: int | None = SILVER_EVERY,
    trigger: Mapping = INGEST_TRIGGER,
    checkpoint: str = "combined",
    pending: bool = True,
) -> StreamingQuery:
    """Payload stream to bronze and, with silver_every, to both silver tables.

    Without silver_every the pending rows are left to start_silver.
    """
    if silver_every is not None and not pending:
        raise ValueError("silver is merged from pending rows")
    check_drift(lake.contract.schema, lake.contract)
    decoded = decode(raw, lake.contract, payload_format)
    callback = ingest_batch(lake, silver_every, pending)
    return _start(decoded, callback, lake.checkpoint(checkpoint), trigger, f"tidemark-{checkpoint}")


def pending_stream(lake: Lake, **limits) -> DataFrame:
    """The rows that ingest keeps for silver, as a stream; files go once they are merged."""
    ensure_folder(lake.spark, lake.pending_path)
    options = {"cleanSource": "delete", **file_options(**{"ignore_missing_files": False, **limits})}
    return lake.spark.readStream.schema(lake.pending_schema()).options(**options).parquet(lake.pending_path)


def start_silver(
    lake: Lake,
    trigger: Mapping = SILVER_TRIGGER,
    checkpoint: str = "silver",
    source: str = "pending",
    **limits,
) -> StreamingQuery:
    """Second query of a chain, merging into silver on its own trigger.

    A slow trigger makes larger silver batches; the checkpoint, not the batch
    number, decides what is still to be merged. A failed batch is not committed
    there and comes again when the query restarts.

    The source "pending" reads the rows the first query keeps and deletes them
    once merged, so that listing it stays cheap. The source "bronze" reads the
    bronze table from its beginning, for a table that was filled without this
    query; its files are listed at every trigger.
    """
    if source == "pending":
        stream, upsert = pending_stream(lake, **limits), lake.upsert
    else:
        ensure_folder(lake.spark, lake.bronze_path)
        stream = file_stream(
            lake.spark, lake.bronze_path, lake.bronze_schema(), **{"ignore_missing_files": False, **limits}
        )
        upsert = lake.upsert_bronze

    def process(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                logger.info("Batch %d: empty, skipping.", batch_id)
                return
            upsert(batch)
            logger.info("[Silver] Batch %d: upserted", batch_id)
            if expiry_due(batch_id, 1):
                expire_silver(lake, batch_id)
        finally:
            batch.unpersist()

    return _start(stream, process, lake.checkpoint(checkpoint), trigger, f"tidemark-{checkpoint}")


def start_stateful(
    lake: Lake,
    raw: DataFrame,
    sink: Callable[[DataFrame, int], None],
    payload_format: str = "json",
    trigger: Mapping = INGEST_TRIGGER,
    checkpoint: str = "stateful",
) -> StreamingQuery:
    """Newest structs per key kept as streaming state; the sink receives changed keys only.

    State is one row per key. It holds what the silver tables hold, so the sink
    can publish it without reading a table back.
    """
    events = with_local_clocks(good_rows(decode(raw, lake.contract, payload_format)), lake.contract)

    def publish(changed: DataFrame, batch_id: int) -> None:
        # a sink may evaluate its rows several times, but the state must be advanced once
        changed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sink(changed, batch_id)
        finally:
            changed.unpersist()

    return (
        lake.newest(events)
        .writeStream.outputMode("update")
        .foreachBatch(publish)
        .queryName(f"tidemark-{checkpoint}")
        .option("checkpointLocation", lake.checkpoint(checkpoint))
        .trigger(**trigger)
        .start()
    )


def start_seeded(
    lake: Lake,
    sink: Callable[[DataFrame, int], None],
    trigger: Mapping = SILVER_TRIGGER,
    checkpoint: str = "seeded",
    **limits,
) -> StreamingQuery:
    """Keyed state that starts from silver: a fresh checkpoint needs neither a replay nor a merge with stored rows.

    It takes the place of start_silver behind ingest, whose pending rows are folded to one per key and batch, so
    that a key with a third of all events reaches its task as one row a batch. The sink receives changed keys with
    all their groups. Silver is read once, in the first batch of a checkpoint.
    """
    structs = seeded.newest_states(
        pending_stream(lake, **limits), lake.stored_structs(), lake.contract.key, lake.clocks())

    def publish(changed: DataFrame, batch_id: int) -> None:
        changed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sink(changed, batch_id)
        finally:
            changed.unpersist()

    return (
        structs.writeStream.outputMode("update")
        .foreachBatch(publish)
        .queryName(f"tidemark-{checkpoint}")
        .option("checkpointLocation", lake.checkpoint(checkpoint))
        .trigger(**trigger)
        .start()
    )
