"""When silver runs, which failures may wait, and how a running query is watched."""

from __future__ import annotations

import logging
from collections import deque
from collections.abc import Callable

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.operators.maintenance import EXPIRE_EVERY, SILVER_EVERY
from tidemark.operators.opslog import TRIGGER_MS

logger = logging.getLogger("tidemark")

# Error names of commits that lost a race against table maintenance.
TRANSIENT_ERRORS = ("CommitFailedException", "ConflictException")


def is_transient(error: BaseException) -> bool:
    return any(name in str(error) for name in TRANSIENT_ERRORS)


def silver_due(batch_id: int, every: int = SILVER_EVERY) -> bool:
    return batch_id % every == 0


def expiry_due(batch_id: int, silver_every: int = SILVER_EVERY, every: int = EXPIRE_EVERY) -> bool:
    run = batch_id // silver_every
    return silver_due(batch_id, silver_every) and run > 0 and run % every == 0


class BatchTimes(StreamingQueryListener):
    """Keeps the last batch times and warns about batches slower than the trigger."""

    def __init__(self, trigger_ms: int = TRIGGER_MS, keep: int = 100):
        self.trigger_ms = trigger_ms
        self.recent: deque = deque(maxlen=keep)
        self.failures: deque = deque(maxlen=keep)

    def onQueryStarted(self, event):
        logger.info("query %s started", event.name or event.id)

    def onQueryProgress(self, event):
        progress = event.progress
        took = progress.batchDuration
        self.recent.append((progress.batchId, took, progress.numInputRows))
        if took > self.trigger_ms:
            logger.warning("Batch %d: falling behind, %d ms", progress.batchId, took)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            self.failures.append(event.exception)
            logger.error("query %s failed: %s", event.id, event.exception)


def supervise(*queries: StreamingQuery, tick: Callable[[], None] | None = None) -> None:
    """Wait until any query ends; report its error, stop the others, raise.

    tick is called every second or so in between; its failure counts as a query's.
    """
    try:
        while all(q.isActive for q in queries):
            queries[0].awaitTermination(1)
            if tick is not None:
                tick()
        for query in queries:
            error = query.exception()
            if error is not None:
                raise error
    except Exception as e:
        logger.error("streaming query failed: %s", e)
        raise
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
