"""Session settings every job shares, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Clock columns are shifted to local wall-clock values with from_utc_timestamp,
# which is only right when the session itself runs in UTC.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # tasks that write a few partitions or buckets keep them open instead of sorting first
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}

# State of many keys belongs outside the heap, and a commit should cost what a batch changed.
STATE_STORE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the transforms rely on to an existing session."""
    for name, value in SESSION_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def configure_state_store(spark: SparkSession) -> SparkSession:
    """Keep keyed streaming state in RocksDB with changelog checkpoints."""
    for name, value in STATE_STORE_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app_name: str, extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SESSION_SETTINGS, **(extra or {})}.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


_scratch: list[str] = []
SCRATCH_TABLES = "tidemark_"


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below spark.checkpoint.dir, which all executors can reach.

    Without that setting it lies below the warehouse, which is shared as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    path = f"{base.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete the folders handed out by shared_dir in this process, and the catalog entries that point into them."""
    from tidemark.sources.files import delete

    for table in spark.catalog.listTables("default"):
        if table.name.startswith(SCRATCH_TABLES) and not table.isTemporary:
            rows = spark.sql(f"DESCRIBE FORMATTED spark_catalog.default.`{table.name}`").where("col_name = 'Location'").collect()
            if rows and any(f"/{path.rsplit('/', 1)[-1]}" in rows[0]["data_type"] for path in _scratch):
                spark.sql(f"DROP TABLE IF EXISTS spark_catalog.default.`{table.name}`")
    released = 0
    while _scratch:
        released += delete(spark, _scratch.pop())
    return released
