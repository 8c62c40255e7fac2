"""Registered queries over the given tables. Each is lazy unless it has to write a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import LATEST_VALID_GROUPS, Contract, evolved, whole_row_group
from tidemark.functions.alarms import alarms_paths, alarms_struct
from tidemark.functions.clocks import date_parts, local_time, minutes_between
from tidemark.functions.validity import bms_flag, iot_flag
from tidemark.operators import compaction, digest, lifetimes, maintenance, opslog, parity, runs, traces, trend
from tidemark.operators.bronze import PARTITIONS, to_bronze, with_local_clocks
from tidemark.operators.decode import BAD_REASON, OUTCOMES, decode_counts, decode_json
from tidemark.operators.latest import (
    combine_by_joins,
    combine_one_pass,
    latest_by_row_number,
    latest_per_key,
    latest_valid,
)
from tidemark.operators.merge import SEQUENCE, fold_batches, merge_by_join, merge_pending
from tidemark.operators.sinks import BucketedTable, append_batch, file_schema, upsert_table
from tidemark.plans.device_view import DEVICE_CONTRACT as CONTRACT
from tidemark.plans.device_view import RENAME_MAP, device_rows, edge_rows, load_table
from tidemark.session import configure, configure_state_store, shared_dir
from tidemark.sources.streams import file_stream
from tidemark.sources.tables import table_inventory
from tidemark.streaming.jobs import start_ingest, start_seeded, start_silver, start_stateful
from tidemark.streaming.lake import Lake

Query = Callable[[SparkSession, str], DataFrame]

KEY = CONTRACT.key
BMS_GROUP, IOT_GROUP = LATEST_VALID_GROUPS[1], LATEST_VALID_GROUPS[2]
LATEST_GROUPS = (whole_row_group(CONTRACT),)
N_BATCHES = 5
FILES_PER_TRIGGER = 2
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
DAY_MS = 86_400_000

# The log line each kind of event stands for, and an exit code.
LOG_LINES = {
    "click": "INFO - [Bronze] Batch {n}: written (4 files)",
    "view": "INFO - [Silver] Batch {n}: skipped (cadence 1-in-10)",
    "signup": "INFO - [Silver] Batch {n} upserted",
    "purchase": "INFO - Batch {n}: empty, skipping.",
    "error": "ERROR - [Silver] Batch {n} FAILED (bronze succeeded): "
             "java.lang.IllegalStateException: stopped",
}
ERROR_LINES = {
    "click": "ERROR - stopped by java.io.IOException: no space left",
    "view": "INFO - all is well",
    "signup": "WARNING - ValueError: no such column",
    "purchase": "ERROR - Failed to reach the broker",
    "error": "ERROR - org.apache.spark.SparkException: Job aborted",
}
TRACE_LINES = {
    "click": "ERROR - [Silver] Batch {n} FAILED (bronze succeeded): org.apache.spark.SparkException: Job aborted{frames}"
             "\nCaused by: java.io.IOException: no space left\n\tat java.io.File.write(File.java:12)\n\t... 12 more"
             "\nCaused by: java.lang.IllegalStateException: stopped\n\t... 3 more",
    "view": "INFO - [Bronze] Batch {n}: written (4 files)",
    "signup": "WARNING - retrying after java.net.SocketTimeoutException: read timed out",
    "purchase": "INFO - [Silver] Batch {n}: upserted",
    "error": "ERROR - streaming query failed\nTraceback (most recent call last):"
             "\n  File \"job.py\", line 7, in run\n    start(n){frames}\nValueError: no such column",
}
TRACE_FRAME = "\n\tat org.apache.spark.Task.run(Task.scala:141)"
RUN_EXITS = (0, 137, 143, 11, 1)
EXIT_BY_TYPE = {"click": 0, "view": 137, "signup": 143, "purchase": 11, "error": 1}


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the comparison reads them."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])


def flat_alarms(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if c != CONTRACT.alarms], f"{CONTRACT.alarms}.*")


def contract_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return device_rows(spark, sf_dir).select(*CONTRACT.columns)


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_local_clocks(contract_rows(spark, sf_dir), CONTRACT)


def event_ranges(spark: SparkSession, sf_dir: str) -> list[tuple[int, int]]:
    """Event id ranges that split all events into batches, in event order."""
    first, last = load_table(spark, sf_dir, "events").agg(F.min("event_id"), F.max("event_id")).first()
    width = (last - first + N_BATCHES) // N_BATCHES
    return [(first + n * width, first + (n + 1) * width - 1) for n in range(N_BATCHES)]


def arriving(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All device rows, split into batches; each range reaches the scan as a filter."""
    rows = device_rows(spark, sf_dir)
    return [
        rows.where(F.col("event_id").between(low, high)).select(*CONTRACT.columns)
        for low, high in event_ranges(spark, sf_dir)
    ]


def batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The arriving rows with their clocks converted for silver."""
    return [with_local_clocks(rows, CONTRACT) for rows in arriving(spark, sf_dir)]


# ---- decode

def with_payload(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    """Device rows as JSON payloads; the payloads of error events may arrive cut short."""
    payload = F.to_json(F.struct(*CONTRACT.columns))
    if damaged:
        payload = F.when(F.col("event_type") == "error", F.substring(payload, 1, 20)).otherwise(payload)
    return device_rows(spark, sf_dir).select("event_id", payload.alias("value"))


def decode_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    small = Contract(
        schema=T.StructType([T.StructField("k", T.IntegerType())]),
        rename_map={},
        key="k",
        epoch_columns=(),
    )
    payloads = load_table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.substring("props", 1, 3))
        .otherwise(F.col("props")).alias("value"),
    )
    return decode_json(payloads, small, keep=["event_id"]).select("event_id", "k")


def decode_device_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_json(with_payload(spark, sf_dir, damaged=True), CONTRACT, keep=["event_id"])
    return decoded.select("event_id", *CONTRACT.columns, F.col(BAD_REASON).alias("reason"))


def decode_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_counts(decode_json(with_payload(spark, sf_dir, damaged=True), CONTRACT), CONTRACT)


# ---- bronze

def bronze_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return device_rows(spark, sf_dir).select(
        "event_id",
        minutes_between("pushedAt", "ts").alias("timeLatency"),
        minutes_between("consumedAt", "pushedAt").alias("consumedLatency"),
    )


def bronze_time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = local_time("ts", CONTRACT.zone)
    return plain_times(device_rows(spark, sf_dir).select(
        "event_id", ts.alias("ts"), *[c.alias(name) for name, c in date_parts(ts).items()]
    ))


def silver_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_local_clocks(device_rows(spark, sf_dir), CONTRACT)
    return plain_times(rows.select("event_id", *CONTRACT.epoch_columns))


def alarms_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = alarms_struct("alarms", T.StringType(), RENAME_MAP)
    return flat_alarms(device_rows(spark, sf_dir).select("event_id", parsed.alias("alarms")))


def alarms_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = alarms_paths("alarms", RENAME_MAP)
    return flat_alarms(device_rows(spark, sf_dir).select("event_id", parsed.alias("alarms")))


def alarms_struct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = device_rows(spark, sf_dir).select(
        "event_id",
        F.struct(
            (F.col("event_id") % 97).alias("k"), (F.col("voltage") > 70).alias("ov")
        ).alias("alarms"),
    )
    renamed = alarms_struct("alarms", source.schema["alarms"].dataType, RENAME_MAP)
    return flat_alarms(source.select("event_id", renamed.alias("alarms")))


def bronze_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(flat_alarms(to_bronze(contract_rows(spark, sf_dir), CONTRACT)))


def bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze appended batch by batch, the second batch twice, read back from the table."""
    path = shared_dir(spark, "bronze")
    stored = [
        to_bronze(rows, CONTRACT).withColumn("batch_id", F.lit(n).cast("long"))
        for n, rows in enumerate(arriving(spark, sf_dir))
    ]
    for n in [*range(N_BATCHES), 1]:
        append_batch(stored[n], path, f"b{n}", PARTITIONS)
    schema = file_schema(stored[0].schema, PARTITIONS)
    return plain_times(flat_alarms(spark.read.schema(schema).parquet(path).drop("batch_key")))


def bronze_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze appended batch by batch, then all days but the last rewritten as one batch folder each."""
    path = shared_dir(spark, "bronze")
    stored = [
        to_bronze(rows, CONTRACT).withColumn("batch_id", F.lit(n).cast("long"))
        for n, rows in enumerate(arriving(spark, sf_dir))
    ]
    for n in range(N_BATCHES):
        append_batch(stored[n], path, f"b{n}", PARTITIONS)
    schema = file_schema(stored[0].schema, PARTITIONS)
    last = spark.read.schema(schema).parquet(path).agg(F.max(F.make_date(*PARTITIONS))).first()[0]
    if last is not None:
        compaction.compact(spark, path, schema, last)
    return plain_times(flat_alarms(spark.read.schema(schema).parquet(path).drop("batch_key")))


def bronze_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two halves of bronze under two contracts: the older lacks a column, has one that went, and narrower numbers."""
    rows = to_bronze(contract_rows(spark, sf_dir), CONTRACT)
    newer = F.col("soc") % 2 == 0
    old = rows.where(~newer).withColumns({
        "soc": F.col("soc").cast("int"), "lat": F.col("lat").cast("float"), "firmware": F.col("deviceID").cast("string"),
        "alarms": F.struct(F.col("alarms.alarmK").alias("alarmK"))}).drop("temperature")
    paths = [shared_dir(spark, name) for name in ("older", "newer")]
    for df, path in zip((old, rows.where(newer)), paths):
        df.write.parquet(path)
    return plain_times(flat_alarms(evolved([spark.read.parquet(p) for p in paths])))


# ---- latest state

def validity_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return device_rows(spark, sf_dir).select(
        "event_id", bms_flag().alias("isBMSValid"), iot_flag().alias("isIoTValid")
    )


def latest_per_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(latest_per_key(silver_rows(spark, sf_dir), KEY))


def latest_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(latest_by_row_number(silver_rows(spark, sf_dir), KEY))


def bms_valid_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(latest_valid(silver_rows(spark, sf_dir), KEY, BMS_GROUP))


def iot_valid_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(latest_valid(silver_rows(spark, sf_dir), KEY, IOT_GROUP))


def silver_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(combine_by_joins(silver_rows(spark, sf_dir), KEY, LATEST_VALID_GROUPS))


def silver_combined_onepass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(combine_one_pass(silver_rows(spark, sf_dir), KEY, LATEST_VALID_GROUPS))


# ---- merge

def silver_merge_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = batches(spark, sf_dir)
    return plain_times(fold_batches(parts, KEY, LATEST_VALID_GROUPS))


def silver_merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = batches(spark, sf_dir)
    return plain_times(fold_batches(parts, KEY, LATEST_GROUPS))


def silver_merge_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, *rest = [
        combine_one_pass(b, KEY, LATEST_VALID_GROUPS) for b in batches(spark, sf_dir)
    ]
    for incoming in rest:
        first = merge_by_join(first, incoming, KEY, LATEST_VALID_GROUPS)
    return plain_times(first)


def cadence_catchup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first batch creates the table, all later ones wait and are merged together."""
    first, *waiting = batches(spark, sf_dir)
    stored = fold_batches([first], KEY, LATEST_VALID_GROUPS)
    return plain_times(merge_pending(stored, waiting, KEY, LATEST_VALID_GROUPS))


def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batches merged into a bucketed table, one after the other."""
    table = BucketedTable(spark, shared_dir(spark, "silver"), KEY)
    for batch in batches(spark, sf_dir):
        upsert_table(table, combine_one_pass(batch, KEY, LATEST_VALID_GROUPS), LATEST_VALID_GROUPS)
    return plain_times(table.read())


def silver_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = to_bronze(contract_rows(spark, sf_dir), CONTRACT)
    return plain_times(flat_alarms(parity.rebuild_latest(bronze, CONTRACT, LATEST_VALID_GROUPS)))


# ---- streams

def new_lake(spark: SparkSession) -> Lake:
    """Empty tables in a fresh shared folder."""
    return Lake(spark, shared_dir(spark, "lake"), CONTRACT)


def payload_stream(spark: SparkSession, sf_dir: str, lake: Lake, damaged: bool = False, skip: int = 0) -> DataFrame:
    """Events as payload files, read back as a stream of a few micro-batches; all of them, or without the first batches."""
    landing = f"{lake.root}/landing"
    ranges = event_ranges(spark, sf_dir)
    number = F.coalesce(*[
        F.when(F.col("event_id") <= high, F.lit(n)) for n, (_, high) in enumerate(ranges)
    ])
    payloads = with_payload(spark, sf_dir, damaged).where(F.col("event_id") >= ranges[skip][0]).select(number.alias("batch"), "value")
    payloads.hint("rebalance", "batch").write.partitionBy("batch").parquet(landing)
    return file_stream(spark, landing, "value string", max_files_per_trigger=FILES_PER_TRIGGER)


def _run(query) -> None:
    try:
        query.awaitTermination()
    finally:
        query.stop()


ONCE = {"availableNow": True}


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark)
    payloads = payload_stream(spark, sf_dir, lake)
    _run(start_ingest(lake, payloads, silver_every=None, trigger=ONCE, pending=False))
    stored = lake.read_bronze().drop("batch_key", "batch_id", "ingest_ts")
    return plain_times(flat_alarms(stored))


def _combined(spark: SparkSession, sf_dir: str) -> Lake:
    lake = new_lake(spark)
    _run(start_ingest(lake, payload_stream(spark, sf_dir, lake), silver_every=2, trigger=ONCE))
    lake.merge_pending()
    return lake


def stream_silver_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(_combined(spark, sf_dir).latest_valid.read())


def stream_silver_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(_combined(spark, sf_dir).latest.read())


def stream_chain_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark)
    _run(start_ingest(lake, payload_stream(spark, sf_dir, lake), silver_every=None, trigger=ONCE))
    _run(start_silver(lake, trigger=ONCE))
    return plain_times(lake.latest_valid.read())


def stream_bronze_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver from a bronze table that was filled beforehand."""
    lake = new_lake(spark)
    payloads = payload_stream(spark, sf_dir, lake)
    _run(start_ingest(lake, payloads, silver_every=None, trigger=ONCE, pending=False))
    _run(start_silver(lake, trigger=ONCE, source="bronze"))
    return plain_times(flat_alarms(lake.latest_valid.read()))


def stream_stateful_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure_state_store(spark)
    lake = new_lake(spark)
    table = lake.latest_valid

    def publish(changed: DataFrame, batch_id: int) -> None:
        lake.upsert(changed)

    _run(start_stateful(lake, payload_stream(spark, sf_dir, lake), publish, trigger=ONCE))
    return plain_times(table.read())


def state_readback_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stateful query knows after all events, read from its checkpoint; the query itself writes nothing."""
    configure_state_store(spark)
    lake = new_lake(spark)
    _run(start_stateful(lake, payload_stream(spark, sf_dir, lake), lambda changed, batch_id: changed.count(), trigger=ONCE))
    return plain_times(lake.read_state().select(KEY, *[f"g{i}.*" for i in range(len(LATEST_VALID_GROUPS))]))


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by outcome over all batches of a stream with damaged payloads, from what each batch observed."""
    lake = new_lake(spark)
    _run(start_ingest(lake, payload_stream(spark, sf_dir, lake, damaged=True), silver_every=2, trigger=ONCE))
    sums = lake.read_progress().agg(*[F.sum(F.col("outcomes")[o]).alias(o) for o in OUTCOMES])
    by_outcome = F.explode(F.create_map(*[x for o in OUTCOMES for x in (F.lit(o), F.col(o))])).alias("outcome", "n_rows")
    return sums.select(by_outcome).where("n_rows > 0")


def stream_seeded_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver holds the first batches; only the others are streamed, into state that starts from silver.

    The result is the state itself, whose keys without a new event are known from silver alone.
    """
    configure_state_store(spark)
    lake = new_lake(spark)
    half = N_BATCHES // 2 + 1
    for n, rows in enumerate(batches(spark, sf_dir)[:half]):
        lake.upsert(lake.newest(rows).withColumn(SEQUENCE, F.lit(n)))
    _run(start_ingest(lake, payload_stream(spark, sf_dir, lake, skip=half), silver_every=None, trigger=ONCE))
    _run(start_seeded(lake, lambda changed, batch_id: changed.count(), trigger=ONCE))
    return plain_times(lake.read_seeded().select(KEY, *[f"g{i}.*" for i in range(len(LATEST_VALID_GROUPS))]))


# ---- upkeep and operations data

def commit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as commits: one table per event type."""
    return load_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("table"),
        F.col("event_id").alias("snapshot_id"),
        F.col("ts").cast("timestamp").alias("committed_at"),
    )


def snapshot_expire_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    cutoff = maintenance.hours_before(F.lit("2024-01-30 00:00:00").cast("timestamp"))
    return plain_times(maintenance.expirable_snapshots(commit_history(spark, sf_dir), cutoff))


def maintenance_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load_table(spark, sf_dir, "events")
    return maintenance.schedule(events.select(F.col("event_id").alias("batch_id")))


def snapshot_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.snapshot_growth(commit_history(spark, sf_dir))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.coalesce(*[
        F.when(F.col("event_type") == kind, F.replace(F.lit(text), F.lit("{n}"), F.col("event_id").cast("string")))
        for kind, text in LOG_LINES.items()
    ])
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS")
    return load_table(spark, sf_dir, "events").select(F.concat_ws(" - ", stamp, line).alias("text"))


def batch_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(opslog.parse_batches(log_lines(spark, sf_dir)))


def device_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = device_rows(spark, sf_dir).select(KEY, "ts", "event_id")
    return opslog.batch_gaps(rows, KEY, "ts", "event_id")


def batch_lag_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return opslog.lag_trend(device_gaps(spark, sf_dir), KEY, "ts", period_ms=DAY_MS)


def error_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return opslog.error_summary(log_lines(spark, sf_dir))


def exit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.coalesce(*[
        F.when(F.col("event_type") == kind, F.lit(value)) for kind, value in EXIT_BY_TYPE.items()
    ])
    per_code = load_table(spark, sf_dir, "events").groupBy(code.alias("code")).agg(
        F.count("*").alias("n_exits")
    )
    return opslog.classify_exits(per_code).select("code", "reason", "meaning", "n_exits")


def order_copy(orders: DataFrame) -> DataFrame:
    """A copy of orders that lost the dearest ones and changed some urgent ones."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return orders.where(F.col("o_totalprice") <= 450_000).withColumns({
        "o_orderstatus": F.when(urgent & (F.col("o_orderstatus") == "P"), "F").otherwise(F.col("o_orderstatus")),
        "o_custkey": F.when(urgent & (F.col("o_totalprice") < 50_000), None).otherwise(F.col("o_custkey")),
    })


def parity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load_table(spark, sf_dir, "orders")
    return parity.row_diff(orders, order_copy(orders))


def parity_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load_table(spark, sf_dir, "orders")
    return parity.column_diff(orders, order_copy(orders), ["o_orderkey"])


def parity_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load_table(spark, sf_dir, "orders")
    return digest.digest_diff(orders, order_copy(orders), ["o_orderkey"])


def snapshot_lifetimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(lifetimes.snapshot_lifetimes(commit_history(spark, sf_dir)))


def snapshot_retained_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(lifetimes.retained_curve(lifetimes.snapshot_lifetimes(commit_history(spark, sf_dir))))


def behind_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether batch times, and the sizes of large tasks, creep up over all hours of the log."""
    behind = opslog.parse_behind(warning_lines(spark, sf_dir))
    points = trend.bucket_means(behind, "kind", F.col("logged_at"), F.coalesce("took_ms", "task_kib"))
    return trend.trend_verdict(points, "kind")


def trace_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record for each event, of one line or of several."""
    frames = F.repeat(F.lit(TRACE_FRAME), (F.col("event_id") % 4).cast("int"))
    record = F.coalesce(*[
        F.when(F.col("event_type") == kind, F.replace(F.replace(F.lit(text), F.lit("{n}"), F.col("event_id").cast("string")), F.lit("{frames}"), frames))
        for kind, text in TRACE_LINES.items()
    ])
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS")
    return load_table(spark, sf_dir, "events").select(F.concat_ws(" - ", stamp, record).alias("text"))


def error_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of several lines written to log files, read back line by line and put together again."""
    path = shared_dir(spark, "log")
    trace_lines(spark, sf_dir).write.text(path)
    return plain_times(traces.error_traces(traces.read_ordered_lines(spark, path)).drop("file"))


def run_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of three jobs: a batch line for each event, or the exit of the job's driver."""
    number = F.col("event_id").cast("string")
    codes = F.array(*map(F.lit, RUN_EXITS))
    code = F.element_at(codes, (F.expr("event_id div 97") % len(RUN_EXITS) + 1).cast("int")).cast("string")
    line = F.when(F.col("event_id") % 97 == 0, F.concat(F.lit("INFO - driver ended, exit code "), code)).otherwise(
        F.concat(F.lit("INFO - [Bronze] Batch "), number, F.lit(": written (4 files)")))
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS")
    return load_table(spark, sf_dir, "events").select((F.col("event_id") % 3).alias("job"), F.concat_ws(" - ", stamp, line).alias("text"))


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = run_lines(spark, sf_dir)
    return plain_times(runs.run_summary(opslog.parse_batches(lines, ["job"]), runs.parse_exits(lines, ["job"]), "job"))


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_inventory({t: load_table(spark, sf_dir, t) for t in TABLES})


# ---- edge rows: no key, no clock, ties, late rows, clocks beyond the calendar, all alarm fields

def edge_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_local_clocks(edge_rows(spark, sf_dir).select("event_id", *CONTRACT.columns), CONTRACT)


def decode_clock_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of payloads whose side clocks may be out of range: none is withheld."""
    rows = edge_rows(spark, sf_dir).select("event_id", F.to_json(F.struct(*CONTRACT.columns)).alias("value"))
    decoded = decode_json(rows, CONTRACT, keep=["event_id"])
    latency = [minutes_between("pushedAt", "ts").alias("timeLatency"),
               minutes_between("consumedAt", "pushedAt").alias("consumedLatency")]
    return plain_times(decoded.select(
        "event_id", "deviceID", local_time("ts", CONTRACT.zone).alias("ts"), "pushedAt", "consumedAt", *latency,
        local_time("pushedAt", CONTRACT.zone).alias("pushed_local"), F.col(BAD_REASON).alias("reason")))


def latest_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(latest_per_key(edge_silver(spark, sf_dir).drop("event_id"), KEY))


def latest_tiebreak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clocks of the same hour tie, and the larger event id decides."""
    return plain_times(latest_per_key(edge_silver(spark, sf_dir), KEY, tiebreak="event_id"))


def silver_combined_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(combine_one_pass(edge_silver(spark, sf_dir), KEY, LATEST_VALID_GROUPS))


def silver_merge_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches by id range; clocks of the same hour tie across them, and the earlier batch stays."""
    rows = edge_silver(spark, sf_dir)
    parts = [rows.where(F.col("event_id").between(*r)).drop("event_id") for r in event_ranges(spark, sf_dir)]
    return plain_times(fold_batches(parts, KEY, LATEST_VALID_GROUPS))


def silver_table_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batches through the stored table."""
    rows = edge_silver(spark, sf_dir)
    table = BucketedTable(spark, shared_dir(spark, "silver"), KEY, buckets=3)
    for r in event_ranges(spark, sf_dir):
        part = rows.where(F.col("event_id").between(*r)).drop("event_id")
        upsert_table(table, combine_one_pass(part, KEY, LATEST_VALID_GROUPS), LATEST_VALID_GROUPS)
    return plain_times(table.read())


def stream_silver_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive out of clock order and hold rows without a key."""
    lake = new_lake(spark)
    late = device_rows(spark, sf_dir).withColumn(
        KEY, F.when(F.col("event_id") % 13 != 0, F.col(KEY)))
    number = F.pmod(F.xxhash64("event_id"), F.lit(N_BATCHES)).alias("batch")
    payloads = late.select(number, F.to_json(F.struct(*CONTRACT.columns)).alias("value"))
    payloads.hint("rebalance", "batch").write.partitionBy("batch").parquet(f"{lake.root}/landing")
    stream = file_stream(spark, f"{lake.root}/landing", "value string", max_files_per_trigger=FILES_PER_TRIGGER)
    _run(start_ingest(lake, stream, silver_every=2, trigger=ONCE))
    lake.merge_pending()
    return plain_times(lake.latest_valid.read())


def alarms_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = alarms_struct("alarms", T.StringType(), RENAME_MAP)
    return flat_alarms(edge_rows(spark, sf_dir).select("event_id", parsed.alias("alarms")))


def batch_gaps_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps where many rows have no series; every clock is its own."""
    rows = device_rows(spark, sf_dir).select(
        F.when(F.col("event_id") % 3 != 0, F.col(KEY) % 7).alias(KEY), "ts", "event_id")
    return opslog.batch_gaps(rows, KEY, "ts", "event_id")


def error_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.coalesce(*[F.when(F.col("event_type") == kind, F.lit(text)) for kind, text in ERROR_LINES.items()])
    return load_table(spark, sf_dir, "events").select(line.alias("text"))


def error_scan_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return opslog.error_summary(error_lines(spark, sf_dir))


def warning_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A warning or a plain line per event, with times taken and task sizes that follow from it."""
    number = F.col("event_id").cast("string")
    took = (30_000 + F.col("event_id") % 9_973).cast("string")
    size = (1_000 + F.col("event_id") % 4_001).cast("string")
    line = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("WARN ProcessingTimeExecutor: Current batch is falling behind. "
               "The trigger interval is 30000 milliseconds, but spent "), took, F.lit(" milliseconds")))
        .when(F.col("event_type") == "purchase", F.concat(F.lit("WARN DAGScheduler: Stage "), number, F.lit(
            " contains a task of very large size ("), size, F.lit(" KiB). The maximum recommended task size is 1000 KiB.")))
        .otherwise(F.concat(F.lit("INFO MicroBatchExecution: Streaming query made progress "), number))
    )
    return load_table(spark, sf_dir, "events").select(
        F.concat_ws(" ", F.date_format("ts", "yy/MM/dd HH:mm:ss"), line).alias("text"))


def behind_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(opslog.parse_behind(warning_lines(spark, sf_dir)))


def behind_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(opslog.behind_trend(opslog.parse_behind(warning_lines(spark, sf_dir))))


_QUERIES: dict[str, Query] = {
    "decode_permissive": decode_permissive,
    "decode_device_rows": decode_device_rows,
    "decode_outcomes": decode_outcomes,
    "bronze_latency": bronze_latency,
    "bronze_time_parts": bronze_time_parts,
    "silver_times": silver_times,
    "alarms_json": alarms_json,
    "alarms_by_path": alarms_by_path,
    "alarms_struct": alarms_struct_rows,
    "bronze_full": bronze_full,
    "bronze_table": bronze_table,
    "bronze_compacted": bronze_compacted,
    "bronze_evolved": bronze_evolved,
    "validity_flags": validity_flags,
    "latest_per_device": latest_per_device,
    "latest_row_number": latest_row_number,
    "bms_valid_latest": bms_valid_latest,
    "iot_valid_latest": iot_valid_latest,
    "silver_combined": silver_combined,
    "silver_combined_onepass": silver_combined_onepass,
    "silver_merge_valid": silver_merge_valid,
    "silver_merge_latest": silver_merge_latest,
    "silver_merge_join": silver_merge_join,
    "cadence_catchup": cadence_catchup,
    "silver_table": silver_table,
    "silver_rebuild": silver_rebuild,
    "stream_bronze": stream_bronze,
    "stream_silver_valid": stream_silver_valid,
    "stream_silver_latest": stream_silver_latest,
    "stream_chain_valid": stream_chain_valid,
    "stream_bronze_valid": stream_bronze_valid,
    "stream_stateful_valid": stream_stateful_valid,
    "state_readback_valid": state_readback_valid,
    "stream_progress": stream_progress,
    "stream_seeded_valid": stream_seeded_valid,
    "snapshot_expire_select": snapshot_expire_select,
    "maintenance_schedule": maintenance_schedule,
    "snapshot_growth": snapshot_growth,
    "batch_log_parse": batch_log_parse,
    "batch_gaps": device_gaps,
    "batch_lag_trend": batch_lag_trend,
    "error_scan": error_scan,
    "exit_codes": exit_codes,
    "parity_rows": parity_rows,
    "parity_columns": parity_columns,
    "parity_digest": parity_digest,
    "snapshot_lifetimes": snapshot_lifetimes,
    "snapshot_retained_curve": snapshot_retained_curve,
    "behind_verdict": behind_verdict,
    "error_traces": error_traces,
    "run_summary": run_summary,
    "table_inventory": inventory,
    "decode_clock_edges": decode_clock_edges,
    "latest_edges": latest_edges,
    "latest_tiebreak": latest_tiebreak,
    "silver_combined_edges": silver_combined_edges,
    "silver_merge_edges": silver_merge_edges,
    "silver_table_edges": silver_table_edges,
    "stream_silver_late": stream_silver_late,
    "alarms_full": alarms_full,
    "batch_gaps_nulls": batch_gaps_nulls,
    "error_scan_classes": error_scan_classes,
    "behind_lines": behind_lines,
    "behind_trend": behind_trend,
}


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


def queries() -> dict[str, Query]:
    return {name: _prepared(query) for name, query in _QUERIES.items()}
