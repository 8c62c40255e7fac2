import json
import logging
import os
import threading
import time
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.contracts import LATEST_VALID_GROUPS
from tidemark.operators import compaction
from tidemark.operators.bronze import with_local_clocks
from tidemark.operators.decode import decode, good_rows
from tidemark.operators.latest import combine_one_pass
from tidemark.operators.merge import merge_sql
from tidemark.operators.opslog import parse_batches
from tidemark.plans.device_view import DEVICE_CONTRACT as CONTRACT
from tidemark.session import configure_state_store
from tidemark.sources import files
from tidemark.sources.state import read_state, state_operators
from tidemark.sources.streams import file_options, file_stream, kafka_options
from tidemark.streaming import app
from tidemark.streaming.jobs import expire_silver, quiet_merge, start_ingest, start_seeded, start_silver, start_stateful
from tidemark.streaming.lake import CatalogLake, Lake
from tidemark.streaming.policy import BatchTimes, expiry_due, is_transient, silver_due, supervise

ONCE = {"availableNow": True}
KEY = CONTRACT.key


def payload(device, minute, **changes):
    ms = 1_704_067_200_000 + minute * 60_000
    return json.dumps({
        "deviceID": device, "ts": ms, "originalTs": ms, "pushedAt": ms + 1000, "consumedAt": ms + 2000,
        "voltage": 50.0, "soc": 1.0, "current": 1.0, "temperature": 1.0, "cellVolt": 3.0, "cellTemp": 2.0,
        "lat": 1.0, "lon": 70.0, "alarms": '{"k": %d}' % minute, **changes})


class Landing:
    """A folder of payload files, one file per micro-batch, in writing order."""

    def __init__(self, spark, tmp_path):
        self.spark, self.path, self.texts = spark, tmp_path / "landing", []
        self.path.mkdir()

    def add(self, *texts):
        n = len(list(self.path.iterdir()))
        file = self.path / f"{n:04d}.txt"
        file.write_text("\n".join(texts) + "\n")
        stamp = time.time() - 10_000 + n
        os.utime(file, (stamp, stamp))
        self.texts += texts

    def stream(self):
        return file_stream(self.spark, str(self.path), "value string", "text", max_files_per_trigger=1)

    def expected(self):
        """Latest valid state of all payloads so far, computed at once."""
        raw = self.spark.createDataFrame([(t,) for t in self.texts], "value string")
        events = with_local_clocks(good_rows(decode(raw, CONTRACT)), CONTRACT)
        return rows(combine_one_pass(events, KEY, LATEST_VALID_GROUPS))


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), CONTRACT, buckets=2)


def run(query):
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return query


def ingest(lake, landing, every=2, **options):
    return run(start_ingest(lake, landing.stream(), silver_every=every, trigger=ONCE, **options))


def test_combined_query_loses_nothing_between_silver_runs(spark, lake, landing, caplog):
    caplog.set_level(logging.INFO, "tidemark")
    landing.add(payload(1, 1), payload(2, 1, voltage=0.0))
    landing.add(payload(2, 2), "broken {", payload(3, 1, lon=0.0))  # device 3 only in a skipped batch
    landing.add(payload(1, 3, voltage=75.0), payload(1, 2), payload(None, 9))
    query = ingest(lake, landing)
    assert [p.batchId for p in query.recentProgress if p.numInputRows] == [0, 1, 2]  # admission control
    assert rows(lake.latest_valid.read()) == landing.expected()
    assert rows(lake.latest.read(), KEY, "alarms") == [(1, '{"k": 3}'), (2, '{"k": 2}'), (3, '{"k": 1}')]
    assert lake.read_bronze().count() == 7
    refused = spark.read.parquet(lake.quarantine_path)
    assert rows(refused, "payload", "reason") == [("broken {", "corrupt")]
    lines = spark.createDataFrame([(r.getMessage(),) for r in caplog.records], "text string")
    assert rows(parse_batches(lines), "batch_id", "outcome") == [
        (0, "upserted"), (0, "written"), (1, "skipped"), (1, "written"), (2, "upserted"), (2, "written")]


def test_restart_and_fresh_checkpoint(lake, landing):
    landing.add(payload(1, 1))
    ingest(lake, landing)
    landing.add(payload(1, 2))
    landing.add(payload(2, 2))
    ingest(lake, landing)  # batches 1 and 2 from the same checkpoint
    assert lake.read_bronze().count() == 3
    assert rows(lake.latest_valid.read()) == landing.expected()
    # batch ids start again at 0: bronze rows of the old run stay, silver does not change
    ingest(lake, landing, checkpoint="second")
    assert lake.read_bronze().count() == 6
    assert rows(lake.latest_valid.read()) == landing.expected()


def test_failure_between_bronze_and_silver_is_replayed_once(lake, landing, monkeypatch):
    landing.add(payload(1, 1), payload(2, 1))
    real = Lake.merge_pending
    monkeypatch.setattr(Lake, "merge_pending", lambda self, spark=None: 1 / 0)
    with pytest.raises(Exception, match="division by zero"):
        ingest(lake, landing)
    assert lake.read_bronze().count() == 2 and lake.latest.read() is None
    monkeypatch.setattr(Lake, "merge_pending", real)
    ingest(lake, landing)
    assert lake.read_bronze().count() == 2  # the replayed batch replaced itself
    assert rows(lake.latest_valid.read()) == landing.expected()


def test_failure_between_the_two_silver_tables(lake, landing, monkeypatch):
    landing.add(payload(1, 1), payload(2, 1))
    from tidemark.streaming import lake as module

    real, calls = module.upsert_table, []

    def second_fails(table, incoming, groups):
        calls.append(table.path)
        if len(calls) == 2:
            raise RuntimeError("lost executor")
        return real(table, incoming, groups)

    monkeypatch.setattr(module, "upsert_table", second_fails)
    with pytest.raises(Exception, match="lost executor"):
        ingest(lake, landing)
    assert lake.latest_valid.read().count() == 2 and lake.latest.read() is None
    ingest(lake, landing)
    assert rows(lake.latest_valid.read()) == landing.expected()
    assert lake.latest.read().count() == 2


def test_commit_conflict_keeps_the_batches_for_the_next_run(lake, landing, monkeypatch, caplog):
    landing.add(payload(1, 1))
    landing.add(payload(2, 1))
    real, calls = Lake.merge_pending, []

    def first_conflicts(self, spark=None):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("org.example.CommitFailedException: token changed")
        return real(self, spark)

    monkeypatch.setattr(Lake, "merge_pending", first_conflicts)
    ingest(lake, landing, every=1)
    assert "transient commit conflict" in caplog.text
    assert rows(lake.latest_valid.read()) == landing.expected()


def test_bronze_failure_stops_before_silver(lake, landing, monkeypatch):
    landing.add(payload(1, 1))
    monkeypatch.setattr(Lake, "write_bronze", lambda *a: 1 / 0)
    with pytest.raises(Exception):
        ingest(lake, landing)
    assert lake.latest.read() is None and lake.merge_pending() == 0


def test_chain_of_two_queries(lake, landing):
    landing.add(payload(1, 1), payload(2, 1, lon=-1.0))
    ingest(lake, landing, every=None)
    run(start_silver(lake, ONCE))
    assert lake.latest_valid.read().count() == 2
    landing.add(payload(2, 2), payload(1, 0), payload(3, 5, voltage=None))
    landing.add(payload(3, 6), payload(2, 1))
    ingest(lake, landing, every=None)
    run(start_silver(lake, ONCE))
    assert rows(lake.latest_valid.read()) == landing.expected()
    assert rows(lake.latest.read(), KEY, "alarms") == [(1, '{"k": 1}'), (2, '{"k": 2}'), (3, '{"k": 6}')]


def test_silver_from_a_filled_bronze_table(lake, landing):
    landing.add(payload(1, 1), payload(2, 1, lon=-1.0))
    landing.add(payload(2, 2), payload(1, 0), payload(3, 5, voltage=None))
    ingest(lake, landing, every=None, pending=False)
    run(start_silver(lake, ONCE, source="bronze", max_files_per_trigger=1))
    flat = lake.latest_valid.read()
    drop = flat.columns.index("alarms")

    def without_alarms(data):
        return [r[:drop] + r[drop + 1:] for r in data]

    assert without_alarms(rows(flat.withColumn("alarms", F.to_json("alarms")))) == without_alarms(landing.expected())
    assert rows(flat, KEY, "alarms.alarmK") == [(1, "1"), (2, "2"), (3, None)]


@pytest.mark.parametrize("source,method", [("pending", "upsert"), ("bronze", "upsert_bronze")])
def test_failed_silver_batch_comes_again(lake, landing, monkeypatch, source, method):
    landing.add(payload(1, 1))
    ingest(lake, landing, every=None)
    real = getattr(Lake, method)
    monkeypatch.setattr(Lake, method, lambda *a: 1 / 0)
    with pytest.raises(Exception, match="division by zero"):
        run(start_silver(lake, ONCE, source=source))
    monkeypatch.setattr(Lake, method, real)
    run(start_silver(lake, ONCE, source=source))
    assert lake.latest_valid.read().count() == 1


def test_rows_without_a_clock(lake, landing):
    landing.add(payload(1, 1, ts=None), payload(2, 1, ts=None))
    landing.add(payload(1, 2))
    ingest(lake, landing, every=1)
    assert rows(lake.read_bronze(), KEY, "year", "day") == [(1, None, None), (1, 2024, 1), (2, None, None)]
    assert rows(lake.latest_valid.read()) == landing.expected()
    assert [r.ts is None for r in lake.latest.read().orderBy(KEY).collect()] == [False, True]


def test_batch_of_refused_payloads_only(spark, lake, landing):
    landing.add("broken {", "")
    landing.add(payload(1, 1))
    ingest(lake, landing, every=1)
    assert spark.read.parquet(lake.quarantine_path).count() == 2
    assert lake.read_bronze().count() == 1
    assert rows(lake.latest_valid.read()) == landing.expected()


def test_bronze_days_are_read_from_their_folders(lake, landing):
    landing.add(payload(1, 0), payload(1, 1440), payload(1, 2 * 1440))
    ingest(lake, landing, every=None, pending=False)
    day = date(2024, 1, 2)
    assert lake.read_bronze(day, day).select("day").distinct().count() == 1
    assert lake.read_bronze(day, day + timedelta(7)).count() == 2
    assert lake.read_bronze(date(2020, 1, 1), date(2020, 1, 2)).count() == 0


def test_stateful_latest(spark, lake, landing):
    configure_state_store(spark)
    for minute in range(3):
        landing.add(payload(1, minute, voltage=[50.0, 0.0, 80.0][minute]), payload(minute + 10, minute))
    changed = []

    def publish(df, batch_id):
        changed.append(df.count())
        lake.upsert(df)

    query = start_stateful(lake, landing.stream(), publish, trigger=ONCE)
    run(query)
    assert [n for n in changed if n] == [2, 2, 2]  # only keys touched by the batch
    # the sink reads its rows several times, the state is advanced once
    updated = [p.stateOperators[0].numRowsUpdated for p in query.recentProgress if p.numInputRows]
    assert updated == [2, 2, 2]
    assert rows(lake.latest_valid.read()) == landing.expected()


def test_catalog_tables(spark, landing, tmp_path, monkeypatch):
    """Creation and append run here; MERGE and conditional overwrite need a table format
    this session lacks, so they are recorded instead of run."""
    from tidemark.streaming import lake as module

    lake = CatalogLake(
        spark, str(tmp_path / "lake"), CONTRACT, bronze_namespace="b", silver_namespace="s", provider="parquet",
        replayable=False)
    lake.prepare()
    merged = []
    monkeypatch.setattr(
        module, "merge_table",
        lambda df, name, key, groups, view: merged.append((name, view, rows(df, KEY, "ts"), merge_sql(name, view, key, groups))))
    landing.add(payload(1, 1), payload(2, 1))
    ingest(lake, landing, every=1)
    landing.add(payload(2, 2), payload(3, 2), payload(3, 1))
    ingest(lake, landing, every=1)
    assert lake.read_bronze().count() == 5
    assert lake.read_bronze(date(2024, 1, 1), date(2024, 1, 1)).count() == 5
    assert spark.sql("SHOW PARTITIONS b.iot").first()[0] == "year=2024/month=1/day=1"
    assert spark.table("s.iot_events_latest_valid").columns[:3] == [KEY, "ts", "bmsLastTs"]
    assert [m[0] for m in merged] == [
        "`spark_catalog`.s.iot_events_latest_valid", "`spark_catalog`.s.iot_events_latest"]
    assert [k for k, _ in merged[0][2]] == [2, 3]  # one row per key
    for statement in merged:
        spark._jsparkSession.sessionState().sqlParser().parsePlan(statement[3])
    with pytest.raises(Exception):
        lake.expire()  # this catalog has no such procedure
    expire_silver(lake, 60)  # which never ends a stream
    replayed = []
    monkeypatch.setattr(module, "replace_batch", lambda df, name, key: replayed.append((name, key)))
    lake.replayable = True
    landing.add(payload(4, 1))
    ingest(lake, landing, every=1)
    assert replayed[0][0] == "`spark_catalog`.b.iot" and replayed[0][1].endswith("-000000002")
    spark.sql("DROP DATABASE b CASCADE")
    spark.sql("DROP DATABASE s CASCADE")


def test_empty_batch_is_skipped(spark, lake, landing, caplog):
    caplog.set_level(logging.INFO, "tidemark")
    from tidemark.streaming.jobs import ingest_batch

    raw = spark.createDataFrame([], "value string")
    ingest_batch(lake, 1)(decode(raw, CONTRACT), 0)
    assert "Batch 0: empty, skipping." in caplog.text
    assert lake.latest.read() is None


def test_supervision_reports_and_stops(spark, lake, landing, tmp_path):
    landing.add(payload(1, 1))
    failing = (landing.stream().writeStream.foreachBatch(lambda df, n: 1 / 0)
               .option("checkpointLocation", str(tmp_path / "c1")).start())
    healthy = spark.readStream.format("rate").load().writeStream.format("noop").option(
        "checkpointLocation", str(tmp_path / "c2")).start()
    with pytest.raises(Exception, match="division by zero"):
        supervise(failing, healthy)
    assert not healthy.isActive


def test_batch_times_are_collected(spark, lake, landing):
    times = BatchTimes(trigger_ms=0)
    spark.streams.addListener(times)
    try:
        landing.add(payload(1, 1))
        ingest(lake, landing)
        for _ in range(50):
            if times.recent:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(times)
    assert times.recent[0][0] == 0 and times.recent[0][2] == 1


def test_policies():
    assert [n for n in range(31) if silver_due(n)] == [0, 10, 20, 30]
    assert [n for n in range(200) if expiry_due(n)] == [60, 120, 180]
    assert is_transient(Exception("x ConflictException y")) and not is_transient(Exception("OutOfMemory"))


def test_source_options():
    options = kafka_options("b:9092", "events", group_id_prefix="g")
    assert options["startingOffsets"] == "latest" and options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "500000" and options["groupIdPrefix"] == "g"
    assert options["kafka.security.protocol"] == "PLAINTEXT" and options["subscribe"] == "events"
    assert kafka_options("b", "t", starting_offsets="earliest")["startingOffsets"] == "earliest"
    assert file_options(max_bytes_per_trigger="1g")["maxBytesPerTrigger"] == "1g"
    assert file_options()["ignoreMissingFiles"] == "true" and file_options()["latestFirst"] == "false"
    with pytest.raises(ValueError):
        file_options(max_files_per_trigger=1, max_bytes_per_trigger="1g")


@pytest.mark.parametrize("topology", ["combined", "chain"])
def test_application(spark, landing, tmp_path, monkeypatch, topology):
    fields = [{"name": f.name, "type": {"bigint": "long"}.get(f.dataType.simpleString(), f.dataType.simpleString())}
              for f in CONTRACT.schema.fields]
    (tmp_path / "event.avsc").write_text(json.dumps({"type": "record", "name": "E", "fields": fields}))
    (tmp_path / "names.json").write_text(json.dumps(CONTRACT.rename_map))
    landing.add(payload(1, 1), payload(2, 1))
    # the application reads parquet folders
    spark.read.text(str(landing.path)).write.parquet(str(tmp_path / "in"))
    app.main([
        "--root", str(tmp_path / "lake"), "--contract", str(tmp_path / "event.avsc"),
        "--rename-map", str(tmp_path / "names.json"), "--folder", str(tmp_path / "in"), "--payload-format", "json",
        "--topology", topology, "--buckets", "2", "--until-caught-up"], keep_session=True)
    lake = Lake(spark, str(tmp_path / "lake"), CONTRACT, buckets=2)
    assert lake.read_bronze().count() == 2 and lake.latest_valid.read().count() == 2


@pytest.mark.parametrize("topology", ["combined", "chain"])
def test_application_leaves_nothing_pending(spark, landing, tmp_path, topology):
    fields = [{"name": f.name, "type": {"bigint": "long"}.get(f.dataType.simpleString(), f.dataType.simpleString())}
              for f in CONTRACT.schema.fields]
    (tmp_path / "event.avsc").write_text(json.dumps({"type": "record", "name": "E", "fields": fields}))
    (tmp_path / "names.json").write_text(json.dumps(CONTRACT.rename_map))
    (tmp_path / "in").mkdir()
    for n in range(12):
        landing.add(payload(n % 5, n), payload(99, n, voltage=float(n)))
        text = spark.read.text(str(landing.path / f"{n:04d}.txt"))
        text.coalesce(1).write.parquet(str(tmp_path / "one" / str(n)))
        next((tmp_path / "one" / str(n)).glob("*.parquet")).rename(tmp_path / "in" / f"{n:04d}.parquet")
    app.main([
        "--root", str(tmp_path / "lake"), "--contract", str(tmp_path / "event.avsc"),
        "--rename-map", str(tmp_path / "names.json"), "--folder", str(tmp_path / "in"), "--payload-format", "json",
        "--topology", topology, "--buckets", "2", "--max-files", "1", "--bronze-files", "0", "--until-caught-up"], keep_session=True)
    lake = Lake(spark, str(tmp_path / "lake"), CONTRACT, buckets=2)
    assert lake.read_bronze().count() == 24 and rows(lake.latest_valid.read()) == landing.expected()
    # the chain's own checkpoint knows what is merged; its source deletes the last files at the next start
    assert lake.pending_since() is None or topology == "chain"


def test_a_quiet_source_does_not_hold_rows_back(spark, lake, landing):
    landing.add(payload(1, 1))
    lake.silver_interval_s = 0
    run(start_ingest(lake, landing.stream(), silver_every=1000, trigger=ONCE))
    landing.add(payload(2, 2))  # batch 1 is not due by number, but batch 0 has waited too long
    run(start_ingest(lake, landing.stream(), silver_every=1000, trigger=ONCE))
    assert rows(lake.latest_valid.read()) == landing.expected() and lake.pending_since() is None


def test_a_quiet_source_is_merged_without_a_batch(spark, lake, landing):
    """One batch, a processing-time trigger, and no new data: nothing is pending after the interval."""
    landing.add(payload(1, 1), payload(2, 1))
    lake.silver_interval_s = 2
    query = start_ingest(lake, landing.stream(), silver_every=1000, trigger={"processingTime": "1 second"})
    first, merge = [], quiet_merge(lake)

    def tick():
        if not first:
            query.processAllAvailable()
            landing.add(payload(1, 2))  # batch 1 is not due by number
            query.processAllAvailable()
            first.append(time.time())
            assert lake.pending_since() is not None
        merge()
        if lake.pending_since() is None or time.time() - first[0] > 60:
            query.stop()

    try:
        supervise(query, tick=tick)
    finally:
        query.stop()
    assert lake.pending_since() is None and rows(lake.latest_valid.read()) == landing.expected()
    assert {p.batchId for p in query.recentProgress if p.numInputRows} == {0, 1}  # no batch did it


def test_ticks_wait_for_a_running_batch_and_report_failures(spark, lake, landing, monkeypatch, caplog):
    landing.add(payload(1, 1))
    lake.silver_interval_s = -1
    run(start_ingest(lake, landing.stream(), silver_every=None, trigger=ONCE))
    with lake.lock:
        other = threading.Thread(target=quiet_merge(lake))
        other.start()
        other.join()
        assert lake.pending_since() is not None
    monkeypatch.setattr(Lake, "merge_pending", lambda *a: (_ for _ in ()).throw(RuntimeError("CommitFailedException: lost")))
    quiet_merge(lake)()
    assert "kept for the next run" in caplog.text
    monkeypatch.setattr(Lake, "merge_pending", lambda *a: 1 / 0)
    healthy = spark.readStream.format("rate").load().writeStream.format("noop").option("checkpointLocation", f"{lake.root}/c").start()
    with pytest.raises(ZeroDivisionError):
        supervise(healthy, tick=quiet_merge(lake))
    assert not healthy.isActive


def test_a_fresh_checkpoint_does_not_reorder_waiting_batches(spark, lake):
    """Equal clocks: the earlier batch stays, also when the later one has a smaller number under a new query."""
    def decoded(text):
        return decode(spark.createDataFrame([(text,)], "value string"), CONTRACT)

    lake.add_pending(decoded(payload(1, 1, voltage=50.0)), 7, started_s=1_700_000_000)
    lake.add_pending(decoded(payload(1, 1, voltage=60.0)), 0, started_s=1_700_000_100)
    lake.merge_pending()
    assert rows(lake.latest_valid.read(), "voltage") == [(50.0,)]


def leaves(lake):
    return sorted(str(p.relative_to(lake.bronze_path)) for p in Path(lake.bronze_path).glob("year=*/month=*/day=*/batch_key=*"))


def test_closed_days_are_compacted(spark, lake, landing):
    """Fifty batches over three days: one folder a closed day, the open one as it was, and the same rows."""
    for n in range(50):
        decoded = decode(spark.createDataFrame([(payload(1, 1440 * (n % 3) + n),), (payload(2, 1440 * (n % 3)),)], "value string"), CONTRACT)
        lake.write_bronze(decoded, n)
    lake.write_bronze(decode(spark.createDataFrame([(payload(3, 0, ts=None),)], "value string"), CONTRACT), 50)
    before, found = rows(lake.read_bronze().drop("batch_key")), leaves(lake)
    assert len(found) == 51
    assert lake.compact_bronze(date(2024, 1, 3)) == 2
    assert rows(lake.read_bronze().drop("batch_key")) == before
    after = leaves(lake)
    assert len([f for f in after if "day=1/" in f]) == len([f for f in after if "day=2/" in f]) == 1
    assert [f for f in after if "day=3/" in f or "HIVE" in f] == [f for f in found if "day=3/" in f or "HIVE" in f]
    assert lake.compact_bronze(date(2024, 1, 3)) == 0  # nothing left to gain
    # a late row makes a closed day worth it again
    lake.write_bronze(decode(spark.createDataFrame([(payload(9, 5),)], "value string"), CONTRACT), 51)
    assert lake.compact_bronze(date(2024, 1, 3)) == 1 and lake.read_bronze().count() == 102
    assert {p.name for p in Path(lake.bronze_path).parent.iterdir()} == {"iot", "iot_aside"} and not list(Path(f"{lake.bronze_path}_aside").iterdir())


def test_compaction_leaves_a_day_that_changes_and_recovers(spark, lake, monkeypatch):
    for n in range(3):
        lake.write_bronze(decode(spark.createDataFrame([(payload(n, n),)], "value string"), CONTRACT), n)
    real, calls = compaction.leaf_files, []

    def one_more(session, folder):
        calls.append(folder)
        return real(session, folder) | ({"late"} if len(calls) == 2 else set())

    monkeypatch.setattr(compaction, "leaf_files", one_more)
    assert lake.compact_bronze(date(2024, 1, 2)) == 0 and lake.read_bronze().count() == 3 and len(leaves(lake)) == 3
    monkeypatch.setattr(compaction, "leaf_files", real)
    moved, rename = [], files.rename

    def second_fails(session, source, target):
        moved.append(source)
        if len(moved) == 2:
            raise OSError("stopped between the renames")
        rename(session, source, target)

    monkeypatch.setattr(files, "rename", second_fails)
    with pytest.raises(OSError):
        lake.compact_bronze(date(2024, 1, 2))
    monkeypatch.setattr(files, "rename", rename)
    assert leaves(lake) == []
    assert compaction.recover(spark, lake.bronze_path) == 1 and lake.read_bronze().count() == 3
    assert lake.compact_bronze(date(2024, 1, 2)) == 1 and lake.read_bronze().count() == 3 and len(leaves(lake)) == 1


def test_plan_takes_days_with_more_files_than_bytes_need(spark):
    sizes = spark.createDataFrame(
        [(2024, 1, 1, "a", "f1", 100), (2024, 1, 1, "b", "f2", 100), (2024, 1, 2, "a", "f3", 900), (2024, 1, 2, "b", "f4", 800),
         (2024, 1, 3, "a", "f5", 10), (2024, 1, 9, "a", "f6", 1), (2024, 1, 9, "b", "f7", 1), (None, None, None, "a", "f8", 1)],
        "year int, month int, day int, batch_key string, file string, bytes long")
    plan = compaction.compaction_plan(sizes, date(2024, 1, 9), target_bytes=1000)
    assert rows(plan, "day", "n_files", "bytes", "n_target") == [(1, 2, 200, 1)]


def test_state_is_read_back_at_any_batch(spark, lake, landing):
    configure_state_store(spark)
    for minute in range(3):
        landing.add(payload(1, minute), payload(minute + 10, minute))
    run(start_stateful(lake, landing.stream(), lambda df, n: df.count(), trigger=ONCE))
    operators = state_operators(spark, lake.checkpoint("stateful")).first()
    assert operators.operatorName == "stateStoreSave" and operators.minBatchId == 0
    assert [lake.read_state(batch_id=n).count() for n in range(3)] == [2, 3, 4]
    assert rows(lake.read_state(batch_id=0).where(f"{KEY} = 1").select("row.ts")) != rows(lake.read_state().where(f"{KEY} = 1").select("row.ts"))
    # silver lost, or never written: the checkpoint has what it takes
    lake.upsert(lake.read_state())
    assert rows(lake.latest_valid.read()) == landing.expected()
    with pytest.raises(ValueError, match="4 values"):
        read_state(spark, lake.checkpoint("stateful"), ["row"])


def test_batches_are_counted_while_they_are_written(spark, lake, landing, monkeypatch):
    """No counting job for a batch with good rows; one without is counted afterwards; a replay counts once."""
    counted, count = [], Lake.count_batch
    monkeypatch.setattr(Lake, "count_batch", lambda self, decoded: counted.append(1) or count(self, decoded))
    landing.add(payload(1, 1), payload(2, 1), payload(None, 3), "broken {")
    landing.add(payload(1, 2), payload(2, 1, ts=10**18), "")
    ingest(lake, landing)
    assert counted == []
    landing.add("broken {", "broken [")
    ingest(lake, landing)
    assert len(counted) <= 1
    done = lake.read_progress()
    found = rows(done.select("batch_id", "silver", "outcomes.*"))
    assert [r[:6] for r in found] == [(0, True, 2, 1, 0, 1), (1, False, 1, 0, 1, 0), (2, True, 0, 0, 0, 2)]
    assert found[1][6] == 1 and rows(spark.read.parquet(lake.quarantine_path).groupBy("reason").count()) == [
        ("clock out of range", 1), ("corrupt", 3), ("empty", 1)]
    again = done.where("batch_id = 1").first()
    for day_later in (0, 86_400_000):
        lake.record_progress(spark, 1, {"good": 7}, again["started_ms"] + day_later, False)
    manual = lake.read_progress().where("outcomes.good = 7")
    assert manual.count() == 1 and lake.read_progress().count() == 4
    assert Lake(spark, f"{lake.root}/none", CONTRACT).read_progress().count() == 0


def test_state_starts_from_silver(spark, lake, landing):
    """A fresh checkpoint knows keys it has not seen, keeps the stored struct on equal clocks, and survives a restart."""
    configure_state_store(spark)
    first = [payload(1, 5, voltage=51.0), payload(2, 1), payload(4, 1, voltage=None, lat=None, lon=None)]
    lake.upsert_decoded(decode(spark.createDataFrame([(t,) for t in first], "value string"), CONTRACT))
    landing.texts += first
    seen = {}

    def sink(changed, batch_id):
        seen.setdefault(batch_id, []).extend(r[0] for r in changed.select(KEY).collect())

    # device 1: equal and older clocks; 2: newer; 3: new; 4: valid for the first time; none for a row without key
    landing.add(payload(1, 5, voltage=99.0), payload(1, 4), payload(2, 7, voltage=52.0), payload(None, 9))
    landing.add(payload(3, 1), payload(4, 2), payload(2, 6))
    ingest(lake, landing, every=None)
    run(start_seeded(lake, sink, ONCE))
    held = lake.read_seeded()
    valid = [f"g{i}.*" for i in range(len(LATEST_VALID_GROUPS))]
    expected = [r for r in landing.expected() if r[0] != 1]
    assert [r for r in rows(held.select(KEY, *valid)) if r[0] != 1] == expected
    assert rows(held.where(f"{KEY} = 1").select("g1.voltage")) == [(51.0,)]
    assert sorted({k for keys in seen.values() for k in keys}) == [2, 3, 4]
    landing.add(payload(3, 2, voltage=53.0))
    ingest(lake, landing, every=None)
    seen.clear()
    run(start_seeded(lake, sink, ONCE))
    assert [k for keys in seen.values() for k in keys] == [3]
    assert rows(lake.read_seeded().where(f"{KEY} = 3").select("g1.voltage")) == [(53.0,)] and lake.read_seeded().count() == 4


def test_state_without_silver_starts_empty(spark, lake, landing):
    configure_state_store(spark)
    landing.add(payload(1, 1), payload(2, 1, lon=0.0))
    ingest(lake, landing, every=None)
    run(start_seeded(lake, lambda changed, batch_id: lake.upsert(changed), ONCE))
    assert rows(lake.latest_valid.read()) == landing.expected()
    assert lake.latest.read().count() == 2
