from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from tidemark.contracts import ColumnGroup
from tidemark.operators.merge import changed_rows, fold_batches, merge_by_join
from tidemark.operators.sinks import (
    BRONZE_PROPERTIES,
    SILVER_PROPERTIES,
    BucketedTable,
    append_batch,
    append_table,
    batch_condition,
    create_table,
    ensure_namespace,
    file_schema,
    table_exists,
    upsert_table,
)
from tidemark.session import release_scratch, shared_dir
from tidemark.sources import files

GROUPS = (ColumnGroup("ts", {"v": "v"}),)


def numbers(spark, start, stop, clock=0):
    return spark.range(start, stop).select(
        F.col("id").alias("k"), F.lit(clock).alias("ts"), F.concat(F.lit("v"), F.col("id")).alias("v"))


def test_append_is_replayable_and_partitioned(spark, tmp_path):
    path = str(tmp_path / "t")
    data = spark.range(100).select(F.col("id"), (F.col("id") % 2 + 1).cast("int").alias("day"))
    for batch in (0, 1, 1, 0):
        append_batch(data.where(F.col("id") >= batch * 50), path, f"q-{batch}", ["day"])
    schema = file_schema(data.schema, ["day"])
    stored = spark.read.schema(schema).parquet(path)
    assert stored.columns == ["id", "day", "batch_key"]
    assert rows(stored.groupBy("batch_key").count()) == [("q-0", 100), ("q-1", 50)]
    assert sorted(p.name for p in Path(path).glob("day=*/*")) == ["batch_key=q-0"] * 2 + ["batch_key=q-1"] * 2
    pruned = plan_of(stored.where("day = 1"))
    assert "PartitionFilters: [isnotnull(day" in pruned


def test_file_count_is_controlled(spark, tmp_path):
    wide = spark.range(0, 1000, numPartitions=16).withColumn("day", F.lit(1))
    append_batch(wide, str(tmp_path / "a"), "x", ["day"])
    assert len(list((tmp_path / "a").rglob("*.parquet"))) == 1
    append_batch(wide, str(tmp_path / "b"), "x", ["day"], n_files=4)
    assert len(list((tmp_path / "b").rglob("*.parquet"))) == 4


def folders(table):
    return sorted(f.name for f in Path(table.path).iterdir() if f.name.startswith("base="))


def test_a_merge_replaces_the_folder_and_readers_see_complete_ones(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "k", buckets=4)
    assert table.read() is None
    assert upsert_table(table, numbers(spark, 0, 10), GROUPS)
    before = table.read()
    assert upsert_table(table, numbers(spark, 5, 15, clock=1), GROUPS)
    assert table.read().columns == ["k", "ts", "v"]
    assert rows(table.read().groupBy("ts").count()) == [(0, 5), (1, 10)]
    assert before.count() == 10  # a reader of the folder before goes on
    assert 1 < len(list(Path(table.current()).glob("*.parquet"))) <= 4  # a file per bucket that has rows
    # a write that was never completed is invisible, and does not stand in the way of the next one
    half = tmp_path / "t" / "base=000000000002-buckets=4"
    half.mkdir()
    (half / "part-00000.parquet").write_text("broken")
    assert table.read().count() == 15
    assert upsert_table(table, numbers(spark, 100, 101), GROUPS)
    assert table.read().count() == 16
    assert folders(table) == ["base=000000000001-buckets=4", "base=000000000003-buckets=4"]
    again = BucketedTable(spark.newSession(), str(tmp_path / "t"), "k", buckets=4)
    assert again.read().count() == 16


def test_replay_changes_and_writes_nothing(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "k", buckets=4)
    for batch in (numbers(spark, 0, 10), numbers(spark, 5, 15, 1)):
        upsert_table(table, batch, GROUPS)
    before, found = rows(table.read()), folders(table)
    assert not upsert_table(table, numbers(spark, 5, 15, 1), GROUPS)
    assert not upsert_table(table, numbers(spark, 0, 10), GROUPS)
    assert rows(table.read()) == before and folders(table) == found


def test_stored_rows_are_not_shuffled(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "k", buckets=6)
    upsert_table(table, numbers(spark, 0, 100), GROUPS)
    incoming = table.align(numbers(spark, 5, 15, 1))
    for merged in (merge_by_join(table.read(), incoming.hint("shuffle_hash"), "k", GROUPS), changed_rows(table.read(), incoming, "k", GROUPS)):
        plan = plan_of(merged)
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
        stored_side = plan[plan.index("ShuffledHashJoin"):]
        assert "Sort" not in stored_side[:stored_side.index("Bucketed: true")]
    assert rows(changed_rows(table.read(), incoming, "k", GROUPS), "k") == [(k,) for k in range(5, 15)]
    # another bucket count still merges right, at the price of a shuffle
    wider = BucketedTable(spark, table.path, "k", buckets=3)
    upsert_table(wider, numbers(spark, 95, 105, 1), GROUPS)
    assert rows(wider.read().groupBy("ts").count()) == [(0, 95), (1, 10)]


def test_batches_are_folded_by_matching(spark):
    parts = [numbers(spark, n, n + 50, clock=n).repartition(2) for n in range(5)]
    folded = fold_batches(parts, "k", GROUPS)
    # one exchange for each batch's own aggregate, one for the state of each match but the first
    assert plan_of(folded).count("Exchange hashpartitioning(") == 5 + 3
    assert rows(folded.groupBy("ts").count()) == [(0, 1), (1, 1), (2, 1), (3, 1), (4, 50)]


def test_catalog_batches_can_be_told_apart(spark):
    assert BRONZE_PROPERTIES["write.metadata.metrics.column.batch_key"] == "full"
    rows_ = spark.createDataFrame([(2024, 1, 2, "a"), (2024, 1, 3, "a"), (2024, 1, 2, "b")], "year int, month int, day int, batch_key string")
    assert rows_.where(batch_condition("a", [(2024, 1, 2)])).count() == 1
    assert rows_.where(batch_condition("a", [])).count() == 2


def test_catalog_tables(spark):
    ensure_namespace(spark, "telemetry")
    ensure_namespace(spark, "telemetry")
    assert not table_exists(spark, "telemetry.iot")
    data = spark.range(3).select("id", F.lit(2024).alias("year"))
    create_table(data, "telemetry.iot", ["year"], {"commit.retry.num-retries": "10"}, provider="parquet")
    assert table_exists(spark, "telemetry.iot")
    described = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED telemetry.iot").collect()}
    assert "commit.retry.num-retries=10" in described["Table Properties"]
    assert spark.sql("SHOW PARTITIONS telemetry.iot").first()[0] == "year=2024"
    append_table(data.select("year", "id"), "telemetry.iot", ["year"], provider="parquet")
    assert rows(spark.table("telemetry.iot"), "id", "year") == [(n, 2024) for n in (0, 0, 1, 1, 2, 2)]
    append_table(data, "telemetry.fresh", properties={"owner-note": "x"}, provider="parquet")
    assert spark.table("telemetry.fresh").count() == 3
    with pytest.raises(Exception, match="(?i)parse"):
        table_exists(spark, "not a name")
    spark.sql("DROP DATABASE telemetry CASCADE")


def test_table_properties():
    assert BRONZE_PROPERTIES["write.merge.mode"] == "merge-on-read"
    assert "write.merge.isolation-level" not in BRONZE_PROPERTIES
    assert SILVER_PROPERTIES["write.merge.isolation-level"] == "snapshot"
    assert SILVER_PROPERTIES["commit.retry.total-timeout-ms"] == "1800000"


def test_shared_folder_follows_the_session(spark):
    path = shared_dir(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    spark.range(1).write.parquet(path)
    assert files.exists(spark, path)
    release_scratch(spark)
    assert not files.exists(spark, path)


def test_released_scratch_leaves_no_catalog_entries(spark):
    table = BucketedTable(spark, shared_dir(spark, "released"), "k", buckets=2)
    upsert_table(table, numbers(spark, 0, 10), GROUPS)
    name = table._table_name(table.current()).split(".", 1)[1]
    assert spark.catalog.tableExists(name)
    release_scratch(spark)
    assert not spark.catalog.tableExists(name) and not files.exists(spark, table.path)
