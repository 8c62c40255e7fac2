"""Digests, snapshot lifetimes, trends, error traces and runs on small tables."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from tidemark.operators import digest, lifetimes, opslog, parity, runs, traces, trend
from tidemark.operators.ordered import running_total

START = datetime(2024, 3, 1)


def counts(df):
    return {r.column_name: r.n_keys for r in df.collect()}


# ---- running totals

@pytest.mark.parametrize("widths", [(7,), (5, 20), (1, 4, 16)])
def test_running_total_over_buckets(spark, widths):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, *range(-30, 60)]), i, rng.choice([None, 1, 2, 5])) for i in range(300)]
    df = spark.createDataFrame(data, "s string, t long, i int, v long")
    got = {r.i: (r.total, r.n) for r in running_total(df, ["s"], "t", ["i"], {"total": F.col("v"), "n": F.lit(1)}, widths).collect()}
    key = {i: (t is not None, t or 0, i) for _, t, i, _ in data}
    for s, t, i, v in data:
        upto = [d for d in data if d[0] == s and key[d[2]] <= key[i]]
        assert got[i] == (sum(d[3] or 0 for d in upto), len(upto))


# ---- digests

def pair(spark, n=20_000, key="id"):
    left = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 7).alias("a"), F.col("id").cast("string").alias("b"))
    changed = F.when(F.col("k").between(700, 705), F.lit("x")).otherwise(F.col("b"))
    right = left.where("k <> 15000").select("k", "a", changed.alias("b")).unionByName(
        spark.createDataFrame([(50_000, 1, "new")], "k long, a long, b string"))
    if key == "text":
        left, right = (df.withColumn("k", F.concat(F.lit("key "), "k")) for df in (left, right))
    return left, right


@pytest.mark.parametrize("key", ["id", "text"])
def test_digests_give_the_same_counts(spark, key):
    left, right = pair(spark, key=key)
    want = counts(parity.column_diff(left, right, ["k"]))
    assert want == {"(left only)": 1, "(right only)": 1, "(repeated key)": 0, "a": 0, "b": 6}
    assert counts(digest.digest_diff(left, right, ["k"], fan_out=32, max_ranges=8, range_keys=4)) == want
    assert counts(digest.digest_diff(left, right, ["k"])) == want


def test_only_differing_ranges_are_read_again(spark, tmp_path):
    """The rows that reach the key comparison lie in a few short ranges, whose bounds reach the scan."""
    for name, df in zip(("l", "r"), pair(spark)):
        df.coalesce(1).write.parquet(str(tmp_path / name))
    left, right = (spark.read.parquet(str(tmp_path / n)) for n in ("l", "r"))
    found = digest.narrow(left, right, ["k"], fan_out=64, range_keys=16)
    assert len(found.levels) == 3 and all(differ <= 5 for _, differ in found.levels)
    place = digest.key_place(left, ["k"])
    assert found.of(left, place).count() < 100
    apart = digest.keys_apart(left, right, ["k"], found)
    assert sorted(r.k for r in apart.collect()) == [*range(700, 706), 15_000, 50_000]
    plan = plan_of(apart)
    assert "PushedFilters: [Or(" in plan and "GreaterThanOrEqual(k" in plan
    # what is exchanged is keys and digests, after a partial aggregate: no column of the rows
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanged and all("hashpartitioning(k#" in line for line in exchanged)
    assert plan.count("HashAggregate") >= 2


def test_equal_tables_and_orders_of_rows(spark):
    left, _ = pair(spark, 3000)
    shuffled = left.orderBy(F.rand(3)).repartition(7)
    assert digest.narrow(left, shuffled, ["k"]).ranges == []
    assert set(counts(digest.digest_diff(left, shuffled, ["k"])).values()) == {0}


def test_digest_edges(spark):
    schema = "k long, a int, b int"
    base = [(1, 1, None), (2, 5, 5), (-(2**63), 0, 0), (2**63 - 1, 0, 0), (None, 3, 3)]

    def diff(left, right):
        return counts(digest.digest_diff(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k"], fan_out=4, range_keys=1))

    assert set(diff(base, base).values()) == {0}
    assert diff(base, [(1, None, 1), *base[1:]]) == {"(left only)": 0, "(right only)": 0, "(repeated key)": 0, "a": 1, "b": 1}
    assert diff(base, [*base[:4], (None, 3, 4)])["b"] == 1
    assert diff(base, base[:4])["(left only)"] == 1
    assert diff(base, [*base, (2, 5, 5), (2, 5, 5)])["(repeated key)"] == 1  # two equal rows more: the sum sees them
    assert diff([], base)["(right only)"] == 5 and set(diff([], []).values()) == {0}


def test_ranges_merge_at_the_smallest_gaps():
    assert digest.merge_ranges([(5, 6), (0, 1), (2, 3), (100, 100)], 9) == [(0, 3), (5, 6), (100, 100)]
    assert digest.merge_ranges([(0, 1), (10, 11), (14, 15), (40, 50)], 2) == [(0, 15), (40, 50)]


# ---- lifetimes

def history(spark, data):
    return spark.createDataFrame([(t, i, START + timedelta(minutes=m)) for t, i, m in data], "table string, snapshot_id long, committed_at timestamp")


@pytest.mark.parametrize("widths", [(3_600_000,), (600_000, 86_400_000)])
def test_lifetimes_and_curve(spark, widths):
    rng = random.Random(4)
    data = [(rng.choice(["a", "b", None]), i, rng.choice([rng.randint(0, 60), rng.randint(0, 2000)])) for i in range(200)]
    life = lifetimes.snapshot_lifetimes(history(spark, data), retain_last=5, older_than_hours=6, widths=widths)
    got = {r.snapshot_id: r.expires_at for r in life.collect()}
    want = {}
    for t in ("a", "b", None):
        own = sorted((m, i) for table, i, m in data if table == t)
        for n, (m, i) in enumerate(own):
            want[i] = START + timedelta(minutes=max(m + 360, own[n + 5][0])) if n + 5 < len(own) else None
    assert got == want
    for r in lifetimes.retained_curve(life, widths).collect():
        alive = [i for t, i, m in data if t == r.table and START + timedelta(minutes=m) <= r.at and not (want[i] and want[i] <= r.at)]
        assert r.retained == len(alive)


def test_lifetimes_agree_with_the_expiry_selection(spark):
    from tidemark.operators import maintenance

    data = [("a", i, 30 * i) for i in range(60)]
    cutoff = START + timedelta(minutes=30 * 59)
    chosen = maintenance.expirable_snapshots(history(spark, data), maintenance.hours_before(F.lit(cutoff)), 20)
    life = lifetimes.snapshot_lifetimes(history(spark, data)).where(F.col("expires_at") <= F.lit(cutoff))
    assert rows(chosen, "snapshot_id") == rows(life, "snapshot_id") != []
    assert lifetimes.snapshot_lifetimes(history(spark, [])).collect() == []
    kept = lifetimes.snapshot_lifetimes(history(spark, [("a", 1, 0)])).first()
    assert kept.expires_at is None and kept.kept_by == "newest"


def test_largest_retained(spark):
    curve = lifetimes.retained_curve(lifetimes.snapshot_lifetimes(history(spark, [("a", i, 60 * i) for i in range(40)]), retain_last=3))
    daily = lifetimes.largest_retained(curve, F.to_date("at"))
    assert rows(daily, "most_retained") == [(6,), (6,)]


# ---- trends

def points(spark, data):
    return spark.createDataFrame([(s, START + timedelta(hours=h), v) for s, h, v in data], "s string, at timestamp, value long")


def test_trend_counts_every_pair(spark):
    rng = random.Random(9)
    data = [(s, h, rng.choice([0, 1, 7, rng.randint(0, 1 << 20)])) for s in ("a", "b") for h in rng.sample(range(400), 60)]
    found = {r.name: r.s for r in trend.trend_verdict(points(spark, data).withColumnRenamed("s", "name"), "name", widths=(36_000_000,)).collect()}
    for s in ("a", "b"):
        own = sorted((h, v) for n, h, v in data if n == s)
        assert found[s] == sum((b > a) - (b < a) for i, (_, a) in enumerate(own) for _, b in own[i + 1:])


def test_planted_slopes(spark):
    rng = random.Random(2)
    data = []
    for h in range(200):
        noise = rng.randint(-2000, 2000)
        data += [("up", h, 30_000 + 50 * h + noise), ("down", h, 60_000 - 50 * h + noise), ("level", h, 40_000 + noise), ("equal", h, 5),
                 (None, h, 100 + h)]
    data.append(("single", 0, 1))
    got = {r.name: r for r in trend.trend_verdict(points(spark, data).withColumnRenamed("s", "name"), "name").collect()}
    assert {n: r.verdict for n, r in got.items()} == {
        "up": "creeping", "down": "falling", "level": "flat", "equal": "flat", "single": "flat", None: "creeping"}
    assert got["up"].slope_per_hour == pytest.approx(50, abs=5) and got["down"].slope_per_hour == pytest.approx(-50, abs=5)
    assert got[None].slope_per_hour == 1 and got["equal"].z == 0 and got["single"].slope_per_hour is None


def test_means_of_a_bucket(spark):
    df = spark.createDataFrame([("a", START, 10), ("a", START + timedelta(minutes=59), 21), ("a", None, 5)], "s string, at timestamp, v long")
    assert [tuple(r) for r in trend.bucket_means(df, "s", F.col("at"), F.col("v")).collect()] == [("a", START, 15)]


# ---- traces

RECORDS = [
    "2024-03-01 00:00:00,000 - INFO - all is well",
    "2024-03-01 00:00:01,000 - ERROR - [Silver] Batch 7 FAILED: org.apache.spark.SparkException: Job aborted\n"
    + "".join(f"\tat org.apache.spark.Task{i}.run(Task.scala:1)\n" for i in range(40))
    + "Caused by: java.io.IOException: disk\n\tat a.B.c(B.java:1)\n\t... 3 more\nCaused by: java.lang.Error: core\n\t... 5 more",
    "2024-03-01 00:00:02,000 - INFO - Batch 8: empty, skipping.",
    "2024-03-01 00:00:03,000 - ERROR - stopped\nTraceback (most recent call last):\n  File \"a.py\", line 1\n    go()\nValueError: no",
]


@pytest.mark.parametrize("split_bytes", [64, 200, 1 << 20])
def test_traces_across_splits(spark, tmp_path, split_bytes):
    """Records are whole wherever the file is cut; lines before the first head are a record of their own."""
    (tmp_path / "a.log").write_text("\n".join(["java.lang.OutOfMemoryError: heap", *RECORDS, *RECORDS[1:2]]) + "\n")
    (tmp_path / "b.log").write_text("\n".join(RECORDS[3:]) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, str(split_bytes))
        lines = traces.read_ordered_lines(spark, str(tmp_path))
        assert (lines.select("split").distinct().count() > 5) == (split_bytes < 1000)
        found = traces.error_traces(lines).drop("file").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    spark_trace = (datetime(2024, 3, 1, 0, 0, 1), "ERROR", "org.apache.spark.SparkException",
                   "java.io.IOException < java.lang.Error", "java.lang.Error", 46, 41)
    python_trace = (datetime(2024, 3, 1, 0, 0, 3), "ERROR", "ValueError", "", "ValueError", 5, 1)
    headless = (None, None, "java.lang.OutOfMemoryError", "", "java.lang.OutOfMemoryError", 1, 0)
    assert sorted(map(tuple, found), key=str) == sorted([spark_trace] * 2 + [python_trace] * 2 + [headless], key=str)


def test_no_traces(spark, tmp_path):
    (tmp_path / "a.log").write_text("")
    assert traces.error_traces(traces.read_ordered_lines(spark, str(tmp_path))).collect() == []


# ---- runs

def test_runs(spark):
    def line(job, minute, text):
        return (job, f"{START + timedelta(minutes=minute):%Y-%m-%d %H:%M:%S},000 - INFO - {text}")

    lines = spark.createDataFrame([
        line("a", 0, "[Bronze] Batch 0: written"), line("a", 1, "[Bronze] Batch 1: written"), line("a", 2, "exit code 137"),
        line("a", 3, "[Bronze] Batch 0: written"), line("a", 70, "[Bronze] Batch 5: written"), line("a", 70, "exit code: 9"),
        line("b", 0, "[Bronze] Batch 4: written"), ("b", "exit code 0 without a time"), line(None, 0, "Batch 1: empty"),
        line("a", 71, "exit code 11")], "job string, text string")
    found = runs.run_summary(opslog.parse_batches(lines, ["job"]), runs.parse_exits(lines, ["job"]), "job", widths=(60_000, 3_600_000))
    at = [START + timedelta(minutes=m) for m in range(72)]
    assert rows(found, "job", "started_at", "ended_at", "n_lines", "first_batch", "last_batch", "length_s", "code", "reason") == rows(
        spark.createDataFrame([
            ("a", at[0], at[2], 2, 0, 1, 120.0, 137, "OOMKilled"), ("a", at[3], at[3], 1, 0, 0, 0.0, None, None),
            ("a", at[70], at[70], 1, 5, 5, 0.0, 9, None), ("a", at[71], at[71], 0, None, None, 0.0, 11, "Error"),
            ("b", at[0], at[0], 1, 4, 4, 0.0, None, None), (None, at[0], at[0], 1, 1, 1, 0.0, None, None)],
            "job string, a timestamp, b timestamp, n long, f long, l long, s double, c int, r string"))
