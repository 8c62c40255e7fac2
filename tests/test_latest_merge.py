from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_of, rows
from tidemark.contracts import LATEST_VALID_GROUPS, ColumnGroup
from tidemark.operators.latest import (
    combine_by_joins,
    combine_one_pass,
    latest_by_row_number,
    latest_per_key,
    latest_valid,
)
from tidemark.operators.merge import (
    SEQUENCE,
    fold_batches,
    merge_by_join,
    merge_latest,
    merge_pending,
    merge_sql,
)

KEY = "deviceID"
EVENT = ("deviceID int, ts timestamp, lat double, lon double, voltage double, soc double, current double, "
         "temperature double, cellVolt array<double>, cellTemp double, alarms string")
T0 = datetime(2024, 1, 1)


def at(minute):
    return None if minute is None else T0 + timedelta(minutes=minute)


def event(device, minute, voltage=50.0, lon=70.0, note=""):
    return (device, at(minute), 9.0, lon, voltage, 1.0, 2.0, 3.0, [3.5, 3.6], 30.0, note)


def events(spark, *data):
    return spark.createDataFrame(list(data), EVENT)


def test_latest_row_and_tie_order(spark):
    df = spark.createDataFrame(
        [("a", 1, 5, "x"), ("a", 3, 1, "y"), ("a", 3, 2, None), ("a", 3, 2, "z"), ("b", None, 1, "n"),
         ("b", None, 4, "n")],
        "k string, ts int, n int, s string",
    )
    out = latest_per_key(df, "k")
    assert out.columns == ["k", "ts", "n", "s"]
    # equal clocks: the larger next column wins, NULL below every value
    assert rows(out) == [("a", 3, 2, "z"), ("b", None, 4, "n")]


def test_latest_carries_unorderable_columns(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 1, map('a', 1)), (1, 2, map('a', 2)), (2, 5, NULL) t(k, ts, m)")
    assert [(r.k, r.ts, r.m) for r in latest_per_key(df, "k").orderBy("k").collect()] == [
        (1, 2, {"a": 2}), (2, 5, None)]


def test_latest_by_row_number_agrees_without_ties(spark):
    df = events(spark, event(1, 1), event(1, 3, note="new"), event(2, 2), event(2, 0))
    assert rows(latest_by_row_number(df, KEY), "deviceID", "ts", "alarms") == rows(
        latest_per_key(df, KEY), "deviceID", "ts", "alarms")


def test_both_forms_reduce_before_the_shuffle(spark):
    df = events(spark, event(1, 1))
    for out, partial in ((latest_per_key(df, KEY), "partial_max"), (latest_by_row_number(df, KEY), "Partial")):
        below = plan_of(out).split("Exchange", 1)[1]
        assert partial in below and "Exchange" not in below


def test_groups_advance_separately(spark):
    df = events(
        spark,
        event(1, 1, voltage=60.0, lon=70.0, note="bms"),
        event(1, 2, voltage=0.0, lon=71.0),
        event(1, 3, voltage=70.0, lon=0.0),
        event(2, 1, voltage=None, lon=None),
        event(None, 9),
    )
    out = combine_one_pass(df, KEY, LATEST_VALID_GROUPS)
    assert out.columns == [
        "deviceID", "ts", "bmsLastTs", "bmsLastLat", "bmsLastLon", "voltage", "soc", "current", "temperature",
        "cellVolt", "cellTemp", "alarms", "iotLastTs", "lat", "lon"]
    one, two = out.orderBy(KEY).collect()
    assert (one.ts, one.bmsLastTs, one.voltage, one.alarms, one.iotLastTs, one.lon) == (
        at(3), at(1), 60.0, "bms", at(2), 71.0)
    assert one.cellVolt == [3.5, 3.6] and one.bmsLastLon == 70.0
    assert (two.ts, two.bmsLastTs, two.voltage, two.iotLastTs, two.lon) == (at(1), None, None, None, None)
    assert rows(combine_by_joins(df, KEY, LATEST_VALID_GROUPS)) == rows(out)
    assert rows(latest_valid(df, KEY, LATEST_VALID_GROUPS[2]), "deviceID", "lon")[-1] == (1, 71.0)


def test_one_pass_has_one_shuffle(spark):
    df = events(spark, event(1, 1))
    assert plan_of(combine_one_pass(df, KEY, LATEST_VALID_GROUPS)).count("Exchange hash") == 1
    assert plan_of(combine_by_joins(df, KEY, LATEST_VALID_GROUPS)).count("Exchange hash") == 3


# ---- merge rule

GROUPS = (ColumnGroup("t", {}), ColumnGroup("u", {"v": "v", "w": "w"}))
STATE = "k int, t int, u int, v string, w string"


def state(spark, *data):
    return spark.createDataFrame(list(data), STATE)


@pytest.mark.parametrize("merge", [merge_latest, merge_by_join])
def test_merge_rule(spark, merge):
    stored = state(
        spark, (1, 5, 5, "t", "t"), (2, 5, None, None, None), (3, 5, 5, "t", "t"), (4, None, None, None, None),
        (5, 5, 5, "t", "t"), (6, 1, 1, "t", None),
    )
    incoming = state(
        spark, (1, 6, 4, "s", "s"), (2, 4, 1, "s", None), (3, 5, 5, "s", "s"), (4, None, None, None, None),
        (6, 2, None, None, None), (7, None, 3, "s", "s"), (None, 9, 9, "s", "s"),
    )
    assert rows(merge(stored, incoming, "k", GROUPS)) == [
        (1, 6, 5, "t", "t"),        # clocks advance one by one
        (2, 5, 1, "s", None),       # NULL stored clock takes the incoming columns
        (3, 5, 5, "t", "t"),        # equal clocks keep what is stored
        (4, None, None, None, None),
        (5, 5, 5, "t", "t"),        # untouched
        (6, 2, 1, "t", None),       # incoming group without a clock changes nothing
        (7, None, 3, "s", "s"),     # inserted, the NULL key is not
    ]


def test_whole_row_merge_replaces_rows_without_clock(spark):
    groups = (ColumnGroup("t", {"u": "u", "v": "v", "w": "w"}),)
    stored = state(spark, (1, None, 1, "t", "t"), (2, 5, 1, "t", "t"))
    incoming = state(spark, (1, 3, 2, "s", "s"), (2, 4, 2, "s", "s"))
    assert rows(merge_latest(stored, incoming, "k", groups)) == [(1, 3, 2, "s", "s"), (2, 5, 1, "t", "t")]


def test_bootstrap_and_first_batch_wins_ties(spark):
    incoming = state(spark, (1, 1, 1, "a", "a")).withColumn(SEQUENCE, F.lit(0)).unionByName(
        state(spark, (1, 1, 1, "b", "b")).withColumn(SEQUENCE, F.lit(1)))
    assert rows(merge_latest(None, incoming, "k", GROUPS)) == [(1, 1, 1, "a", "a")]


def test_merge_sql_parses_and_skips_unchanged_rows(spark):
    text = merge_sql("cat.silver.t", "global_temp.s", KEY, LATEST_VALID_GROUPS)
    spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    assert "WHEN MATCHED AND ((t.`ts` IS NULL OR s.`ts` > t.`ts`) OR" in text
    assert "`voltage` = CASE WHEN (t.`bmsLastTs` IS NULL OR s.`bmsLastTs` > t.`bmsLastTs`)" in text
    assert text.count("= CASE") == 14


# ---- laws

reading = st.tuples(
    st.integers(1, 3),
    st.sampled_from([0.0, 30.0, 69.99, 70.0, None]),
    st.sampled_from([-1.0, 0.0, 80.0, None]),
    st.integers(0, 2),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(reading, min_size=1, max_size=12), st.randoms(use_true_random=False))
def test_any_split_into_batches_gives_the_same_state(spark, readings, shuffled):
    minutes = list(range(len(readings)))
    shuffled.shuffle(minutes)  # late rows, but no two rows with one clock
    parts = [
        [event(d, m, v, lon) for (d, v, lon, batch), m in zip(readings, minutes) if batch == n] for n in range(3)
    ]
    whole = rows(combine_one_pass(events(spark, *sum(parts, [])), KEY, LATEST_VALID_GROUPS))
    split = [events(spark, *p) for p in parts if p]
    assert rows(fold_batches(split, KEY, LATEST_VALID_GROUPS)) == whole
    assert rows(merge_pending(None, split, KEY, LATEST_VALID_GROUPS)) == whole
    replayed = [*split, split[0], split[-1]]
    assert rows(fold_batches(replayed, KEY, LATEST_VALID_GROUPS)) == whole


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 3), st.sampled_from([None, 1, 2]), st.integers(0, 2)), max_size=10))
def test_one_merge_of_many_batches_equals_merging_in_turn(spark, readings):
    """Also with equal and missing clocks across batches."""
    parts = [
        [event(d, m, note=str(i)) for i, (d, m, batch) in enumerate(readings) if batch == n] for n in range(3)
    ]
    split = [events(spark, *p) for p in parts]
    assert rows(merge_pending(None, split, KEY, LATEST_VALID_GROUPS)) == rows(
        fold_batches(split, KEY, LATEST_VALID_GROUPS))


def test_skipping_batches_would_lose_devices(spark):
    """What dropping the batches between silver runs does, against keeping them."""
    parts = [events(spark, event(1, 1)), events(spark, event(2, 2)), events(spark, event(1, 3))]
    kept = merge_pending(None, parts, KEY, LATEST_VALID_GROUPS)
    dropped = fold_batches(parts[:1], KEY, LATEST_VALID_GROUPS)
    assert rows(kept, KEY, "ts") == [(1, at(3)), (2, at(2))]
    assert rows(dropped, KEY, "ts") == [(1, at(1))]


def test_a_tiebreak_column_decides_equal_clocks(spark):
    data = [(1, 5, 9, 1), (1, 5, 1, 2), (1, 4, 9, 9), (2, None, 1, 1), (2, None, 2, None), (3, 1, None, 1), (3, 1, 0, 1), (None, 9, 9, 9)]
    df = spark.createDataFrame(data, "k long, ts long, v long, n long")
    want = [(1, 5, 1, 2), (2, None, 1, 1), (3, 1, 0, 1)]
    assert rows(latest_per_key(df, "k", tiebreak="n")) == want
    assert rows(latest_by_row_number(df.where("k < 3"), "k", tiebreak="n")) == want[:2]
    assert rows(latest_per_key(df, "k"), "k", "v") == [(1, 9), (2, 2), (3, 0)]
