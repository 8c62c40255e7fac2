import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan_of, rows
from tidemark.contracts import Contract, ContractDrift, contract_from_texts
from tidemark.functions.alarms import alarms_paths, alarms_struct
from tidemark.functions.validity import bms_flag, iot_flag
from tidemark.operators.bronze import DERIVED, to_bronze, with_local_clocks
from tidemark.operators.decode import decode, decode_counts, decode_json, good_rows, refused_rows
from tidemark.plans.device_view import DEVICE_CONTRACT as CONTRACT

GOOD = {"deviceID": 7, "ts": 1_706_725_800_000, "originalTs": 1, "pushedAt": 1_706_725_890_000,
        "consumedAt": 1_706_725_893_000, "voltage": 51.5, "lat": 1.0, "lon": 2.0, "alarms": '{"k": 1}'}


def payloads(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_refused_payloads_are_kept_with_a_reason(spark):
    text = json.dumps(GOOD)
    decoded = decode_json(
        payloads(spark, text, text[:30], "", None, "  ", "{}", '["a"]', json.dumps({**GOOD, "ts": "x"}),
                 json.dumps({**GOOD, "ts": 9 * 10**18}), json.dumps({**GOOD, "deviceID": None})),
        CONTRACT,
    )
    assert rows(good_rows(decoded), "deviceID", "voltage") == [(None, None), (None, 51.5), (7, 51.5)]
    reasons = [(r.reason, r.payload is None) for r in refused_rows(decoded).collect()]
    assert sorted(reasons) == [
        ("clock out of range", False), ("corrupt", False), ("corrupt", False), ("corrupt", False),
        ("empty", False), ("empty", False), ("empty", True),
    ]
    counts = dict(rows(decode_counts(decoded, CONTRACT)))
    assert counts == {"good": 1, "no key": 2, "corrupt": 3, "empty": 3, "clock out of range": 1}


def test_a_broken_side_clock_withholds_nothing(spark):
    far = json.dumps({**GOOD, "pushedAt": 9 * 10**18, "consumedAt": -9 * 10**18})
    good = good_rows(decode_json(payloads(spark, far), CONTRACT))
    bronze = to_bronze(good, CONTRACT).first()
    assert bronze.pushedAt == 9 * 10**18 and bronze.consumedLatency is None and bronze.ts is not None
    silver = with_local_clocks(good, CONTRACT).first()
    assert silver.pushedAt is None and silver.consumedAt is None and silver.ts is not None


def test_payload_is_parsed_once(spark):
    assert plan_of(good_rows(decode_json(payloads(spark, "{}"), CONTRACT))).count("from_json(") == 1


def test_nested_columns_decode(spark):
    schema = T.StructType.fromDDL("deviceID string, ts long, cellVolt array<double>, alarms struct<k: boolean>")
    contract = Contract(schema, {"k": "alarmK"}, epoch_columns=("ts",))
    decoded = decode(payloads(spark, '{"deviceID":"d","ts":1,"cellVolt":[1.5,2],"alarms":{"k":true}}'), contract)
    row = good_rows(decoded).first()
    assert row.cellVolt == [1.5, 2.0] and row.alarms.k is True


def test_avro_needs_contract_text(spark):
    with pytest.raises(ValueError):
        decode(payloads(spark, "x"), CONTRACT, "avro")


def test_avro_plumbing(spark, monkeypatch):
    """The Avro module is absent here, so its decoder is replaced by a stand-in on JSON bytes."""
    import pyspark.sql.avro.functions as avro

    text = json.dumps({"type": "record", "name": "E", "fields": [
        {"name": "deviceID", "type": "long"}, {"name": "ts", "type": "long"}, {"name": "alarms", "type": "string"}]})
    contract = contract_from_texts(text, "{}", epoch_columns=("ts",))
    asked = []

    def stand_in(column, schema, options):
        asked.append((schema, options))
        return F.from_json(column.cast("string"), contract.schema)

    monkeypatch.setattr(avro, "from_avro", stand_in)
    raw = spark.createDataFrame([(b'{"deviceID": 1, "ts": 2}',), (b"\xff\x00",), (b"",), (None,)], "value binary")
    decoded = decode(raw, contract, "avro")
    assert asked == [(text, {"mode": "PERMISSIVE"})]
    assert rows(good_rows(decoded), "deviceID", "ts") == [(1, 2)]
    assert rows(refused_rows(decoded)) == [(None, "empty"), ("", "empty"), ("/wA=", "corrupt")]


def device(spark, *changes):
    data = [tuple({**{c: None for c in CONTRACT.columns}, **GOOD, **c}[n] for n in CONTRACT.columns)
            for c in changes]
    return spark.createDataFrame(data, CONTRACT.schema)


def test_bronze_columns_latencies_and_local_date(spark):
    # 2024-01-31 18:30 UTC is midnight of the next month in the contract's zone
    out = to_bronze(device(spark, {}), CONTRACT)
    assert out.columns == [*CONTRACT.columns, *DERIVED]
    row = out.first()
    assert row.ts == datetime(2024, 2, 1, 0, 0)
    assert (row.year, row.month, row.day, row.insert_date) == (2024, 2, 1, date(2024, 2, 1))
    assert (row.timeLatency, row.consumedLatency) == (1.5, 0.05)
    assert (row.originalTs, row.pushedAt) == (1, GOOD["pushedAt"])
    assert row.alarms.asDict() == {"alarmK": "1", "overVoltage": None, "underTemp": None}
    assert "Exchange" not in plan_of(out)


def test_bronze_keeps_rows_without_clock(spark):
    row = to_bronze(device(spark, {"ts": None}), CONTRACT).first()
    assert row.ts is None and row.year is None and row.timeLatency is None and row.consumedLatency == 0.05


def test_silver_converts_all_clocks(spark):
    row = with_local_clocks(device(spark, {}), CONTRACT).first()
    assert row.ts == datetime(2024, 2, 1) and row.pushedAt == datetime(2024, 2, 1, 0, 1, 30)
    assert row.alarms == '{"k": 1}'


def test_struct_alarms(spark):
    df = spark.sql("SELECT named_struct('ut', 2.5D, 'k', true) AS alarms UNION ALL SELECT NULL")
    out = df.select(alarms_struct("alarms", df.schema["alarms"].dataType, CONTRACT.rename_map).alias("a"))
    assert rows(out, "a.alarmK", "a.overVoltage", "a.underTemp") == [(None, None, None), ("true", None, "2.5")]
    schema = T.StructType([*[f for f in CONTRACT.schema.fields if f.name != "alarms"],
                           T.StructField("alarms", T.StructType.fromDDL("k int, odd int"))])
    with pytest.raises(ContractDrift):
        to_bronze(spark.createDataFrame([], schema), CONTRACT)


JSON_ALARMS = ['{"k": 1.50}', '{"k": 1e5, "ov": true}', '{"k": {"a": 1,  "b":"x"}}', '{"k": "q\\"z"}',
               '{"k": null}', '{"ut":[1, 2]}', '{"k":1, "x', '', '[{"k":1}]', '{"k":""}', None,
               '{"other": 1}', 'null', '7']


def test_json_alarms_agree_with_path_lookup(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(JSON_ALARMS)], "i int, alarms string")
    parsed = alarms_struct("alarms", T.StringType(), CONTRACT.rename_map)
    by_path = alarms_paths("alarms", CONTRACT.rename_map)
    fields = ("i", "a.alarmK", "a.overVoltage", "a.underTemp")
    assert rows(df.select("i", parsed.alias("a")), *fields) == rows(df.select("i", by_path.alias("a")), *fields)
    assert df.select(parsed.isNull().alias("n")).where("n").count() == 0


def test_json_alarms_are_parsed_once(spark):
    df = spark.createDataFrame([("{}",)], "alarms string")
    parsed = df.select(alarms_struct("alarms", T.StringType(), CONTRACT.rename_map).alias("a"))
    assert plan_of(parsed).count("from_json(") == 1


def test_validity_bounds_are_strict(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 70.0, 69.99, -1.0, None)], "voltage double")
    assert rows(df.select("voltage", bms_flag().alias("f"))) == [
        (None, 0), (-1.0, 0), (0.0, 0), (69.99, 1), (70.0, 0)]
    df = spark.createDataFrame([(v,) for v in (0.0, -5.0, 0.1, None)], "lon double")
    assert rows(df.select("lon", iot_flag().alias("f"))) == [(None, 0), (-5.0, 0), (0.0, 0), (0.1, 1)]
    assert df.select(F.max(iot_flag())).first()[0] == 1
