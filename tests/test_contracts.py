import json

import pytest
from conftest import plan_of
from pyspark.sql import types as T

from tidemark.contracts import (
    Contract,
    ContractDrift,
    check_drift,
    conform,
    contract_changes,
    contract_from_texts,
    evolved,
    load_contract,
    schema_from_avsc,
    whole_row_group,
    wider_schema,
)

AVSC = json.dumps({
    "type": "record",
    "name": "Event",
    "fields": [
        {"name": "deviceID", "type": "string"},
        {"name": "ts", "type": ["null", "long"]},
        {"name": "cellVolt", "type": {"type": "array", "items": "double"}},
        {"name": "extra", "type": {"type": "map", "values": "int"}},
        {"name": "seen", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "price", "type": {"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 2}},
        {"name": "state", "type": {"type": "enum", "name": "S", "symbols": ["A"]}},
        {"name": "number", "type": ["int", "long"]},
        {"name": "alarms", "type": ["null", {
            "type": "record", "name": "Alarms",
            "fields": [{"name": "k", "type": "boolean"}, {"name": "ov", "type": "int"}]}]},
    ],
})


def test_schema_keeps_order_and_types():
    schema = schema_from_avsc(AVSC)
    assert schema.fieldNames()[:3] == ["deviceID", "ts", "cellVolt"]
    assert schema["ts"].dataType == T.LongType() and schema["ts"].nullable
    assert schema["cellVolt"].dataType == T.ArrayType(T.DoubleType())
    assert schema["extra"].dataType == T.MapType(T.StringType(), T.IntegerType())
    assert schema["seen"].dataType == T.TimestampType()
    assert schema["price"].dataType == T.DecimalType(9, 2)
    assert schema["number"].dataType == T.LongType()
    assert schema["alarms"].dataType.fieldNames() == ["k", "ov"]


@pytest.mark.parametrize("bad", ['"string"', '{"type": "record", "fields": [{"name": "a", "type": "odd"}]}',
                                 '{"type": "record", "fields": [{"name": "a", "type": ["int", "string"]}]}'])
def test_unusable_contracts_are_refused(bad):
    with pytest.raises(ContractDrift):
        schema_from_avsc(bad)


def test_contract_is_read_from_files(spark, tmp_path):
    (tmp_path / "event.avsc").write_text(AVSC)
    (tmp_path / "names.json").write_text('{\n "k": "alarmK",\n "ov": "overVoltage"\n}')
    contract = load_contract(spark, str(tmp_path / "event.avsc"), str(tmp_path / "names.json"), zone="UTC")
    assert contract.rename_map == {"k": "alarmK", "ov": "overVoltage"}
    assert contract.columns == schema_from_avsc(AVSC).fieldNames()
    assert contract.zone == "UTC"


def test_drift_guard():
    names = '{"k": "alarmK", "ov": "overVoltage", "ut": "underTemp"}'
    contract = contract_from_texts(AVSC, names)
    check_drift(contract.schema, contract)  # a mapped field missing from the input is fine
    narrow = Contract(contract.schema, {"k": "alarmK"})
    with pytest.raises(ContractDrift, match="ov"):
        check_drift(contract.schema, narrow)
    with pytest.raises(ContractDrift, match="price"):
        check_drift(T.StructType([f for f in contract.schema.fields if f.name != "price"]), contract)


def test_whole_row_group_covers_all_columns():
    contract = contract_from_texts(AVSC, "{}")
    group = whole_row_group(contract)
    assert [contract.key, *group.outputs] == contract.columns


def schema(text):
    return T._parse_datatype_string(text)


def test_the_least_contract_above_two(spark):
    old = schema("k bigint, a int, gone string, n struct<x:int,y:string>, l array<float>, d date")
    new = schema("k bigint, a bigint, n struct<x:double,z:int>, l array<double>, d timestamp, more string")
    wide = wider_schema(old, new)
    assert wide.simpleString() == schema(
        "k bigint, a bigint, n struct<x:double,z:int,y:string>, l array<double>, d timestamp, more string, gone string").simpleString()
    assert wider_schema(new, old) == wider_schema(new, wider_schema(new, old))
    assert contract_changes(old, new) == [
        ("a", "widened", "int", "bigint"), ("n.x", "widened", "int", "double"), ("n.z", "added", None, "int"), ("n.y", "dropped", "string", None),
        ("l", "widened", "array<float>", "array<double>"), ("d", "widened", "date", "timestamp"), ("more", "added", None, "string"),
        ("gone", "dropped", "string", None)]
    assert ("a", "narrowed", "bigint", "int") in contract_changes(new, old)
    for a, b in (("v string", "v int"), ("v bigint", "v double"), ("n struct<x:string>", "n struct<x:date>")):
        with pytest.raises(ContractDrift, match=a[0]):
            wider_schema(schema(a), schema(b))


def test_rows_of_old_contracts(spark):
    first = spark.createDataFrame([(1, 2, (3,), [(4,)]), (2, None, None, None)], "k int, a int, n struct<x:int>, l array<struct<p:int>>")
    second = spark.createDataFrame([(2**40, "s", (1.5, "y"), [(2**40, "q")])], "k bigint, s string, n struct<x:double,y:string>, l array<struct<p:bigint,q:string>>")
    got = evolved([first, second])
    assert got.columns == ["k", "s", "n", "l", "a"]
    assert sorted(map(str, got.collect())) == sorted([
        "Row(k=1, s=None, n=Row(x=3.0, y=None), l=[Row(p=4, q=None)], a=2)", "Row(k=2, s=None, n=None, l=None, a=None)",
        f"Row(k={2**40}, s='s', n=Row(x=1.5, y='y'), l=[Row(p={2**40}, q='q')], a=None)"])
    plan = plan_of(conform(first, second.schema))
    assert "Exchange" not in plan and "Python" not in plan
    assert evolved([first.where("k > 5")]).count() == 0
