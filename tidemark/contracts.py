"""The data contract: payload schema, key and clock columns, alarm names, column groups.

Everything that depends on the device fleet is data held here, so that no
transform names a column of its own.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.files import read_text


class ContractDrift(ValueError):
    """Incoming columns are not covered by the contract."""


@dataclass(frozen=True)
class ColumnGroup:
    """Columns that advance together, on one clock, from rows passing one test.

    columns maps source column to output column; the source clock column is
    written as `clock`. A group without a test takes every row.
    """

    clock: str
    columns: Mapping[str, str] = field(default_factory=dict)
    test: str | None = None
    source_clock: str = "ts"

    @property
    def outputs(self) -> list[str]:
        return [self.clock, *self.columns.values()]


@dataclass(frozen=True)
class Contract:
    schema: T.StructType
    rename_map: Mapping[str, str]
    key: str = "deviceID"
    clock: str = "ts"
    epoch_columns: tuple[str, ...] = ("ts", "originalTs", "consumedAt", "pushedAt")
    alarms: str = "alarms"
    zone: str = "Asia/Kolkata"
    avro_text: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


# The strict bounds of a plausible pack voltage, and the columns
# each kind of valid row carries into the latest-valid table, in output order.
BMS_TEST = "voltage > 0 AND voltage < 70"
IOT_TEST = "lon > 0"

LATEST_VALID_GROUPS = (
    ColumnGroup("ts"),
    ColumnGroup(
        "bmsLastTs",
        {
            "lat": "bmsLastLat",
            "lon": "bmsLastLon",
            "voltage": "voltage",
            "soc": "soc",
            "current": "current",
            "temperature": "temperature",
            "cellVolt": "cellVolt",
            "cellTemp": "cellTemp",
            "alarms": "alarms",
        },
        BMS_TEST,
    ),
    ColumnGroup("iotLastTs", {"lat": "lat", "lon": "lon"}, IOT_TEST),
)


def whole_row_group(contract: Contract) -> ColumnGroup:
    """Every column on the event clock: the rule of the newest-row-wins table."""
    rest = [c for c in contract.columns if c not in (contract.key, contract.clock)]
    return ColumnGroup(contract.clock, {c: c for c in rest}, None, contract.clock)


_AVRO_PRIMITIVES = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}

_AVRO_LOGICAL = {
    "date": T.DateType(),
    "timestamp-millis": T.TimestampType(),
    "timestamp-micros": T.TimestampType(),
}


def _spark_type(avro) -> T.DataType:
    if isinstance(avro, list):
        members = [m for m in avro if m != "null"]
        if len(members) == 1:
            return _spark_type(members[0])
        if set(members) == {"int", "long"}:
            return T.LongType()
        if set(members) == {"float", "double"}:
            return T.DoubleType()
        raise ContractDrift(f"union of several types is not supported: {avro}")
    if isinstance(avro, str):
        if avro not in _AVRO_PRIMITIVES:
            raise ContractDrift(f"unknown type in contract: {avro}")
        return _AVRO_PRIMITIVES[avro]
    if avro.get("logicalType") in _AVRO_LOGICAL:
        return _AVRO_LOGICAL[avro["logicalType"]]
    if avro.get("logicalType") == "decimal":
        return T.DecimalType(avro["precision"], avro.get("scale", 0))
    kind = avro["type"]
    if kind == "record":
        return T.StructType([T.StructField(f["name"], _spark_type(f["type"])) for f in avro["fields"]])
    if kind == "array":
        return T.ArrayType(_spark_type(avro["items"]))
    if kind == "map":
        return T.MapType(T.StringType(), _spark_type(avro["values"]))
    if kind == "enum":
        return T.StringType()
    if kind == "fixed":
        return T.BinaryType()
    return _spark_type(kind)


def schema_from_avsc(text: str) -> T.StructType:
    """Avro record text to a Spark schema, every field nullable, order kept."""
    record = _spark_type(json.loads(text))
    if not isinstance(record, T.StructType):
        raise ContractDrift("the contract must describe a record")
    return record


def contract_from_texts(avsc_text: str, rename_text: str, **overrides) -> Contract:
    return Contract(
        schema=schema_from_avsc(avsc_text),
        rename_map=json.loads(rename_text),
        avro_text=avsc_text,
        **overrides,
    )


def load_contract(spark: SparkSession, avsc_path: str, rename_path: str, **overrides) -> Contract:
    """Read both contract files from any path the cluster can read."""
    return contract_from_texts(read_text(spark, avsc_path), read_text(spark, rename_path), **overrides)


def check_drift(schema: T.StructType, contract: Contract) -> None:
    """Fail on missing contract columns and on alarm fields the rename map lacks.

    Runs on the schema alone, once when a query starts. Mapped alarm fields
    missing from the schema are allowed.
    """
    missing = [c for c in contract.columns if c not in schema.fieldNames()]
    if missing:
        raise ContractDrift(f"columns missing from input: {missing}")
    alarms_type = schema[contract.alarms].dataType
    if isinstance(alarms_type, T.StructType):
        unknown = sorted(set(alarms_type.fieldNames()) - set(contract.rename_map))
        if unknown:
            raise ContractDrift(f"alarm fields without an output name: {unknown}")


# Types that hold all values of the ones before them in the same line.
WIDENING = (("tinyint", "smallint", "int", "bigint"), ("float", "double"), ("tinyint", "smallint", "int", "double"), ("date", "timestamp"))


def wider_type(one: T.DataType, other: T.DataType, path: str = "") -> T.DataType:
    """The least type that holds the values of both, field by field and element by element."""
    if one == other:
        return one
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        return wider_schema(one, other, path)
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        return T.ArrayType(wider_type(one.elementType, other.elementType, f"{path}[]"))
    names = one.simpleString(), other.simpleString()
    for line in WIDENING:
        if all(n in line for n in names):
            return max((one, other), key=lambda t: line.index(t.simpleString()))
    raise ContractDrift(f"{path or 'value'}: no type holds both {names[0]} and {names[1]}")


def wider_schema(old: T.StructType, new: T.StructType, path: str = "") -> T.StructType:
    """The new contract's fields in order, widened where the old ones need it, then the fields it dropped; all nullable."""
    known = {f.name: f.dataType for f in old.fields}
    fields = [
        T.StructField(f.name, wider_type(known[f.name], f.dataType, f"{path}.{f.name}".lstrip(".")) if f.name in known else f.dataType)
        for f in new.fields
    ]
    return T.StructType([*fields, *[T.StructField(f.name, f.dataType) for f in old.fields if f.name not in new.fieldNames()]])


def contract_changes(old: T.StructType, new: T.StructType, path: str = "") -> list[tuple[str, str, str | None, str | None]]:
    """(field, change, old type, new type) of every field that is added, dropped, widened or narrowed; nested ones by path."""
    out = []
    known, wanted = ({f.name: f.dataType for f in s.fields} for s in (old, new))
    for name in [*wanted, *[n for n in known if n not in wanted]]:
        a, b, at = known.get(name), wanted.get(name), f"{path}{name}"
        if isinstance(a, T.StructType) and isinstance(b, T.StructType):
            out += contract_changes(a, b, f"{at}.")
        elif a is None or b is None:
            out.append((at, "added" if a is None else "dropped", a and a.simpleString(), b and b.simpleString()))
        elif a != b:
            out.append((at, "widened" if wider_type(a, b, at) == b else "narrowed", a.simpleString(), b.simpleString()))
    return out


def _conformed(value: Column, kind: T.DataType, wanted: T.DataType) -> Column:
    if kind == wanted:
        return value
    if isinstance(wanted, T.StructType):
        have = {f.name: f.dataType for f in kind.fields}
        made = F.struct(*[
            (_conformed(value.getField(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted.fields
        ])
        return F.when(value.isNotNull(), made)
    if isinstance(wanted, T.ArrayType) and isinstance(wanted.elementType, (T.StructType, T.ArrayType)):
        return F.transform(value, lambda x: _conformed(x, kind.elementType, wanted.elementType))
    return value.cast(wanted)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of an older contract in the shape of a wider one: one projection; missing fields are NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        (_conformed(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def evolved(generations: Sequence[DataFrame]) -> DataFrame:
    """Rows written under successive contracts, oldest first, as one table of the least contract above all of them."""
    schema = reduce(wider_schema, [g.schema for g in generations])
    return reduce(DataFrame.unionByName, [conform(g, schema) for g in generations])
