"""Newest structs per key as arbitrary keyed state with an initial state.

Python sees one clock and one opaque text per struct: the texts are made and read by Spark, whose rows need not be
rebuilt in Python field by field, and only clocks are compared there. Timestamps travel as microseconds.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import SEQUENCE

STATE = "newest"


def _is_time(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.TimestampType)


def _as_number(column: Column, field: T.StructField) -> Column:
    return F.unix_micros(column) if _is_time(field) else column.cast("long")


def _packed(schema: T.StructType, name: str, clock: str) -> list[Column]:
    """Clock and text of a struct; both NULL for a NULL struct."""
    fields = schema[name].dataType.fields
    members = [(F.unix_micros(F.col(name)[f.name]) if _is_time(f) else F.col(name)[f.name]).alias(f.name) for f in fields]
    text = F.when(F.col(name).isNotNull(), F.to_json(F.struct(*members)))
    return [_as_number(F.col(name)[clock], schema[name].dataType[clock]).alias(f"{name}_clock"), text.alias(f"{name}_text")]


def _unpacked(data_type: T.StructType, name: str) -> Column:
    carried = T.StructType([T.StructField(f.name, T.LongType() if _is_time(f) else f.dataType) for f in data_type])
    parsed = F.from_json(f"{name}_text", carried)
    members = [(F.timestamp_micros(parsed[f.name]) if _is_time(f) else parsed[f.name]).alias(f.name) for f in data_type]
    return F.when(F.col(f"{name}_text").isNotNull(), F.struct(*members)).alias(name)


def _state_schema(names: list[str]) -> T.StructType:
    return T.StructType([
        T.StructField(f"{n}_{part}", kind) for n in names for part, kind in (("clock", T.LongType()), ("text", T.StringType()))])


def _processor(names: list[str], key: str):
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    schema, sequence, variable = _state_schema(names), SEQUENCE, STATE
    columns = schema.names

    class Newest(StatefulProcessor):  # defined here to be shipped by value
        def init(self, handle) -> None:
            self.held = handle.getValueState(variable, schema)

        def handleInitialState(self, key_values, initialState, timerValues) -> None:
            self.held.update(tuple(initialState[c] for c in columns))

        def handleInputRows(self, key_values, rows: Iterator[Row], timerValues) -> Iterator[Row]:
            """The stored struct stays unless its clock is NULL or smaller; batches count in their order."""
            state = list(self.held.get()) if self.held.exists() else [None] * len(columns)
            before = list(state)
            for row in sorted(rows, key=lambda r: r[sequence]):
                for i in range(0, len(columns), 2):
                    clock, held = row[columns[i]], state[i]
                    if held is None or (clock is not None and clock > held):
                        state[i:i + 2] = clock, row[columns[i + 1]]
            if state != before or not self.held.exists():
                self.held.update(tuple(state))
                yield Row(**dict(zip([key, *columns], [key_values[0], *state], strict=True)))

        def close(self) -> None:
            pass

    return Newest()


def newest_states(incoming: DataFrame, stored: DataFrame, key: str, clocks: Mapping[str, str]) -> DataFrame:
    """Changed keys with their newest structs. incoming is a stream of (key, a struct per name, `_seq`), stored a
    table of at most one row per key, which fills the state of a fresh checkpoint.

    Rows without a key are left out. Equal clocks keep the earlier struct, NULL clocks give way to later rows. A
    key that one batch brings several times is folded in the order of `_seq`.
    """
    names = list(clocks)
    schema = incoming.schema

    def packed(df: DataFrame, *more: str) -> DataFrame:
        columns = [c for n in names for c in _packed(schema, n, clocks[n])]
        return df.where(F.col(key).isNotNull()).select(key, *columns, *more)

    result = T.StructType([schema[key], *_state_schema(names).fields])
    states = packed(incoming, SEQUENCE).groupBy(key).transformWithState(
        _processor(names, key), result, "Update", "None", packed(stored).groupBy(key))
    return states.select(key, *[_unpacked(schema[n].dataType, n) for n in names])


def read_states(
    spark: SparkSession, checkpoint: str, schema: T.StructType, key: str, batch_id: int | None = None
) -> DataFrame:
    """All keys and their structs as the state holds them after a batch, by default the last one committed."""
    reader = spark.read.format("statestore").option("stateVarName", STATE)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    rows = reader.load(checkpoint).select(F.col("key")[key].alias(key), "value.*")
    return rows.select(key, *[_unpacked(f.dataType, f.name) for f in schema if f.name != key])
