"""Device telemetry derived from the events table, in Spark and as SQL text for checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.contracts import Contract

# How telemetry columns follow from an event.
DEVICE_SQL = """
SELECT event_id, event_type, user_id AS deviceID, ms AS ts, ms-(event_id%3)*1000 AS originalTs,
  ms+(event_id%7)*1501 AS pushedAt, ms+(event_id%7)*1501+(event_id%5)*1501 AS consumedAt,
  value AS voltage, DOUBLE(event_id%101) AS soc, DOUBLE(event_id%41)-20 AS current,
  20+DOUBLE(event_id%17) AS temperature, value/16 AS cellVolt, 25+DOUBLE(event_id%11) AS cellTemp,
  8+DOUBLE(event_id%23) AS lat,
  CASE WHEN event_type='error' THEN 0.0D ELSE 68+DOUBLE(event_id%29) END AS lon,
  props AS alarms
FROM (SELECT *, unix_millis(CAST(ts AS TIMESTAMP)) AS ms FROM {events})
"""

DEVICE_CTE = """
WITH e AS (SELECT *, epoch_us(ts)//1000 AS ms FROM events),
dev AS (SELECT event_id, user_id AS "deviceID", ms AS ts, ms-(event_id%3)*1000 AS "originalTs",
  ms+(event_id%7)*1501 AS "pushedAt", ms+(event_id%7)*1501+(event_id%5)*1501 AS "consumedAt",
  value AS voltage, (event_id%101)::DOUBLE AS soc, (event_id%41)::DOUBLE-20 AS current,
  20+(event_id%17)::DOUBLE AS temperature, value/16 AS "cellVolt", 25+(event_id%11)::DOUBLE AS "cellTemp",
  8+(event_id%23)::DOUBLE AS lat, CASE WHEN event_type='error' THEN 0.0::DOUBLE ELSE 68+(event_id%29)::DOUBLE END AS lon,
  props AS alarms, event_type FROM e)
"""

# The same events with what the plain view lacks: rows without key or clock, clocks that
# tie within an hour, clocks that a timestamp cannot hold, and alarms with every mapped field.
_EDGE_COLUMNS = """
SELECT event_id, event_type, CASE WHEN event_id%13=0 THEN NULL ELSE {q}deviceID{q} END AS {q}deviceID{q},
  CASE WHEN event_id%17=0 THEN NULL ELSE ts - ts%3600000 END AS ts, {q}originalTs{q},
  CASE WHEN event_id%19=0 THEN 9000000000000000000 ELSE {q}pushedAt{q} END AS {q}pushedAt{q},
  CASE WHEN event_id%23=0 THEN -9000000000000000000 ELSE {q}consumedAt{q} END AS {q}consumedAt{q},
  voltage, soc, current, temperature, {q}cellVolt{q}, {q}cellTemp{q}, lat, lon,
  chr(123) || '"k":' || event_id%97 || ',"ov":' || CASE WHEN voltage > 70 THEN 'true' ELSE 'false' END ||
  ',"ut":"t' || event_id%5 || '"' || chr(125) AS alarms
"""
EDGE_SQL = f"{_EDGE_COLUMNS.format(q='`')} FROM ({DEVICE_SQL})"
EDGE_CTE = f"{DEVICE_CTE.rstrip()}, edge AS ({_EDGE_COLUMNS.format(q=chr(34))} FROM dev)"

RENAME_MAP = {"k": "alarmK", "ov": "overVoltage", "ut": "underTemp"}

_LONG, _DOUBLE, _STRING = T.LongType(), T.DoubleType(), T.StringType()

DEVICE_CONTRACT = Contract(
    schema=T.StructType([
        T.StructField("deviceID", _LONG),
        T.StructField("ts", _LONG),
        T.StructField("originalTs", _LONG),
        T.StructField("pushedAt", _LONG),
        T.StructField("consumedAt", _LONG),
        T.StructField("voltage", _DOUBLE),
        T.StructField("soc", _DOUBLE),
        T.StructField("current", _DOUBLE),
        T.StructField("temperature", _DOUBLE),
        T.StructField("cellVolt", _DOUBLE),
        T.StructField("cellTemp", _DOUBLE),
        T.StructField("lat", _DOUBLE),
        T.StructField("lon", _DOUBLE),
        T.StructField("alarms", _STRING),
    ]),
    rename_map=RENAME_MAP,
)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def edge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with edge cases, for every event."""
    return spark.sql(EDGE_SQL.format(events="{events}"), events=load_table(spark, sf_dir, "events"))


def device_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, event_type and the contract columns, one row per event."""
    return spark.sql(DEVICE_SQL.format(events="{events}"), events=load_table(spark, sf_dir, "events"))
