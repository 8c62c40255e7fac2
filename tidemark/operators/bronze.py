"""Decoded rows to bronze rows, and their clocks to timestamps for silver.

Both are single projections: no shuffle, one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import Contract, check_drift
from tidemark.functions.alarms import alarms_struct
from tidemark.functions.clocks import date_parts, local_time, minutes_between

DERIVED = ("timeLatency", "consumedLatency", "year", "month", "day", "insert_date")
PARTITIONS = ("year", "month", "day")


def bronze_columns(schema: T.StructType, contract: Contract) -> dict[str, Column]:
    """Output expressions by name, in contract order and then the derived ones.

    Date parts come from the event clock, so late rows land in past partitions.
    """
    event_time = local_time(contract.clock, contract.zone)
    replaced = {
        contract.clock: event_time,
        contract.alarms: alarms_struct(
            contract.alarms, schema[contract.alarms].dataType, contract.rename_map
        ),
    }
    derived = {
        "timeLatency": minutes_between("pushedAt", contract.clock),
        "consumedLatency": minutes_between("consumedAt", "pushedAt"),
        **date_parts(event_time),
    }
    ordered = {c: replaced.get(c, F.col(c)) for c in contract.columns}
    ordered.update({c: derived[c] for c in DERIVED})
    return ordered


def to_bronze(df: DataFrame, contract: Contract) -> DataFrame:
    """All contract columns with the event clock as local timestamp, alarms renamed."""
    check_drift(df.schema, contract)
    return df.select(*[c.alias(name) for name, c in bronze_columns(df.schema, contract).items()])


def with_local_clocks(df: DataFrame, contract: Contract) -> DataFrame:
    """Every epoch column as local timestamp, other columns as they are."""
    return df.withColumns({c: local_time(c, contract.zone) for c in contract.epoch_columns})


def bronze_to_events(bronze: DataFrame, contract: Contract) -> DataFrame:
    """Bronze rows in the shape silver reads: all four clocks as local timestamps.

    Alarms stay the renamed struct, the one way in which silver built from
    bronze differs from silver built from the decoded rows.
    """
    epochs = [c for c in contract.epoch_columns if c != contract.clock]
    return bronze.select(*contract.columns).withColumns(
        {c: local_time(c, contract.zone) for c in epochs}
    )
