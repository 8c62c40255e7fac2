"""Alarm payloads, as a struct or as JSON text, to a struct of renamed strings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def alarms_struct(alarms: str, alarms_type: T.DataType, rename_map: Mapping[str, str]) -> Column:
    """Mapped alarm fields as strings under their output names, in map order.

    Every mapped name is present whatever the input holds (NULL when absent), so
    the table schema does not depend on the form in which alarms arrived.
    """
    if isinstance(alarms_type, T.StructType):
        present = set(alarms_type.fieldNames())
        fields = [
            (F.col(alarms).getField(source).cast("string") if source in present else F.lit(None).cast("string"))
            .alias(output)
            for source, output in rename_map.items()
        ]
        return F.struct(*fields)
    # One parse for all fields: read them under their source names, then rename by
    # casting the struct. Nested values stay JSON text.
    text_schema = T.StructType([T.StructField(source, T.StringType()) for source in rename_map])
    renamed = T.StructType([T.StructField(output, T.StringType()) for output in rename_map.values()])
    empty = F.struct(*[F.lit(None).cast("string").alias(output) for output in rename_map.values()])
    return F.coalesce(F.from_json(F.col(alarms), text_schema).cast(renamed), empty)


def alarms_paths(alarms: str, rename_map: Mapping[str, str]) -> Column:
    """JSON text only: one path lookup per field, in sorted field order."""
    return F.struct(*[
        F.get_json_object(F.col(alarms), f"$['{source}']").alias(rename_map[source])
        for source in sorted(rename_map)
    ])
