"""Row validity as 1/0 flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.contracts import BMS_TEST, IOT_TEST


def flag(test: str) -> Column:
    """1 where the test holds, 0 where it fails or is NULL."""
    return F.when(F.expr(test), 1).otherwise(0)


def bms_flag() -> Column:
    return flag(BMS_TEST)


def iot_flag() -> Column:
    return flag(IOT_TEST)
