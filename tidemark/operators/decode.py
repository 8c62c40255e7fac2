"""Payload bytes to contract columns, keeping undecodable payloads apart."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import Contract
from tidemark.functions.clocks import in_calendar

BAD_PAYLOAD = "_bad_payload"
BAD_REASON = "_bad_reason"
# What may become of a row; the last three are reasons of refusal.
OUTCOMES = ("good", "no key", "empty", "corrupt", "clock out of range")
REFUSALS = OUTCOMES[2:]
_CORRUPT = "_corrupt_text"
_PAYLOAD = "_payload"


def decode_json(
    df: DataFrame, contract: Contract, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Contract columns of a JSON payload; a payload that fails gives NULLs.

    Columns of the input named in keep come first. The two trailing columns are
    NULL for good rows; for bad ones they hold the payload text and why it was
    refused.
    """
    schema = T.StructType([*contract.schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    payload = F.col(value).cast("string")
    data = F.from_json(payload, schema, options)
    return _with_verdict(
        _unpacked(df, payload, data, keep),
        contract,
        keep,
        empty=F.trim(_PAYLOAD) == "",
        corrupt=F.col(_CORRUPT).isNotNull(),  # a record without any value is still a record
        text=F.col(_PAYLOAD),
    )


def decode_avro(
    df: DataFrame, contract: Contract, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Same as decode_json for Avro binary; needs Spark's Avro module on the classpath."""
    if not contract.avro_text:
        raise ValueError("an Avro payload needs the contract's Avro text")
    from pyspark.sql.avro.functions import from_avro

    data = from_avro(F.col(value), contract.avro_text, {"mode": "PERMISSIVE"})
    return _with_verdict(
        _unpacked(df, F.col(value), data, keep),
        contract,
        keep,
        empty=F.length(_PAYLOAD) == 0,
        # a payload that Avro cannot read gives a row of NULLs and nothing else to tell it by
        corrupt=_all([F.col(c).isNull() for c in contract.columns]),
        text=F.base64(_PAYLOAD),
    )


DECODERS = {"json": decode_json, "avro": decode_avro}


def decode(
    df: DataFrame,
    contract: Contract,
    payload_format: str = "json",
    value: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    return DECODERS[payload_format](df, contract, value, keep)


def _unpacked(df: DataFrame, payload: Column, data: Column, keep: Sequence[str]) -> DataFrame:
    """Payload and decoded columns. Decoding inside a generator happens once per row;
    as a plain projection it would be repeated in every filter pushed below it."""
    return df.select(*keep, payload.alias(_PAYLOAD), F.inline(F.array(data)))


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _with_verdict(
    df: DataFrame,
    contract: Contract,
    keep: Sequence[str],
    empty: Column,
    corrupt: Column,
    text: Column,
) -> DataFrame:
    # only the event clock becomes a bronze timestamp and partition; the others stay numbers there
    reason = (
        F.when(F.col(_PAYLOAD).isNull() | empty, "empty")
        .when(corrupt, "corrupt")
    )
    if contract.clock in contract.epoch_columns:
        reason = reason.when(~in_calendar(F.col(contract.clock)), "clock out of range")
    judged = df.withColumn(BAD_REASON, reason)
    refused = F.col(BAD_REASON).isNotNull()
    return judged.select(
        *keep,
        *[F.when(~refused, F.col(c)).alias(c) for c in contract.columns],
        F.when(refused, text).alias(BAD_PAYLOAD),
        BAD_REASON,
    )


def good_rows(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(BAD_REASON).isNull()).drop(BAD_PAYLOAD, BAD_REASON)


def refused_rows(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(BAD_REASON).isNotNull()).select(
        F.col(BAD_PAYLOAD).alias("payload"), F.col(BAD_REASON).alias("reason")
    )


def outcome(contract: Contract) -> Column:
    """What became of a decoded row: good, good without a key, or the reason of refusal."""
    return F.coalesce(F.col(BAD_REASON), F.when(F.col(contract.key).isNull(), "no key").otherwise("good"))


def outcome_counts(contract: Contract) -> list[Column]:
    """One aggregate per outcome, to be observed while rows pass."""
    return [F.count_if(outcome(contract) == name).alias(name) for name in OUTCOMES]


def decode_counts(decoded: DataFrame, contract: Contract) -> DataFrame:
    """Rows per outcome."""
    return decoded.groupBy(outcome(contract).alias("outcome")).agg(F.count("*").alias("n_rows"))
