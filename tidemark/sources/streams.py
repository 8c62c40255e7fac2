"""Streaming inputs: a Kafka topic, or a folder of files carrying the same value column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Admission cap per trigger and start position of the topic reader.
MAX_OFFSETS_PER_TRIGGER = 500_000
STARTING_OFFSETS = "latest"


def kafka_options(
    brokers: str,
    topic: str,
    starting_offsets: str = STARTING_OFFSETS,
    max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER,
    group_id_prefix: str | None = None,
    fail_on_data_loss: bool = False,
    security_protocol: str = "PLAINTEXT",
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options for one topic.

    starting_offsets only applies to a fresh checkpoint. With "latest" the gap
    since the previous checkpoint is not read; pass "earliest" to replay it.
    min_partitions splits large topic partitions over more tasks.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "kafka.security.protocol": security_protocol,
        "maxOffsetsPerTrigger": str(max_offsets_per_trigger),
    }
    if group_id_prefix:
        options["groupIdPrefix"] = group_id_prefix
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_stream(spark: SparkSession, **options) -> DataFrame:
    """The topic as a stream holding only the payload bytes."""
    return spark.readStream.format("kafka").options(**kafka_options(**options)).load().select("value")


def file_options(
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
    ignore_missing_files: bool = True,
    latest_first: bool = False,
) -> dict[str, str]:
    options = {
        "latestFirst": str(latest_first).lower(),
        "ignoreMissingFiles": str(ignore_missing_files).lower(),
    }
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("admission is limited either by files or by bytes, not both")
    if max_files_per_trigger:
        options["maxFilesPerTrigger"] = str(max_files_per_trigger)
    if max_bytes_per_trigger:
        options["maxBytesPerTrigger"] = max_bytes_per_trigger
    return options


def file_stream(
    spark: SparkSession, path: str, schema: StructType | str, file_format: str = "parquet", **limits
) -> DataFrame:
    """A folder of files as a stream, with admission control by files or bytes."""
    return (
        spark.readStream.format(file_format)
        .schema(schema)
        .options(**file_options(**limits))
        .load(path)
    )
