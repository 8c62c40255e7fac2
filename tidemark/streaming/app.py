"""spark-submit entry point of the streaming job."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from tidemark.contracts import load_contract
from tidemark.operators.maintenance import SILVER_EVERY
from tidemark.session import build_session
from tidemark.sources.streams import MAX_OFFSETS_PER_TRIGGER, STARTING_OFFSETS, file_stream, kafka_stream
from tidemark.streaming.jobs import INGEST_TRIGGER, SILVER_TRIGGER, quiet_merge, start_ingest, start_silver
from tidemark.streaming.lake import SILVER_INTERVAL_S, CatalogLake, Lake
from tidemark.streaming.policy import BatchTimes, supervise


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("--root", required=True, help="folder of all tables and checkpoints")
    p.add_argument("--contract", required=True, help="Avro record text of the payload")
    p.add_argument("--rename-map", required=True, help="JSON object: alarm field to output name")
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--topic", help="Kafka topic")
    source.add_argument("--folder", help="folder of files with a value column")
    p.add_argument("--brokers")
    p.add_argument("--starting-offsets", default=STARTING_OFFSETS)
    p.add_argument("--max-offsets", type=int, default=MAX_OFFSETS_PER_TRIGGER)
    p.add_argument("--group-prefix", help="consumer group prefix of the topic reader")
    p.add_argument("--fail-on-data-loss", action="store_true", help="stop when offsets are gone instead of going on")
    p.add_argument("--max-files", type=int)
    p.add_argument("--max-bytes", help="admission by bytes instead of files, such as 512m")
    p.add_argument("--bronze-files", type=int, help="files per bronze batch; 0 writes partitions as they are, without a shuffle")
    p.add_argument("--silver-interval", type=int, default=SILVER_INTERVAL_S, help="seconds a pending row may wait for silver")
    p.add_argument("--payload-format", choices=["avro", "json"], default="avro")
    p.add_argument("--topology", choices=["combined", "chain"], default="chain")
    p.add_argument("--silver-every", type=int, default=SILVER_EVERY)
    p.add_argument("--buckets", type=int, default=8)
    p.add_argument("--catalog", help="write bronze and silver to this catalog instead of folders below root")
    p.add_argument("--bronze-namespace", default="bronze")
    p.add_argument("--silver-namespace", default="silver")
    p.add_argument("--zone", default="Asia/Kolkata")
    p.add_argument("--checkpoint", default="ingest", help="name; change it when the topology changes")
    p.add_argument("--until-caught-up", action="store_true", help="process what is there, then stop")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, keep_session: bool = False) -> None:
    """Run the job; the session ends with it unless the caller keeps it."""
    args = arguments(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s - %(levelname)s - %(message)s")
    spark = build_session("tidemark")
    try:
        run(spark, args)
    finally:
        if not keep_session:
            spark.stop()


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    spark.streams.addListener(BatchTimes())
    contract = load_contract(spark, args.contract, args.rename_map, zone=args.zone)
    if args.catalog:
        lake = CatalogLake(
            spark,
            args.root,
            contract,
            catalog=args.catalog,
            bronze_namespace=args.bronze_namespace,
            silver_namespace=args.silver_namespace,
            bronze_files=args.bronze_files,
            silver_interval_s=args.silver_interval,
        )
        lake.prepare()
    else:
        lake = Lake(
            spark, args.root, contract, buckets=args.buckets, bronze_files=args.bronze_files,
            silver_interval_s=args.silver_interval,
        )
    if args.topic:
        raw = kafka_stream(
            spark,
            brokers=args.brokers,
            topic=args.topic,
            starting_offsets=args.starting_offsets,
            max_offsets_per_trigger=args.max_offsets,
            group_id_prefix=args.group_prefix,
            fail_on_data_loss=args.fail_on_data_loss,
        )
    else:
        kind = "binary" if args.payload_format == "avro" else "string"
        raw = file_stream(spark, args.folder, f"value {kind}", max_files_per_trigger=args.max_files,
                          max_bytes_per_trigger=args.max_bytes)
    once = {"availableNow": True}
    combined = args.topology == "combined"
    if combined:
        lake.merge_pending()  # what an earlier run left behind
    ingest = start_ingest(
        lake,
        raw,
        args.payload_format,
        args.silver_every if combined else None,
        once if args.until_caught_up else INGEST_TRIGGER,
        args.checkpoint,
    )
    if combined:
        supervise(ingest, tick=quiet_merge(lake))
        lake.merge_pending()  # the last batches may not have been due
    elif args.until_caught_up:
        supervise(ingest)
        supervise(start_silver(lake, once, f"{args.checkpoint}-silver"))
    else:
        supervise(ingest, start_silver(lake, SILVER_TRIGGER, f"{args.checkpoint}-silver"))


if __name__ == "__main__":
    main()
