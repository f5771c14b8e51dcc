"""Command-line entry point: run the relay as a long-lived streaming job.

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version> \\
        --py-files ferry.zip ferry/cli.py --bootstrap-servers b1:9092 \\
        --source-topic inputTopic --target-topic employees --consumer-id relay

(or ``python -m ferry ...`` where pyspark is installed).

Every constant the reference hard-coded (hosts, topics, consumer id, fetch
size, start position, batch interval) is a flag. The checkpoint lives at a
stable path under ``spark.checkpoint.dir`` keyed by the consumer id, so a
restarted job resumes after the last committed batch. ``--replay-path`` /
``--output-path`` swap Kafka for the parquet file twin.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ferry.functions.strict_json import DEFAULT_TIMESTAMP_FORMAT
from ferry.schemas import EMPLOYEE
from ferry.session import shared_dir
from ferry.sources.kafka import read_kafka
from ferry.sources.options import KafkaSink, KafkaSource
from ferry.sources.replay import read_replay
from ferry.streaming.jobs import RelayTables, committed_offsets, start_publish, start_relay
from ferry.streaming.resume import frozen_marks, plan_starting_offsets, resume_replay
from ferry.streaming.sinks import FileSink, KafkaWriter


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="ferry", description=__doc__.split("\n\n")[0])
    p.add_argument("--bootstrap-servers", help="Kafka brokers (source and sink)")
    p.add_argument("--source-topic", default=None)
    p.add_argument("--target-topic", required=True)
    p.add_argument("--consumer-id", required=True, help="names the query and its checkpoint")
    p.add_argument("--schema", default=None, help="record schema as DDL; default: the employee record")
    p.add_argument("--from-start", action="store_true", help="first run starts at the earliest offsets")
    p.add_argument("--fetch-bytes", type=int, default=None)
    p.add_argument(
        "--max-offsets-per-trigger",
        type=int,
        default=None,
        help="most messages of a micro-batch; default: what the cores read in one trigger interval; 0 = no bound",
    )
    p.add_argument("--max-files-per-trigger", type=int, default=None, help="most replayed files of a micro-batch")
    p.add_argument(
        "--max-bytes-per-trigger", type=int, default=None, help="most bytes of replayed files of a micro-batch; default 4 GiB"
    )
    p.add_argument(
        "--resume-from",
        default=None,
        metavar="TABLES",
        help="side tables of an earlier run: a new checkpoint starts after their committed offsets",
    )
    p.add_argument("--partitions", type=int, default=None, help="partitions of the source topic, for --resume-from")
    p.add_argument("--dead-letter-topic", default=None, help="publish only, invalid messages to this topic; no side tables")
    p.add_argument("--timestamp-format", default=DEFAULT_TIMESTAMP_FORMAT, help="format of timestamp fields")
    p.add_argument(
        "--min-partitions",
        type=int,
        default=None,
        help="Spark tasks per micro-batch at least; large (hot) Kafka partitions are split in proportion "
        "to their offset ranges. Default: 3 x the cluster's default parallelism; 0 = one task per partition",
    )
    p.add_argument("--trigger-seconds", type=float, default=2.0)
    p.add_argument("--once", action="store_true", help="process what is available, then stop")
    p.add_argument("--json-option", action="append", default=[], metavar="KEY=VALUE")
    p.add_argument("--source-option", action="append", default=[], metavar="KEY=VALUE", help="extra Kafka source option")
    p.add_argument("--sink-option", action="append", default=[], metavar="KEY=VALUE", help="extra Kafka sink option")
    p.add_argument("--source-headers", action="store_true", help="add src topic/partition/offset headers")
    p.add_argument("--root", default=None, help="checkpoint and side tables; default under spark.checkpoint.dir")
    p.add_argument("--replay-path", default=None, help="read parquet messages instead of Kafka")
    p.add_argument("--output-path", default=None, help="write parquet messages instead of Kafka")
    args = p.parse_args(argv)
    if args.replay_path is None and (args.bootstrap_servers is None or args.source_topic is None):
        p.error("--bootstrap-servers and --source-topic are required unless --replay-path is given")
    if args.output_path is None and args.bootstrap_servers is None:
        p.error("--bootstrap-servers is required unless --output-path is given")
    if args.resume_from is not None and args.replay_path is None and args.partitions is None:
        p.error("--resume-from needs --partitions, the number of partitions of the source topic")
    return args


def _pairs(items: Sequence[str]) -> dict[str, str]:
    return dict(kv.split("=", 1) for kv in items)


def min_partitions(spark: SparkSession, requested: int | None) -> int | None:
    """Tasks per micro-batch: by default 3 x default parallelism, so a Kafka
    partition carrying a large share of the traffic is read by many tasks."""
    if requested is None:
        return 3 * spark.sparkContext.defaultParallelism
    return requested or None


# Messages a core reads in a second, at the lower end of what was measured.
MESSAGES_PER_CORE_SECOND = 35_000


def max_offsets(spark: SparkSession, requested: int | None, seconds: float) -> int | None:
    """Most messages of a micro-batch, which is cached: bounded by default."""
    if requested is None:
        return int(MESSAGES_PER_CORE_SECOND * spark.sparkContext.defaultParallelism * max(seconds, 1.0))
    return requested or None


def start(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    root = args.root or f"{shared_dir(spark)}/ferry/{args.consumer_id}"
    marks = None
    if args.resume_from is not None:
        committed = committed_offsets(spark, RelayTables(args.resume_from))
        marks = frozen_marks(spark, committed, f"{root}/resume_marks")
    if args.replay_path is not None:
        schema = spark.read.parquet(args.replay_path).schema
        source = read_replay(
            spark,
            args.replay_path,
            schema,
            max_files_per_trigger=args.max_files_per_trigger,
            max_bytes_per_trigger=args.max_bytes_per_trigger,
        )
        if marks is not None:
            source = resume_replay(source, marks)
    else:
        source = read_kafka(
            spark,
            KafkaSource(
                args.bootstrap_servers,
                args.source_topic,
                from_start=args.from_start,
                starting_offsets=None if marks is None else plan_starting_offsets(marks, {args.source_topic: args.partitions}),
                fetch_bytes=args.fetch_bytes,
                max_offsets_per_trigger=max_offsets(spark, args.max_offsets_per_trigger, args.trigger_seconds),
                min_partitions=min_partitions(spark, args.min_partitions),
                consumer_id=args.consumer_id,
                extra=_pairs(args.source_option),
            ),
        )
    if args.output_path is not None:
        sink = FileSink(args.output_path, routed=args.dead_letter_topic is not None)
    else:
        sink = KafkaWriter(
            KafkaSink(args.bootstrap_servers, args.target_topic, extra=_pairs(args.sink_option)),
            routed=args.dead_letter_topic is not None,
        )
    trigger = {"availableNow": True} if args.once else {"processingTime": f"{args.trigger_seconds} seconds"}
    if args.dead_letter_topic is not None:
        return start_publish(
            source,
            args.schema or EMPLOYEE,
            args.target_topic,
            sink,
            f"{root}/checkpoint",
            trigger=trigger,
            json_options=_pairs(args.json_option),
            timestamp_format=args.timestamp_format,
            dead_letter_topic=args.dead_letter_topic,
            query_name=args.consumer_id,
        )
    return start_relay(
        source,
        args.schema or EMPLOYEE,
        args.target_topic,
        sink,
        RelayTables(f"{root}/tables"),
        f"{root}/checkpoint",
        trigger=trigger,
        json_options=_pairs(args.json_option),
        timestamp_format=args.timestamp_format,
        source_headers=args.source_headers,
        query_name=args.consumer_id,
    )


def main(argv: Sequence[str] | None = None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName(f"ferry-{args.consumer_id}").getOrCreate()
    start(spark, args).awaitTermination()


if __name__ == "__main__":
    main()
