"""The relay as a streaming query.

``start_publish`` is the straight path: source -> classify -> publish ->
sink, one Catalyst plan per micro-batch with no shuffle, so each source
partition (Kafka partition or file split) is one task and message order
inside a partition is kept.

``start_relay`` adds the side outputs through ``foreachBatch``: the
classified batch is persisted once and written three times - published
records, rejects, then the committed-offsets snapshot - and then marked as
ended. Readers take marked batches only. Progress (the checkpoint's commit log)
advances only after all succeed; a failed batch is replayed under the same batch
id and the per-batch-id writes overwrite instead of duplicating.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ferry.functions.strict_json import DEFAULT_TIMESTAMP_FORMAT, classify
from ferry.operators.offsets import merge_offsets
from ferry.operators.records import publish_envelope, rejects, routed, status_metrics
from ferry.schemas import OFFSETS, POSITION, PUBLISHED, REJECTS, as_struct
from ferry.streaming.sinks import FileSink, run_id

logger = logging.getLogger(__name__)

# The reference's micro-batch interval, as the default trigger.
DEFAULT_TRIGGER: Mapping[str, object] = {"processingTime": "2 seconds"}
# Name of the observed per-batch counts (StreamingQueryProgress.observedMetrics).
METRICS_NAME = "ferry_relay"


def _with_trigger(writer: DataStreamWriter, trigger: Mapping[str, object] | None) -> DataStreamWriter:
    return writer.trigger(**dict(trigger or DEFAULT_TRIGGER))


@dataclass(frozen=True)
class RelayTables:
    """Where ``start_relay`` keeps its side tables.

    ``rejects`` grows by one partition per batch (it is data). The committed
    offsets are snapshots, one folder with one small file per run and batch:
    batch N folds its maxima into the snapshot of batch N-1 of its run, and
    nothing but its own replay writes that folder again. A run keeps its last
    ``KEEP_SNAPSHOTS``, so storage stays bounded however long the job goes on.
    Offsets only grow, so readers take the maximum over all that is there.

    ``commits`` makes the three outputs one: a run's batches end one after the
    other, and each leaves a marker when all its writes are done. Readers take
    the batches up to a run's last marker, so that a crash between two writes
    never shows published messages without their rejects, or offsets without
    either.
    """

    root: str

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def offsets(self) -> str:
        return f"{self.root}/offsets"

    @property
    def commits(self) -> str:
        return f"{self.root}/commits"

    def commit(self, run: str, batch_id: int) -> str:
        return f"{self.commits}/run_id={run}/batch_id={batch_id}"

    def offsets_snapshot(self, run: str, batch_id: int) -> str:
        return f"{self.offsets}/run_id={run}/batch_id={batch_id}"


# Snapshots of a run that stay: a reader has that many batches' time to read
# what it has listed.
KEEP_SNAPSHOTS = 20
# n_records: the messages of that batch (null: none from the partition).
_SNAPSHOT = T.StructType([*OFFSETS.fields, T.StructField("n_records", T.LongType(), True)])


_COMMIT = T.StructType([T.StructField("n_messages", T.LongType(), True)])
_COMMIT_KEYS = "run_id string, batch_id long"


def _init_tables(spark: SparkSession, tables: RelayTables) -> None:
    """An empty snapshot and marker, unless they are there, so that readers find the tables."""
    spark.createDataFrame([], _SNAPSHOT).write.mode("ignore").parquet(tables.offsets_snapshot("none", -1))
    spark.createDataFrame([], _COMMIT).write.mode("ignore").parquet(tables.commit("none", -1))


def _path(spark: SparkSession, path: str):
    """A path and its file system."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _drop_old(spark: SparkSession, path: str) -> None:
    old, files = _path(spark, path)
    files.delete(old, True)


def _write_commit(spark: SparkSession, tables: RelayTables, batch_id: int, messages: int | None) -> None:
    """The marker of a batch whose writes are all done: one small file."""
    run = run_id(spark)
    spark.createDataFrame([(messages,)], _COMMIT).coalesce(1).write.mode("overwrite").parquet(tables.commit(run, batch_id))
    _drop_old(spark, tables.commit(run, batch_id - KEEP_SNAPSHOTS))


def complete(spark: SparkSession, tables: RelayTables, rows: DataFrame) -> DataFrame:
    """``rows`` (with run_id and batch_id) of the batches that ended. The other
    side has one row for each run and is broadcast only if Spark finds it small."""
    schema = T.StructType([*_COMMIT.fields, *as_struct(_COMMIT_KEYS).fields])
    marks = spark.read.schema(schema).parquet(tables.commits).where("n_messages is not null or batch_id >= 0")
    last = marks.groupBy(F.col("run_id").alias("_run")).agg(F.max("batch_id").alias("_last"))
    done = (F.col("run_id") == F.col("_run")) & (F.col("batch_id") <= F.col("_last"))
    return rows.join(last, done, "left_semi")


def _write_offsets_snapshot(spark: SparkSession, tables: RelayTables, batch: DataFrame, batch_id: int) -> None:
    """K1: committed offsets after ``batch_id`` = snapshot of ``batch_id - 1`` + this batch."""
    run = run_id(spark)
    current = batch.groupBy(*POSITION).agg(
        F.max("offset").alias("max_offset"), F.count(F.lit(1)).alias("n_records")
    )
    if batch_id > 0:
        before, files = _path(spark, tables.offsets_snapshot(run, batch_id - 1))
        if files.exists(before):
            previous = spark.read.schema(_SNAPSHOT).parquet(tables.offsets_snapshot(run, batch_id - 1))
        else:
            # the tables were lost or moved, the checkpoint was not: go on from what is there
            logger.warning("no offsets snapshot of batch %d of run %s; going on from the other ones", batch_id - 1, run)
            previous = spark.read.schema(_SNAPSHOT).parquet(tables.offsets).select(*_SNAPSHOT.fieldNames())
        both = current.unionByName(previous.withColumn("n_records", F.lit(None).cast("long")))
        current = both.groupBy(*POSITION).agg(
            F.max("max_offset").alias("max_offset"), F.max("n_records").alias("n_records")
        )
    # one row per topic partition: a single file
    current.repartition(1).write.mode("overwrite").parquet(tables.offsets_snapshot(run, batch_id))
    _drop_old(spark, tables.offsets_snapshot(run, batch_id - KEEP_SNAPSHOTS))


def start_publish(
    source: DataFrame,
    schema: T.StructType | str,
    target_topic: str,
    sink,
    checkpoint: str,
    *,
    trigger: Mapping[str, object] | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    json_options: Mapping[str, str] | None = None,
    timestamp_format: str = DEFAULT_TIMESTAMP_FORMAT,
    source_headers: bool = False,
    dead_letter_topic: str | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """S6 + O2: stream valid records of ``source`` to ``sink`` as JSON messages.

    With ``dead_letter_topic`` the invalid ones go there in the same write, with
    their source and reason in the headers; the sink must be ``routed``.
    ``prepare`` is a user ``DataFrame -> DataFrame`` stage applied to the raw
    messages first (U1). Each batch's message/published/rejected counts are
    observed under ``METRICS_NAME`` in the query progress.
    """
    messages = prepare(source) if prepare is not None else source
    classified = classify(messages, schema, json_options=json_options, timestamp_format=timestamp_format)
    classified = classified.observe(METRICS_NAME, *status_metrics())
    if dead_letter_topic is not None:
        if not sink.routed:
            raise ValueError("rows of two topics need a routed sink")
        out = routed(classified, target_topic, dead_letter_topic, timestamp_format=timestamp_format)
    else:
        out = publish_envelope(
            classified, target_topic, source_headers=source_headers, timestamp_format=timestamp_format
        )
    writer = sink.write_stream(out).outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return _with_trigger(writer, trigger).start()


def start_relay(
    source: DataFrame,
    schema: T.StructType | str,
    target_topic: str,
    sink,
    tables: RelayTables,
    checkpoint: str,
    *,
    trigger: Mapping[str, object] | None = None,
    envelope: Callable[[DataFrame], DataFrame] | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    json_options: Mapping[str, str] | None = None,
    timestamp_format: str = DEFAULT_TIMESTAMP_FORMAT,
    source_headers: bool = False,
    query_name: str | None = None,
    on_batch: Callable[[int, dict], None] | None = None,
) -> StreamingQuery:
    """O1 + K1: publish, write rejects and the batch's max offsets per partition.

    ``envelope`` maps the source's rows to messages, one to one. ``prepare`` is
    a user stage on the messages (U1) that may drop or add some: offsets are
    taken from the messages before it, so what it drops counts as processed.
    With it a batch's positions are read from the source a second time.
    ``on_batch(batch_id, counts)`` receives the batch's observed
    message/published/rejected counts after its writes succeed.
    """
    reject_sink = FileSink(tables.rejects)
    _init_tables(source.sparkSession, tables)
    messages = envelope(source) if envelope is not None else source

    # Only what the three writes read is kept: the raw text for rejects
    # alone (valid messages carry their parsed record instead).
    def classified(df: DataFrame) -> DataFrame:
        return classify(df, schema, json_options=json_options, timestamp_format=timestamp_format).select(
            "topic",
            "partition",
            "offset",
            "status",
            "record",
            F.when(F.col("status") != "ok", F.col("value")).alias("value"),
        )

    # Without a user stage the plan is classified once on the stream, not
    # rebuilt in every batch.
    stream = classified(messages) if prepare is None else messages

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        counts = Observation(METRICS_NAME)
        parsed = batch if prepare is None else classified(prepare(batch))
        cached = parsed.observe(counts, *status_metrics()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sink.write_batch(
                publish_envelope(
                    cached, target_topic, source_headers=source_headers, timestamp_format=timestamp_format
                ),
                batch_id,
            )
            # Rebalance: AQE sizes the reject files (few when rejects are rare)
            # instead of one small file per source task and batch.
            reject_sink.write_batch(rejects(cached).hint("rebalance"), batch_id)
            # Offsets last: every message of the batch, valid or not, is processed.
            _write_offsets_snapshot(batch.sparkSession, tables, cached if prepare is None else batch, batch_id)
            seen = counts.get
            _write_commit(batch.sparkSession, tables, batch_id, seen["messages"])
            if on_batch is not None:
                on_batch(batch_id, seen)
        finally:
            cached.unpersist()

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return _with_trigger(writer, trigger).start()


def _snapshots(spark: SparkSession, tables: RelayTables) -> DataFrame:
    schema = T.StructType([*_SNAPSHOT.fields, *as_struct(_COMMIT_KEYS).fields])
    return complete(spark, tables, spark.read.schema(schema).parquet(tables.offsets))


def committed_offsets(spark: SparkSession, tables: RelayTables) -> DataFrame:
    """K1: highest processed offset per (topic, partition) over all runs' batches that ended."""
    return merge_offsets(_snapshots(spark, tables).select(*OFFSETS.fieldNames()))


def batch_counts(spark: SparkSession, tables: RelayTables) -> DataFrame:
    """A2: messages of the latest micro-batches (those whose snapshot is kept)
    per run, batch, topic and partition."""
    rows = _snapshots(spark, tables).where("n_records is not null")
    return rows.select("run_id", "batch_id", *POSITION, "n_records")


def _file_rows(spark: SparkSession, sink: FileSink, schema: T.StructType) -> DataFrame:
    return sink.read(spark, T.StructType([*schema.fields, *as_struct(_COMMIT_KEYS).fields]))


def read_rejects(spark: SparkSession, tables: RelayTables) -> DataFrame:
    """The rejected messages of the batches that ended, none where all were valid."""
    rows = _file_rows(spark, FileSink(tables.rejects), REJECTS)
    return complete(spark, tables, rows).select(*REJECTS.fieldNames())


def read_published(spark: SparkSession, tables: RelayTables, sink: FileSink, schema: T.StructType = PUBLISHED) -> DataFrame:
    """O2: the messages of the batches that ended, as ``start_relay`` wrote them to ``sink``."""
    return complete(spark, tables, _file_rows(spark, sink, schema)).select(*schema.fieldNames())
