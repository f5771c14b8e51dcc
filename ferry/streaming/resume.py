"""S3/K2: go on after the committed-offsets table with a new checkpoint.

A checkpoint holds its own progress. Where it is lost, or the job moves to
another cluster or version, the table says what has been processed. The marks
are read once and kept beside the new checkpoint (``frozen_marks``): the table
goes on growing with the new run's own batches, and a batch that is replayed
after a crash must not be filtered by marks that it has itself moved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ferry.operators.offsets import MAX_BROADCAST_PARTITIONS, after_committed, merge_offsets
from ferry.schemas import OFFSETS
from ferry.sources.options import resume_offsets


def frozen_marks(spark: SparkSession, committed: DataFrame, folder: str) -> DataFrame:
    """The committed offsets as they were when the new run was first planned.
    Written once; a restart reads what is there."""
    marks = merge_offsets(committed).where("topic is not null and partition is not null and max_offset is not null")
    # one row for each topic partition: a single file, there as a whole or not at all
    marks.coalesce(1).write.mode("ignore").parquet(folder)
    return spark.read.schema(OFFSETS).parquet(folder)


def plan_starting_offsets(marks: DataFrame, partitions: dict[str, int]) -> str:
    """Kafka's ``startingOffsets`` for the topics' partitions: after the mark (5
    is followed by 6), at the earliest offset where there is none. Marks of other
    topics are left out; one beyond a topic's partitions is refused."""
    rows = marks.where(marks["topic"].isin(sorted(partitions))).limit(MAX_BROADCAST_PARTITIONS + 1).collect()
    if len(rows) > MAX_BROADCAST_PARTITIONS:
        raise ValueError(f"more than {MAX_BROADCAST_PARTITIONS} topic partitions")
    beyond = sorted((r.topic, r.partition) for r in rows if not 0 <= r.partition < partitions[r.topic])
    if beyond:
        raise ValueError(f"marks of partitions that the topic has not: {beyond[:5]}")
    return resume_offsets([(r.topic, r.partition, r.max_offset) for r in rows], partitions)


def resume_replay(messages: DataFrame, marks: DataFrame) -> DataFrame:
    """The file twin: the messages, a batch or a stream, after the marks."""
    return after_committed(messages, marks)
