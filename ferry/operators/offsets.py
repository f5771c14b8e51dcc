"""A1, A2, K2: offset bookkeeping per Kafka (topic, partition).

The aggregates group on (topic, partition) only, a key with as many values
as the topic has partitions. Spark plans them as a partial hash aggregate
before the exchange, so each map task ships one row per partition it saw:
a partition holding a third of all messages is combined map-side and never
lands as a hot group on one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.schemas import POSITION
from ferry.session import shared_dir

# Largest committed-offsets table that is broadcast (one row per topic
# partition). Kafka clusters hold far fewer partitions per topic; past this
# bound the join falls back to a salted shuffle join.
MAX_BROADCAST_PARTITIONS = 200_000
# Marks that the driver looks through for a filter on the scan; with more, there is none.
MAX_PUSHED_MARKS = 10_000
# Salt buckets of the fallback join: a hot partition is spread over this many tasks.
SALT_BUCKETS = 64


def max_offsets(df: DataFrame, offset: str = "offset") -> DataFrame:
    """A1: highest offset per (topic, partition)."""
    return df.groupBy(*POSITION).agg(F.max(offset).alias("max_offset"))


def record_counts(df: DataFrame) -> DataFrame:
    """A2: number of messages per (topic, partition)."""
    return df.groupBy(*POSITION).agg(F.count(F.lit(1)).alias("n_records"))


def merge_offsets(*tables: DataFrame) -> DataFrame:
    """K1: fold offsets tables (e.g. one per micro-batch) into the committed one.

    An empty batch contributes no rows, so it leaves every offset unchanged.
    """
    union = tables[0]
    for t in tables[1:]:
        union = union.unionByName(t)
    return union.groupBy(*POSITION).agg(F.max("max_offset").alias("max_offset"))


def _bounded(small: DataFrame, max_rows: int) -> bool:
    """True when ``small`` has at most ``max_rows`` rows (counts at most max_rows + 1)."""
    return small.limit(max_rows + 1).count() <= max_rows


def _lowest_mark(marks: DataFrame, offset: str) -> Column | None:
    """A filter that the scan can apply before the join: what it drops lies at or
    below the lowest mark, in a partition that has one. None unless the marks cover
    every topic's same unbroken range of partitions: an unmarked one keeps all."""
    rows = marks.limit(MAX_PUSHED_MARKS + 1).collect()
    if not rows or len(rows) > MAX_PUSHED_MARKS:
        return None
    topics, partitions = ({r[f"_c_{c}"] for r in rows} for c in POSITION)
    first, last = min(partitions), max(partitions)
    if len(rows) != len(topics) * (last - first + 1):
        return None
    topic, partition = (F.col(c) for c in POSITION)
    unmarked = topic.isNull() | ~topic.isin(sorted(topics)) | partition.isNull() | ~partition.between(first, last)
    return (F.col(offset) > min(r["_committed"] for r in rows)) | F.col(offset).isNull() | unmarked


def after_committed(
    df: DataFrame,
    committed: DataFrame,
    offset: str = "offset",
    committed_offset: str = "max_offset",
    *,
    max_broadcast_partitions: int = MAX_BROADCAST_PARTITIONS,
    salt_buckets: int = SALT_BUCKETS,
) -> DataFrame:
    """K2 (batch form): messages after the committed offset of their partition.

    Keeps ``offset > committed`` (or everything for a partition with no
    committed offset) as a left anti join on ``offset <= committed``, so the
    output has exactly ``df``'s columns. ``committed`` is first reduced to one
    row per (topic, partition) and materialized once with a reliable
    checkpoint (in the session's checkpoint folder), so the size check and
    the join do not both recompute it. It is broadcast only after counting
    that it has at most ``max_broadcast_partitions`` rows. Otherwise it is a
    shuffled hash join with a salt, so that one hot partition is split over
    ``salt_buckets`` tasks. Where the marks leave no partition out, the lowest
    of them is also a filter on the scan.
    """
    shared_dir(df.sparkSession)  # makes sure a checkpoint folder is set
    # Right-side names are unique, so the join needs no dataset-qualified
    # columns (both sides often come from the same source).
    marks = (
        committed.groupBy(*POSITION)
        .agg(F.max(committed_offset).alias("_committed"))
        .select(*[F.col(c).alias(f"_c_{c}") for c in POSITION], "_committed")
        .where(F.col("_committed").isNotNull() & F.col("_c_topic").isNotNull() & F.col("_c_partition").isNotNull())
        .checkpoint(eager=True)
    )
    same_position = [F.col(c) == F.col(f"_c_{c}") for c in POSITION]
    already_done = F.col(offset) <= F.col("_committed")
    above = _lowest_mark(marks, offset)
    if above is not None:
        df = df.where(above)
    if _bounded(marks, max_broadcast_partitions):
        return df.join(F.broadcast(marks), [*same_position, already_done], "left_anti")

    # Deterministic salt: a retried task recomputes the same bucket.
    left = df.withColumn("_salt", F.pmod(F.xxhash64(F.col(offset)), F.lit(salt_buckets)))
    # Shuffled hash join: the salted committed side is hashed per shuffle
    # partition, the big message side is neither sorted nor broadcast.
    right = marks.withColumn("_c_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1)))).hint(
        "shuffle_hash"
    )
    same_bucket = F.col("_salt") == F.col("_c_salt")
    return left.join(right, [*same_position, same_bucket, already_done], "left_anti").drop("_salt")
