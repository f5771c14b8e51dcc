"""O2: read what an at-least-once relay sent, each message once.

A replayed micro-batch is sent again. Its messages carry the source topic,
partition and offset as headers (``source_headers``, or a routed write), so a
reader can tell a repeat. For a stream the offsets seen are kept as bits: a
state row for each target topic, source topic partition and block of BLOCK
offsets, of at most BLOCK / 8 bytes. A partition with a third of all messages
has many blocks, so it spreads over tasks, and the state is about one bit for
each message, where Spark's ``dropDuplicates`` would hold a row for each. It is
never forgotten: a repeat is dropped however late it comes. On a cluster, let
the RocksDB state store hold it.

Defined cases: a message without the three headers, or with an offset or
partition that is no number, cannot be told from others and always stays. The
same offset in two target topics is two messages. Extra columns are kept; an
empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ferry.operators.records import header

# Offsets of one state row: 8 KiB of bits.
BLOCK = 1 << 16
# Groups that messages without a source are dealt to.
UNKNOWN_GROUPS = 4096
_SOURCE = ("_src_topic", "_src_partition", "_src_offset")


def _with_source(messages: DataFrame, headers: str) -> DataFrame:
    clash = {c.lower() for c in messages.columns} & {*_SOURCE, "_block"}
    if clash:
        raise ValueError(f"read_once adds columns {sorted(clash)} that the input already has; rename them first")
    topic, partition, offset = (header(f"src_{c}", headers) for c in ("topic", "partition", "offset"))
    partition, offset = partition.try_cast("int"), offset.try_cast("long")
    known = topic.isNotNull() & partition.isNotNull() & offset.isNotNull() & (offset >= 0)
    values = (F.when(known, v).alias(n) for n, v in zip(_SOURCE, (topic, partition, offset), strict=True))
    return messages.select("*", *values)


def read_once(messages: DataFrame, headers: str = "headers") -> DataFrame:
    """The messages without repeats, in the columns of ``messages``."""
    rows = _with_source(messages, headers)
    unknown = F.col("_src_offset").isNull()
    if messages.isStreaming:
        return _stateful(rows, messages)
    once = rows.where(~unknown).dropDuplicates(["topic", *_SOURCE])
    return once.unionByName(rows.where(unknown)).drop(*_SOURCE)


def _block(rows: DataFrame) -> Column:
    # rows of no source stay as they are; a hash deals them evenly
    dealt = F.pmod(F.xxhash64("key", "value"), F.lit(UNKNOWN_GROUPS))
    return F.coalesce(F.floor(F.col("_src_offset") / BLOCK), dealt)


def _stateful(rows: DataFrame, messages: DataFrame) -> DataFrame:
    names, block = messages.columns, BLOCK

    def keep(key: tuple, batches: Iterator, state: GroupState) -> Iterator:
        import numpy as np

        if key[1] is None:
            for rows in batches:
                yield rows[names]
            return
        if state.exists:
            bits = np.unpackbits(np.frombuffer(state.get[0], dtype=np.uint8))
        else:
            bits = np.zeros(block, dtype=np.uint8)
        for rows in batches:
            at = rows["_src_offset"].to_numpy(dtype=np.int64) % block
            fresh = (bits[at] == 0) & ~rows["_src_offset"].duplicated().to_numpy()
            bits[at] = 1
            yield rows.loc[fresh, names]
        state.update((np.packbits(bits).tobytes(),))

    keyed = rows.withColumn("_block", _block(rows))
    return keyed.groupBy("topic", "_src_topic", "_src_partition", "_block").applyInPandasWithState(
        keep, messages.schema, "seen binary", "append", GroupStateTimeout.NoTimeout
    )
