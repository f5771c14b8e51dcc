"""P3, P4, P6, P7 over a classified DataFrame (output of ``classify``).

All of these are narrow projections/filters except ``reject_counts``,
whose grouping key has a handful of values: Spark's partial aggregation
collapses every input partition to a few rows before the shuffle, so a
partition holding a third of all messages costs one map-side hash table,
not a hot reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.functions.serialize import serialize
from ferry.functions.strict_json import DEFAULT_TIMESTAMP_FORMAT

_POSITION = ["topic", "partition", "offset"]


def _position(df: DataFrame) -> list[str]:
    return [c for c in _POSITION if c in df.columns]


def _fields(classified: DataFrame, record: str, *others: str) -> list[str]:
    """Names of the record's fields; refuses those of the columns beside them."""
    names = [f.name for f in classified.schema[record].dataType.fields]
    clash = {n.lower() for n in names} & {c.lower() for c in (*_position(classified), *others)}
    if clash:
        raise ValueError(f"record fields {sorted(clash)} clash with message columns; rename those first")
    return names


def keep_where(df: DataFrame, condition: Column, *cols: Column) -> DataFrame:
    """``df.filter(condition).select(*cols)`` with the parse evaluated once.

    A plain filter on ``status`` is pushed below the projection that
    computes it, and Catalyst then inlines the whole classification - the
    JSON parse included - into the filter, so every payload is parsed twice.
    Emitting the kept rows through a generator (``inline`` of a one-element
    array, or of null when the row is dropped) leaves no filter to push.
    """
    return df.select(F.inline(F.when(condition, F.array(F.struct(*cols)))))


def records(classified: DataFrame, status: str = "status", record: str = "record") -> DataFrame:
    """The valid records only, as columns, with their message position."""
    fields = _fields(classified, record)
    return keep_where(
        classified,
        F.col(status) == "ok",
        *[F.col(c) for c in _position(classified)],
        *[F.col(record)[n].alias(n) for n in fields],
    )


def parsed_fields(classified: DataFrame, status: str = "status", record: str = "record") -> DataFrame:
    """Every message with its status and the parsed fields (null unless ok)."""
    fields = _fields(classified, record, status)
    return classified.select(
        *_position(classified), status, *[F.col(record)[n].alias(n) for n in fields]
    )


def rejects(classified: DataFrame, status: str = "status", value: str = "value") -> DataFrame:
    """Invalid messages with the raw text and the reason."""
    return keep_where(
        classified,
        F.col(status) != "ok",
        *[F.col(c) for c in _position(classified)],
        F.col(value).alias("value"),
        F.col(status).alias("reason"),
    )


def reject_counts(classified: DataFrame, status: str = "status") -> DataFrame:
    """Number of rejected messages per topic and reason."""
    keys = [c for c in ("topic",) if c in classified.columns]
    failed = keep_where(classified, F.col(status) != "ok", *[F.col(k) for k in keys], F.col(status).alias("reason"))
    return failed.groupBy(*keys, "reason").agg(F.count(F.lit(1)).alias("n_rejects"))


def serialized(
    classified: DataFrame,
    status: str = "status",
    record: str = "record",
    timestamp_format: str = DEFAULT_TIMESTAMP_FORMAT,
) -> DataFrame:
    """JSON text of each valid record, with its message position."""
    return keep_where(
        classified,
        F.col(status) == "ok",
        *[F.col(c) for c in _position(classified)],
        serialize(record, timestamp_format).alias("value"),
    )


def publish_envelope(
    classified: DataFrame,
    target_topic: str,
    status: str = "status",
    record: str = "record",
    *,
    source_headers: bool = False,
    timestamp_format: str = DEFAULT_TIMESTAMP_FORMAT,
) -> DataFrame:
    """The output message (``topic``, null ``key``, JSON ``value``).

    Kafka delivery is at-least-once; with ``source_headers`` each message
    also carries its source topic/partition/offset as Kafka headers so a
    consumer can drop duplicates.
    """
    cols = [
        F.lit(target_topic).alias("topic"),
        F.lit(None).cast("string").alias("key"),
        serialize(record, timestamp_format).alias("value"),
    ]
    if source_headers:
        cols.append(F.array(*[_header(f"src_{c}", F.col(c)) for c in _POSITION]).alias("headers"))
    return keep_where(classified, F.col(status) == "ok", *cols)


def _header(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("key"), value.cast("string").cast("binary").alias("value"))


def routed(
    classified: DataFrame,
    target_topic: str,
    dead_letter_topic: str,
    status: str = "status",
    record: str = "record",
    value: str = "value",
    *,
    timestamp_format: str = DEFAULT_TIMESTAMP_FORMAT,
) -> DataFrame:
    """P4 + P7: every message with its destination in ``topic``: valid ones as
    the output message, the others as they came, for the dead-letter topic.

    The headers hold the source topic, partition and offset, and for a dead
    letter the ``reason``. One projection, so a single streaming write sends
    both and the payload is parsed once; a sink routes by the column.
    """
    if target_topic == dead_letter_topic:
        raise ValueError("the dead-letter topic is the target topic")
    ok = F.col(status) == "ok"
    source = [_header(f"src_{c}", F.col(c)) for c in _position(classified)]
    row = F.struct(
        F.when(ok, F.lit(target_topic)).otherwise(F.lit(dead_letter_topic)).alias("topic"),
        F.lit(None).cast("string").alias("key"),
        F.when(ok, serialize(record, timestamp_format)).otherwise(F.col(value)).alias("value"),
        F.when(ok, F.array(*source)).otherwise(F.array(*source, _header("reason", F.col(status)))).alias("headers"),
    )
    # a generator, as in keep_where: nothing above is pushed into the parse
    return classified.select(F.inline(F.array(row)))


def header(name: str, headers: str = "headers") -> Column:
    """The text of a message's header; null where it has none of that name."""
    found = F.filter(F.col(headers), lambda h: h["key"] == F.lit(name))
    return F.get(found, F.lit(0))["value"].cast("string")


def status_metrics(status: str = "status") -> list[Column]:
    """Aggregates for ``DataFrame.observe``: messages, published and rejected
    counts of one batch (the reference printed a size per partition)."""
    ok = F.col(status) == "ok"
    return [
        F.count(F.lit(1)).alias("messages"),
        F.count_if(ok).alias("published"),
        F.count_if(~ok).alias("rejected"),
    ]
