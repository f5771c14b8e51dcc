"""Schemas of the relay: the record type, the message envelope and the
side tables (rejects, offsets)."""

from __future__ import annotations

from pyspark.sql import types as T

# The record the reference relays: four nullable string fields, matched by
# exact (case-sensitive) JSON key.
EMPLOYEE = T.StructType(
    [
        T.StructField("id", T.StringType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("firstName", T.StringType(), True),
        T.StructField("lastName", T.StringType(), True),
    ]
)

# Columns of Spark's Kafka source. A replayed file stream must carry the
# same columns; ``value`` may also be a string there.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("timestampType", T.IntegerType(), True),
    ]
)

# Position of a message: the grouping key of every offset aggregate.
POSITION = ["topic", "partition"]

REJECTS = T.StructType(
    [
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("value", T.StringType(), True),
        T.StructField("reason", T.StringType(), False),
    ]
)

OFFSETS = T.StructType(
    [
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("max_offset", T.LongType(), True),
    ]
)

# Output message: topic plus JSON text, no key.
PUBLISHED = T.StructType(
    [
        T.StructField("topic", T.StringType(), True),
        T.StructField("key", T.StringType(), True),
        T.StructField("value", T.StringType(), True),
    ]
)

_HEADER = T.StructType([T.StructField("key", T.StringType(), True), T.StructField("value", T.BinaryType(), True)])
PUBLISHED_WITH_HEADERS = T.StructType(
    [*PUBLISHED.fields, T.StructField("headers", T.ArrayType(_HEADER, True), True)]
)


def as_struct(schema: T.StructType | str) -> T.StructType:
    """Accept a ``StructType`` or a DDL string such as ``"id string, at timestamp"``."""
    if isinstance(schema, T.StructType):
        return schema
    parsed = T._parse_datatype_string(schema)
    if not isinstance(parsed, T.StructType):
        raise TypeError(f"record schema must be a struct, got {parsed!r}")
    return parsed
