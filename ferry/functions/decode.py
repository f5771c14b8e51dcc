"""Payload decode. Bytes become UTF-8 text; invalid UTF-8 becomes null
(never a task failure), so the classifier can report it as ``bad_utf8``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def payload_text(df: DataFrame, value: str = "value") -> Column:
    """UTF-8 text of ``value``; null when the bytes are not valid UTF-8.

    A string column is taken as already decoded. ``cast`` alone never checks
    the bytes and ``decode(v, 'UTF-8')`` raises on bad input, so the cast is
    followed by ``try_validate_utf8``.
    """
    dtype = df.schema[value].dataType
    if isinstance(dtype, T.BinaryType):
        return F.try_validate_utf8(F.col(value).cast("string"))
    if isinstance(dtype, T.StringType):
        return F.col(value)
    raise TypeError(f"payload column {value!r} must be binary or string, got {dtype}")


def decode(df: DataFrame, value: str = "value") -> DataFrame:
    """Replace ``value`` by its text and add ``n_bytes`` (raw payload size).

    Metadata columns (topic, partition, offset, ...) are kept; the reference
    dropped them, but rejects and offsets need them downstream.
    """
    dtype = df.schema[value].dataType
    raw_len = F.octet_length(F.col(value)) if not isinstance(dtype, T.BinaryType) else F.length(F.col(value))
    return df.withColumn("n_bytes", raw_len.cast("long")).withColumn(value, payload_text(df, value))
