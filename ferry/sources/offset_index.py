"""K2: an index of a replay folder's files by the offsets they hold.

A row for each file, topic and partition has the lowest and highest offset, so
that resuming opens only files with a message above its partition's mark. A
filter on the scan cannot do that where one partition has no mark, as it keeps
all of that partition's messages; the index still leaves out the other files.

The index grows with the files, not the messages. It is a table of its own,
to which ``update_index`` appends the files that it has not seen. A file that is
not in it yet is always read, so a late index costs time, never rows. Replay
files are not changed once written.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.operators.offsets import after_committed, merge_offsets
from ferry.schemas import ENVELOPE, POSITION

INDEX = "file string, topic string, partition int, min_offset long, max_offset long, n_records long, n_offsets long"


def index_of(messages: DataFrame) -> DataFrame:
    """The index rows of a batch read of replay files. Only the position columns
    are read; each task adds its files up before the shuffle."""
    offset = F.col("offset")
    return messages.groupBy(F.col("_metadata.file_path").alias("file"), *POSITION).agg(
        F.min(offset).alias("min_offset"),
        F.max(offset).alias("max_offset"),
        F.count(F.lit(1)).alias("n_records"),
        F.count(offset).alias("n_offsets"),
    )


def _plain(uri: str) -> str:
    """A file's path as the listing and the metadata column both give it: they
    differ in the slashes behind the scheme and in quoting."""
    return re.sub("^([a-z0-9+.-]+):/+", r"\1:/", unquote(uri))


def _files(spark: SparkSession, path: str, schema: T.StructType) -> dict[str, str]:
    """The folder's files as Spark lists them, by their plain path."""
    return {_plain(f): unquote(f) for f in spark.read.schema(schema).parquet(path).inputFiles()}


def _known(index: DataFrame) -> set[str]:
    return {_plain(r.file) for r in index.select("file").distinct().toLocalIterator()}


def read_index(spark: SparkSession, index_path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(index_path)


def update_index(spark: SparkSession, path: str, index_path: str, schema: T.StructType = ENVELOPE) -> DataFrame:
    """Append the files that the index has not yet; returns the index. A file
    without messages gives no row and is looked at again."""
    spark.createDataFrame([], INDEX).write.mode("append").parquet(index_path)
    known = _known(read_index(spark, index_path))
    new = [f for name, f in _files(spark, path, schema).items() if name not in known]
    if new:
        index_of(spark.read.schema(schema).parquet(*new)).write.mode("append").parquet(index_path)
    return read_index(spark, index_path)


def files_after(index: DataFrame, marks: DataFrame) -> DataFrame:
    """The indexed files (column ``file``) that hold a message after its
    partition's mark, one of a partition without a mark, or one without an offset."""
    done = merge_offsets(marks).select(*[F.col(c).alias(f"_c_{c}") for c in POSITION], F.col("max_offset").alias("_mark"))
    same = [F.col(c) == F.col(f"_c_{c}") for c in POSITION]
    above = F.col("_mark").isNull() | (F.col("n_offsets") < F.col("n_records")) | (F.col("max_offset") > F.col("_mark"))
    return index.join(done, same, "left").where(above).select("file").distinct()


def read_after(
    spark: SparkSession, path: str, index: DataFrame, marks: DataFrame, schema: T.StructType = ENVELOPE
) -> DataFrame:
    """The folder's messages after the marks, from the files that can hold one.
    The driver gets file names, as it does for any scan."""
    wanted, known = _known(files_after(index, marks)), _known(index)
    files = [f for name, f in _files(spark, path, schema).items() if name in wanted or name not in known]
    if not files:
        return spark.createDataFrame([], schema)
    return after_committed(spark.read.schema(schema).parquet(*files), marks)
