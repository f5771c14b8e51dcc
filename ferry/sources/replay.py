"""The test twin of the Kafka source: parquet files with the same columns,
read as a batch or as a file stream (one new file = new messages)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ferry.schemas import ENVELOPE

# Bytes of the files that a micro-batch takes, unless the caller says otherwise:
# without a bound the first batch of a replay is the whole folder.
MAX_BYTES_PER_TRIGGER = 4 << 30


def _admission(max_files: int | None, max_bytes: int | None) -> dict[str, str]:
    """The bound of a micro-batch. Spark takes files up to one of the two; a file
    larger than the bytes is a batch of its own."""
    if max_files is not None and max_bytes is not None:
        raise ValueError("bound a micro-batch by files or by bytes, not by both")
    if max_files is not None:
        return {"maxFilesPerTrigger": str(max_files)}
    bound = MAX_BYTES_PER_TRIGGER if max_bytes is None else max_bytes
    return {"maxBytesPerTrigger": str(bound)}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Batch read of one driver table ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """File stream over one driver table.

    A file stream cannot point at a single file, so it watches the table's
    directory with a glob filter on the file name.
    """
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    return reader.options(**_admission(max_files_per_trigger, max_bytes_per_trigger)).parquet(sf_dir)


def read_replay(
    spark: SparkSession,
    path: str,
    schema: T.StructType = ENVELOPE,
    stream: bool = True,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Messages staged as parquet under ``path`` with envelope columns
    (by default exactly the Kafka source's columns). A stream's micro-batch is
    bounded by bytes, MAX_BYTES_PER_TRIGGER by default, or by files."""
    if not stream:
        return spark.read.schema(schema).parquet(path)
    bound = _admission(max_files_per_trigger, max_bytes_per_trigger)
    return spark.readStream.schema(schema).options(**bound).parquet(path)
