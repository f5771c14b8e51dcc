"""O2/O3 and the file twin used where no broker exists.

A sink offers a streaming writer (for a plain ``writeStream``) and a
per-micro-batch write (for ``foreachBatch``). File writes are keyed by the
run (the query id that its checkpoint keeps) and the batch id, so a replayed
batch overwrites its own output instead of duplicating it, and a run on a new
checkpoint, whose batch ids start again, leaves the others' output alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ferry.schemas import PUBLISHED
from ferry.sources.options import KafkaSink


def run_id(spark: SparkSession) -> str:
    """Id of the streaming query whose micro-batch runs here: it lives in the
    checkpoint, so restarts share it. ``batch`` outside of a query."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


@dataclass(frozen=True)
class FileSink:
    """Files under ``path`` (parquet by default). With ``routed`` a streaming
    write has a folder for each topic, as messages go to each topic of a broker."""

    path: str
    fmt: str = "parquet"
    routed: bool = False

    def write_stream(self, df: DataFrame) -> DataStreamWriter:
        # The file sink commits each batch in its metadata log: exactly once.
        writer = df.writeStream.format(self.fmt).option("path", self.path)
        return writer.partitionBy("topic") if self.routed else writer

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        (
            df.withColumn("run_id", F.lit(run_id(df.sparkSession)))
            .withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_id", "batch_id")
            .format(self.fmt)
            .save(self.path)
        )

    def read(self, spark: SparkSession, schema: T.StructType = PUBLISHED) -> DataFrame:
        """What was written; empty where every message was rejected."""
        return spark.read.schema(schema).format(self.fmt).load(self.path)


@dataclass(frozen=True)
class KafkaWriter:
    """Spark's Kafka sink (at-least-once: a replayed batch is sent again). With
    ``routed`` each row goes to the topic that its column names."""

    sink: KafkaSink
    routed: bool = False

    def _options(self) -> dict[str, str]:
        options = self.sink.options()
        if self.routed:
            del options["topic"]  # the option would go before the column
        return options

    def write_stream(self, df: DataFrame) -> DataStreamWriter:
        return df.writeStream.format("kafka").options(**self._options())

    def write_batch(self, df: DataFrame, batch_id: int) -> None:  # noqa: ARG002
        df.write.format("kafka").options(**self._options()).save()
