"""The Kafka source. One Spark source covers every partition of the
topic (one task per Kafka partition), so no receiver union is needed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ferry.sources.options import KafkaSource


def read_kafka(spark: SparkSession, source: KafkaSource, stream: bool = True) -> DataFrame:
    """Kafka rows (key, value, topic, partition, offset, timestamp, timestampType).

    Needs the ``spark-sql-kafka`` connector on the classpath; a batch read
    (``stream=False``) covers earliest..latest, which is how a replay or a
    backfill of the relay runs.
    """
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**source.options(stream)).load()
