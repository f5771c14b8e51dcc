"""Kafka options as data (S2-S4, O3). The Kafka connector is not installed in
this environment, so the source and sink are checked as option maps, and
reading is expected to fail with Spark's missing-data-source error."""

from __future__ import annotations

import pytest

from ferry.sources import KafkaSink, KafkaSource, read_kafka


def test_source_defaults_follow_latest():
    opts = KafkaSource("broker:9092", "inputTopic").options()
    assert opts == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "inputTopic",
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
    }


def test_source_all_settings():
    src = KafkaSource(
        "b1:9092,b2:9092",
        "inputTopic",
        from_start=True,
        fetch_bytes=102400,
        max_offsets_per_trigger=50000,
        min_partitions=64,
        consumer_id="relay",
        extra={"kafka.security.protocol": "SSL"},
    )
    opts = src.options()
    assert opts["startingOffsets"] == "earliest"
    assert opts["kafka.max.partition.fetch.bytes"] == "102400"
    assert opts["maxOffsetsPerTrigger"] == "50000"
    assert opts["minPartitions"] == "64"
    assert opts["groupIdPrefix"] == "relay"
    assert opts["kafka.security.protocol"] == "SSL"


def test_batch_read_covers_earliest_to_latest():
    opts = KafkaSource("b:9092", "t", max_offsets_per_trigger=10).options(stream=False)
    assert opts["startingOffsets"] == "earliest" and opts["endingOffsets"] == "latest"
    assert "maxOffsetsPerTrigger" not in opts


def test_sink_options():
    assert KafkaSink("b:9092", "employees").options() == {"kafka.bootstrap.servers": "b:9092", "topic": "employees"}


def test_kafka_connector_absent_here(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka(spark, KafkaSource("localhost:9092", "inputTopic"), stream=False).schema  # noqa: B018


def test_kafka_writer_targets_the_kafka_format(spark, scratch):
    from ferry import EMPLOYEE, classify, publish_envelope
    from ferry.sources.replay import read_replay
    from ferry.streaming import KafkaWriter, start_publish

    writer = KafkaWriter(KafkaSink("localhost:9092", "employees"))
    df = spark.createDataFrame([("employees", None, '{"id":"1"}')], "topic string, key string, value string")
    with pytest.raises(Exception, match="(?i)kafka"):
        writer.write_batch(df, 0)

    landing = f"{scratch}/landing"
    spark.createDataFrame([("t", 0, 0, '{"id":"1"}')], "topic string, partition int, offset long, value string").write.parquet(
        landing
    )
    source = read_replay(spark, landing, spark.read.parquet(landing).schema)
    with pytest.raises(Exception, match="(?i)kafka"):
        start_publish(source, EMPLOYEE, "employees", writer, f"{scratch}/ckpt", trigger={"availableNow": True})
    assert publish_envelope(classify(df.select("value"), EMPLOYEE), "employees").columns == ["topic", "key", "value"]


def test_resume_by_offset():
    from ferry.sources.options import KafkaSource, resume_offsets

    marks = resume_offsets([("t", 0, 5)], {"t": 2})
    assert marks == '{"t": {"0": 6, "1": -2}}'
    assert KafkaSource("b:1", "t", starting_offsets=marks).options()["startingOffsets"] == marks
