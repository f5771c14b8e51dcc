"""Message sources: Kafka (S1-S5) and a replayed file stream with the same columns."""

from ferry.sources.derived import customer_envelope, documents_envelope, events_envelope, events_time_envelope
from ferry.sources.kafka import read_kafka
from ferry.sources.options import KafkaSink, KafkaSource
from ferry.sources.replay import read_replay, read_table, stream_table

__all__ = [
    "KafkaSink",
    "KafkaSource",
    "customer_envelope",
    "documents_envelope",
    "events_envelope",
    "events_time_envelope",
    "read_kafka",
    "read_replay",
    "read_table",
    "stream_table",
]
