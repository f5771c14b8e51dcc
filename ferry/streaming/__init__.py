"""Structured Streaming: the relay as a streaming query."""

from ferry.streaming.jobs import (
    DEFAULT_TRIGGER,
    RelayTables,
    batch_counts,
    committed_offsets,
    read_published,
    read_rejects,
    start_publish,
    start_relay,
)
from ferry.streaming.resume import frozen_marks, plan_starting_offsets, resume_replay
from ferry.streaming.sinks import FileSink, KafkaWriter

__all__ = [
    "DEFAULT_TRIGGER",
    "FileSink",
    "KafkaWriter",
    "RelayTables",
    "batch_counts",
    "committed_offsets",
    "frozen_marks",
    "plan_starting_offsets",
    "read_published",
    "read_rejects",
    "resume_replay",
    "start_publish",
    "start_relay",
]
