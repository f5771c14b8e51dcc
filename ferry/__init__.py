"""ferry: a Spark-native JSON message relay.

Reads messages (Kafka, or a replayed file stream with the Kafka source's
columns), decodes and strictly parses each payload against an explicit
schema, routes malformed payloads to a rejects table with a reason,
re-serializes valid records as compact JSON, and tracks the highest
processed offset per partition so a restarted job resumes after it.

Every step is a ``DataFrame -> DataFrame`` function built from Spark
built-ins, so the same code serves batch and Structured Streaming.
"""

from ferry.schemas import EMPLOYEE, ENVELOPE, OFFSETS, REJECTS
from ferry.functions.strict_json import STATUSES, classify
from ferry.functions.serialize import serialize
from ferry.operators.records import (
    keep_where,
    parsed_fields,
    publish_envelope,
    records,
    reject_counts,
    rejects,
    serialized,
    status_metrics,
)
from ferry.operators.offsets import after_committed, max_offsets, merge_offsets, record_counts
from ferry.plans.relay import RelayOutput, relay

__all__ = [
    "EMPLOYEE",
    "ENVELOPE",
    "OFFSETS",
    "REJECTS",
    "STATUSES",
    "RelayOutput",
    "after_committed",
    "classify",
    "keep_where",
    "max_offsets",
    "merge_offsets",
    "parsed_fields",
    "publish_envelope",
    "record_counts",
    "records",
    "reject_counts",
    "rejects",
    "relay",
    "serialize",
    "serialized",
    "status_metrics",
]
