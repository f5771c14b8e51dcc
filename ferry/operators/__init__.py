"""DataFrame -> DataFrame operators of the relay (records, rejects, offsets)."""

from ferry.operators.offsets import after_committed, max_offsets, merge_offsets, record_counts
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

__all__ = [
    "keep_where",
    "after_committed",
    "max_offsets",
    "merge_offsets",
    "parsed_fields",
    "publish_envelope",
    "record_counts",
    "records",
    "reject_counts",
    "rejects",
    "serialized",
    "status_metrics",
]
