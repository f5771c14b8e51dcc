"""The derived envelopes have exactly the Kafka source's columns and types."""

from __future__ import annotations

import pytest

from ferry.schemas import ENVELOPE, as_struct
from ferry.sources.derived import (
    customer_bytes_envelope,
    customer_envelope,
    documents_envelope,
    events_envelope,
    events_time_envelope,
)
from ferry.sources.replay import read_replay, read_table

from .conftest import SF_SMALL


def _shape(schema):
    return [(f.name, f.dataType) for f in schema.fields]


@pytest.mark.parametrize(
    "table, envelope",
    [
        ("customer", customer_envelope),
        ("customer", customer_bytes_envelope),
        ("events", events_envelope),
        ("events", events_time_envelope),
        ("documents", documents_envelope),
    ],
)
def test_envelopes_match_the_kafka_source_schema(spark, table, envelope):
    assert _shape(envelope(read_table(spark, SF_SMALL, table)).schema) == _shape(ENVELOPE)


def test_replay_defaults_to_the_kafka_schema(spark, scratch):
    path = f"{scratch}/landing"
    events_envelope(read_table(spark, SF_SMALL, "events")).write.parquet(path)
    batch = read_replay(spark, path, stream=False)
    assert _shape(batch.schema) == _shape(ENVELOPE) and batch.count() > 0
    assert read_replay(spark, path).isStreaming


def test_ddl_schemas():
    assert [f.name for f in as_struct("id string, at timestamp").fields] == ["id", "at"]
    with pytest.raises(TypeError):
        as_struct("int")
