"""The relay as one batch plan (replays, backfills, tests).

All outputs derive from one classified DataFrame. ``records``/``rejects``
are narrow (no shuffle); ``offsets`` is a partial + final aggregate on
(topic, partition). Callers that materialize several outputs should
persist ``classified`` first, as ``start_relay`` does per micro-batch.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ferry.functions.strict_json import DEFAULT_TIMESTAMP_FORMAT, classify
from ferry.operators.offsets import max_offsets
from ferry.operators.records import publish_envelope, rejects


@dataclass(frozen=True)
class RelayOutput:
    classified: DataFrame
    published: DataFrame
    rejects: DataFrame
    offsets: DataFrame


def relay(
    messages: DataFrame,
    schema: T.StructType | str,
    target_topic: str,
    *,
    json_options: Mapping[str, str] | None = None,
    timestamp_format: str = DEFAULT_TIMESTAMP_FORMAT,
    source_headers: bool = False,
) -> RelayOutput:
    classified = classify(messages, schema, json_options=json_options, timestamp_format=timestamp_format)
    return RelayOutput(
        classified=classified,
        published=publish_envelope(
            classified, target_topic, source_headers=source_headers, timestamp_format=timestamp_format
        ),
        rejects=rejects(classified),
        offsets=max_offsets(classified),
    )
