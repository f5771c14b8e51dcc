"""Kafka connection settings as data.

Every setting the reference hard-codes (hosts, topics, consumer id, fetch
size, start position) is a field here; nothing has a baked-in host.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field


def resume_offsets(committed: Iterable[tuple[str, int, int]], partitions: Mapping[str, int] | None = None) -> str:
    """K2: ``startingOffsets`` that go on after committed (topic, partition,
    offset) rows, one per topic partition: 5 is followed by 6. Spark wants every
    partition named; those below ``partitions[topic]`` without a mark start at
    the earliest offset (-2)."""
    out: dict[str, dict[str, int]] = {t: {str(p): -2 for p in range(n)} for t, n in (partitions or {}).items()}
    for topic, partition, offset in committed:
        out.setdefault(topic, {})[str(partition)] = offset + 1
    return json.dumps(out, sort_keys=True)


@dataclass(frozen=True)
class KafkaSource:
    """Options of Spark's Kafka source for one subscribed topic.

    ``from_start`` is the reference's ``consumer.forcefromstart``: ``False``
    starts at the latest offsets, ``True`` at the earliest. Like the
    reference's committed offsets, a streaming checkpoint overrides it once
    it exists. ``fetch_bytes`` is the per-partition fetch size;
    ``max_offsets_per_trigger`` bounds one micro-batch (back-pressure).
    ``consumer_id`` becomes the consumer group prefix; the progress itself
    lives in the query's checkpoint directory.
    """

    bootstrap_servers: str
    topic: str
    from_start: bool = False
    starting_offsets: str | None = None  # e.g. of resume_offsets(); goes before from_start
    fetch_bytes: int | None = None
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    consumer_id: str | None = None
    fail_on_data_loss: bool = True
    extra: Mapping[str, str] = field(default_factory=dict)

    def options(self, stream: bool = True) -> dict[str, str]:
        opts = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": self.topic,
            "startingOffsets": "earliest" if (self.from_start or not stream) else "latest",
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.starting_offsets is not None:
            opts["startingOffsets"] = self.starting_offsets
        if not stream:
            opts["endingOffsets"] = "latest"
        if self.fetch_bytes is not None:
            opts["kafka.max.partition.fetch.bytes"] = str(self.fetch_bytes)
        if self.max_offsets_per_trigger is not None and stream:
            opts["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        if self.min_partitions is not None:
            opts["minPartitions"] = str(self.min_partitions)
        if self.consumer_id is not None:
            opts["groupIdPrefix"] = self.consumer_id
        opts.update(self.extra)
        return opts


@dataclass(frozen=True)
class KafkaSink:
    """Options of Spark's Kafka sink.

    Key and value are written as UTF-8 bytes of the string columns, which is
    what a string serializer produces, so no serializer setting is needed
    (Spark rejects ``kafka.key.serializer`` / ``kafka.value.serializer``).
    """

    bootstrap_servers: str
    topic: str
    extra: Mapping[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        opts = {"kafka.bootstrap.servers": self.bootstrap_servers, "topic": self.topic}
        opts.update(self.extra)
        return opts
