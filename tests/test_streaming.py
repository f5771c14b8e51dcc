"""Structured Streaming relay: resume, replay, empty polls, batch parity."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException

from ferry import EMPLOYEE, classify, publish_envelope
from ferry.schemas import PUBLISHED_WITH_HEADERS
from ferry.sources.derived import customer_envelope
from ferry.sources.replay import read_replay, read_table, stream_table
from ferry.streaming import FileSink, RelayTables, batch_counts, committed_offsets, jobs, read_rejects, start_publish, start_relay
from ferry.streaming.jobs import DEFAULT_TRIGGER

from .conftest import SF_SMALL

ONCE = {"availableNow": True}
SCHEMA = "topic string, partition int, offset long, value string"


def _land(spark, landing, start, stop, parts=2):
    rows = [("in", o % parts, o // parts, '{"id":"%d"}' % o) for o in range(start, stop)]
    spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(landing)


def _source(spark, landing):
    return read_replay(spark, landing, spark.read.parquet(landing).schema)


def _ids(df):
    return sorted(int(r.value.split('"')[3]) for r in df.select("value").collect())


def test_resume_publishes_new_messages_once(spark, scratch):
    landing, ckpt, sink = f"{scratch}/landing", f"{scratch}/ckpt", FileSink(f"{scratch}/out")
    _land(spark, landing, 0, 50)
    start_publish(_source(spark, landing), EMPLOYEE, "out", sink, ckpt, trigger=ONCE).awaitTermination()
    assert _ids(sink.read(spark)) == list(range(50))
    # rerun with nothing new: no duplicates
    start_publish(_source(spark, landing), EMPLOYEE, "out", sink, ckpt, trigger=ONCE).awaitTermination()
    assert _ids(sink.read(spark)) == list(range(50))
    # a new file arrives: only its rows are added
    _land(spark, landing, 50, 80)
    start_publish(_source(spark, landing), EMPLOYEE, "out", sink, ckpt, trigger=ONCE).awaitTermination()
    assert _ids(sink.read(spark)) == list(range(80))


class _FlakySink(FileSink):
    """Fails the first write of the given batch id, as a lost executor would."""

    fail_batches: set

    def write_batch(self, df, batch_id):
        if batch_id in self.fail_batches:
            self.fail_batches.discard(batch_id)
            raise RuntimeError(f"simulated failure in batch {batch_id}")
        super().write_batch(df, batch_id)


def test_failed_batch_is_replayed_under_same_id(spark, scratch):
    landing, ckpt = f"{scratch}/landing", f"{scratch}/ckpt"
    tables = RelayTables(f"{scratch}/tables")
    sink = _FlakySink(f"{scratch}/out")
    object.__setattr__(sink, "fail_batches", {0})
    _land(spark, landing, 0, 40)
    with pytest.raises(StreamingQueryException):
        start_relay(_source(spark, landing), EMPLOYEE, "out", sink, tables, ckpt, trigger=ONCE).awaitTermination()
    # restart on the same checkpoint: batch 0 runs again and completes
    start_relay(_source(spark, landing), EMPLOYEE, "out", sink, tables, ckpt, trigger=ONCE).awaitTermination()
    out = sink.read(spark)
    assert [r.batch_id for r in out.select("batch_id").distinct().collect()] == [0]
    assert _ids(out) == list(range(40))
    offsets = sorted(tuple(r) for r in committed_offsets(spark, tables).collect())
    assert offsets == [("in", 0, 19), ("in", 1, 19)]


def test_relay_side_tables_and_empty_polls(spark, scratch):
    landing, ckpt = f"{scratch}/landing", f"{scratch}/ckpt"
    tables = RelayTables(f"{scratch}/tables")
    sink = FileSink(f"{scratch}/out")
    rows = [("in", 0, 0, '{"id":"0"}'), ("in", 0, 1, "bad"), ("in", 1, 0, "null"), ("in", 1, 3, '{"id":"3"}')]
    spark.createDataFrame(rows, SCHEMA).write.parquet(landing)
    run = lambda: start_relay(
        _source(spark, landing), EMPLOYEE, "out", sink, tables, ckpt, trigger=ONCE
    ).awaitTermination()
    run()
    before = sorted(tuple(r) for r in committed_offsets(spark, tables).collect())
    assert before == [("in", 0, 1), ("in", 1, 3)]
    rej = sorted((r.partition, r.offset, r.reason) for r in spark.read.parquet(tables.rejects).collect())
    assert rej == [(0, 1, "malformed"), (1, 0, "json_null")]
    run()  # empty poll
    assert sorted(tuple(r) for r in committed_offsets(spark, tables).collect()) == before
    assert sink.read(spark).count() == 2


def test_stream_matches_batch(spark, scratch):
    sink = FileSink(f"{scratch}/out")
    start_publish(
        stream_table(spark, SF_SMALL, "customer"),
        EMPLOYEE,
        "employees",
        sink,
        f"{scratch}/ckpt",
        trigger=ONCE,
        prepare=customer_envelope,
    ).awaitTermination()
    batch = publish_envelope(classify(customer_envelope(read_table(spark, SF_SMALL, "customer")), EMPLOYEE), "employees")
    streamed = sorted(tuple(r) for r in sink.read(spark).collect())
    assert streamed == sorted(tuple(r) for r in batch.collect())
    assert len(streamed) > 0


def test_default_trigger_is_two_second_batches(spark, scratch):
    assert dict(DEFAULT_TRIGGER) == {"processingTime": "2 seconds"}
    landing = f"{scratch}/landing"
    _land(spark, landing, 0, 10)
    sink = FileSink(f"{scratch}/out")
    q = start_publish(_source(spark, landing), EMPLOYEE, "out", sink, f"{scratch}/ckpt", query_name="relay_t")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert _ids(sink.read(spark)) == list(range(10))


def test_observed_counts(spark, scratch):
    landing = f"{scratch}/landing"
    rows = [("in", 0, 0, '{"id":"0"}'), ("in", 0, 1, "bad"), ("in", 1, 0, '{"id":"2"}')]
    spark.createDataFrame(rows, SCHEMA).write.parquet(landing)
    q = start_publish(_source(spark, landing), EMPLOYEE, "out", FileSink(f"{scratch}/out"), f"{scratch}/c1", trigger=ONCE)
    q.awaitTermination()
    metrics = q.lastProgress["observedMetrics"]["ferry_relay"]
    assert (metrics["messages"], metrics["published"], metrics["rejected"]) == (3, 2, 1)

    seen = {}
    start_relay(
        _source(spark, landing),
        EMPLOYEE,
        "out",
        FileSink(f"{scratch}/out2"),
        RelayTables(f"{scratch}/tables"),
        f"{scratch}/c2",
        trigger=ONCE,
        on_batch=lambda batch_id, counts: seen.update({batch_id: counts}),
    ).awaitTermination()
    assert seen == {0: {"messages": 3, "published": 2, "rejected": 1}}


def test_offsets_snapshots_stay_bounded(spark, scratch, monkeypatch):
    monkeypatch.setattr(jobs, "KEEP_SNAPSHOTS", 2)
    landing, ckpt = f"{scratch}/landing", f"{scratch}/ckpt"
    tables = RelayTables(f"{scratch}/tables")
    sink = FileSink(f"{scratch}/out")
    for start, stop in ((0, 10), (10, 30), (30, 36)):
        _land(spark, landing, start, stop)
        start_relay(_source(spark, landing), EMPLOYEE, "out", sink, tables, ckpt, trigger=ONCE).awaitTermination()
    kept = spark.read.parquet(tables.offsets).select("batch_id").distinct().collect()
    assert {r.batch_id for r in kept} - {-1} == {1, 2}
    assert sorted(tuple(r) for r in committed_offsets(spark, tables).collect()) == [("in", 0, 17), ("in", 1, 17)]


class _CrashAfterWrite(FileSink):
    """Writes the batch, then fails once for the given batch id: a crash between
    the records write and the rejects/offsets writes."""

    crash_batches: set

    def write_batch(self, df, batch_id):
        super().write_batch(df, batch_id)
        if batch_id in self.crash_batches:
            self.crash_batches.discard(batch_id)
            raise RuntimeError(f"crash after writing batch {batch_id}")


def test_crash_between_writes_keeps_every_message_once(spark, scratch):
    landing, ckpt = f"{scratch}/landing", f"{scratch}/ckpt"
    tables = RelayTables(f"{scratch}/tables")
    sink = _CrashAfterWrite(f"{scratch}/out")
    object.__setattr__(sink, "crash_batches", {1})
    bad = {7, 18, 25}
    for start, stop in ((0, 10), (10, 20), (20, 30)):
        rows = [("in", o % 2, o // 2, "oops" if o in bad else '{"id":"%d"}' % o) for o in range(start, stop)]
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(landing)

    def run():
        src = read_replay(spark, landing, spark.read.parquet(landing).schema, max_files_per_trigger=1)
        start_relay(src, EMPLOYEE, "out", sink, tables, ckpt, trigger=ONCE).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    run()
    published = _ids(sink.read(spark))
    rejected = sorted(r.offset * 2 + r.partition for r in spark.read.parquet(tables.rejects).collect())
    assert published == sorted(set(range(30)) - bad)
    assert rejected == sorted(bad)
    assert sorted(tuple(r) for r in committed_offsets(spark, tables).collect()) == [("in", 0, 14), ("in", 1, 14)]


def test_relay_prepare_stage(spark, scratch):
    from pyspark.sql import functions as F

    landing = f"{scratch}/landing"
    _land(spark, landing, 0, 20)
    tables = RelayTables(f"{scratch}/tables")
    sink = FileSink(f"{scratch}/out")
    start_relay(
        _source(spark, landing),
        EMPLOYEE,
        "out",
        sink,
        tables,
        f"{scratch}/ckpt",
        trigger=ONCE,
        prepare=lambda df: df.filter(F.col("partition") == 0),
    ).awaitTermination()
    assert _ids(sink.read(spark)) == list(range(0, 20, 2))
    # what the stage drops is processed too
    offsets = sorted(tuple(r) for r in committed_offsets(spark, tables).collect())
    assert offsets == [("in", 0, 9), ("in", 1, 9)]


def test_new_checkpoint_on_old_tables(spark, scratch):
    """Batch ids start again: offsets never fall and no output goes."""
    landing, tables, sink = f"{scratch}/landing", RelayTables(f"{scratch}/tables"), FileSink(f"{scratch}/out")
    for k in range(3):
        _land(spark, landing, 10 * k, 10 * k + 10)
        start_relay(_source(spark, landing), EMPLOYEE, "out", sink, tables, f"{scratch}/a", trigger=ONCE).awaitTermination()
    late = f"{scratch}/late"
    _land(spark, late, 10, 14)
    start_relay(_source(spark, late), EMPLOYEE, "out", sink, tables, f"{scratch}/b", trigger=ONCE).awaitTermination()
    assert sorted(tuple(r) for r in committed_offsets(spark, tables).collect()) == [("in", 0, 14), ("in", 1, 14)]
    assert _ids(sink.read(spark)) == sorted([*range(30), *range(10, 14)])
    counts = batch_counts(spark, tables).groupBy("run_id").sum("n_records").collect()
    assert sorted(r[1] for r in counts) == [4, 30]


def test_empty_outputs_can_be_read(spark, scratch):
    rows = {"good": '{"id":"1"}', "bad": "{"}
    for name, value in rows.items():
        landing, tables, sink = f"{scratch}/{name}", RelayTables(f"{scratch}/{name}-t"), FileSink(f"{scratch}/{name}-o")
        spark.createDataFrame([("in", 0, 0, value)], SCHEMA).write.parquet(landing)
        start_relay(_source(spark, landing), EMPLOYEE, "out", sink, tables, f"{landing}-c", trigger=ONCE).awaitTermination()
        counts = (sink.read(spark).count(), read_rejects(spark, tables).count())
        assert counts == ((1, 0) if name == "good" else (0, 1))


def test_rejects_are_rebalanced_into_few_files(spark, scratch):
    landing = f"{scratch}/landing"
    rows = [("in", o % 8, o, "bad" if o % 50 == 0 else '{"id":"%d"}' % o) for o in range(4000)]
    spark.createDataFrame(rows, SCHEMA).repartition(8).write.parquet(landing)
    tables = RelayTables(f"{scratch}/tables")
    sink = FileSink(f"{scratch}/out")
    start_relay(_source(spark, landing), EMPLOYEE, "out", sink, tables, f"{scratch}/ckpt", trigger=ONCE).awaitTermination()
    rejects = spark.read.parquet(tables.rejects)
    assert rejects.count() == 80
    assert len(rejects.inputFiles()) == 1  # not one per source task
    assert len(sink.read(spark).inputFiles()) == 8  # the data path keeps one task per source split


def test_published_messages_carry_source_headers(spark, scratch):
    landing = f"{scratch}/landing"
    _land(spark, landing, 0, 6)
    sink = FileSink(f"{scratch}/out")
    start_publish(
        _source(spark, landing), EMPLOYEE, "out", sink, f"{scratch}/ckpt", trigger=ONCE, source_headers=True
    ).awaitTermination()
    got = {}
    for r in sink.read(spark, PUBLISHED_WITH_HEADERS).collect():
        h = {x.key: bytes(x.value).decode() for x in r.headers}
        got[int(r.value.split('"')[3])] = (h["src_topic"], int(h["src_partition"]), int(h["src_offset"]))
    assert got == {o: ("in", o % 2, o // 2) for o in range(6)}


def test_relay_with_a_hot_partition(spark, scratch):
    """Partition 0 carries a third of all messages, spread over several arrivals."""
    landing = f"{scratch}/landing"
    tables = RelayTables(f"{scratch}/tables")
    sink = FileSink(f"{scratch}/out")
    n, next_offset, rows = 3000, {}, []
    for i in range(n):
        part = 0 if i % 3 == 0 else 1 + i % 7
        off = next_offset.get(part, 0)
        next_offset[part] = off + 1
        rows.append(("in", part, off, "x" if i % 11 == 0 else '{"id":"%d"}' % i))
    for k in range(3):
        spark.createDataFrame(rows[k * 1000 : (k + 1) * 1000], SCHEMA).write.mode("append").parquet(landing)
    src = read_replay(spark, landing, spark.read.parquet(landing).schema, max_files_per_trigger=4)
    start_relay(src, EMPLOYEE, "out", sink, tables, f"{scratch}/ckpt", trigger=ONCE).awaitTermination()
    published, rejected = sink.read(spark).count(), spark.read.parquet(tables.rejects).count()
    assert published + rejected == n and rejected == len(range(0, n, 11))
    committed = {r.partition: r.max_offset for r in committed_offsets(spark, tables).collect()}
    assert committed == {p: c - 1 for p, c in next_offset.items()}
