"""Records, rejects, counts, publish and offset bookkeeping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferry import EMPLOYEE, after_committed, classify, max_offsets, publish_envelope, record_counts
from ferry.operators.offsets import merge_offsets
from ferry.operators.records import records, reject_counts, rejects
from ferry.plans import relay

GOOD = '{"id":"%d","name":"n%d"}'


def _messages(spark, rows):
    return spark.createDataFrame(rows, "topic string, partition int, offset long, value string")


def _skewed(spark, n=3000):
    """Partition 0 holds a third of all messages; every 7th payload is broken."""
    rows = []
    for i in range(n):
        part = 0 if i % 3 == 0 else 1 + i % 5
        value = "nope" if i % 7 == 0 else GOOD % (i, i)
        rows.append(("t", part, i, value))
    return _messages(spark, rows)


def test_records_and_rejects_partition_all_messages(spark):
    classified = classify(_skewed(spark), EMPLOYEE)
    n_ok = records(classified).count()
    n_bad = rejects(classified).count()
    assert n_ok + n_bad == 3000
    assert n_bad == len([i for i in range(3000) if i % 7 == 0])
    bad = rejects(classified).select("reason").distinct().collect()
    assert [r.reason for r in bad] == ["malformed"]
    counts = reject_counts(classified).collect()
    assert [(r.topic, r.reason, r.n_rejects) for r in counts] == [("t", "malformed", n_bad)]


def test_publish_envelope_shape(spark):
    classified = classify(_messages(spark, [("t", 0, 1, GOOD % (1, 1)), ("t", 0, 2, "x")]), EMPLOYEE)
    out = publish_envelope(classified, "employees").collect()
    assert [tuple(r) for r in out] == [("employees", None, '{"id":"1","name":"n1"}')]
    with_headers = publish_envelope(classified, "employees", source_headers=True).collect()
    headers = {h.key: bytes(h.value).decode() for h in with_headers[0].headers}
    assert headers == {"src_topic": "t", "src_partition": "0", "src_offset": "1"}


def test_max_offsets_and_counts_with_hot_partition(spark):
    df = _skewed(spark)
    got = {(r.partition): r.max_offset for r in max_offsets(df).collect()}
    want = {}
    for i in range(3000):
        part = 0 if i % 3 == 0 else 1 + i % 5
        want[part] = max(want.get(part, -1), i)
    assert got == want
    counts = {r.partition: r.n_records for r in record_counts(df).collect()}
    assert counts[0] == 1000 and sum(counts.values()) == 3000


def test_merge_offsets_ignores_empty_batch(spark):
    a = spark.createDataFrame([("t", 0, 5), ("t", 1, 9)], "topic string, partition int, max_offset long")
    b = spark.createDataFrame([("t", 0, 7)], "topic string, partition int, max_offset long")
    empty = a.limit(0)
    got = sorted(tuple(r) for r in merge_offsets(a, b, empty).collect())
    assert got == [("t", 0, 7), ("t", 1, 9)]


def _after(spark, **kw):
    df = _skewed(spark)
    committed = spark.createDataFrame(
        [("t", 0, 1500), ("t", 2, 10), ("t", 2, 20)], "topic string, partition int, max_offset long"
    )
    return df, sorted(r.offset for r in after_committed(df, committed, **kw).collect())


def _want_after(df):
    marks = {0: 1500, 2: 20}
    return sorted(r.offset for r in df.collect() if r.offset > marks.get(r.partition, -1))


def test_after_committed_broadcast(spark):
    df, got = _after(spark)
    assert got == _want_after(df)


def test_after_committed_salted_fallback(spark):
    df, got = _after(spark, max_broadcast_partitions=0, salt_buckets=8)
    assert got == _want_after(df)


def test_after_committed_plan_broadcasts_bounded_side(spark):
    df = _skewed(spark)
    committed = max_offsets(df.filter(F.col("offset") < 100))
    plan = after_committed(df, committed)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_committed_offset_five_resumes_at_six(spark):
    """The reference log: offset 5 committed, the next read starts at 6."""
    df = _messages(spark, [("inputTopic", 0, o, GOOD % (o, o)) for o in range(4, 9)])
    committed = spark.createDataFrame([("inputTopic", 0, 5)], "topic string, partition int, max_offset long")
    assert [r.offset for r in after_committed(df, committed).orderBy("offset").collect()] == [6, 7, 8]


def test_relay_plan_outputs(spark):
    out = relay(_skewed(spark), EMPLOYEE, "employees")
    assert out.published.count() + out.rejects.count() == 3000
    assert out.offsets.count() == 6


def test_publish_plan_parses_once(spark):
    """No Filter above the scan: the parse is not duplicated into a pushed-down predicate."""
    classified = classify(_skewed(spark), EMPLOYEE)
    plan = publish_envelope(classified, "employees")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(StructField(w,") == 1


def _filtered(spark, tmp_path, rows, marks):
    path = str(tmp_path / "messages")
    _messages(spark, rows).write.parquet(path)
    committed = spark.createDataFrame(marks, "topic string, partition int, max_offset long")
    out = after_committed(spark.read.parquet(path), committed)
    plan = out._jdf.queryExecution().executedPlan().toString()
    return sorted((str(r.topic), str(r.partition), str(r.offset)) for r in out.collect()), plan


_LOG = [(t, p, o, "x") for t in ("a", "b", None) for p in (0, 1, 2, None) for o in (1, 4, 5, 6, 9, None)]


def _left_after(marks):
    last = {(t, p): o for t, p, o in marks if o is not None}
    done = [r for r in _LOG if r[2] is not None and r[2] <= last.get(r[:2], -1)]
    return sorted((str(t), str(p), str(o)) for t, p, o, _ in _LOG if (t, p, o, "x") not in done)


def test_after_committed_pushes_the_lowest_mark(spark, tmp_path):
    marks = [("a", 0, 5), ("a", 1, 4), ("a", 2, 6)]
    got, plan = _filtered(spark, tmp_path, _LOG, marks)
    assert got == _left_after(marks)
    assert "GreaterThan(offset,4)" in plan


def test_after_committed_with_unmarked_partitions(spark, tmp_path):
    """Unmarked partitions, topics and null marks keep all their messages."""
    for k, marks in enumerate(
        [
            [("a", 0, 5), ("a", 2, 6)],  # a gap
            [("a", 0, 5), ("a", 1, 5), ("b", 1, 4)],  # not every topic's partitions
            [("a", 1, 5)],
            [("a", 0, 5), ("a", 1, None)],
            [("b", 0, None)],
            [],
        ]
    ):
        got, _ = _filtered(spark, tmp_path / str(k), _LOG, marks)
        assert got == _left_after(marks), marks
