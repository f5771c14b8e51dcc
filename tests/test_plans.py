"""Physical-plan properties the relay relies on at scale."""

from __future__ import annotations

import re

from ferry import EMPLOYEE, after_committed, classify, max_offsets, publish_envelope
from ferry.operators.records import reject_counts
from ferry.sources.derived import customer_envelope, events_envelope
from ferry.sources.replay import read_table

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _operators(plan: str) -> list[str]:
    """Operator names of a plan tree, e.g. ['Generate', 'Project', 'FileScan']."""
    names = []
    for line in plan.splitlines():
        node = re.sub(r"^[\s:+\-|]*(\*\(\d+\)\s*)?", "", line)
        if node:
            names.append(node.split(" ")[0])
    return names


def _customers(spark):
    return classify(customer_envelope(read_table(spark, SF_SMALL, "customer")), EMPLOYEE)


def test_publish_path_has_no_shuffle_and_prunes_columns(spark):
    plan = _plan(publish_envelope(_customers(spark), "employees"))
    ops = _operators(plan)
    assert not any(op.endswith("Exchange") for op in ops)
    assert "Filter" not in ops  # rows are selected by a generator, the parse is not duplicated
    assert plan.count("from_json(StructField(w,") == 1  # the wrapper; long numbers alone are read again
    scan = _plan(max_offsets(events_envelope(read_table(spark, SF_SMALL, "events"))))
    assert "ReadSchema: struct<event_id:bigint>" in scan


def test_offset_aggregate_is_partial_then_final(spark):
    plan = _plan(max_offsets(events_envelope(read_table(spark, SF_SMALL, "events"))))
    assert "partial_max" in plan
    plan = _plan(reject_counts(_customers(spark)))
    assert "partial_count" in plan


def test_resume_filter_reaches_the_scan(spark):
    from pyspark.sql import functions as F

    messages = events_envelope(read_table(spark, SF_SMALL, "events"))
    committed = max_offsets(messages.filter(F.col("timestamp") < F.lit("2024-01-16").cast("timestamp")))
    df = after_committed(messages, committed)
    assert "BroadcastHashJoin" in _plan(df)
    scan = _plan(committed)
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts," in scan


def test_fallback_join_is_salted_not_broadcast(spark):
    messages = events_envelope(read_table(spark, SF_SMALL, "events"))
    df = after_committed(messages, max_offsets(messages), max_broadcast_partitions=0, salt_buckets=4)
    plan = _plan(df)
    assert "BroadcastHashJoin" not in plan and "BroadcastExchange" not in plan
    assert "ShuffledHashJoin" in plan
    assert "_salt" in plan and "_c_salt" in plan
    assert df.count() == 0  # everything is committed


def test_streaming_publish_plan_is_one_stage(spark, scratch):
    import contextlib
    import io

    from ferry.sources.replay import stream_table
    from ferry.streaming import FileSink, start_publish

    q = start_publish(
        stream_table(spark, SF_SMALL, "customer"),
        EMPLOYEE,
        "employees",
        FileSink(f"{scratch}/out"),
        f"{scratch}/ckpt",
        trigger={"availableNow": True},
        prepare=customer_envelope,
    )
    q.awaitTermination()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain()
    plan = buf.getvalue()
    assert plan.count("from_json(StructField(w,") == 1  # the wrapper; long numbers alone are read again
    assert "Exchange" not in plan
    assert "CollectMetrics" in plan


def test_deep_messages_are_made_in_many_tasks(spark):
    """A small file is one task; its rows are dealt out before they become large messages."""
    from ferry.plans.catalog import DEAL, QUERIES

    plan = QUERIES["classify_deep"](spark, SF_SMALL)
    assert plan.rdd.getNumPartitions() == DEAL * spark.sparkContext.defaultParallelism
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" in text and text.index("from_json") < text.index("RoundRobinPartitioning")
