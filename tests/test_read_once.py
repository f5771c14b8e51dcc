"""Reading each message once, and the index of replay files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ferry.operators.offsets import after_committed
from ferry.operators.records import header
from ferry.schemas import OFFSETS, PUBLISHED_WITH_HEADERS
from ferry.sources.offset_index import files_after, read_after, update_index
from ferry.sources.replay import read_replay
from ferry.streaming import FileSink
from ferry.streaming import read_once as ro

SCHEMA = "topic string, partition int, offset long, value string"


def _message(topic, value, src=None):
    heads = None if src is None else [(f"src_{n}", None if v is None else str(v).encode()) for n, v in zip(("topic", "partition", "offset"), src)]
    return (topic, None, value, heads)


FIRST = [_message("out", f"v{o}", ("in", o % 2, o * 40_000)) for o in range(6)]
ODD = [_message("out", "none"), _message("out", "none"), _message("out", "bad", ("in", 0, "x")), _message("out", "bad", ("in", 0, "x")),
       _message("out", "neg", ("in", 0, -1)), _message("out", "half", ("in", None, 1)), _message(None, None, None)]
LATER = [_message("out", "again", ("in", 0, 0)), _message("dead", "v0", ("in", 0, 0)), _message("out", "new", ("in", 0, 1)),
         _message("out", "other", ("in2", 0, 0)), _message("out", "new", ("in", 0, 1))]
WANT = sorted([r[2] or "" for r in FIRST + ODD] + ["v0", "new", "other"])


def test_batch(spark):
    sent = spark.createDataFrame(FIRST + ODD + FIRST + LATER, PUBLISHED_WITH_HEADERS).where("value is null or value <> 'again'")
    out = ro.read_once(sent)
    assert out.schema == sent.schema and sorted(r.value or "" for r in out.collect()) == WANT
    assert ro.read_once(sent.limit(0)).collect() == []
    with pytest.raises(ValueError, match="_src_topic"):
        ro.read_once(sent.withColumn("_Src_Topic", F.lit(1)))


def test_stream_drops_what_came_in_an_earlier_batch(spark, scratch):
    sink = FileSink(f"{scratch}/out")
    for rows in (FIRST + ODD, FIRST + LATER, []):
        spark.createDataFrame(rows, PUBLISHED_WITH_HEADERS).repartition(2).write.mode("append").parquet(f"{scratch}/topic")
        arrived = read_replay(spark, f"{scratch}/topic", PUBLISHED_WITH_HEADERS, max_files_per_trigger=1)
        writer = sink.write_stream(ro.read_once(arrived)).option("checkpointLocation", f"{scratch}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    got = sink.read(spark, PUBLISHED_WITH_HEADERS)
    assert sorted(r.value or "" for r in got.collect()) == WANT
    # the headers come through whole
    assert got.where("value = 'other'").select(header("src_topic").alias("t")).first().t == "in2"


def test_stream_keeps_extra_columns(spark, scratch):
    rows = spark.createDataFrame(FIRST + FIRST, PUBLISHED_WITH_HEADERS).withColumn("partition", F.lit(3)).withColumn("N", F.lit("x"))
    rows.write.parquet(f"{scratch}/topic")
    writer = ro.read_once(read_replay(spark, f"{scratch}/topic", rows.schema)).writeStream.format("parquet")
    writer.option("checkpointLocation", f"{scratch}/c").option("path", f"{scratch}/out").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema(rows.schema).parquet(f"{scratch}/out").collect()
    assert len(out) == 6 and {(r.partition, r.N) for r in out} == {(3, "x")}


def _land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_index_reads_only_files_above_the_marks(spark, scratch):
    folder = f"{scratch}/landing with space"
    schema = spark.createDataFrame([], SCHEMA).schema
    for first in range(0, 50, 10):  # partition 0 in five files
        _land(spark, folder, [("in", 0, o, f"a{o}") for o in range(first, first + 10)])
    _land(spark, folder, [("in", 1, o, f"b{o}") for o in range(5)])  # no mark
    index = update_index(spark, folder, f"{scratch}/index", schema)
    marks = spark.createDataFrame([("in", 0, 29), ("in", 0, 3), ("else", 1, 99)], OFFSETS)
    assert files_after(index, marks).count() == 3  # offsets 30 to 39, 40 to 49, and partition 1
    out = read_after(spark, folder, index, marks, schema)
    whole = after_committed(spark.read.schema(schema).parquet(folder), marks)
    assert len(out.inputFiles()) == 3 < len(whole.inputFiles())
    assert sorted(r.value for r in out.collect()) == sorted(r.value for r in whole.collect())
    # a file that the index has not yet is read; rows without a position always are
    _land(spark, folder, [("in", 0, 50, "a50"), ("in", 0, None, "lost"), (None, None, 1, "void")])
    for now in (index.checkpoint(), update_index(spark, folder, f"{scratch}/index", schema)):
        out = read_after(spark, folder, now, marks, schema)
        assert len(out.inputFiles()) == 4 and {"a50", "lost", "void"} <= {r.value for r in out.collect()}
    n = update_index(spark, folder, f"{scratch}/index", schema).count()
    assert n == update_index(spark, folder, f"{scratch}/index", schema).count()  # nothing twice


def test_index_all_done_and_empty(spark, scratch):
    schema = spark.createDataFrame([], SCHEMA).schema
    _land(spark, f"{scratch}/l", [("in", 0, 1, "a")])
    index = update_index(spark, f"{scratch}/l", f"{scratch}/i", schema)
    assert read_after(spark, f"{scratch}/l", index, spark.createDataFrame([("in", 0, 1)], OFFSETS), schema).collect() == []
    none = spark.createDataFrame([], OFFSETS)
    assert len(read_after(spark, f"{scratch}/l", index, none, schema).collect()) == 1
