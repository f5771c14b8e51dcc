"""Exactly-once check of the foreachBatch relay at scale.

Lands the events envelope of <sf_dir> as 10 files (every 9th payload
broken), relays them 2 files per micro-batch, crashes batch 2 right after
its records write, resumes, and checks that every message is either
published or rejected exactly once and that the committed offsets are the
per-partition maxima. usage: python tools/resume_check.py [sf_dir]
"""

from __future__ import annotations

import sys

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from ferry.session import fresh_dir, local_session  # noqa: E402
from ferry.sources.derived import events_envelope  # noqa: E402
from ferry.sources.replay import read_replay  # noqa: E402
from ferry.streaming import FileSink, RelayTables, committed_offsets, start_relay  # noqa: E402


class CrashOnce(FileSink):
    def write_batch(self, df, batch_id):
        super().write_batch(df, batch_id)
        if batch_id == 2 and not getattr(self, "_crashed", False):
            object.__setattr__(self, "_crashed", True)
            raise RuntimeError("simulated crash after the records write of batch 2")


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    root = fresh_dir(spark, "resume_check")
    broken = F.col("offset") % 9 == 0
    env = events_envelope(spark.read.parquet(f"{sf_dir}/events.parquet")).withColumn(
        "value", F.when(broken, F.lit("{bad").cast("binary")).otherwise(F.col("value"))
    )
    env.repartition(10).write.parquet(f"{root}/landing")
    sink, tables = CrashOnce(f"{root}/out"), RelayTables(f"{root}/tables")

    def run():
        src = read_replay(spark, f"{root}/landing", spark.read.parquet(f"{root}/landing").schema, max_files_per_trigger=2)
        start_relay(src, "k string", "out", sink, tables, f"{root}/ckpt", trigger={"availableNow": True}).awaitTermination()

    try:
        run()
        print("expected the first run to fail")
        return 1
    except Exception:  # noqa: BLE001 - the simulated crash
        pass
    run()
    total = env.count()
    published, rejected = sink.read(spark).count(), spark.read.parquet(tables.rejects).count()
    offsets = sorted(tuple(r) for r in committed_offsets(spark, tables).collect())
    want = sorted(tuple(r) for r in env.groupBy("topic", "partition").agg(F.max("offset")).collect())
    ok = published + rejected == total and rejected == env.filter(broken).count() and offsets == want
    print(f"messages {total} published {published} rejected {rejected} offsets {offsets} -> {'OK' if ok else 'BAD'}")
    spark.stop()
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())
