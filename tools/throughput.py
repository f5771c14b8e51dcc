"""Per-core-independent throughput of the relay's data path.

The sf0.1 driver tables are single files with one row group, so a plain
scan is one task. Here each derived envelope is split 8 ways and cached
first, then classify (+ parse) and serialize are timed through the noop
sink (best of 3). usage: python tools/throughput.py [sf_dir]
"""

from __future__ import annotations

import json
import sys
import time

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from ferry import EMPLOYEE, classify  # noqa: E402
from ferry.operators.records import parsed_fields, publish_envelope  # noqa: E402
from ferry.session import local_session  # noqa: E402
from ferry.sources.derived import customer_envelope, documents_envelope, events_time_envelope  # noqa: E402


def best(df, n=3):
    out = 1e9
    for _ in range(n):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        out = min(out, time.perf_counter() - t0)
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    cases = {
        "customer": (customer_envelope, EMPLOYEE),
        "events": (events_time_envelope, "id string, at timestamp"),
        "documents": (documents_envelope, "doc_id string, lang string, source string, text string"),
    }
    report = {}
    for table, (envelope, schema) in cases.items():
        env = envelope(spark.read.parquet(f"{sf_dir}/{table}.parquet")).repartition(8).cache()
        rows = env.count()
        mb = env.select(F.sum(F.length("value"))).first()[0] / 1e6
        classified = classify(env, schema)
        t_parse = best(parsed_fields(classified))
        t_pub = best(publish_envelope(classified, "out"))
        report[table] = {
            "rows": rows,
            "payload_mb": round(mb, 1),
            "classify_parse_rows_per_s": round(rows / t_parse),
            "classify_parse_mb_per_s": round(mb / t_parse, 1),
            "publish_rows_per_s": round(rows / t_pub),
        }
        env.unpersist()
    print(json.dumps({"sf_dir": sf_dir, "cores": 8, "spark": spark.version, "results": report}))
    spark.stop()


if __name__ == "__main__":
    main()
