"""Round trip on hard text: payload -> classify -> serialize -> Python json."""

from __future__ import annotations

import json
import random

from ferry import EMPLOYEE, classify
from ferry.operators.records import parsed_fields, serialized

FIELDS = ["id", "name", "firstName", "lastName"]
POOL = list('abc XYZ"\\/\b\f\n\r\t\x01\x1f<>&=\'{}[]:,') + ["é", "ß", "中", " ", "😀", "𝄞", " "]


def _records(seed: int, n: int) -> list[dict]:
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        rec = {}
        for f in FIELDS:
            r = rng.random()
            if r < 0.15:
                continue  # missing key
            if r < 0.25:
                rec[f] = None
            else:
                rec[f] = "".join(rng.choice(POOL) for _ in range(rng.randint(0, 40)))
        out.append(rec)
    return out


def test_round_trip_of_hard_strings(spark):
    recs = _records(11, 2000)
    rng = random.Random(5)
    payloads = [json.dumps(r, ensure_ascii=rng.random() < 0.5) for r in recs]
    df = spark.createDataFrame(list(enumerate(payloads)), "offset long, value string")
    classified = classify(df, EMPLOYEE)
    fields = {r.offset: r for r in parsed_fields(classified).collect()}
    texts = {r.offset: r.value for r in serialized(classified).collect()}
    assert len(texts) == len(recs)
    for i, rec in enumerate(recs):
        row = fields[i]
        assert row.status == "ok", payloads[i]
        assert [row[f] for f in FIELDS] == [rec.get(f) for f in FIELDS], payloads[i]
        expected = {f: rec[f] for f in FIELDS if rec.get(f) is not None}
        assert json.loads(texts[i]) == expected
        assert list(json.loads(texts[i])) == [f for f in FIELDS if f in expected]  # declared order
