"""op11 against all pairs, and its bounds against exact scores."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ferry.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>, line string, i int, j int, least int"
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def all_pairs(rows, positives=5, negatives=3):
    """The contract, one anchor after the other."""
    kept = {}
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        v = [math.floor(256 * float(np.float32(x))) for x in vector]
        if sum(x * x for x in v) < 2**62:
            kept[vec_id] = min(kept.get(vec_id, (label, v)), (label, v))
    out = set()
    for a, (label, x) in kept.items():
        if a % 50:
            continue
        scores = [(-sum(p * q for p, q in zip(x, y)), i, other) for i, (other, y) in kept.items() if i != a]
        mine = sorted(s[:2] for s in scores if s[2] == label)[:positives]
        for p, pos in mine:
            fits = sorted(s[:2] for s in scores if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p)[:negatives]
            out |= {(a, pos, r, n, -p, -s) for r, (s, n) in enumerate(fits, 1)}
    return out


def run(spark, rows, **kw):
    full = [(i, l, v, "x", 1, 2, 3) for i, l, v in rows]
    df = spark.createDataFrame(full, SCHEMA).repartition(4)
    return H.hard_negatives(df, F.col("vec_id") % 50 == 0, **kw)


def vectors(n, dims, labels, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims))
    out = []
    for i in range(n):
        label = int(rng.integers(labels)) if i % 3 else 0  # a third of the rows has one label
        out.append((i, label, (0.15 * (centres[label] + rng.normal(size=dims))).tolist()))
    return out


@pytest.mark.parametrize(("dims", "block"), [(64, 65_536), (13, 100), (3, 40)])
def test_equals_all_pairs(spark, monkeypatch, dims, block):
    rows = vectors(600, dims, 5, dims)
    rows += [(1000 + i, i % 3, rows[7][2]) for i in range(60)]  # copies: ties by vec_id
    monkeypatch.setattr(H, "ROWS", block)
    monkeypatch.setattr(H, "SEED_STEP", 4)
    monkeypatch.setattr(H, "ANCHORS", 6)
    got = [tuple(r[c] for c in COLUMNS) for r in run(spark, rows).collect()]
    assert len(got) == len(set(got))
    assert set(got) == all_pairs(rows)
    assert got


def test_odd_rows(spark):
    rows = [
        (0, 1, [0.5, 0.25]), (1, 1, [0.5, 0.25]), (2, 2, [0.3]), (3, 2, []), (4, 1, None), (5, None, [1.0, 1.0]),
        (None, 1, [0.5, 0.5]), (6, 2, [None, 0.5]), (7, 2, [float("nan"), 0.5]), (8, 2, [float("inf"), 0.5]),
        (9, 2, [1e30, 0.5]), (10, 2, [0.4, 0.3]), (10, 2, [0.4, 0.3]), (10, 3, [9.0, 9.0]), (50, 7, [0.1, 0.1]),
        (100, 1, [-0.5, -0.25]), (11, 2, [0.4, 0.3, 0.2, 0.1]),
    ]
    got = {tuple(r[c] for c in COLUMNS) for r in run(spark, rows).collect()}
    assert got == all_pairs(rows)
    assert (0, 1) in {g[:2] for g in got}


def test_long_scores_are_exact(spark):
    rows = [(i, i % 3, [float(1 << 20) + 1024 * i, -4096.0 * (i % 7), float(i)]) for i in range(120)]
    got = {tuple(r[c] for c in COLUMNS) for r in run(spark, rows).collect()}
    assert got == all_pairs(rows) and got
    assert max(abs(g[4]) for g in got) > 2**53


def test_empty_and_without_anchors(spark):
    assert run(spark, []).collect() == []
    assert run(spark, [(1, 1, [0.1]), (2, 1, [0.1])]).collect() == []


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(3)
    for dims in (1, 3, 8, 64, 100):
        x, y = (rng.integers(-200, 200, size=(40, dims)).astype(float) for _ in range(2))
        exact, width = x @ y.T, None
        for (ma, da), (mb, db) in zip(*(H.levels(H.summary(v), dims) for v in (x, y)), strict=True):
            middle, spread = ma @ mb.T, da @ db.T
            assert (exact <= middle + spread + 1e-6).all() and (exact >= middle - spread - 1e-6).all()
            assert width is None or spread.sum() <= width + 1e-6
            width = spread.sum()


def test_bounds_leave_few_rows(monkeypatch):
    """On vectors whose segments differ, most rows are dropped before exact scoring."""
    rng = np.random.default_rng(5)
    size, n = 64, 4_000
    x = np.repeat(rng.normal(size=(n, 8)), 8, axis=1) + 0.1 * rng.normal(size=(n, size))
    ints = np.floor(256 * x).astype(np.int64)
    import pyarrow as pa

    short = H.summary(ints.astype(float)).astype("<f4")
    t = pa.table({"vec_id": np.arange(n), "label": np.zeros(n, dtype=np.int64),
                  "vector": [v.astype("<i8").tobytes() for v in ints], "summary": [s.tobytes() for s in short]})
    a, b = H._Block(t.slice(0, 10), size), H._Block(t, size)
    scored = []
    best = H._best
    monkeypatch.setattr(H, "_best", lambda who, *r: scored.append(len(who)) or best(who, *r))
    exact = np.sort(ints[:10] @ ints.T, axis=1)[:, -6][:, None]
    low = np.full((10, 1), 0) + exact
    H._search(a, b, True, low, np.full((10, 1), 2**62), 5)
    assert sum(scored) < 0.02 * 10 * n


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    got = {tuple(r[c] for c in COLUMNS) for r in H.op11_hard_negatives(spark, sf).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({H.ORACLE_SQL})").fetchall()
    assert got == set(want) and len(got) == len(want)


def test_sample_of_random_rows(spark):
    random.seed(4)
    rows = [(i, random.randrange(2), [random.uniform(-1, 1) for _ in range(random.randrange(1, 9))]) for i in range(300)]
    got = {tuple(r[c] for c in COLUMNS) for r in run(spark, rows, positives=3, negatives=2).collect()}
    assert got == all_pairs(rows, 3, 2)
