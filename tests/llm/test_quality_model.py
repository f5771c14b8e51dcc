"""Models, sampling and held-out labels of the importance resampling."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferry.llm import quality_model as qm

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def scored(spark):
    return qm.op10_quality_model(spark, SF).cache()


def test_held_out_labels(spark, scored):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    both = scored.join(labels, "doc_id").where(~qm.learning_part(F.col("doc_id")))
    n = {(r.quality, r.kept): r["count"] for r in both.groupBy("quality", "kept").count().collect()}
    good, bad = n.get((1, True), 0), n.get((0, False), 0)
    assert good / (good + n.get((1, False), 0)) >= 0.995
    assert bad / (bad + n.get((0, True), 0)) >= 0.85
    assert scored.count() == 10_000 and scored.select("doc_id").distinct().count() == 10_000


def test_kept_rows_are_the_largest_keys(scored):
    rows = scored.select("sample_key", "kept").collect()
    low = min(r.sample_key for r in rows if r.kept)
    assert all(r.sample_key is None or r.sample_key <= low for r in rows if not r.kept)


def test_counts_against_a_plain_count(spark, make_docs):
    rows = [(1, "a b a"), (2, "B, c"), (3, None), (4, "a b a")]
    good = spark.createDataFrame([(1, 2), (3, 1), (9, 1)], "doc_id long, n long")
    raw, target = qm.count_models(make_docs(rows), good)
    want_raw = Counter(g for _, t in rows for g in qm.grams(t).tolist())
    want_target = Counter(g for g in qm.grams("a b a").tolist() for _ in range(2))
    assert {i: raw[i] for i in np.flatnonzero(raw)} == want_raw
    assert {i: target[i] for i in np.flatnonzero(target)} == want_target
    assert len(qm.grams("a b a")) == 5 and len(qm.grams("")) == 0


def test_the_key_is_the_weight_with_gumbel_noise(spark, make_docs):
    rows = [(i, f"text number {i}") for i in range(4000)]
    out = qm.weights(make_docs(rows), np.zeros(qm.BUCKETS)).collect()
    noise = np.array([r.sample_key - r.log_weight for r in out])
    assert abs(noise.mean() - 0.5772) < 0.08 and abs(noise.std() - math.pi / math.sqrt(6)) < 0.08


def test_cases(spark, make_docs):
    rows = [(1, "good text here"), (1, "good text here"), (2, None), (3, " "), (None, "good words"), (4, "x " * 50_000)]
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 1, 0), (3, None, None)], LABELS)
    docs = make_docs(rows).withColumn("kept", F.lit("mine")).withColumn("text_hash", F.lit("mine"))
    out = qm.resample(docs, labels).collect()
    assert len(out) == 6 and not any(r.kept for r in out if r.n_grams == 0)
    assert qm.keep_quality(docs, labels).columns == docs.columns


def test_without_labels_every_text_with_words_stays(spark, make_docs):
    rows = [(1, "a b"), (2, "### ###"), (3, ""), (4, None)]
    none = spark.createDataFrame([], LABELS)
    assert sorted(r.doc_id for r in qm.keep_quality(make_docs(rows), none).collect()) == [1, 2]
    assert qm.keep_quality(make_docs([]).limit(0), none).collect() == []


def test_all_good_documents_count_however_many(spark, make_docs, monkeypatch):
    """Past the bound on broadcast ids the models and the threshold are of all documents all the same."""
    rows = [(i % 290, f"good text {i} w{i % 7}") for i in range(300)] + [(None, "null id")] * 20 + [(i, f"bad {i}") for i in range(400, 500)]
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in range(500)] + [(3, 1, 0)], LABELS)
    docs = make_docs(rows).cache()
    good = labels.where("quality = 1").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    want, kept = qm.count_models(docs, good), sorted(map(str, qm.resample(docs, labels).collect()))
    for name in ("BROADCAST_IDS", "TARGET_DOCUMENTS"):
        monkeypatch.setattr(qm, name, 20, raising=False)
    got = qm.count_models(docs, good)
    assert all((a == b).all() for a, b in zip(got, want, strict=True)) and want[1].sum()
    assert sorted(map(str, qm.resample(docs, labels).collect())) == kept


def test_threshold_is_exact(spark):
    values = [float((i * 7919) % 30_011) for i in range(30_000)]
    rows = spark.createDataFrame([(v,) for v in values], "log_weight double").repartition(5)
    for share in (0.0, 0.002, 0.00213, 0.5, 1.0):
        assert qm.nth_weight(rows, share) == sorted(values)[max(0, math.ceil(share * len(values)) - 1)]
    assert qm.nth_weight(rows.limit(0), 0.5) is None
