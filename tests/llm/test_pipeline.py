"""The pipeline against its stages done by hand, and what its stages keep."""

from __future__ import annotations

import hashlib

import corpus_pipeline as cp
import numpy as np
from pyspark.sql import functions as F

from ferry.llm import bpe, decontaminate, quality_model, quality_rules
from tests.llm.test_neardup import by_hand

SF = "/root/testdata/sf0.01"


def test_against_brute_force(spark):
    """Stages 1 and 2 by their per-document verdicts, 3 by all pairs, 4 by
    tiling every item against every text, 5 text by text."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    sampled = {r.doc_id for r in quality_model.resample(docs, labels).where("kept").collect()}
    ruled = quality_rules.quality_rules(docs.where(F.col("doc_id").isin(sampled))).where("kept")
    rows = [(r.doc_id, r.cleaned) for r in ruled.select("doc_id", "cleaned").collect()]
    first = {x[0] for x in by_hand(rows) if x[3]}
    rows = [(d, t) for d, t in rows if d in first]
    items = [h for h in decontaminate.word_hashes([r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]) if len(h)]
    encoder = bpe.Encoder(*bpe._paths(None, None))
    want = set()
    for (d, t), h in zip(rows, decontaminate.word_hashes([t for _, t in rows]), strict=True):
        seen = set(h.tolist())
        near = [i for i in items if np.mean([w in seen for w in i.tolist()]) >= decontaminate.MIN_COVERAGE]
        if any(sum(n for _, _, n in decontaminate.tiles(i, h)) >= decontaminate.MIN_COVERAGE * len(i) for i in near):
            continue
        ids = encoder.encode([t])[0]
        want.add((d, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = cp.run(spark, SF).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 300


def test_stages_keep_the_columns(spark, make_docs):
    docs = make_docs([(d, f"A sentence with number {d}, and some more words, so that it is long enough to be kept by rules {d * 7}.") for d in range(30)])
    docs = docs.withColumn("kept", F.lit("mine")).withColumn("_row", F.lit(1))
    for clash in ("_w", "_t", "_l", "_in", "_seed", "_Kept_id", "_kept", "_rank", "N_Words", "a`b", "a.b"):
        docs = docs.withColumn(clash, F.lit("mine"))
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString(), name
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "quality_rules", "near_duplicates", "decontamination", "bpe"]
