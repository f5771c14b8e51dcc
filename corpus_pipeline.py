"""Corpus pipeline: quality classifier, quality rules, near-duplicates,
benchmark decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on every document that its
predecessor kept; all but the last return the columns of ``docs``. ``run``
writes each stage's documents as Parquet in the cluster's shared folder and
reads them back, so a lost executor repeats one stage's tasks at most.

* quality_classifier: documents that the importance resampling rejects go.
* quality_rules: rejected documents go; of the others, failing lines go.
* near_duplicates: one document of each group of near copies stays.
* decontamination: documents that hold a benchmark item go.
* bpe: the kept texts' token counts, and digests of their ids and of the bytes
  decoded from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ferry.llm import bpe, decontaminate, neardup, quality_model, quality_rules
from ferry.llm.common import table
from ferry.session import fresh_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_model.keep_quality(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


def line_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    return quality_rules.clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    return neardup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    return bpe.encode_digests(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", line_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("bpe", encode),
]

# The classifier's hashes, MinHash and BPE have no SQL form: tests/llm/test_pipeline.py
# holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), fresh_dir(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
