from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """documents with the given (doc_id, text) rows, in a few partitions."""

    def make(rows, partitions=3):
        full = [(d, t, "en", "src0", None if t is None else len(t)) for d, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)

    return make


@pytest.fixture
def sf_dir(spark, scratch, make_docs):
    """Writes the given rows as a table folder and returns its path."""

    def write(rows, **tables):
        folder = f"{scratch}/sf{len(rows)}"
        make_docs(rows).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        return folder

    return write
