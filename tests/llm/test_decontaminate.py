"""Greedy string tiling against a plain version, and planted passages."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferry.llm import decontaminate as dc
from ferry.session import fresh_dir

ITEMS = "item_id long, text string"


def plain_tiles(a, b, least):
    """Longest common run of unmarked words, first in a, then in b, again and again."""
    least = max(1, min(least, len(a)))
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n > best[2]:
                    best = (i, j, n)
        if best[2] < least:
            return out
        i, j, n = best
        out.append(best)
        free_a[i : i + n] = [False] * n
        free_b[j : j + n] = [False] * n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=25), st.lists(st.integers(1, 4), max_size=40), st.integers(1, 5))
def test_tiles_against_a_plain_version(a, b, least):
    got = dc.tiles(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64), least) if a else []
    assert got == (plain_tiles(a, b, least) if a else [])


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(5)
    items = [(k, ". ".join(" ".join(words(rng, 12)).capitalize() for _ in range(4)) + ".") for k in range(30)]
    docs, want = [], set()
    for d in range(120):
        text = " ".join(words(rng, 80))
        kind = d % 6
        if kind < 4:
            k = rng.randrange(30)
            body = items[k][1]
            if kind == 1:  # sentences in another order, other marks and case
                parts = body.split(". ")
                rng.shuffle(parts)
                body = "\n".join(p.upper().replace(".", " !") for p in parts)
            if kind == 2:  # every twelfth word changed
                body = " ".join("xxxx" if i % 12 == 6 else w for i, w in enumerate(body.split()))
            if kind == 3:  # a quarter only: not contaminated
                body = body.split(". ")[0]
            else:
                want.add((d, k))
            at = rng.randrange(0, 80)
            text = text[: at * 7] + " " + body + " " + text[at * 7 :]
        docs.append((d, text))
    return docs, items, want


@pytest.mark.parametrize("block", [dc.BLOCK_WORDS, 100])
def test_planted_passages(spark, make_docs, planted, block):
    docs, items, want = planted
    out = dc.contaminations(make_docs(docs), spark.createDataFrame(items, ITEMS), block_words=block).collect()
    assert {(r.doc_id, r.item_id) for r in out} == want and len(out) == len(want)
    assert all(r.coverage >= dc.MIN_COVERAGE and r.n_covered <= r.n_item_words for r in out)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = set()
    texts = dc.word_hashes([t for _, t in docs])
    for (i, _), h in zip(items, dc.word_hashes([t for _, t in items]), strict=True):
        rare = set(h.tolist())
        for (d, _), t in zip(docs, texts, strict=True):
            if len(rare.intersection(t.tolist())) < 0.3 * len(rare):
                continue  # covered words are among the shared ones
            covered = sum(n for _, _, n in dc.tiles(h, t))
            if covered >= dc.MIN_COVERAGE * len(h):
                want.add((d, i, covered))
    got = dc.op2_decontaminate(spark, sf).collect()
    assert {(r.doc_id, r.item_id, r.n_covered) for r in got} == want and len(got) == len(want) > 10


def test_cases(spark, make_docs):
    bench = spark.createDataFrame([(1, "alpha beta gamma"), (2, None), (3, " ... "), (None, "one two three four five six")], ITEMS)
    bench = bench.withColumn("doc_id", F.lit("x"))
    rows = [(1, "x Alpha, beta-gamma alpha beta; gamma!"), (1, "alpha beta gamma"), (2, None), (3, ""), (None, "one two three four five six"), (4, "pad " * 60_000 + "alpha beta gamma")]
    docs = make_docs(rows).withColumn("item_id", F.lit("y"))
    got = sorted(((r.doc_id, r.item_id) for r in dc.contaminations(docs, bench).collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (None, None), (4, 1)], key=str)
    kept = dc.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_empty_tables(spark, make_docs):
    empty = spark.createDataFrame([], ITEMS)
    assert dc.contaminations(make_docs([(1, "a b c d e f")]), empty).collect() == []
    assert dc.contaminations(make_docs([]).limit(0), spark.createDataFrame([(1, "a b")], ITEMS)).collect() == []
    assert dc.drop_contaminated(make_docs([(1, "a")]), empty).count() == 1


def test_query_reads_its_tables(spark, sf_dir):
    folder = sf_dir([(5, "so one two three four five six it is")], benchmark=spark.createDataFrame([(9, "one two three four five six")], ITEMS))
    assert [(r.doc_id, r.item_id) for r in dc.op2_decontaminate(spark, folder).collect()] == [(5, 9)]
    assert fresh_dir(spark, "tests") != folder


def test_repeated_word_in_a_very_long_text_is_linear():
    """One word 100 times, against a text of it: no list of place pairs."""
    import tracemalloc

    item, text = np.full(100, 7, dtype=np.uint64), np.full(400_000, 7, dtype=np.uint64)
    tracemalloc.start()
    found = dc.tiles(item, text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(0, 0, 100)] and peak < 60e6, peak
