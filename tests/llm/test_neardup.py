"""Links and components against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferry.llm import neardup as nd
from ferry.llm.common import components


def shingles(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def reach(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def by_hand(rows):
    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    links = [
        (a, b)
        for i, (a, x) in enumerate(sets)
        for b, y in sets[i + 1 :]
        if x and y and 100 * len(x & y) >= 75 * len(x | y)
    ]
    root = reach({d for d, _ in sets}, links)
    out = []
    for d, t in rows:
        out.append((d, len(shingles(t)), None if d is None else root[d], d is not None and root[d] == d))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(3000)]

    def text(n):
        return rng.choices(vocabulary, k=n)

    def edited(words, n):
        words = list(words)
        for _ in range(n):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        return words

    rows, passage = [], text(30)
    for _ in range(120):  # small groups, from near to just beyond the bound
        base = text(rng.randrange(40, 200))
        rows.append(base)
        rows += [edited(base, rng.randrange(0, 6)) for _ in range(rng.randrange(4))]
    hot = text(120)
    rows += [edited(hot, rng.randrange(0, 5)) for _ in range(300)]  # a large group of near copies
    chain = text(100)
    for _ in range(40):  # each is near the last, the ends share nothing
        chain = edited(chain, 2)
        rows.append(chain)
    rows += [text(15) + passage + text(15) for _ in range(200)]  # a passage that many share
    rows += [text(rng.randrange(0, 6)) for _ in range(60)]
    rows += [rng.choice(rows) for _ in range(100)]
    rng.shuffle(rows)
    return [(d, " ".join(w).title() if d % 2 else "\n".join(w)) for d, w in enumerate(rows)]


def test_against_all_pairs(spark, make_docs, corpus):
    assert got(nd.near_duplicates(make_docs(corpus))) == by_hand(corpus)


def test_small_regions_and_groups(spark, make_docs, corpus, monkeypatch):
    """Adaptive depth and blocks on small data: every region is dense."""
    monkeypatch.setattr(nd, "REGION", 3)
    monkeypatch.setattr(nd, "GROUP", 10)
    monkeypatch.setattr(nd, "BLOCK", 20)
    monkeypatch.setattr(nd, "OUTSIDE", 30)
    monkeypatch.setattr(nd, "BLOCK_SHINGLES", 2_000)
    assert got(nd.near_duplicates(make_docs(corpus))) == by_hand(corpus)


def test_cases(spark, make_docs):
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a b c"), (7, "a b c d e"), (7, "a b c d e"),
        (8, "A B C D E"), (None, "a b c d e"), (None, None), (9, "word " * 60_000), (10, "word word word word word"),
        (11, "é b c d e"), (12, "É b c d e"), (13, "a\x0bb"), (14, "a b"),
    ]
    docs = make_docs(rows).withColumn("component_id", F.lit("mine")).withColumn("set_hash", F.lit("mine"))
    assert got(nd.near_duplicates(docs)) == by_hand(rows)
    kept = nd.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 2, 3, 4, 6, 7, 9, 11, 12, 14]
    assert kept.where("doc_id is null").count() == 2


def test_empty_and_blank_tables(spark, make_docs):
    assert nd.near_duplicates(make_docs([]).limit(0)).collect() == []
    assert got(nd.near_duplicates(make_docs([(1, ""), (2, None)]))) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    y = np.concatenate([x[:3000], rng.integers(0, 2**63, 1000, dtype=np.uint64)])
    a, b = nd.signatures([np.sort(x), np.sort(y)])
    assert abs((a == b).mean() - 0.6) < 0.17


def test_components_against_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    edges += [(k, k + 1) for k in range(1000, 1300)] + [(5000, k) for k in range(5001, 5200)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    out = {r.node: r.component for r in components(df).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert out == reach({n for e in real for n in e}, real)
    assert components(df.limit(0)).collect() == []


def test_one_doc_id_with_several_texts(spark, make_docs):
    """Each row comes out once, and a doc_id's texts are linked by it."""
    rng = random.Random(5)
    texts = [" ".join(rng.choices([f"w{k}" for k in range(500)], k=60)) for _ in range(12)]
    rows = [(7, t) for t in texts[:6]] + [(7, texts[0]), (7, None), (7, "")]
    rows += [(3, texts[2]), (9, texts[4] + " and more"), (4, texts[6]), (4, texts[7]), (8, texts[7]), (5, ""), (None, texts[1]), (None, texts[11])]
    rows += [(20 + k, texts[9] + f" end {k}") for k in range(40)] + [(20, texts[10]), (60, texts[10])]
    assert got(nd.near_duplicates(make_docs(rows))) == by_hand(rows)
    kept = [r.doc_id for r in nd.drop_near_duplicates(make_docs(rows)).collect() if r.doc_id is not None]
    assert sorted(kept, key=str) == sorted({d for d, _, c, k in by_hand(rows) if k}, key=str)


def test_a_mass_of_near_copies_lists_few_pairs(spark, make_docs):
    """2,000 near copies: at most two pairs a class before the first
    confirmation, and next to none that are still apart after it."""

    random.seed(11)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(2_000):
        words = list(base)
        words[random.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(words)))
    docs = make_docs(rows, 8).select("doc_id", "text")
    sketched = nd.sketch(docs)
    classes = nd.checkpointed(
        sketched.select(F.xxhash64("set_hash").alias("node"), "set_hash", "doc_id", "text_key", "n_shingles", "signature", "low")
    )
    levels = nd.regions(classes)
    first = nd._screen(nd.stars(levels), classes).withColumns({"ca": F.col("a"), "cb": F.col("b")})
    first = nd.checkpointed(first)
    assert first.count() <= 2 * 2_000
    known = classes.select("node", F.col("node").alias("component"))
    known = nd._joined(known, nd.checkpointed(nd._confirm(first, classes, docs)))
    assert known.select("component").distinct().count() <= 20
    assert nd.apart(levels, known).count() <= 2_000
