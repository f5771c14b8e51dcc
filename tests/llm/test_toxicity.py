"""Held-out labels, the effect of the counterfactual pairs, and odd rows."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferry.llm import toxicity as tx

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, toxic int"


def test_held_out_accuracy(spark):
    out = tx.op3_toxicity(spark, SF).cache()
    assert out.count() == 10_000 and out.where("score < 0 or score > 1 or score is null").count() == 0
    both = out.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out")
    n = {(r.toxic, r.predicted): r["count"] for r in both.groupBy("toxic", "predicted").count().collect()}
    recall = n[(1, 1)] / (n[(1, 1)] + n.get((1, 0), 0))
    precision = n[(1, 1)] / (n[(1, 1)] + n.get((0, 1), 0))
    assert recall > 0.9 and precision > 0.9, (recall, precision)


@pytest.fixture(scope="module")
def biased(spark):
    """A group named in half of the toxic texts and in few others."""
    rng = np.random.default_rng(3)
    plain = [f"word{k}" for k in range(300)]
    rows, labels = [], []
    for d in range(2000):
        words = list(rng.choice(plain, 12))
        toxic = d % 4 == 0
        if toxic:
            words[3] = str(rng.choice(["idiot", "scum", "moron"]))
        if rng.random() < (0.5 if toxic else 0.02):
            words[7] = "muslims"
        rows.append((d, " ".join(words) + "."))
        labels.append((d, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, LABELS)


def test_swapped_groups_score_alike(biased):
    without, with_pairs = (tx.train_model(*biased, fairness=f) for f in (0.0, tx.FAIRNESS))

    def gap(model):
        return abs(model.logit("word1 word2 muslims word3") - model.logit("word1 word2 christians word3"))

    assert gap(without) > 1.0 and gap(with_pairs) < 0.2 * gap(without)
    neutral = "word1 word2 muslims word3"
    assert with_pairs.score(neutral) < without.score(neutral) and with_pairs.score(neutral) < 0.5
    assert with_pairs.score("word1 word2 idiot word3") > 0.5


def plain_pairs(text, features):
    """Every pair of sentences written out, then compared by their features."""
    out = Counter()
    for sentence in tx._SENTENCE.split(text or ""):
        words, pairs = sentence.split(), []
        for i, word in enumerate(words):
            for other in tx._SWAPS.get(tx.bare(word), ()):
                pairs.append((words, [*words[:i], other, *words[i + 1 :]]))
        if words and not pairs:
            term = list(tx._SWAPS)[tx.xxhash.xxh3_64_intdigest(sentence.encode()) % len(tx._SWAPS)]
            pairs = [([*words, term], [*words, o]) for o in tx._SWAPS[term]] + [([*words, term], words)]
        for a, b in pairs:
            a, b = ({f for w in side for f in features(w)} for side in (a, b))
            out[tuple(sorted(a - b)), tuple(sorted(b - a))] += 1
    return out


def test_pairs_equal_all_written_out():
    rng = np.random.default_rng(5)
    words = ["women", "Women,", "men", "Muslims", "muslimish", "womenfolk", "old", "oldest", "fine", "a", "--", "young"]
    made = tx.Counterfactuals(tx.word_features)
    for _ in range(300):
        text = " ".join(str(w) + str(rng.choice(["", "", ".", "\n"])) for w in rng.choice(words, rng.integers(0, 25)))
        assert made.count(text) == plain_pairs(text, tx.word_features), text
    assert made.count(None) == made.count("...") == Counter()


def test_pairs_of_later_sentences_and_long_texts():
    made = tx.Counterfactuals(tx.word_features)
    swap = (tuple(sorted(set(tx.word_features("women")) - set(tx.word_features("men")))),
            tuple(sorted(set(tx.word_features("men")) - set(tx.word_features("women")))))
    assert made.count("It rains. All women sing.")[swap] == 1
    assert sum(made.count("old " * 300_000).values()) == 300_000  # each occurrence, in linear time


def test_fit_equals_a_plain_descent():
    """The fitted weights against the loss written out: no direction lowers it."""
    rng = np.random.default_rng(2)
    rows = [np.flatnonzero(rng.random(6) < 0.4) for _ in range(60)]
    toxic = np.array([bool(0 in r) ^ bool(rng.random() < 0.1) for r in rows])
    pairs = [(np.array([1]), np.array([2]), 5), (np.array([0]), np.array([], dtype=np.int64), 1)]
    w, bias = tx.fit(rows, toxic, pairs, 6)

    def loss(w, bias):
        total = 0.0
        for r, t in zip(rows, toxic, strict=True):
            z = sum(w[k] for k in r) + bias
            total += (tx.TOXIC_WEIGHT * np.log1p(np.exp(-z)) if t else np.log1p(np.exp(z))) / len(rows)
        gaps = [(sum(w[k] for k in a) - sum(w[k] for k in b), n) for a, b, n in pairs]
        total += tx.FAIRNESS * sum(n * g * g for g, n in gaps) / sum(n for _, n in gaps)
        return total + tx.SHRINK * float(w @ w)

    least = loss(w, bias)
    for k in range(6):
        for step in (-0.2, 0.2):
            moved = w.copy()
            moved[k] += step
            assert loss(moved, bias) > least
    assert loss(w, bias + 0.2) > least and loss(w, bias - 0.2) > least


def test_a_scorer_equals_the_features_summed():
    model = tx.Model(np.unique(tx.features("idiot women fine")), np.arange(1.0, 1 + len(tx.features("idiot women fine"))), -2.0)
    for text in (None, "", "Idiot! idiot", "women idiots " + "x" * 100_000):
        at = np.flatnonzero(np.isin(model.keys, tx.features(text)))
        assert abs(model.logit(text) - (model.weights[at].sum() - 2.0)) < 1e-9


def test_cases(spark, make_docs):
    rows = [(d, f"word{d} idiot" if d % 2 else f"word{d} fine") for d in range(200)]
    odd = [(500, None), (500, None), (501, ""), (None, "idiot"), (502, "idiot " * 50_000)]
    labels = [(d, d % 2) for d in range(200)] + [(None, 1), (500, None), (9999, 1), (1, 1)]
    docs = make_docs(rows + odd).withColumn("toxic", F.lit("mine")).withColumn("score", F.lit("mine"))
    model = tx.train_model(docs, spark.createDataFrame(labels, LABELS))
    out = [r for r in tx.toxicity(docs, model).collect() if r.doc_id is None or r.doc_id >= 500]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.predicted) for r in out)
    assert got == [(False, 500, 0), (False, 500, 0), (False, 501, 0), (False, 502, 1), (True, 0, 1)]


def test_without_labels_and_empty(spark, make_docs):
    docs = make_docs([(1, "a"), (2, None)])
    none = spark.createDataFrame([], LABELS)
    out = tx.toxicity(docs, tx.train_model(docs, none)).collect()
    assert len(out) == 2 and all(0 <= r.score < 0.5 and r.predicted == 0 for r in out)
    one_kind = spark.createDataFrame([(1, 1), (2, 1)], LABELS)
    assert all(r.score > 0.5 for r in tx.toxicity(docs, tx.train_model(docs, one_kind)).collect())
    empty = make_docs([]).limit(0)
    assert tx.toxicity(empty, tx.train_model(empty, one_kind)).collect() == []
