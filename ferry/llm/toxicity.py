"""Toxicity by a counterfactual-regularised classifier.

A logistic model over the words and word beginnings present in a text. It is
trained on labelled documents, and on pairs of sentences that differ by an
identity term only (women / men, muslims / christians, ...). Every sentence of
a training text gives pairs: one that names a group, with each name swapped for
each other of its kind; one that names none, with a term chosen by the
sentence's hash set behind it, against the others of its kind and against the
sentence alone. The squared difference of the two logits is penalised, so that
a neutral mention of a group does not raise the score because the group is
often named in toxic texts.

A pair's logits differ by the features that only one sentence has, which are
features of the two terms. So a pair is kept as these two short lists, equal
ones are added up in tasks and by key, and the fit weighs each by the number of
its sentences: it sees all pairs of the training texts, in few rows.

How: labels of a bounded sample (TRAIN_DOCUMENTS in expectation, by a hash of
the doc_id; its ids are broadcast) choose the training texts. Their features
are counted by label in tasks and reduced; the VOCABULARY features that tell
the labels apart best are kept. The training rows, lists of these features,
are fitted on the driver, which they reach at that bound. Then one pass scores
every whole text; there is no shuffle of texts.

Defined cases: a null or wordless text gets the score of no feature. Labels
that are null or whose doc_id is null or unknown are not learnt from; repeated
ones count each time. Only labels of the learning part (crc32 of the doc_id
as text, modulo 5, not 0) are used, and of documents only the text. Without
labels of both kinds every score is the share of toxic labels (0 without any).
Repeated rows are scored alike; extra columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm.common import checkpointed, chunks, map_rows, table, worker_cache

TRAIN_DOCUMENTS = 40_000
VOCABULARY = 8_192
MIN_DOCUMENTS = 5  # toxic training documents a feature must stand in
# Times the odds by chance that a feature's document is toxic: features that are
# usual in clean ones would add up with a text's length.
MIN_LIFT = 2.0
TOXIC_WEIGHT = 4.0  # of a toxic document in the fit; a clean one weighs 1
BEGINNINGS = (3, 4, 5, 6)  # lengths of the word beginnings that are features
FAIRNESS = 1.0  # weight of the penalty on counterfactual pairs
SHRINK = 1e-5  # weight of the squared weights
STEPS = 400
CACHE_ENTRIES = 300_000
CACHED_LETTERS = 64  # longer words are not remembered, so entries bound a cache's bytes

# Names of groups; a term may be swapped for another of its row.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "citizens"), ("old", "young"), ("disabled", "blind", "deaf"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "deutsche"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("étrangers", "français"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("extranjeros", "españoles"),
)
_SWAPS = {t: tuple(o for o in row if o != t) for row in IDENTITY_TERMS for t in row}

_EDGE = re.compile(r"^\W+|\W+$")
_SENTENCE = re.compile(r"[.!?\n]+")


def bare(word: str) -> str:
    return _EDGE.sub("", word.lower())


def word_features(word: str) -> tuple[int, ...]:
    """Hashes of a word and of its beginnings."""
    w = bare(word)
    names = [f"w:{w}"] + [f"b:{w[:n]}" for n in BEGINNINGS if len(w) >= n] if w else []
    return tuple(xxhash.xxh3_64_intdigest(n.encode()) - (1 << 63) for n in names)


class _Known(dict):
    """What a function gives for each word, remembered for short words."""

    def __init__(self, of: Callable[[str], tuple[int, ...]]) -> None:
        self.of = of

    def __missing__(self, word: str) -> tuple[int, ...]:
        out = self.of(word)
        if len(word) <= CACHED_LETTERS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = out
        return out


def features(text: str | None) -> np.ndarray:
    """Distinct hashed features of a text."""
    seen = worker_cache("toxicity features", lambda: _Known(word_features))
    words = set((text or "").split())
    return np.unique(np.fromiter(itertools.chain.from_iterable(map(seen.__getitem__, words)), dtype=np.int64))


class Counterfactuals:
    """Pairs of a text's sentences, as features that only one side has, in a
    vocabulary's places."""

    def __init__(self, places: Callable[[str], tuple[int, ...]]) -> None:
        self.terms = {t: frozenset(places(t)) for t in _SWAPS}
        shared = frozenset().union(*self.terms.values())
        self.names = list(_SWAPS)
        # of a sentence's other words only the features that terms have too count
        self.of = _Known(lambda w: (bare(w), *(f for f in set(places(w)) if f in shared)))

    def count(self, text: str | None) -> Counter:
        """How many pairs have each difference (left, right), both sorted."""
        out: Counter = Counter()
        for sentence in _SENTENCE.split(text or ""):
            words = Counter(sentence.split())
            if not words:
                continue
            named, holders = Counter(), Counter()
            for word, n in words.items():
                name, *found = self.of[word]
                if name in _SWAPS:
                    named[name] += n
                for f in found:
                    holders[f] += n
            for name, n in named.items():
                term = self.terms[name]
                # what the sentence has without this one occurrence
                rest = {f for f, m in holders.items() if m > (f in term)}
                for other in _SWAPS[name]:
                    self._add(out, term, self.terms[other], rest, n)
            if not named:
                name = self.names[xxhash.xxh3_64_intdigest(sentence.encode()) % len(self.names)]
                for other in (*(self.terms[o] for o in _SWAPS[name]), frozenset()):
                    self._add(out, self.terms[name], other, holders.keys(), 1)
        return out

    @staticmethod
    def _add(out: Counter, a: frozenset, b: frozenset, rest, n: int) -> None:
        left, right = tuple(sorted((a - b).difference(rest))), tuple(sorted((b - a).difference(rest)))
        out[left, right] += n


@dataclass(frozen=True)
class Model:
    """Weights of hashed features, sorted by hash, and the bias."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def scorer(self) -> Callable[[str | None], float]:
        """The logit of a text. A word is looked up once, as the places of its
        features that the model knows; most words have none."""
        at = dict(zip(self.keys.tolist(), range(len(self.keys)), strict=True))
        known = _Known(lambda w: tuple(at[h] for h in word_features(w) if h in at))
        weights = self.weights.tolist()

        def logit(text: str | None) -> float:
            found = set(itertools.chain.from_iterable(map(known.__getitem__, set((text or "").split()))))
            # an exact sum: the order of a set's elements does not show
            return math.fsum([self.bias, *map(weights.__getitem__, found)])

        return logit

    def logit(self, text: str | None) -> float:
        return self.scorer()(text)

    def score(self, text: str | None) -> float:
        return probability(self.logit(text))


def probability(logit: float) -> float:
    return 1 / (1 + math.exp(-min(max(logit, -500.0), 500.0)))


def fit(
    rows: list[np.ndarray],
    toxic: np.ndarray,
    pairs: list[tuple[np.ndarray, np.ndarray, int]],
    size: int,
    fairness: float = FAIRNESS,
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the weighted mean log loss, plus ``fairness`` times
    the mean squared difference of the pairs' logits, plus the shrinkage. A pair is
    the features that only its left and only its right side has, and its number."""
    if not len(toxic):
        return np.zeros(size), -30.0
    y = toxic.astype(float)
    w, bias = np.zeros(size), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    if y.min() == y.max():
        return w, bias
    n = len(rows)
    at, row = np.concatenate(rows), np.repeat(np.arange(n), [len(r) for r in rows])
    pair = np.repeat(np.arange(len(pairs)), [len(a) + len(b) for a, b, _ in pairs])
    mixed = [x for a, b, _ in pairs for x in (a, b)]
    pair_at = np.concatenate(mixed) if mixed else np.zeros(0, dtype=np.int64)
    sign = np.concatenate([np.full(len(x), 1.0 if k % 2 == 0 else -1.0) for k, x in enumerate(mixed)]) if mixed else np.zeros(0)
    share = np.array([k for _, _, k in pairs], dtype=float)
    share /= max(1.0, share.sum())
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[at], n) + bias, -500, 500)))
        g = np.where(toxic, TOXIC_WEIGHT, 1.0) * (p - y) / n
        grad = np.append(np.bincount(at, g[row], size) + 2 * SHRINK * w, g.sum())
        if len(pairs) and fairness:
            gap = share * np.bincount(pair, sign * w[pair_at], len(pairs))
            grad[:-1] += 2 * fairness * np.bincount(pair_at, sign * gap[pair], size)
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def learning_part(doc_id: Column) -> Column:
    """Whether a labelled document may be learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def _training(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and toxic of the sampled labelled documents."""
    known = labels.where("doc_id is not null and toxic is not null").where(learning_part(F.col("doc_id")))
    known = known.select(F.col("doc_id").alias("_id"), (F.col("toxic") == 1).alias("toxic"))
    n = known.count()
    if n > TRAIN_DOCUMENTS:
        cut = int(TRAIN_DOCUMENTS / n * 1_000_000)
        known = known.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < cut)
    # at most TRAIN_DOCUMENTS rows in expectation: a bounded broadcast
    return docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_id")).select("text", "toxic")


def _vocabulary(train: DataFrame) -> np.ndarray:
    """The VOCABULARY features with the largest log-likelihood ratio, and those
    of the identity terms."""

    def run(batches):
        for chunk in chunks(batches):
            toxic = np.array(chunk.column("toxic").to_pylist(), dtype=bool)
            found = [features(t) for t in chunk.column("text").to_pylist()]
            flat = np.concatenate(found)
            mark = np.repeat(toxic, [len(f) for f in found])
            keys, at = np.unique(flat, return_inverse=True)
            n = np.bincount(at, minlength=len(keys))
            n_toxic = np.bincount(at, mark, len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"feature": keys, "n": n, "n_toxic": n_toxic})

    counts = train.mapInArrow(run, "feature long, n long, n_toxic long").groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic")
    )
    total = train.agg(F.count(F.lit(1)), F.sum(F.col("toxic").cast("long"))).first()
    n, n_toxic = total[0], total[1] or 0
    expected = F.col("n") * (n_toxic / max(1, n))

    def part(seen: Column, want: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / want)).otherwise(0.0)

    gain = part(F.col("n_toxic"), expected) + part(F.col("n") - F.col("n_toxic"), F.col("n") - expected)
    odds = MIN_LIFT * n_toxic / max(1, n - n_toxic)
    marks = F.col("n_toxic") >= odds * (F.col("n") - F.col("n_toxic"))
    best = (
        counts.where((F.col("n_toxic") >= MIN_DOCUMENTS) & (F.lit(n_toxic) < n) & marks)
        .select("feature", gain.alias("gain"))
        .orderBy(F.desc("gain"), "feature")
        .limit(VOCABULARY)
    )
    keys = [r.feature for r in best.collect()]
    for term in _SWAPS:
        keys += features(term).tolist()
    return np.unique(np.array(keys, dtype=np.int64))


def train_model(docs: DataFrame, labels: DataFrame, fairness: float = FAIRNESS) -> Model:
    train = _training(docs, labels)
    keys = _vocabulary(train)
    sent = docs.sparkSession.sparkContext.broadcast(keys)

    def make():
        at = dict(zip(sent.value.tolist(), range(len(sent.value)), strict=True))
        known = _Known(lambda w: tuple(at[h] for h in word_features(w) if h in at))
        pairs = Counterfactuals(known.__getitem__)

        def work(rows: dict) -> dict:
            found: Counter = Counter()
            packed = []
            for text in rows["text"]:
                places = set(itertools.chain.from_iterable(map(known.__getitem__, set((text or "").split()))))
                packed.append(np.array(sorted(places), dtype="<i4").tobytes())
                found.update(pairs.count(text))
            n, none = len(packed), [None] * len(packed)
            return {
                "toxic": [*rows["toxic"], *[None] * len(found)], "row": [*packed, *[None] * len(found)],
                "left": [*none, *(a for a, _ in found)], "right": [*none, *(b for _, b in found)],
                "n": [*[None] * n, *found.values()],
            }

        return work

    schema = "toxic boolean, row binary, left array<int>, right array<int>, n long"
    found = checkpointed(map_rows(train, make, schema))
    rows = found.where("toxic is not null").select("toxic", "row").collect()  # TRAIN_DOCUMENTS in expectation
    # differences of terms: their number depends on the lists of terms, not on the texts
    both = found.where("toxic is null").groupBy("left", "right").agg(F.sum("n").alias("n")).orderBy("left", "right").collect()
    weights, bias = fit(
        [np.frombuffer(r.row, dtype="<i4").astype(np.int64) for r in rows],
        np.array([r.toxic for r in rows], dtype=bool),
        [(np.array(r.left, dtype=np.int64), np.array(r.right, dtype=np.int64), r.n) for r in both if r.left or r.right],
        len(keys),
        fairness,
    )
    return Model(keys, weights, bias)


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        logit = sent.value.scorer()

        def work(rows: dict) -> dict:
            return {"doc_id": rows["doc_id"], "score": [probability(logit(t)) for t in rows["text"]]}

        return work

    out = map_rows(docs.select("doc_id", "text"), make, "doc_id long, score double")
    return out.select(
        "doc_id",
        F.coalesce(~learning_part(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(docs, train_model(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")))
