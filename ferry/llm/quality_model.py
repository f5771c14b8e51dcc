"""Quality classifier by importance resampling of hashed n-grams.

Two generative models over hashed word and mark n-grams are counted: one from
the documents that the labels call good (the target), one from all documents
(the raw corpus). A document's importance weight is the ratio of its
probabilities under the two; a document is kept by sampling without
replacement in proportion to the weights, which is a Gumbel top-k: the k
largest of log weight + Gumbel noise. The noise is drawn from the document
itself, so every run and every retry samples alike.

The log weight is the mean over the n-grams, times LENGTH: the same text twice
is no better than once, and a short good text is not beaten by a long one.
k is the number of documents that weigh at least as much as all but
GOOD_TAIL of the good documents learnt from, less SLACK: however many of the
corpus are good, as many are sampled.

How: one pass counts n-grams in tasks (a vector of BUCKETS counts each, added
up by bucket: bounded by partitions x BUCKETS), a second scores; the models
are two vectors of BUCKETS numbers. k is found by a range shuffle of keys.

Defined cases: a null or wordless text has no n-grams and is never kept. Labels
are joined by doc_id; null labels and ids don't count, repeated ones count
each time. Without good labels nothing tells texts apart: all weights are 0
and every text with words is kept. Only labels of the learning part (crc32 of
the doc_id as text, modulo 5, not 0) are learnt from. Equal keys are told
apart by text checksum and row. Extra columns pass through
``keep_quality``. Empty tables give empty results.
"""

from __future__ import annotations

import itertools
import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm.common import checkpointed, chunks, global_rank, map_rows, quoted, table, unused, worker_cache

BUCKETS = 1 << 16
# Log weights are means over n-grams times this length.
LENGTH = 200.0
# Share of the good documents that may weigh less than the k-th, and how much
# less than theirs that weight is set: the noise has a deviation of 1.3.
GOOD_TAIL = 0.002
SLACK = 5.0
# Good documents up to which their ids are broadcast; more meet the texts in a
# shuffle by doc_id. Either way all of them are counted.
BROADCAST_IDS = 200_000
# Added to each bucket of the raw counts (and in proportion to the target's).
SMOOTHING = 1.0
CACHE_ENTRIES = 150_000

_CUT = re.compile(r"\w+|[^\w\s]+")


class _Grams(dict):
    """Hashes of the runs of letters and of marks in a word, in lower case."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        self[word] = h = tuple(xxhash.xxh3_64_intdigest(x.encode()) for x in _CUT.findall(word.lower()))
        return h


def _grams() -> _Grams:
    return worker_cache("grams", _Grams)


def grams(text: str | None) -> np.ndarray:
    """Buckets of the text's tokens and pairs of neighbouring tokens."""
    seen = _grams()
    if len(seen) > CACHE_ENTRIES:
        seen.clear()
    tokens = np.fromiter(
        itertools.chain.from_iterable(map(seen.__getitem__, (text or "").split())), dtype=np.uint64
    )
    pairs = (tokens[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (tokens[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = np.concatenate([tokens, pairs]) * np.uint64(0xFF51AFD7ED558CCD)
    return (mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def learning_part(doc_id: Column) -> Column:
    """Whether a labelled document may be learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def with_good(rows: DataFrame, good: DataFrame, how: str) -> DataFrame:
    """``rows`` joined with the good documents by doc_id."""
    good = good.withColumnRenamed("doc_id", "_id")
    if good.count() <= BROADCAST_IDS:
        return rows.join(F.broadcast(good), F.col("doc_id") == F.col("_id"), how)
    # null ids meet nothing: each row goes to a partition by its text
    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 16))).otherwise(-1)
    rows, good = rows.withColumn("_spread", spread), good.withColumn("_at", F.lit(-1).cast("long"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_spread") == F.col("_at"))
    return rows.join(good.hint("merge"), same, how)


def count_models(docs: DataFrame, good: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all documents' and the good ones' n-grams, by bucket.
    ``good``: doc_id and n, how many good labels a document has."""
    marked = with_good(docs.select("doc_id", "text"), good, "left")
    schema = "bucket long, raw long, target long"

    def run(batches):
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for chunk in chunks(batches):
            found = [grams(t) for t in chunk.column("text").to_pylist()]
            raw += np.bincount(np.concatenate(found), minlength=BUCKETS)
            times = [np.tile(g, n) for g, n in zip(found, chunk.column("n").to_pylist(), strict=True) if n]
            if times:
                target += np.bincount(np.concatenate(times), minlength=BUCKETS)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"bucket": at, "raw": raw[at], "target": target[at]})

    counts = marked.select("text", "n").mapInArrow(run, schema).groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")
    )
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.collect():  # BUCKETS rows at most
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    return raw, target


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of target over raw probability of each bucket; 0 without a target."""
    if not target.sum():
        return np.zeros(len(raw))
    p = (raw + SMOOTHING) / (raw + SMOOTHING).sum()
    # the target is smoothed towards the raw model, so rare buckets stay near 0
    extra = SMOOTHING * len(raw)
    q = (target + extra * p) / (target.sum() + extra)
    return np.log(q / p)


def weights(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """doc_id, n_grams, log_weight and sample_key (null without n-grams) of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(ratio)

    def make():
        ratio = sent.value

        def work(rows: dict) -> dict:
            out: dict[str, list] = {k: [] for k in ("doc_id", "text_hash", "n_grams", "log_weight", "sample_key")}
            for doc, text in zip(rows["doc_id"], rows["text"], strict=True):
                g = grams(text)
                seed = xxhash.xxh3_64_intdigest(f"{doc}:".encode() + (text or "").encode())
                uniform = min((seed + 0.5) / 2.0**64, 1 - 2.0**-53)
                weight = float(ratio[g].mean() * LENGTH) if len(g) else None
                out["doc_id"].append(doc)
                out["text_hash"].append(seed - (1 << 63))
                out["n_grams"].append(len(g))
                out["log_weight"].append(weight)
                out["sample_key"].append(None if weight is None else weight - float(np.log(-np.log(uniform))))
            return out

        return work

    schema = "doc_id long, text_hash long, n_grams long, log_weight double, sample_key double"
    return map_rows(docs.select("doc_id", "text"), make, schema)


def nth_weight(rows: DataFrame, share: float) -> float | None:
    """The least log_weight that at least ``share`` of the rows don't exceed, exactly; of no rows, None."""
    ranked = checkpointed(global_rank(rows, [F.col("log_weight")], "_rank"))
    at = max(0, math.ceil(share * ranked.count()) - 1)
    found = ranked.where(F.col("_rank") == at).first()
    return None if found is None else found.log_weight


def resample(docs: DataFrame, labels: DataFrame, good_tail: float = GOOD_TAIL, slack: float = SLACK) -> DataFrame:
    """Each row of ``docs``: doc_id, text_hash, n_grams, log_weight, sample_key, kept."""
    good = labels.where((F.col("quality") == 1) & learning_part(F.col("doc_id"))).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    good = checkpointed(good)
    raw, target = count_models(docs, good)
    rows = weights(docs, log_ratio(raw, target)).withColumn("_row", F.monotonically_increasing_id())
    rows = checkpointed(rows)
    known = with_good(rows.select("doc_id", "log_weight"), good, "left_semi").where("log_weight is not null")
    bound = nth_weight(known.select("log_weight"), good_tail)
    k = rows.where(F.lit(bound is None) | (F.col("log_weight") >= F.lit((bound or 0.0) - slack))).count()
    order = [F.col("sample_key").desc_nulls_last(), F.col("doc_id"), F.col("text_hash"), F.col("_row")]
    ranked = global_rank(rows, order, "_rank")
    kept = (F.col("_rank") < k) & F.col("sample_key").isNotNull()
    return ranked.select("doc_id", "text_hash", "n_grams", "log_weight", "sample_key", kept.alias("kept"))


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The sampled documents, in the columns of ``docs``. Rows with one doc_id
    and one text are kept or rejected together, by the best of them."""
    kept = checkpointed(resample(docs, labels).where("kept").select("doc_id", "text_hash").distinct())
    names = docs.columns
    schema = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in docs.schema.fields)
    seed, kept_id, kept_seed = unused(names, "_seed", "_kept_id", "_kept_seed")

    def make():
        def work(rows: dict) -> dict:
            seeds = [
                xxhash.xxh3_64_intdigest(f"{d}:".encode() + (t or "").encode()) - (1 << 63)
                for d, t in zip(rows["doc_id"], rows["text"], strict=True)
            ]
            return {n: rows[n] for n in names} | {seed: seeds}

        return work

    kept = kept.select(F.col("doc_id").alias(kept_id), F.col("text_hash").alias(kept_seed))
    same = F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(seed) == F.col(kept_seed))
    return map_rows(docs, make, f"{schema}, {seed} long").join(kept, same, "left_semi").select(*map(quoted, names))


def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(docs, table(spark, sf_dir, "labels")).drop("text_hash")
