"""Hard negatives by segment summaries.

A vector is cut into segments of components; of each its mean and deviation are
stored. For two vectors, a segment's share of their inner product is its length
times (product of the means, plus or minus the product of the deviations) at
most and at least, so sums over segments bound the score. The bounds of few
long segments are tried first, those of ever shorter ones on what is left, and
only what is left after the shortest is scored exactly. Only the shortest
segments are stored: two of them give those of the segment they make up.

* Rows are dealt into blocks by hash, anchors likewise, and each block of rows
  meets each block of anchors in a task of its own, of bounded size whatever
  the labels or copies. It returns the best rows of each anchor in it, so what
  is sent grows with anchors times blocks, not with pairs.
* First one block of rows in SEED_STEP is searched. What it finds gives every
  anchor a score that a row must reach at least, with which the other blocks'
  bounds leave few rows from the start.
* An anchor's positives are its best ``positives`` other rows of its label;
  for each, the best ``negatives`` rows of other labels whose score is within
  ``low`` to ``high`` hundredths of the positive's. All is exact: a bound that
  rounding could have moved keeps its row.

Defined cases: rows with a null vec_id, label or vector, or a null or
non-finite component, take no part, nor do vectors so long that a score could
leave the range of a long (scaled norm of 2**31 and more). A shorter vector
counts as padded with zeros; an empty one scores 0. Rows of one vec_id are one
row, the least by label, then vector. Ties go to the smaller vec_id. Anchors
without positives, or positives without negatives, give no row. An empty table
gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ferry.llm.common import checkpointed, chunks, table

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
# Segments of the coarsest and, at most, of the finest level.
COARSE, FINE = 4, 64
# Rows of a block, and anchors of a block; a small table still gives every task some.
ROWS, LEAST_ROWS, ANCHORS = 65_536, 1_024, 16_384
# Of so many blocks, one is searched first.
SEED_STEP = 32
# Rows and anchors whose bounds are worked out together.
TILE_ROWS, TILE_ANCHORS = 4_096, 64
# Scores may differ from their bounds by rounding: a share of the norms' product.
SLACK = 1e-6
_ROW = "vec_id long, label long, vector binary, summary binary"


def scaled(vectors: list[list[float]], scale: int) -> list[np.ndarray | None]:
    """Integer components floor(scale * x); None for what cannot take part."""
    out: list[np.ndarray | None] = []
    for v in vectors:
        x = np.array(v, dtype=np.float64)  # a null becomes NaN
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.floor(scale * x)
            fits = np.isfinite(x).all() and float(x @ x) < 2.0**62
        out.append(x.astype(np.int64) if fits else None)
    return out


def segments(size: int) -> np.ndarray:
    """Where the finest segments of a vector of ``size`` components start."""
    n = COARSE
    while n < FINE and 2 * n <= size // 2:
        n *= 2
    return np.arange(n) * size // n


def summary(x: np.ndarray) -> np.ndarray:
    """Means and deviations (rows x 2 x segments), times the roots of the
    segments' lengths, so that products need no weights."""
    size = x.shape[1]
    starts = segments(size)
    length = np.diff(np.append(starts, size))
    padded = np.concatenate([x, np.zeros((len(x), 1))], axis=1)  # so that an empty last segment has a start
    total, square = (np.where(length > 0, np.add.reduceat(y, starts, axis=1), 0) for y in (padded, padded * padded))
    mean = total / np.sqrt(np.maximum(length, 1))
    return np.stack([mean, np.sqrt(np.maximum(square - mean * mean, 0))], axis=1)


def levels(fine: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(mean, deviation) of each level, the coarsest first, from the finest."""
    mean, deviation = fine[:, 0].astype(np.float64), fine[:, 1].astype(np.float64)
    length = np.diff(np.append(segments(size), size))
    out = [(mean, deviation)]
    while len(length) > COARSE:
        both = length[::2] + length[1::2]
        total = mean[:, ::2] * np.sqrt(length[::2]) + mean[:, 1::2] * np.sqrt(length[1::2])
        square = mean**2 + deviation**2
        mean, square = total / np.sqrt(np.maximum(both, 1)), square[:, ::2] + square[:, 1::2]
        deviation, length = np.sqrt(np.maximum(square - mean**2, 0)), both
        out.append((mean, deviation))
    return out[::-1]


def index_rows(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, scaled vector (long integers) and summary of every row of
    (vec_id, label, embedding) that takes part, one for each vec_id."""
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("vector", pa.binary()), ("summary", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in chunks(batches):
            out: dict[str, list] = {n: [] for n in schema.names}
            vectors = scaled(some.column("embedding").to_pylist(), scale)
            for i, l, v in zip(some.column("vec_id").to_pylist(), some.column("label").to_pylist(), vectors, strict=True):
                if v is not None:
                    short = summary(v[None].astype(np.float64)).astype("<f4")
                    for name, value in zip(out, (i, l, v.astype("<i8").tobytes(), short.tobytes()), strict=True):
                        out[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in schema], schema=schema)

    part = rows.where("vec_id is not null and label is not null and embedding is not null")
    part = part.select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    found = part.mapInArrow(run, _ROW)
    one = found.groupBy("vec_id").agg(F.min(F.struct("label", "vector", "summary")).alias("x"))
    return one.select("vec_id", "x.*")


class _Block:
    """Rows of a task: vectors, labels and summaries of all levels, by label."""

    def __init__(self, rows: pa.Table, size: int) -> None:
        order = np.lexsort((rows["vec_id"].to_numpy(), rows["label"].to_numpy()))
        self.ids, self.label = (rows[c].to_numpy()[order] for c in ("vec_id", "label"))
        vectors = rows["vector"].to_pylist()
        self.x = np.zeros((len(order), size), dtype=np.int64)
        even = all(len(v) == 8 * size for v in vectors)
        for k, j in enumerate(order):
            v = np.frombuffer(vectors[j], dtype="<i8")
            self.x[k, : len(v)] = v
        real = self.x.astype(np.float64)
        self.norm = np.sqrt(np.einsum("ij,ij->i", real, real))
        if even:
            fine = rows["summary"].to_pylist()
            fine = np.frombuffer(b"".join(fine), dtype="<f4").reshape(len(order), 2, -1)[order]
        else:  # summaries of another length: those of the padded vectors
            fine = summary(real).astype("<f4")
        self.levels = levels(fine, size)
        # sums below 2**53 are exact in doubles, whose products are far faster
        self.real = real if len(order) == 0 or self.norm.max() < 2.0**26 else None


def _best(who: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the first k of each ``who`` by higher score, then smaller id."""
    order = np.lexsort((ids, -score, who))
    first = np.searchsorted(who[order], who[order])
    return order[np.arange(len(order)) - first < k]


def _search(a: _Block, b: _Block, same: bool, least: np.ndarray, most: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(anchor, window, row, score) of the best k rows of each anchor's windows:
    of its label (``same``) or of others, with scores from ``least`` to ``most``
    (anchors x windows; an empty window has least > most)."""
    least, windows = least.copy(), least.shape[1]
    held = tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    starts = np.flatnonzero(np.append(True, a.label[1:] != a.label[:-1])) if len(a.label) else np.zeros(0, dtype=int)
    for lo, hi in zip(starts, [*starts[1:], len(a.label)], strict=True):
        own = slice(*np.searchsorted(b.label, [a.label[lo], a.label[lo] + 1]))
        at = np.arange(len(b.label))
        at = at[own] if same else np.concatenate([at[: own.start], at[own.stop :]])
        for i in range(lo, hi, TILE_ANCHORS):
            tile = np.arange(i, min(hi, i + TILE_ANCHORS))
            for j in range(0, len(at), TILE_ROWS):
                got = _tile(a, b, tile, at[j : j + TILE_ROWS], least, most, k)
                if not len(got[0]):
                    continue
                merged = tuple(np.concatenate(x) for x in zip(held, got, strict=True))
                line = merged[0] * windows + merged[1]
                keep = _best(line, merged[3], b.ids[merged[2]], k)
                held = tuple(x[keep] for x in merged)
                line = line[keep]
                # a full window is left to better rows, or equal ones of a smaller id
                full = np.flatnonzero(np.bincount(line, minlength=least.size) == k)
                if len(full):
                    lowest = np.full(least.size, np.iinfo(np.int64).max)
                    np.minimum.at(lowest, line, held[3])
                    least.reshape(-1)[full] = np.maximum(least.reshape(-1)[full], lowest[full])
    return held


def _tile(a: _Block, b: _Block, tile: np.ndarray, at: np.ndarray, least: np.ndarray, most: np.ndarray, k: int) -> tuple:
    open_ = least <= most
    low = np.where(open_, least, np.iinfo(np.int64).max).min(axis=1)
    high = np.where(open_, most, np.iinfo(np.int64).min).max(axis=1)
    tile = tile[open_[tile].any(axis=1)]
    alive = a.ids[tile][:, None] != b.ids[at]
    for (ma, da), (mb, db) in zip(a.levels, b.levels, strict=True):
        keep_a, keep_b = alive.any(axis=1), alive.any(axis=0)
        tile, at, alive = tile[keep_a], at[keep_b], alive[keep_a][:, keep_b]
        if not len(tile) or not len(at):
            break
        middle, spread = ma[tile] @ mb[at].T, da[tile] @ db[at].T
        spread += SLACK * np.outer(a.norm[tile], b.norm[at]) + SLACK
        alive &= middle + spread >= low[tile][:, None]
        alive &= middle - spread <= high[tile][:, None]
    who, row = np.nonzero(alive)
    if not len(who):
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    if a.real is not None and b.real is not None:
        score = np.rint(a.real[tile] @ b.real[at].T).astype(np.int64)
    else:
        score = a.x[tile] @ b.x[at].T
    out: list[tuple] = []
    for w in range(least.shape[1]):
        fits = alive & (score >= least[tile, w][:, None]) & (score <= most[tile, w][:, None])
        if score.shape[1] > 4 * k:  # rows below the k-th best of the tile go before sorting
            inside = np.where(fits, score, np.iinfo(np.int64).min)
            fits &= score >= np.partition(inside, -k, axis=1)[:, -k][:, None]
        who, row = np.nonzero(fits)
        best = _best(who, score[who, row], b.ids[at[row]], k)
        who, row = who[best], row[best]
        out.append((tile[who], np.full(len(who), w), at[row], score[who, row]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


_FOUND = pa.schema([(n, pa.int64()) for n in ("anchor_id", "line", "vec_id", "score")])


def _task(left: pa.Table, right: pa.Table, same: bool, k: int) -> pa.Table:
    """The best rows of the block ``right`` for the anchors ``left``."""
    if not left.num_rows or not right.num_rows:
        return _FOUND.empty_table()
    size = max(len(v) // 8 for t in (left, right) for v in t["vector"].to_pylist())
    a, b = _Block(left, size), _Block(right, size)
    # anchors in the block's order; their windows, as many for each
    order = np.lexsort((left["vec_id"].to_numpy(), left["label"].to_numpy()))
    lists = {c: left[c].to_pylist() for c in ("least", "most")}
    wide = max(map(len, lists["least"]))
    least = np.full((len(order), wide), 1, dtype=np.int64)
    most = np.zeros((len(order), wide), dtype=np.int64)
    for row, j in enumerate(order):
        n = len(lists["least"][j])
        least[row, :n], most[row, :n] = lists["least"][j], lists["most"][j]
    who, line, row, score = _search(a, b, same, least, most, k)
    return pa.table({"anchor_id": a.ids[who], "line": line, "vec_id": b.ids[row], "score": score}, schema=_FOUND)


def best_rows(rows: DataFrame, anchors: DataFrame, blocks: int, same: bool, k: int) -> DataFrame:
    """anchor_id, line, vec_id, score of the best k of ``rows`` (with column j,
    their block) in every window of ``anchors`` (with columns i, least, most)."""
    sides = anchors.agg(F.max("i")).first()[0]
    if sides is None:
        return anchors.sparkSession.createDataFrame([], "anchor_id long, line long, vec_id long, score long, rank int")

    def search(some: DataFrame, asked: DataFrame, last: int, step: int) -> DataFrame:
        left = asked.toDF(*asked.columns).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(last), F.lit(step))))
        right = some.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(sides))))
        keys = ("i", "j")
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
            partial(_task, same=same, k=k), "anchor_id long, line long, vec_id long, score long"
        )
        first = W.partitionBy("anchor_id", "line").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)

    if blocks > 1:
        seeds = search(rows.where(F.col("j") % SEED_STEP == 0), anchors, blocks - 1, SEED_STEP)
        # where a window is full already, the score of its last row
        reached = seeds.where(F.col("rank") == k).groupBy("anchor_id").agg(
            F.map_from_entries(F.collect_list(F.struct("line", "score"))).alias("reached")
        )
        asked = anchors.join(checkpointed(reached), F.col("vec_id") == F.col("anchor_id"), "left").drop("anchor_id")
        raised = F.expr("transform(least, (s, w) -> greatest(s, try_element_at(reached, cast(w as bigint))))")
        anchors = asked.withColumn("least", raised).drop("reached")
    return search(rows, anchors, blocks - 1, 1)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score
    for ``rows`` (vec_id, label, embedding)."""
    spark = rows.sparkSession
    index = checkpointed(index_rows(rows, scale))
    n = index.count()
    deal = max(1, -(-n // ROWS), min(int(spark.conf.get("spark.sql.shuffle.partitions")), n // LEAST_ROWS))
    index = index.withColumn("j", F.pmod(F.xxhash64("vec_id"), F.lit(deal)).cast("int"))
    anchors = index.where(is_anchor).drop("j")
    sides = max(1, -(-anchors.count() // ANCHORS))
    anchors = anchors.withColumn("i", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(sides)).cast("int"))
    all_scores = (F.array(F.lit(-(2**62)).cast("long")), F.array(F.lit(2**62).cast("long")))
    asked = anchors.withColumn("least", all_scores[0]).withColumn("most", all_scores[1])
    found = best_rows(index, asked, deal, True, positives)
    first = F.array_sort(F.collect_list(F.struct("rank", F.col("vec_id").alias("id"), "score")))
    found = checkpointed(found.groupBy("anchor_id").agg(first.alias("positives")))
    # a positive's window; whole scores from the first to the last of it
    windows = anchors.join(found, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id", "positives")
    bounds = found.select(
        F.col("anchor_id").alias("_a"),
        F.expr(f"transform(positives, p -> cast(ceil(cast({low} * cast(p.score as decimal(38,0)) as decimal(38,0)) / 100) as bigint))").alias("least"),
        F.expr(f"transform(positives, p -> cast(floor(cast({high} * cast(p.score as decimal(38,0)) as decimal(38,0)) / 100) as bigint))").alias("most"),
    )
    asked = windows.join(bounds, F.col("vec_id") == F.col("_a")).drop("_a")
    mined = best_rows(index, asked, deal, False, negatives)
    mined = mined.select("anchor_id", "line", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    positive = found.select("anchor_id", F.posexplode("positives").alias("line", "p"))
    positive = positive.select("anchor_id", "line", F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    return mined.join(positive, ["anchor_id", "line"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)


ORACLE_SQL = r"""
WITH e AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS r
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
           AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, r::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE r <= 3
"""
