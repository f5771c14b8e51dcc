"""Benchmark decontamination by greedy string tiling.

Texts and benchmark items are compared as normalised words (lower case,
without marks). Documents and items that share a seed, a run of MIN_MATCH
words, are joined; for each such pair the longest common runs of words not
yet marked are found by running Karp-Rabin hashes, marked on both sides, and
so on down to MIN_MATCH words. An item's coverage is the share of its words
that tiles cover, so a passage is caught when its sentences come in another
order. A document is contaminated by an item covered to MIN_COVERAGE or more.

The join goes through the seeds of a block of items: blocks hold at most
BLOCK_WORDS words, are built one after another from the benchmark in item
order, and each is held by the tasks that pass over all documents, so its
size is bounded whatever the benchmark's. A pair is tiled only if the item's
words that lie in any shared seed reach the coverage, which tiles can't
exceed. Documents are not shuffled; no text is cut.

Defined cases: null or blank texts and items match nothing. An item of fewer
than MIN_MATCH words is one seed of its own length. Repeated documents and
items give a row for each pair of rows. Null ids are kept. Extra columns are
not read; empty tables give an empty result.
"""

from __future__ import annotations

import functools
import itertools
import unicodedata

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm.common import map_rows, quoted, table, worker_cache

MIN_MATCH = 5
MIN_COVERAGE = 0.6
# Words of the items that one pass over the documents looks for.
BLOCK_WORDS = 2_000_000
CACHE_ENTRIES = 250_000

# Base of the rolling hash and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Words(dict):
    """Hash of each word's letters and digits in lower case; 0 if it has none."""

    def __missing__(self, word: str) -> int:
        bare = "".join(c for c in unicodedata.normalize("NFC", word.lower()) if c.isalnum())
        self[word] = h = (xxhash.xxh3_64_intdigest(bare.encode()) | 1) if bare else 0
        return h


def _words() -> _Words:
    return worker_cache("item words", _Words)


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    seen = _words()
    if len(seen) > CACHE_ENTRIES:
        seen.clear()
    out = []
    for t in texts:
        h = np.fromiter(map(seen.__getitem__, (t or "").split()), dtype=np.uint64)
        out.append(h[h != 0])
    return out


@functools.lru_cache(maxsize=8)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 2^n powers of the base and of its inverse."""
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(1 << n, base, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Rolling:
    """Hashes of all windows of any length, from one pass of prefix sums."""

    def __init__(self, words: np.ndarray) -> None:
        self.n = len(words)
        power, self.inverse = _powers(max(4, self.n.bit_length()))
        self.sums = np.zeros(self.n + 1, dtype=np.uint64)
        np.cumsum(words * power[: self.n], out=self.sums[1:])

    def windows(self, size: int) -> np.ndarray:
        if self.n < size:
            return np.zeros(0, dtype=np.uint64)
        at = self.n - size + 1
        return (self.sums[size:] - self.sums[:at]) * self.inverse[:at]


def tiles(item: np.ndarray, text: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in item, start in text, length) of each
    tile, longest first; ties go to the first place in the item, then in the
    text. ``least`` is cut to the item's length."""
    least = max(1, min(least, len(item)))
    a, b = Rolling(item), Rolling(text)
    free_a, free_b = np.ones(len(item), dtype=bool), np.ones(len(text), dtype=bool)
    found, size = [], min(len(item), len(text))
    while size >= least:
        # the largest size with a common window of free words, by bisection:
        # a common run of free words contains one of every smaller size
        lo, hi, best = least, size, None
        while lo <= hi:
            mid = (lo + hi) // 2
            common = _common(a, b, free_a, free_b, mid)
            if common is not None:
                best, lo = common, mid + 1
            else:
                hi = mid - 1
        if best is None:
            break
        size = lo - 1
        starts, places, first, last = best
        # Marks only grow, so a place of a hash that is no longer free is passed for good.
        at = dict(zip(first.tolist(), first.tolist(), strict=True))
        for i, p, q in zip(starts.tolist(), first.tolist(), last.tolist(), strict=True):
            if not free_a[i : i + size].all():
                continue
            while at[p] < q and not free_b[places[at[p]] : places[at[p]] + size].all():
                at[p] += 1
            for j in map(int, places[at[p] : q]):
                if free_b[j : j + size].all() and (item[i : i + size] == text[j : j + size]).all():
                    free_a[i : i + size] = False
                    free_b[j : j + size] = False
                    found.append((i, j, size))
                    break
    return found


def _common(
    a: Rolling, b: Rolling, free_a: np.ndarray, free_b: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """Equal windows of free words: their starts in the item, the places in the
    text ordered by hash and place, and where each start's places begin and end
    among those. No pair is listed, so this grows with the two lengths' sum."""
    x, y = a.windows(size), b.windows(size)
    x_at = np.flatnonzero(_all_free(free_a, size))
    y_at = np.flatnonzero(_all_free(free_b, size))
    if not len(x_at) or not len(y_at):
        return None
    known = np.unique(x[x_at])
    near = np.searchsorted(known, y[y_at])
    near[near == len(known)] = 0
    y_at = y_at[known[near] == y[y_at]]
    if not len(y_at):
        return None
    y_at = y_at[np.argsort(y[y_at], kind="stable")]
    keys = y[y_at]
    lo, hi = np.searchsorted(keys, x[x_at], "left"), np.searchsorted(keys, x[x_at], "right")
    some = lo < hi
    return x_at[some], y_at, lo[some], hi[some]


def _all_free(free: np.ndarray, size: int) -> np.ndarray:
    if len(free) < size:
        return np.zeros(0, dtype=bool)
    s = np.concatenate([[0], np.cumsum(free)])
    return s[size:] - s[:-size] == size


class ItemBlock:
    """Some benchmark items and the index of their seeds."""

    def __init__(self, items: list[tuple[int | None, str | None]], least: int) -> None:
        self.least = least
        hashes = word_hashes([t for _, t in items])
        self.items = [(i, h) for (i, _), h in zip(items, hashes, strict=True) if len(h)]
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        seeds: dict[int, list[tuple[np.ndarray, int]]] = {}
        for k, (_, h) in enumerate(self.items):
            size = min(least, len(h))
            seeds.setdefault(size, []).append((Rolling(h).windows(size), k))
        for size, some in seeds.items():
            keys = np.concatenate([w for w, _ in some])
            item = np.concatenate([np.full(len(w), k) for w, k in some])
            start = np.concatenate([np.arange(len(w)) for w, _ in some])
            order = np.argsort(keys, kind="stable")
            self.by_size[size] = keys[order], item[order], start[order]

    def matches(self, text: np.ndarray, coverage: float) -> list[tuple[int | None, int, int, int, int]]:
        """(item id, words covered, words, tiles, longest) of each item that
        reaches the coverage in the text."""
        if not len(text):
            return []
        rolling, out = Rolling(text), []
        for size, (keys, item, start) in self.by_size.items():
            windows = rolling.windows(size)
            near = np.searchsorted(keys, windows)
            near[near == len(keys)] = 0
            hits = np.unique(windows[keys[near] == windows])
            if not len(hits):
                continue
            lo, hi = np.searchsorted(keys, hits, "left"), np.searchsorted(keys, hits, "right")
            rows = np.concatenate([np.arange(p, q) for p, q in zip(lo, hi, strict=True)])
            for k in np.unique(item[rows]).tolist():
                name, words = self.items[k]
                inside = np.zeros(len(words), dtype=bool)
                for s in start[rows[item[rows] == k]].tolist():
                    inside[s : s + size] = True
                if inside.sum() < coverage * len(words):
                    continue
                found = tiles(words, text, self.least)
                covered = sum(n for _, _, n in found)
                if covered >= coverage * len(words):
                    out.append((name, covered, len(words), len(found), max(n for _, _, n in found)))
        return out


def _blocks(benchmark: DataFrame, words: int):
    """Lists of (item_id, text) of about ``words`` words at most, one in memory
    at a time: the benchmark streams through the driver in item order."""
    rows = benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator()
    block, n = [], 0
    for r in rows:
        size = len((r.text or "").split())
        if block and n + size > words:
            yield block
            block, n = [], 0
        block.append((r.item_id, r.text))
        n += size
    if block:
        yield block


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = MIN_MATCH,
    min_coverage: float = MIN_COVERAGE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """A row for each contaminated document and item: doc_id, item_id,
    n_item_words, n_covered, n_tiles, longest_tile, coverage."""
    schema = "doc_id long, item_id long, n_item_words long, n_covered long, n_tiles long, longest_tile long"
    found = []
    for items in _blocks(benchmark, block_words):
        # at most block_words words; sent once to each executor, not with each task
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def make(sent=sent):
            block = _item_block(sent, min_match)

            def work(rows: dict) -> dict | None:
                out: dict[str, list] = {n.split()[0]: [] for n in schema.split(", ")}
                for doc, words in zip(rows["doc_id"], word_hashes(rows["text"]), strict=True):
                    for item, covered, size, n_tiles, longest in block.matches(words, min_coverage):
                        for name, value in zip(out, (doc, item, size, covered, n_tiles, longest), strict=True):
                            out[name].append(value)
                return out if out["doc_id"] else None

            return work

        found.append(map_rows(docs.select("doc_id", "text"), make, schema))
    if not found:
        return docs.sparkSession.createDataFrame([], schema + ", coverage double")
    pairs = functools.reduce(DataFrame.unionByName, found)
    return pairs.withColumn("coverage", F.col("n_covered") / F.col("n_item_words"))


_held: dict[int, ItemBlock] = {}


def _item_block(sent, least: int) -> ItemBlock:
    """The block's index, built once in each worker process."""
    key = (sent._jbroadcast.id() if sent._jbroadcast is not None else id(sent.value), least)
    if key not in _held:
        _held.clear()
        _held[key] = ItemBlock(sent.value, least)
    return _held[key]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no item contaminates, in the columns of ``docs``. The
    verdict is made row by row; nothing is joined."""
    out = docs
    for items in _blocks(benchmark, BLOCK_WORDS):
        sent = docs.sparkSession.sparkContext.broadcast(items)
        names, schema = docs.columns, ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in docs.schema.fields)

        def make(sent=sent):
            block = _item_block(sent, MIN_MATCH)

            def work(rows: dict) -> dict | None:
                clean = [not block.matches(w, MIN_COVERAGE) for w in word_hashes(rows["text"])]
                return {n: list(itertools.compress(rows[n], clean)) for n in names} if any(clean) else None

            return work

        out = map_rows(out, make, schema)
    return out


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
