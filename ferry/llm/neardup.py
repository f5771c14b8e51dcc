"""MinHash near-duplicates by an LSH forest.

A document is the set of its distinct 5-word shingles; two are linked when
100 x |intersection| >= 75 x |union|, confirmed on the full sets.

* Documents with equal sets form a class; one of them stands for all.
* A class has SIGNATURE minimum hashes. Each of TREES trees reads them in an
  order of its own; classes that agree on the first values of a tree's order
  are one region of it, the longest common prefixes are the neighbours.
* The depth adapts to the region: in a region of at most REGION classes all
  pairs are candidates; a larger one is cut by deeper prefixes, and at every
  depth each of its classes is also a candidate with the region's smallest and
  largest.
* First each class is compared with the smallest and the largest of all its
  neighbours, two pairs a class, so that a mass of near copies hangs together
  before its pairs are listed. Then the candidates that are still in different
  components are listed and compared.
* Candidates are screened by their signatures, and gathered by the neighbour or
  component that they share (large ones in blocks) so that each full set travels
  a few times at most; there the links are confirmed, as long as they join
  something new.
* Then the larger regions are gone through again, so that no link is lost in
  them: classes outside a region's largest component are compared with all of
  the region, in blocks of bounded classes and shingles, by signature and then
  on the full sets. A block returns only links that join components, never the
  pairs it compared, so its rows grow with the classes.

Two texts at exactly the bound agree on a tree's first 4 values with
probability 0.75^4, so one of 24 trees finds them with 0.9999; closer ones
more surely. No number of partners or candidates is capped.

Defined cases: no words (or a null text) is an empty set, linked with nothing
and kept; fewer than five words are one shingle. Rows with a null doc_id
cannot be named: they are counted, not linked, and not kept. Rows with one
doc_id count as one document: what any of its texts is linked with, it is, and
each row has its own count. Repeated rows are all returned. Extra columns
are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm.common import checkpointed, components, map_rows, release, table, unused, worker_cache

SHINGLE = 5
PERCENT = 75
SIGNATURE = 96
TREES = 24
DEPTHS = (4, 6, 8, 12)  # prefix lengths of a tree, from wide to narrow regions
REGION = 24  # classes up to which a region's pairs are all candidates
# Screening: share of equal signature values below which a candidate is
# dropped. A true link has 0.75 at least, with a deviation of 0.044: one in 20,000
# of those at the very bound is lost, of closer ones next to none. Values are
# compared by their lowest byte: equal ones stay equal, others agree once in 256.
SCREEN = 0.58
# Classes of a block of comparisons in large regions, and of those outside the
# largest component that they are compared with; shingles of either at most.
BLOCK, OUTSIDE, BLOCK_SHINGLES = 250, 1_000, 1_000_000
# Classes of a component whose sets are held by one task at a time.
GROUP = 200
CACHE_ENTRIES = 300_000

_M = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _word_hashes() -> _WordHashes:
    """Hashes of words seen by this worker."""
    return worker_cache("shingle words", _WordHashes)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    seen = _word_hashes()
    if len(seen) > CACHE_ENTRIES:
        seen.clear()
    # bytes.lower() touches A-Z only; bytes.split() breaks at [\x20\x09-\x0D]
    words = [(t or "").encode().lower().split() for t in texts]
    sizes = [len(w) for w in words]
    flat = np.fromiter(map(seen.__getitem__, itertools.chain.from_iterable(words)), dtype=np.uint64, count=sum(sizes))
    out, at = [], 0
    rolled = flat[: max(0, len(flat) - SHINGLE + 1)].copy()
    for k in range(1, SHINGLE):
        rolled *= _M
        rolled += flat[k : len(flat) - SHINGLE + 1 + k]
    rolled = _mix(rolled)
    for n in sizes:
        if n >= SHINGLE:
            out.append(np.unique(rolled[at : at + n - SHINGLE + 1]))
        elif n:
            h = np.uint64(n)
            for w in flat[at : at + n]:
                h = np.uint64((int(h) * int(_M) + int(w)) & 0xFFFFFFFFFFFFFFFF)
            out.append(_mix(np.array([h], dtype=np.uint64)))
        else:
            out.append(flat[:0])
        at += n
    return out


@functools.lru_cache(maxsize=1)
def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    a = rng.integers(0, 2**63, SIGNATURE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 2**63, SIGNATURE, dtype=np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SIGNATURE minimum hashes (32 bits) of each set; the sets are not empty."""
    a, b = _coefficients()
    out = np.empty((len(sets), SIGNATURE), dtype="<u4")
    # some sets at a time, so that their hashes stay in the processor's cache
    first = 0
    while first < len(sets):
        last, n = first, 0
        while last < len(sets) and (n < 30_000 or last == first):
            n += len(sets[last])
            last += 1
        some = sets[first:last]
        flat = np.concatenate(some)
        starts = np.cumsum([0] + [len(s) for s in some[:-1]])
        for k in range(SIGNATURE):
            out[first:last, k] = np.minimum.reduceat((flat * a[k] + b[k]) >> np.uint64(32), starts)
        first = last
    return out


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, set_hash (null: empty), signature and low
    (the lowest byte of each of its values) of each row."""

    def make():
        def work(rows: dict) -> dict:
            sets = shingle_sets(rows["text"])
            full = [s for s in sets if len(s)]
            signed = signatures(full) if full else np.empty((0, SIGNATURE), dtype="<u4")
            low, signed = iter(signed.astype(np.uint8)), iter(signed)
            return {
                "doc_id": rows["doc_id"],
                "text_key": rows["text_key"],
                "n_shingles": [len(s) for s in sets],
                "set_hash": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                "signature": [next(signed).tobytes() if len(s) else None for s in sets],
                "low": [next(low).tobytes() if len(s) else None for s in sets],
            }

        return work

    schema = "doc_id long, text_key long, n_shingles long, set_hash binary, signature binary, low binary"
    return map_rows(docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")), make, schema)


def _texts(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """``nodes`` with the text of each one's chosen row (doc_id and text_key)."""
    chosen = classes.select("node", F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    texts = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key"), "text")
    return texts.join(nodes.join(chosen, "node"), ["_id", "_key"]).drop("_id", "_key")


def _first_of_each(rows: dict, names: tuple[str, ...], seen: set) -> dict:
    """Repeats of a row that the task has seen go."""
    new = []
    for k, key in enumerate(zip(*(rows[n] for n in names), strict=True)):
        if key not in seen:
            seen.add(key)
            new.append(k)
    return rows if len(new) == len(rows["node"]) else {n: [v[k] for k in new] for n, v in rows.items()}


@functools.lru_cache(maxsize=1)
def _orders() -> list[np.ndarray]:
    """Each tree's order of signature values. The first four of the trees are
    disjoint; deeper places go over all other values, another way in each tree."""
    rng = np.random.default_rng(7)
    out = []
    for t in range(TREES):
        own = np.arange(DEPTHS[0] * t, DEPTHS[0] * (t + 1)) % SIGNATURE
        rest = rng.permutation(np.setdiff1d(np.arange(SIGNATURE), own))
        out.append(np.concatenate([own, rest])[: DEPTHS[-1]])
    return out


def _prefixes(classes: DataFrame) -> DataFrame:
    """A row for each class and tree: node and the hash of each prefix."""
    names = [f"p{d}" for d in DEPTHS]

    def make():
        def work(rows: dict) -> dict:
            values = np.frombuffer(b"".join(rows["signature"]), dtype="<u4").reshape(-1, SIGNATURE).astype(np.uint64)
            out: dict[str, list] = {"node": [], **{n: [] for n in names}}
            for t, order in enumerate(_orders()):
                h = np.full(len(values), t + 1, dtype=np.uint64)
                for d in range(DEPTHS[-1]):
                    h = _mix(h * _M + values[:, order[d]])
                    if d + 1 in DEPTHS:
                        out[f"p{d + 1}"].append(h.view(np.int64))
                out["node"].append(np.array(rows["node"], dtype=np.int64))
            return {k: np.concatenate(v) for k, v in out.items()}

        return work

    schema = "node long, " + ", ".join(f"{n} long" for n in names)
    # a row makes TREES rows: small chunks bound what a task builds at once
    return map_rows(classes.select("node", "signature"), make, schema, 2 << 20)


def regions(classes: DataFrame) -> list[DataFrame]:
    """For each depth a row for each class in a region of two and more: node,
    the region, its size _n and its smallest and largest class _lo and _hi.
    Only regions too large to list their pairs are cut at the next depth."""
    rows, out = _prefixes(classes), []
    for level, depth in enumerate(DEPTHS):
        key = f"p{depth}"
        sizes = rows.groupBy(key).agg(
            F.count(F.lit(1)).alias("_n"), F.min("node").alias("_lo"), F.max("node").alias("_hi")
        )
        # the join alone, then a checkpoint: adaptive execution can split a hot region
        rows = checkpointed(rows.join(sizes.where("_n > 1").hint("merge"), key))
        out.append(rows.select("node", F.col(key).alias("region"), "_n", "_lo", "_hi"))
        rows = rows.where(F.col("_n") > REGION).drop("_n", "_lo", "_hi")
        if level + 1 < len(DEPTHS):
            rows = rows.drop(key)
    return out


def stars(levels: list[DataFrame]) -> DataFrame:
    """Pairs (a < b) of each class with the smallest and the largest of all its
    neighbours, the ``hub``: two rows a class, with which most of a mass of
    copies hangs together before any other pair is listed."""
    rows = functools.reduce(DataFrame.unionByName, [x.select("node", "_lo", "_hi") for x in levels])
    ends = rows.groupBy("node").agg(F.min("_lo").alias("lo"), F.max("_hi").alias("hi"))
    low = ends.where("lo < node").select(F.col("lo").alias("a"), F.col("node").alias("b"), F.col("lo").alias("hub"))
    high = ends.where("node < hi").select(F.col("node").alias("a"), F.col("hi").alias("b"), F.col("hi").alias("hub"))
    return low.unionByName(high)


def apart(levels: list[DataFrame], known: DataFrame) -> DataFrame:
    """Pairs (a < b) of neighbours in different components of ``known``: all of
    a small region, those with the smallest and largest class of a larger one.
    ``hub`` is the smaller of their components."""
    rows = functools.reduce(DataFrame.unionByName, levels)
    rows = checkpointed(rows.join(known.withColumnRenamed("component", "c"), "node"))
    small = rows.where(F.col("_n") <= REGION).groupBy("region").agg(
        F.array_sort(F.collect_set(F.struct("node", "c"))).alias("nodes"), F.min("c").alias("least"), F.max("c").alias("most")
    )
    pairs = small.where("least < most").select(
        F.explode(
            F.expr(
                "flatten(transform(nodes, (x, i) -> transform(filter(slice(nodes, i + 2, size(nodes)), y -> y.c <> x.c),"
                " y -> named_struct('a', x.node, 'b', y.node, 'hub', least(x.c, y.c)))))"
            )
        ).alias("p")
    )
    large = rows.where(F.col("_n") > REGION)
    ends = large.select("node", "c", F.col("_lo").alias("end")).unionByName(large.select("node", "c", F.col("_hi").alias("end")))
    ends = ends.distinct().join(known.select(F.col("node").alias("end"), F.col("component").alias("ce")), "end").where("c <> ce")
    ends = ends.select(F.least("end", "node").alias("a"), F.greatest("end", "node").alias("b"), F.least("c", "ce").alias("hub"))
    return pairs.select("p.*").unionByName(ends).distinct()


def _joined(known: DataFrame, links: DataFrame) -> DataFrame:
    """``known`` (node, component) after ``links`` between components ca and cb."""
    step = components(links.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    step = step.select(F.col("node").alias("component"), F.col("component").alias("_to"))
    out = known.join(step, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    return checkpointed(out)


def _rest(large: DataFrame, known: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (components ca, cb) of the classes of large regions that are outside
    their region's largest component, but for those inside what a block's others
    join."""
    rows = large.join(known.withColumnRenamed("component", "c"), "node")
    sizes = rows.groupBy("region", "c").agg(F.count(F.lit(1)).alias("n"))
    # a row for each component of a region; of the largest, one
    regions = sizes.groupBy("region").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "c")).alias("top"), F.count(F.lit(1)).alias("parts")
    )
    # regions of several trees around one component are gone through together
    around = F.when(F.col("n") < 2 * F.col("top.n"), F.lit(0)).otherwise(F.col("region"))
    regions = regions.where("parts > 1").select(
        "region", F.col("top.c").alias("top"), F.xxhash64(around, "top.c").alias("around")
    )
    rows = rows.join(regions.hint("merge"), "region").select("around", "node", "c", (F.col("c") != F.col("top")).alias("out"))
    rows = rows.distinct().join(classes.select("node", "n_shingles", "low"), "node")
    rows = checkpointed(rows)

    def blocks(size: int, n: str, shingles: str) -> Column:
        return F.greatest(F.ceil(F.col(n) / size), F.ceil(F.col(shingles) / BLOCK_SHINGLES), F.lit(1))

    outside = F.when(F.col("out"), F.col("n_shingles"))
    totals = rows.groupBy("around").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("n_shingles").alias("s"),
        F.count(outside).alias("n_out"),
        F.coalesce(F.sum(outside), F.lit(0)).alias("s_out"),
    )
    totals = totals.select(
        "around", blocks(BLOCK, "n", "s").alias("blocks"), blocks(OUTSIDE, "n_out", "s_out").alias("out_blocks")
    )
    rows = rows.join(totals.hint("merge"), "around").drop("n_shingles")
    texts = _texts(docs, classes, rows)
    same = ("around", "node", "c", "out", "low", "blocks", "out_blocks")

    def make():
        seen: set = set()

        def work(rows: dict) -> dict:
            rows = _first_of_each(rows, ("around", "node"), seen)
            return {k: rows[k] for k in same} | {"hashes": [x.tobytes() for x in shingle_sets(rows["text"])]}

        return work

    schema = "around long, node long, c long, out boolean, low binary, blocks long, out_blocks long, hashes binary"
    sets = map_rows(texts.select(*same, "text"), make, schema)
    # every class meets all blocks of those outside, and each of those all blocks
    at = """concat(
        transform(sequence(0L, out_blocks - 1), i -> named_struct('i', i, 'j', pmod(xxhash64(node), blocks), 'left', false)),
        if(out, transform(sequence(0L, blocks - 1), j -> named_struct('i', pmod(xxhash64(node, 1), out_blocks), 'j', j, 'left', true)),
           array()))"""
    dealt = sets.select("around", "node", "c", "low", "hashes", F.inline(F.expr(at)))
    return dealt.groupBy("around", "i", "j").applyInArrow(_block_links, "ca long, cb long")


def _block_links(rows: pa.Table) -> pa.Table:
    """Links between the rows marked left and the others, confirmed on the full
    sets, as long as they join components that are not joined in this block."""
    left = rows["left"].to_numpy()
    low = np.frombuffer(b"".join(rows["low"].to_pylist()), dtype=np.uint8).reshape(-1, SIGNATURE)
    sets = [np.frombuffer(h, dtype=np.uint64) for h in rows["hashes"].to_pylist()]
    size = np.array([len(s) for s in sets], dtype=np.int64)
    ends = np.cumsum(size)
    vocabulary, ids = np.unique(np.concatenate(sets), return_inverse=True)
    comp, label = np.unique(rows["c"].to_numpy(), return_inverse=True)
    others = np.flatnonzero(~left)
    low_others, size_others = low[others], size[others]
    mark = np.zeros(len(vocabulary), dtype=bool)
    out: dict[str, list] = {"ca": [], "cb": []}
    for x in np.flatnonzero(left):
        n = size[x]
        at = (label[others] != label[x]) & (100 * np.minimum(n, size_others) >= PERCENT * np.maximum(n, size_others))
        at = np.flatnonzero(at)
        at = others[at[(low_others[at] == low[x]).mean(axis=1) >= SCREEN]]
        if not len(at):
            continue
        own = ids[ends[x] - n : ends[x]]
        mark[own] = True
        for y in at:
            if label[y] == label[x]:
                continue
            both = np.count_nonzero(mark[ids[ends[y] - size[y] : ends[y]]])
            if 100 * both >= PERCENT * (n + size[y] - both):
                out["ca"].append(int(rows["c"][int(x)].as_py()))
                out["cb"].append(int(rows["c"][int(y)].as_py()))
                label[label == label[y]] = label[x]
        mark[own] = False
    return pa.table({k: pa.array(v, type=pa.int64()) for k, v in out.items()})


def _screen(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose signatures and sizes allow a link, with their hub as component."""
    short = classes.select("node", "n_shingles", "low")
    left = short.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("low").alias("sa"))
    right = short.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("low").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    both = both.where(100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")).drop("na", "nb")

    def make():
        def work(rows: dict) -> dict:
            x, y = (np.frombuffer(b"".join(rows[c]), dtype=np.uint8).reshape(-1, SIGNATURE) for c in ("sa", "sb"))
            same = (x == y).mean(axis=1) >= SCREEN
            return {c: np.array(rows[n])[same] for c, n in (("a", "a"), ("b", "b"), ("component", "hub"))}

        return work

    return map_rows(both.select("a", "b", "hub", "sa", "sb"), make, "a long, b long, component long")


def _confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs that are links, but for those inside what others join.
    ``component`` gathers pairs with an end in common or in one component; ca,
    cb: components of a, b that are known."""
    # A large component is cut by the end that has fewer partners, so that the
    # many pairs of one node are spread, and a set goes to few blocks.
    node = pairs.select("component", F.explode(F.array("a", "b")).alias("node"))
    node = node.groupBy("component", "node").agg(F.count(F.lit(1)).alias("d"))
    sizes = node.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    left = node.join(sizes, "component").select("component", F.col("node").alias("a"), F.col("d").alias("da"), "n")
    right = node.select("component", F.col("node").alias("b"), F.col("d").alias("db"))
    end = F.when(F.col("da") < F.col("db"), F.col("a")).otherwise(F.col("b"))
    cut = F.pmod(F.xxhash64(end), F.ceil(F.col("n") / GROUP).cast("long"))
    blocks = pairs.join(left, ["component", "a"]).join(right, ["component", "b"]).select(
        "a", "b", "ca", "cb", "component", F.when(F.col("n") <= GROUP, F.lit(0)).otherwise(cut).cast("long").alias("block")
    )
    blocks = checkpointed(blocks)
    nodes = blocks.select("component", "block", F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = _texts(docs, classes, nodes)

    def make():
        seen: set = set()

        def work(rows: dict) -> dict:
            rows = _first_of_each(rows, ("component", "block", "node"), seen)
            sets = shingle_sets(rows["text"])
            out = {c: rows[c] for c in ("component", "block", "node")}
            return out | {"hashes": [s.tobytes() for s in sets]}

        return work

    sets = map_rows(texts, make, "component long, block long, node long, hashes binary")

    def links(left: pa.Table, right: pa.Table) -> pa.Table:
        have = {
            n: np.frombuffer(h, dtype=np.uint64)
            for n, h in zip(right["node"].to_pylist(), right["hashes"].to_pylist(), strict=True)
        }
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out: dict[str, list] = {"ca": [], "cb": []}
        for a, b, ca, cb in sorted(zip(*(left[c].to_pylist() for c in ("a", "b", "ca", "cb")), strict=True)):
            if find(ca) == find(cb):
                continue
            x, y = have[a], have[b]
            if 100 * min(len(x), len(y)) < PERCENT * max(len(x), len(y)):
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= PERCENT * (len(x) + len(y) - both):
                root[find(ca)] = find(cb)
                out["ca"].append(ca)
                out["cb"].append(cb)
        return pa.table({k: pa.array(v, type=pa.int64()) for k, v in out.items()})

    keys = ("component", "block")
    return blocks.groupBy(*keys).cogroup(sets.groupBy(*keys)).applyInArrow(links, "ca long, cb long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of ``docs``."""
    rows = checkpointed(sketch(docs))
    named = rows.where("doc_id is not null and set_hash is not null")
    # equal sets are one class, named by a number made from the set's hash, with
    # one chosen row; a hot class is reduced before the shuffle
    chosen = F.min(F.struct("doc_id", "text_key", "n_shingles", "signature", "low")).alias("x")
    classes = named.groupBy("set_hash").agg(chosen).select("set_hash", F.xxhash64("set_hash").alias("node"), "x.*")
    classes = checkpointed(classes)
    levels = regions(classes)
    large = levels[0].where(F.col("_n") > REGION).select("region", "node")
    known = checkpointed(classes.select("node", F.col("node").alias("component")))
    pairs = checkpointed(_screen(stars(levels), classes)).withColumns({"ca": F.col("a"), "cb": F.col("b")})
    known = _joined(known, checkpointed(_confirm(pairs, classes, docs)))
    pairs = checkpointed(_screen(apart(levels, known), classes))
    for end in ("a", "b"):
        pairs = pairs.join(known.select(F.col("node").alias(end), F.col("component").alias(f"c{end}")), end)
    known = _joined(known, checkpointed(_confirm(pairs, classes, docs)))
    release(docs.sparkSession)
    known = _joined(known, checkpointed(_rest(large, known, classes, docs)))
    links = checkpointed(_shared_ids(named))
    if not links.isEmpty():
        for end in ("a", "b"):
            links = links.join(known.select(F.col("node").alias(end), F.col("component").alias(f"c{end}")), end)
        known = _joined(known, links.select("ca", "cb"))
    # a component is named by its smallest doc_id
    both = classes.select("set_hash", "node", "doc_id").join(known, "node")
    names = both.groupBy("component").agg(F.min("doc_id").alias("name"))
    named_class = checkpointed(both.join(names, "component").select("set_hash", F.col("name").alias("component")))
    full = rows.where("set_hash is not null").select("doc_id", "n_shingles", "set_hash").join(named_class, "set_hash", "left")
    # an empty text belongs with the other texts of its doc_id
    empty = rows.where("set_hash is null").select("doc_id", "n_shingles")
    ids = empty.where("doc_id is not null").select("doc_id").distinct()
    others = named.select("doc_id", "set_hash").join(ids, "doc_id", "left_semi").join(named_class, "set_hash")
    empty = empty.join(others.groupBy("doc_id").agg(F.min("component").alias("component")), "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    out = full.select("doc_id", "n_shingles", "component").unionByName(empty.select("doc_id", "n_shingles", "component"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        (F.col("doc_id").isNotNull() & (component == F.col("doc_id"))).alias("kept"),
    )


def _shared_ids(named: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of the texts of one doc_id."""
    rows = named.select("doc_id", F.xxhash64("set_hash").alias("b"))
    ends = rows.groupBy("doc_id").agg(F.min("b").alias("a"), F.max("b").alias("_last")).where("a < _last")
    return rows.join(ends.drop("_last").hint("merge"), "doc_id").where("a < b").select("a", "b").distinct()


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group stays, in the columns of ``docs``: the one
    with the smallest doc_id; of rows with that doc_id, one. Rows without a
    doc_id are linked with nothing and stay."""
    kept = near_duplicates(docs.select("doc_id", "text")).where("kept")
    (mine,) = unused(docs.columns, "_kept")
    kept = kept.select(F.col("doc_id").alias(mine)).distinct()
    out = docs.join(kept, F.col("doc_id") == F.col(mine), "left_semi").dropDuplicates(["doc_id"])
    return out.unionByName(docs.where("doc_id is null"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


# Exact links by counting shared shingles, then reachability.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda s: s <> '') AS ws FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i+4], ' ') END AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
u AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT a AS node, a AS reach FROM u UNION SELECT r.node, u.b FROM r JOIN u ON r.reach = u.a),
c AS (SELECT node, min(reach) AS component FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component, w.doc_id) AS component_id,
       coalesce(component, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.node = w.doc_id
"""
