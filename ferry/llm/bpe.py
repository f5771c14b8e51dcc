"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Ranks are read from a public vocabulary file; nothing is trained. A text is
cut by a pattern; each match (pre-token) is merged on its own, lowest rank
first, leftmost first. All unseen pre-tokens of a chunk of rows share one
linked list of nodes and one queue: a bucket for each merge rank holds list
positions, a bitmap of bitmaps finds the lowest rank with a bucket by
find-first-set, and an entry whose pair has changed meanwhile is stale and
skipped. Merging is linear in the bytes but for the sort in a bucket, so one
pre-token of a million bytes costs as much as many short ones.

Defined cases: a null text encodes as an empty one (no ids). Doc ids may be
null or repeat; rows are encoded one by one. Extra columns pass through
``encode_documents`` (its own ``ids``, ``n_tokens`` win over clashing ones).
An empty table gives an empty result. There is no shuffle; a task holds one
chunk of rows and a bounded cache of pre-tokens.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
from collections.abc import Iterable

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession

from ferry.llm.common import map_rows, quoted, table, worker_cache

VOCABULARY = "byte_bpe_50k.tiktoken"
# Pre-tokens a worker remembers before it starts anew: bounds its memory.
CACHE_ENTRIES = 150_000
# Bytes of text worked on together: more pre-tokens share each bucket.
TEXT_BYTES = 8 << 20
# Above this many entries of a bucket a piece, the bucket is merged one by one.
ENTRIES_A_PIECE = 4


class RankQueue:
    """Set of ranks with find-first-set over three levels of 64-bit words."""

    def __init__(self, size: int) -> None:
        self.low = [0] * (size // 64 + 1)
        self.mid = [0] * (len(self.low) // 64 + 1)
        self.top = 0

    def add(self, rank: int) -> None:
        a, b = rank >> 6, rank >> 12
        self.low[a] |= 1 << (rank & 63)
        self.mid[b] |= 1 << (a & 63)
        self.top |= 1 << b

    def remove(self, rank: int) -> None:
        a, b = rank >> 6, rank >> 12
        self.low[a] &= ~(1 << (rank & 63))
        if not self.low[a]:
            self.mid[b] &= ~(1 << (a & 63))
            if not self.mid[b]:
                self.top &= ~(1 << b)

    def first(self) -> int:
        """Lowest rank, or -1."""
        if not self.top:
            return -1
        b = (self.top & -self.top).bit_length() - 1
        m = self.mid[b]
        a = (b << 6) + (m & -m).bit_length() - 1
        w = self.low[a]
        return (a << 6) + (w & -w).bit_length() - 1


class Vocabulary:
    """Token bytes by rank, and the rank that each pair of tokens merges to."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.bytes: list[bytes] = [b""] * self.size
        for token, rank in ranks.items():
            self.bytes[rank] = token
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"not a byte-level vocabulary: no rank for bytes {missing[:5]}")
        self.byte_rank = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = rank
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)
        self.keys = np.append(self.keys, np.iinfo(np.int64).max)
        self.merged = np.append(self.merged, -1)
        # Tokens whose new neighbours may merge at a lower rank than their own: of
        # their bucket, one position of each piece is merged before looking again.
        left, right = self.keys[:-1] // self.size, self.keys[:-1] % self.size
        self.early = np.zeros(self.size, dtype=bool)
        self.early[left[self.merged[:-1] < left]] = True
        self.early[right[self.merged[:-1] < right]] = True

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank that tokens a, b merge to; -1 for none."""
        want = a * self.size + b
        at = np.searchsorted(self.keys, want)
        return np.where(self.keys[at] == want, self.merged[at], -1)

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece, all pieces through one queue."""
        raw = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        n = len(raw)
        ends = np.cumsum([len(p) for p in pieces])
        ids = self.byte_rank[raw]
        following = np.arange(1, n + 1)
        preceding = np.arange(-1, n - 1)
        following[ends[ends > 0] - 1] = -1
        preceding[ends[ends < n]] = -1
        preceding[:1] = -1
        alive = np.ones(n, dtype=bool)
        piece = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        pair = np.full(n, -1, dtype=np.int64)  # rank that node and its follower merge to
        at = np.flatnonzero(following >= 0)
        pair[at] = self.pair_ranks(ids[at], ids[at + 1])
        queue = RankQueue(self.size)
        buckets: dict[int, list[int]] = {}

        def push(positions: np.ndarray) -> None:
            ranks = pair[positions]
            for rank, p in zip(ranks.tolist(), positions.tolist(), strict=True):
                if rank >= 0:
                    bucket = buckets.get(rank)
                    if bucket is None:
                        buckets[rank] = [p]
                        queue.add(rank)
                    else:
                        bucket.append(p)

        push(at)
        while (rank := queue.first()) >= 0:
            queue.remove(rank)
            entries = np.array(buckets.pop(rank))
            entries = entries[pair[entries] == rank]  # the others are stale
            if len(entries) > 1:
                entries = np.unique(entries)
            if not len(entries):
                continue
            right = following[entries]
            if self.early[rank] or (right[:-1] == entries[1:]).any():
                # Order matters inside a piece: merge its leftmost entry, keep the rest.
                of = piece[entries]
                leftmost = np.append(True, of[1:] != of[:-1])
                if len(entries) > ENTRIES_A_PIECE * leftmost.sum():
                    self._one_by_one(rank, entries, ids, following, preceding, alive, pair, queue, buckets)
                    continue
                if not leftmost.all():
                    buckets[rank] = entries[~leftmost].tolist()
                    queue.add(rank)
                    entries, right = entries[leftmost], right[leftmost]
            after = following[right]
            ids[entries] = rank
            following[entries] = after
            alive[right] = False
            pair[right] = -1
            has = after >= 0
            preceding[after[has]] = entries[has]
            pair[entries] = -1
            left, after = entries[has], after[has]
            pair[left] = self.pair_ranks(ids[left], ids[after])
            before = preceding[entries]
            before = before[before >= 0]
            pair[before] = self.pair_ranks(ids[before], ids[following[before]])
            push(np.concatenate([left, before]))
        ids, kept = ids[alive], np.cumsum(alive)
        return np.split(ids, kept[ends[:-1] - 1]) if n else [ids[:0]] * len(pieces)

    def _one_by_one(self, rank, entries, ids, following, preceding, alive, pair, queue, buckets) -> None:
        """Merge a bucket from the left, and stop as soon as a lower rank shows up."""
        heap = entries.tolist()
        while heap:
            p = heapq.heappop(heap)
            if pair[p] != rank:
                continue
            q = int(following[p])
            r, b = int(following[q]), int(preceding[p])
            ids[p], following[p], alive[q], pair[q], pair[p] = rank, r, False, -1, -1
            if r >= 0:
                preceding[r] = p
            for x, y in ((p, r), (b, p)):
                if x >= 0 and y >= 0:
                    new = int(self.pair_ranks(ids[x : x + 1], ids[y : y + 1])[0])
                    pair[x] = new
                    if new == rank:
                        heapq.heappush(heap, x)
                    elif new >= 0:
                        bucket = buckets.setdefault(new, [])
                        bucket.append(x)
                        queue.add(new)
            if heap and 0 <= queue.first() < rank:
                buckets[rank] = heap
                queue.add(rank)
                return


def load_vocabulary(path: str) -> Vocabulary:
    """Ranks of a file with one base64 token and its rank on each line."""
    with open(path, "rb") as file:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, file)})


class _Index(dict):
    """Number of each pre-token; new ones are numbered as they are met."""

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        return n


class Encoder:
    """Encodes texts chunk by chunk, remembering the ids of pre-tokens."""

    def __init__(self, path: str, pattern: str) -> None:
        self.vocabulary = load_vocabulary(path)
        self.cut = regex.compile(pattern).findall
        self.index, self.ids = _Index(), []

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.index) > CACHE_ENTRIES:
            self.index, self.ids = _Index(), []
        number = self.index.__getitem__
        rows = [np.fromiter(map(number, self.cut(t or "")), dtype=np.int32) for t in texts]
        self._fill()
        take = self.ids.__getitem__
        return [b"".join(map(take, row.tolist())) for row in rows]

    def _fill(self) -> None:
        known = len(self.ids)
        new = [p.encode() for p in itertools.islice(self.index, known, None)]
        ranks = [self.vocabulary.ranks.get(p) for p in new]
        rest = [p for p, r in zip(new, ranks, strict=True) if r is None]
        merged = iter(self.vocabulary.merge(rest)) if rest else iter(())
        for rank in ranks:
            self.ids.append(
                rank.to_bytes(4, "little") if rank is not None else next(merged).astype("<u4").tobytes()
            )

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.bytes.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder for each worker process, so that its tasks share the cache."""
    return worker_cache(f"bpe {path} {pattern}", lambda: Encoder(path, pattern))


def _paths(path: str | None, pattern: str | None) -> tuple[str, str]:
    return path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN


def encode_digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the bytes decoded from them."""
    path, pattern = _paths(path, pattern)

    def make():
        e = encoder(path, pattern)

        def work(rows: dict) -> dict:
            ids = e.encode(rows["text"])
            return {
                "doc_id": rows["doc_id"],
                "n_tokens": [len(x) // 4 for x in ids],
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(e.decode(x)).hexdigest() for x in ids],
            }

        return work

    return map_rows(
        docs.select("doc_id", "text"), make,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
        TEXT_BYTES,
    )


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``docs`` without its text, with ``ids`` (array of int) and ``n_tokens``."""
    path, pattern = _paths(path, pattern)
    rest = [c for c in docs.columns if c.lower() not in ("text", "ids", "n_tokens")]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([f"{quoted(c)} {kinds[c]}" for c in rest] + ["n_tokens long", "ids array<int>"])

    def make():
        e = encoder(path, pattern)

        def work(rows: dict) -> dict:
            ids = e.encode(rows["text"])
            out = {c: rows[c] for c in rest}
            return out | {
                "n_tokens": [len(x) // 4 for x in ids],
                "ids": [np.frombuffer(x, dtype="<u4").astype(np.int32) for x in ids],
            }

        return work

    return map_rows(docs.select(*map(quoted, rest), "text"), make, schema, TEXT_BYTES)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ``bytes``, the text's UTF-8, of rows with doc_id and ``ids``."""
    path, pattern = _paths(path, None)

    def make():
        e = encoder(path, pattern)

        def work(rows: dict) -> dict:
            raw = [np.array(x or [], dtype="<u4").tobytes() for x in rows["ids"]]
            return {"doc_id": rows["doc_id"], "bytes": [e.decode(x) for x in raw]}

        return work

    return map_rows(encoded.select("doc_id", "ids"), make, "doc_id long, bytes binary")


def op1_bpe_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"))
