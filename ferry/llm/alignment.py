"""Alignment of two tokenizers' ids over the same bytes.

Both id lists of a text have cumulative byte ends. Two dictionaries (arrays
addressed by the end) map each list's ends to places; the ends in both key sets, in order, slice the lists
into groups that cover the same bytes. Every id of a slice's one list is linked
with every id of its other.

* ``alignments`` encodes texts chunk by chunk, to a row for each chunk: its
  documents, both id lists and the groups' sizes, compressed.
  ``read_alignments`` gives a row for each document back.
* ``write_links`` does so too and writes what the counts need: a row for each
  chunk and pair of ids linked in it, and a row for each chunk with its
  documents' digests and pairs, as places in the chunk's sorted pairs.
* ``link_counts`` counts, for each pair of ids, the documents that hold it
  linked. A chunk has been reduced to its distinct pairs by then, so a pair that
  is in every document is one row for each chunk.
* ``alignment_digests`` sends the counts back to the chunks that hold the
  pairs, again a row for each chunk and pair, never one for each document.

Defined cases: a null or empty text, or one whose joined token bytes differ
from a space and the text in either vocabulary, has no tokens. Each row counts
as a document, also those with a repeated or null doc_id. Special tokens'
strings are plain text. A text is never split; a chunk holds CHUNK_BYTES of
text or one longer text. An empty table gives an empty result. Extra columns
are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm.byte_words import byte_words, token_bytes
from ferry.llm.common import checkpointed, map_rows, table, worker_cache
from ferry.session import fresh_dir

BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"
# Text of a chunk. Larger chunks repeat fewer pairs; a task holds one.
CHUNK_BYTES = 4 << 20
# Texts given to a library at a time, in bytes.
BATCH_BYTES = 1 << 20
# Linked pairs worked out at a time; a group with more is counted by distinct ids.
LINKS = 1 << 21
_CHUNK_DDL = (
    "chunk long, doc_ids array<long>, n_a array<int>, n_b array<int>, n_groups array<int>,"
    " a_ids binary, b_ids binary, a_sizes binary, b_sizes binary"
)
_CHUNK = pa.schema(
    [("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64()))]
    + [(n, pa.list_(pa.int32())) for n in ("n_a", "n_b", "n_groups")]
    + [(n, pa.binary()) for n in ("a_ids", "b_ids", "a_sizes", "b_sizes")]
)


class Aligner:
    """Both encoders of a worker, and the byte lengths of their ids."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece

        self.a = byte_words(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.lossless = self.a.tokenizer.normalizer is None
        self.a_bytes = token_bytes(self.a.tokenizer)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_len, self.b_len = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.a_bytes, self.b_bytes))

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of both vocabularies, or two empty lists, of each text."""
        none = np.zeros(0, dtype=np.uint32)
        full = [t for t in texts if t]
        pieces = iter(self.b.encode(full, num_threads=1) if full else [])
        for t in texts:
            if not t:
                yield none, none
                continue
            want, b = f" {t}".encode(), next(pieces)
            a = np.frombuffer(self.a.encode(f" {t}"), dtype="<u4")
            # byte-level ids lose nothing: their bytes are the text's if they are as many
            same = self.a_len[a].sum() == len(want) if self.lossless else b"".join(map(self.a_bytes.__getitem__, a.tolist())) == want
            same = same and b"".join(map(self.b_bytes.__getitem__, b)) == want
            yield (a, np.array(b, dtype=np.uint32)) if same else (none, none)


def slices(a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups end in either list, from the tokens' lengths."""
    a_ends, b_ends = np.cumsum(a_len), np.cumsum(b_len)
    none = np.zeros(0, dtype=np.int64)
    if not len(a_ends) or not len(b_ends):
        return none, none
    # dictionaries from ends to places, addressed by the end itself
    a_at, b_at = (np.zeros(max(a_ends[-1], b_ends[-1]) + 1, dtype=np.int32) for _ in range(2))
    a_at[a_ends] = np.arange(1, len(a_ends) + 1)
    b_at[b_ends] = np.arange(1, len(b_ends) + 1)
    common = a_ends[b_at[a_ends] > 0]
    if len(common) > 1:  # tokens of no bytes share an end
        common = common[np.append(common[1:] != common[:-1], True)]
    return a_at[common].astype(np.int64), b_at[common].astype(np.int64)


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Numbers in as few bytes as the largest needs, compressed."""
    flat = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int64)
    top = int(flat.max()) if len(flat) else 0
    kind = next(k for k in ("u1", "<u2", "<u4") if top < 1 << (8 * np.dtype(k).itemsize))
    return bytes([np.dtype(kind).itemsize]) + zstandard.ZstdCompressor(level=1).compress(flat.astype(kind).tobytes())


def _unpack(blob: bytes) -> np.ndarray:
    kind = {1: "u1", 2: "<u2", 4: "<u4"}[blob[0]]
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), dtype=kind).astype(np.int64)


def _aligned(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[tuple[int, list[tuple]]]:
    """The task's chunks: number and (doc_id, ids of a, ids of b, ends of a, ends of b)."""
    number = TaskContext.get().partitionId() << 32
    tool = worker_cache(f"align {a_path} {b_path}", lambda: Aligner(a_path, b_path))
    held: list[tuple] = []
    size = 0
    for doc_ids, texts in _texts(batches):
        for doc, text, (a, b) in zip(doc_ids, texts, tool.encode(texts), strict=True):
            held.append((doc, a, b, *slices(tool.a_len[a], tool.b_len[b])))
            size += len(text or "") + 16
            if size >= CHUNK_BYTES:
                yield number, held
                held, size, number = [], 0, number + 1
    if held:
        yield number, held


def _paths(a_path: str | None, b_path: str | None) -> tuple[str, str]:
    return a_path or public_tokenizers.path(BYTE_VOCABULARY), b_path or public_tokenizers.path(PIECE_VOCABULARY)


def _sizes(ends: np.ndarray) -> np.ndarray:
    return np.diff(ends, prepend=0)


def alignments(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """The texts' alignments, a row for each chunk of documents."""
    paths = _paths(a_path, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, held in _aligned(batches, *paths):
            docs, a, b, ga, gb = zip(*held, strict=True)
            sizes = ([_sizes(x) for x in g] for g in (ga, gb))
            row = [number, list(docs), *([len(x) for x in col] for col in (a, b, ga)), *map(_pack, (a, b, *sizes))]
            yield pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, _CHUNK, strict=True)], schema=_CHUNK)

    return docs.select("doc_id", "text").mapInArrow(run, _CHUNK_DDL)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """doc_ids and texts, about BATCH_BYTES at a time."""
    for batch in batches:
        step = max(1, int(batch.num_rows * BATCH_BYTES / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            some = batch.slice(at, step)
            yield some.column("doc_id").to_pylist(), some.column("text").to_pylist()


def read_alignments(chunks: DataFrame) -> DataFrame:
    """doc_id, a_ids, b_ids, a_sizes and b_sizes (the groups' tokens) of each document."""

    def make():
        def work(rows: dict) -> dict:
            out: dict[str, list] = {n: [] for n in ("doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes")}
            for k, docs in enumerate(rows["doc_ids"]):
                out["doc_id"] += docs
                for name, count in (("a_ids", "n_a"), ("b_ids", "n_b"), ("a_sizes", "n_groups"), ("b_sizes", "n_groups")):
                    out[name] += np.split(_unpack(rows[name][k]), np.cumsum(rows[count][k])[:-1])
            return out

        return work

    return map_rows(chunks, make, "doc_id long, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>")


def _within(times: np.ndarray) -> np.ndarray:
    return np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)


def _links(doc: np.ndarray, a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray, shift: int):
    """(document and pair, links) of a chunk, distinct: doc is each group's
    document, ga and gb its tokens; a pair is a * 2**shift + b."""
    keys, times = [], []
    first_a, first_b = np.cumsum(ga) - ga, np.cumsum(gb) - gb
    count = ga * gb
    place = np.cumsum(count)
    at = 0
    while at < len(count):
        done = place[at] - count[at]
        end = max(at + 1, int(np.searchsorted(place, done + LINKS, side="right")))
        if end == at + 1 and count[at] > LINKS:  # one very large group: by distinct ids
            ua, na = np.unique(a[first_a[at] : first_a[at] + ga[at]], return_counts=True)
            ub, nb = np.unique(b[first_b[at] : first_b[at] + gb[at]], return_counts=True)
            pair = ((ua << shift)[:, None] + ub).ravel()
            keys.append((doc[at] << (2 * shift)) + pair)
            times.append(np.outer(na, nb).ravel())
        else:
            some = slice(at, end)
            group = np.repeat(np.arange(at, end), count[some])
            k = _within(count[some])
            pair = (a[first_a[group] + k // gb[group]] << shift) + b[first_b[group] + k % gb[group]]
            key, n = np.unique((doc[group] << (2 * shift)) + pair, return_counts=True)
            keys.append(key)
            times.append(n)
        at = end
    if not keys:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    if len(keys) == 1:
        return keys[0], times[0].astype(np.int64)
    key, slot = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(key), dtype=np.int64)
    np.add.at(total, slot, np.concatenate(times))
    return key, total


# An id of either vocabulary is below 2**SHIFT, a chunk has below 2**(63 - 2 * SHIFT) documents.
SHIFT = 20


_LINKS = pa.schema(
    [("chunk", pa.int64()), ("pair", pa.int64()), ("documents", pa.int64()), ("doc_ids", pa.list_(pa.int64()))]
    + [(n, pa.list_(pa.int64())) for n in ("n_a", "n_b", "n_groups", "n_links", "n_pairs")]
    + [("groups_sha256", pa.list_(pa.string())), ("slots", pa.binary()), ("times", pa.binary())]
)
_LINKS_DDL = (
    "chunk long, pair long, documents long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>,"
    " n_links array<long>, n_pairs array<long>, groups_sha256 array<string>, slots binary, times binary"
)


def write_links(docs: DataFrame, folder: str, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Write the chunks' pairs and documents to ``folder``: rows with a pair are
    (chunk, pair, documents in the chunk), a row without one has the chunk's
    documents. Returns the table."""
    paths = _paths(a_path, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, held in _aligned(batches, *paths):
            yield from _linked(number, held)

    rows = docs.select("doc_id", "text").mapInArrow(run, _LINKS_DDL)
    rows.write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(_LINKS_DDL).parquet(folder)


def _linked(number: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
    docs, a, b, ga, gb = zip(*held, strict=True)
    n = np.array([len(g) for g in ga], dtype=np.int64)
    key, times = _links(
        np.repeat(np.arange(len(held)), n), *(np.concatenate(x).astype(np.int64) for x in (a, b)),
        *(np.concatenate([_sizes(x) for x in g]) for g in (ga, gb)), SHIFT,
    )
    doc = key >> (2 * SHIFT)
    pair, slot, documents = np.unique(key & ((1 << (2 * SHIFT)) - 1), return_inverse=True, return_counts=True)
    first = np.append(True, doc[1:] != doc[:-1])[: len(doc)]
    step = np.where(first, slot, slot - np.append(0, slot[:-1])[: len(slot)])
    n_links = np.zeros(len(held), dtype=np.int64)
    np.add.at(n_links, doc, times)
    for at in range(0, len(pair), 100_000):
        some = pair[at : at + 100_000]
        empty = [pa.nulls(len(some), f.type) for f in list(_LINKS)[3:]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(some), number)), pa.array(some), pa.array(documents[at : at + 100_000]), *empty], schema=_LINKS
        )
    row = [
        number, None, None, list(docs), [len(x) for x in a], [len(x) for x in b], n, n_links,
        np.bincount(doc, minlength=len(held)), [_digest(*x) for x in zip(a, b, ga, gb, strict=True)], _pack([step]), _pack([times]),
    ]
    yield pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, _LINKS, strict=True)], schema=_LINKS)


@functools.lru_cache(maxsize=1)
def _decimals(n: int) -> list[str]:
    """Each id's decimal followed by ',', '|' or ';'."""
    return [f"{i}{mark}" for i in range(n) for mark in ",|;"]


def _digest(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> str:
    """Digest of ``a1,a2|b1;a3|b2,b3``; of no tokens, ''."""
    if not len(ends_a):
        return ""
    ga, gb = _sizes(ends_a), _sizes(ends_b)
    # a group's ids of a stand after earlier groups' ids of b, its ids of b after its own of a
    shifts = (np.repeat(np.cumsum(gb) - gb, ga), np.repeat(np.cumsum(ga), gb))
    codes = np.empty(len(a) + len(b), dtype=np.int64)
    for ids, ends, shift, mark in ((a, ends_a, shifts[0], 1), (b, ends_b, shifts[1], 2)):
        code = 3 * ids.astype(np.int64)
        code[ends - 1] += mark
        codes[np.arange(len(ids)) + shift] = code
    known = _decimals(1 << 16)
    top = int(codes.max())
    if top >= len(known):  # a vocabulary of more ids
        text = "".join(f"{c // 3}{',|;'[c % 3]}" for c in codes.tolist())
    else:
        text = "".join(map(known.__getitem__, codes.tolist()))
    return hashlib.sha256(text[:-1].encode()).hexdigest()


def link_counts(links: DataFrame) -> DataFrame:
    """a_id, pair, documents and is_best (no pair of its A id is in more)."""
    counts = checkpointed(links.where("pair is not null").groupBy("pair").agg(F.sum("documents").alias("documents")))
    a = F.shiftright("pair", SHIFT).alias("a_id")
    best = counts.groupBy(a).agg(F.max("documents").alias("_most"))
    return counts.select("*", a).join(best, "a_id").select("a_id", "pair", "documents", (F.col("documents") == F.col("_most")).alias("is_best"))


_DIGEST = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    + [("groups_sha256", pa.string())]
)
_DIGEST_DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _digests(left: pa.Table, right: pa.Table) -> pa.Table:
    """A chunk's documents with the counts of the pairs linked in them."""
    # one row for each of the chunk's pairs, so that their order gives the slots
    order = np.argsort(right["pair"].to_numpy())
    counts, best = (right[c].to_numpy()[order].astype(np.int64) for c in ("documents", "is_best"))
    out = []
    for row in left.to_pylist():
        n, step, times = np.array(row["n_pairs"], dtype=np.int64), _unpack(row["slots"]), _unpack(row["times"])
        doc, run = np.repeat(np.arange(len(n)), n), np.append(0, np.cumsum(step))
        slot = run[1:] - run[np.repeat(np.cumsum(n) - n, n)]
        sums = {}
        for name, value in (("n_best", times * best[slot]), ("count_sum", times * counts[slot])):
            sums[name] = np.zeros(len(n), dtype=np.int64)
            np.add.at(sums[name], doc, value)
        out.append(pa.table([sums[f.name] if f.name in sums else pa.array(row["doc_ids" if f.name == "doc_id" else f.name], type=f.type) for f in _DIGEST], schema=_DIGEST))
    return pa.concat_tables(out) if out else _DIGEST.empty_table()


def alignment_digests(links: DataFrame) -> DataFrame:
    """A row for each document of ``write_links``'s table, with its links' counts."""
    pairs = links.where("pair is not null").select("chunk", "pair")
    known = pairs.join(link_counts(links).drop("a_id"), "pair")
    chunks = links.where("pair is null").drop("pair", "documents")
    chunks = chunks.toDF(*chunks.columns)  # columns of its own beside those of known
    return chunks.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(_digests, _DIGEST_DDL)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_digests(write_links(table(spark, sf_dir, "documents"), fresh_dir(spark, "alignment")))
