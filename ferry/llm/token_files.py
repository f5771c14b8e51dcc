"""Token-id files with bit-plane shuffling.

Documents are encoded in ascending doc_id order and their ids written as
chunks of whole documents. A chunk holds fixed-size blocks of ids; the bytes
(or the bits) of a block are transposed into planes, so that the high, almost
constant parts of the ids lie together, and each plane is compressed with
zstandard. The chunks are rows of a parquet table (Spark's writer gives the
commit protocol and works on any store); beside them lie the number and order
of their documents and the chunk index: for each chunk its first and last
document and where its ids start.

Defined cases: a null text encodes as an empty one; every document gets the
end id. Null doc ids come first; equal ones are ordered by the head of
their text, then by its hash, equal texts by their place in the input. An empty table writes an empty
folder and gives an empty result. Extra columns are not written. Rows go to
parts by ranges of (doc_id, hash, place), so no source, copy group or doc_id
meets in one task; a task holds one chunk, or one document if larger.
"""

from __future__ import annotations

import itertools
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm.common import before, chunks, map_rows, table, worker_cache
from ferry.session import fresh_dir

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
# Ids in a block whose planes are transposed and compressed together.
BLOCK_IDS = 65_536
# Ids after which a chunk is closed at the end of its document.
CHUNK_IDS = 4 * BLOCK_IDS
# Words a worker remembers in each of two generations: bounds its memory.
CACHE_ENTRIES = 400_000
# Characters of a text that order rows of one doc_id: bounds what the driver samples.
HEAD = 256
# Characters that never join a letter before them in one pre-token.
TAIL = ".,;:!?&$%*#|"

MAGIC = b"PLN1"
_HEAD = struct.Struct("<4sBIII")  # magic, bits of a plane row (1 or 8), ids, block size, blocks


def pack(ids: np.ndarray, plane_bits: int = 8, block: int = BLOCK_IDS, level: int = 3) -> bytes:
    """Ids (unsigned 32-bit) as blocks of compressed byte (8) or bit (1) planes.

    Layout: a head, then for each block its planes' compressed lengths
    (unsigned 32-bit), then the planes, least significant first.
    """
    if plane_bits not in (1, 8):
        raise ValueError("plane_bits is 1 or 8")
    press = zstandard.ZstdCompressor(level=level).compress
    ids = np.ascontiguousarray(ids, dtype="<u4")
    blocks = -(-len(ids) // block)
    out = [_HEAD.pack(MAGIC, plane_bits, len(ids), block, blocks)]
    for at in range(0, len(ids), block):
        rows = ids[at : at + block].view(np.uint8).reshape(-1, 4)
        if plane_bits == 1:
            rows = np.unpackbits(rows, axis=1, bitorder="little")
            planes = [press(np.packbits(rows[:, k], bitorder="little").tobytes()) for k in range(32)]
        else:
            planes = [press(np.ascontiguousarray(rows[:, k]).tobytes()) for k in range(4)]
        out.append(struct.pack(f"<{len(planes)}I", *map(len, planes)))
        out += planes
    return b"".join(out)


def unpack(blob: bytes) -> np.ndarray:
    """The ids that ``pack`` was given."""
    magic, plane_bits, n, block, blocks = _HEAD.unpack_from(blob)
    if magic != MAGIC or plane_bits not in (1, 8):
        raise ValueError("not a chunk of token ids")
    expand, at, found = zstandard.ZstdDecompressor().decompress, _HEAD.size, []
    n_planes = 32 // plane_bits
    for k in range(blocks):
        size = min(block, n - k * block)
        lengths = struct.unpack_from(f"<{n_planes}I", blob, at)
        at += 4 * n_planes
        planes = []
        for length in lengths:
            planes.append(np.frombuffer(expand(blob[at : at + length]), dtype=np.uint8))
            at += length
        if plane_bits == 1:
            bits = np.stack([np.unpackbits(p, count=size, bitorder="little") for p in planes], axis=1)
            rows = np.packbits(bits, axis=1, bitorder="little")
        else:
            rows = np.stack(planes, axis=1)
        found.append(np.ascontiguousarray(rows).view("<u4").reshape(-1))
    return np.concatenate(found) if found else np.zeros(0, dtype="<u4")


class WordEncoder:
    """Encodes whole texts with the tokenizers library.

    The vocabulary's normaliser and pre-tokeniser treat white space as a
    break and never look across it, so the ids of a text are those of its
    white-space-separated words in a row, and letters are cut from marks after
    them; such parts are encoded once and remembered. ``check_separable``
    refuses a vocabulary without that.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        suffix = self.tokenizer.model.end_of_word_suffix or ""
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self.check_separable()

    def check_separable(self) -> None:
        for a, b in (("it's", "HE 12a!"), ("!x", "?'s"), ("é", "\u0301e")):
            parts = self._library([a, b])
            if self._library([f"{a} {b}", f"{a}\n\t{b}"]) != [parts[0] + parts[1]] * 2:
                raise ValueError("this vocabulary does not treat white space as a plain break")
        for a in ("Word", "\u00c9t\u00e9"):
            parts = self._library([a, TAIL, a.lower()])
            if self._library([a + TAIL]) != [parts[0] + parts[1]] or parts[2] != parts[0]:
                raise ValueError("this vocabulary does not cut letters from marks, or heeds case")

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _letters(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of letters, encoded as one text: each is one pre-token,
        whose last id, and no other, has the vocabulary's end-of-word suffix."""
        text = b" ".join(words).decode()
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words):
            return self._library([w.decode() for w in words])
        raw, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [raw[a:b] for a, b in itertools.pairwise(cuts)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        rows = []
        for t in texts:
            raw = (t or "").encode()
            # the vocabulary lower-cases; its special tokens are the exception
            rows.append((raw if b"<|" in raw else raw.lower()).split())
        if len(self.words) > CACHE_ENTRIES:
            self.words, self.older = {}, self.words
        self._learn(set().union(*rows))
        take = self.words.__getitem__
        return [b"".join(map(take, row)) for row in rows]

    def _learn(self, needed: set[bytes]) -> None:
        """Put the ids of these words into the younger generation."""
        words, new, parts = self.words, [], []
        for w in needed.difference(words):
            ids = self.older.get(w)
            if ids is not None:
                words[w] = ids
                continue
            text = w.decode()
            core = text.rstrip(TAIL)
            if len(core) < len(text) and core.lower().isalpha():  # letters, then marks: two pre-tokens at least
                parts.append((w, core.encode(), text[len(core) :].encode()))
            else:
                new.append(w)
        known = set(new)
        for _, *both in parts:
            for x in both:
                if x not in words and x not in known:
                    ids = self.older.get(x)
                    if ids is not None:
                        words[x] = ids
                    else:
                        known.add(x)
                        new.append(x)
        plain, other = [], []
        for w in new:
            (plain if w.isalpha() or w.decode().lower().isalpha() else other).append(w)
        for at in range(0, len(plain), 500):
            some = plain[at : at + 500]
            words.update(zip(some, self._letters(some), strict=True))
        for at in range(0, len(other), 20_000):
            some = other[at : at + 20_000]
            words.update(zip(some, self._library([w.decode() for w in some]), strict=True))
        for w, core, tail in parts:
            words[w] = words[core] + words[tail]


def word_encoder(path: str) -> WordEncoder:
    """One encoder for each worker process, so that its tasks share the cache."""
    return worker_cache(f"words {path}", lambda: WordEncoder(path))


_CHUNK = pa.schema(
    [
        ("part", pa.int64()), ("first_id", pa.int64()), ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64())), ("planes", pa.binary()),
    ]
)
_CHUNK_DDL = "part long, first_id long, n_ids long, doc_ids array<long>, doc_sizes array<long>, planes binary"

_INDEX_DDL = "part long, first_id long, first_doc long, last_doc long, start long, n_ids long, n_docs long"


def write_token_files(
    docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, plane_bits: int = 8
) -> None:
    """Write ``folder``/chunks and ``folder``/index for the texts of ``docs``."""
    spark = docs.sparkSession
    path = path or public_tokenizers.path(VOCABULARY)
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first = TaskContext.get().partitionId(), 0
        held: list[tuple[int | None, bytes]] = []
        n = 0

        def chunk() -> pa.RecordBatch:
            sizes = [len(x) // 4 for _, x in held]
            blob = pack(np.frombuffer(b"".join(x for _, x in held), dtype="<u4"), plane_bits)
            columns = [[part], [first], [n], [[d for d, _ in held]], [sizes], [blob]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, _CHUNK, strict=True)], schema=_CHUNK
            )

        encode = word_encoder(path).encode
        for rows in chunks(batches):
            texts = encode(rows.column("text").to_pylist())
            for doc, ids in zip(rows.column("doc_id").to_pylist(), texts, strict=True):
                held.append((doc, ids + end))
                n += len(ids) // 4 + 1
                if n >= CHUNK_IDS:
                    yield chunk()
                    first += n
                    held, n = [], 0
        if held:
            yield chunk()

    # a doc_id with many rows, also equal ones, is split like any others
    order = ("doc_id", "_head", "_text", "_row")
    rows = docs.select(
        "doc_id", "text", F.substring("text", 1, HEAD).alias("_head"), F.xxhash64("text").alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    # the planes are compressed already
    rows.mapInArrow(run, _CHUNK_DDL).write.option("compression", "none").parquet(f"{folder}/chunks")
    written = read_chunks(spark, folder).select("part", "first_id", "n_ids", "doc_ids")
    # one row for each part that was written: at most the number of shuffle partitions
    starts = F.broadcast(before(written, "part", F.col("n_ids")))
    written.join(starts, "part").select(
        "part", "first_id", F.col("doc_ids")[0].alias("first_doc"), F.element_at("doc_ids", -1).alias("last_doc"),
        (F.col("_before") + F.col("first_id")).alias("start"), "n_ids", F.size("doc_ids").cast("long").alias("n_docs"),
    ).write.parquet(f"{folder}/index")


def read_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_CHUNK_DDL).parquet(f"{folder}/chunks")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each chunk: its part and place in it, its first and last doc_id,
    the ids of all documents before it, its ids and documents."""
    return spark.read.schema(_INDEX_DDL).parquet(f"{folder}/index")


def read_document(spark: SparkSession, folder: str, doc_id: int) -> DataFrame:
    """start, n_tokens and ids of the document (of each, of a repeated doc_id):
    the index names the chunks that can hold it, and only those are unpacked."""
    # a chunk that starts without a doc_id starts before all others
    found = read_index(spark, folder).where(f"(first_doc is null or first_doc <= {int(doc_id)}) and last_doc >= {int(doc_id)}")
    found = read_chunks(spark, folder).join(found.select("part", "first_id", "start"), ["part", "first_id"])

    def make():
        def work(rows: dict) -> dict:
            out: dict[str, list] = {"start": [], "n_tokens": [], "ids": []}
            for base, docs, sizes, planes in zip(rows["start"], rows["doc_ids"], rows["doc_sizes"], rows["planes"], strict=True):
                ids, at = unpack(planes), 0
                for doc, size in zip(docs, sizes, strict=True):
                    if doc == doc_id:
                        out["start"].append(base + at)
                        out["n_tokens"].append(size)
                        out["ids"].append(ids[at : at + size].tobytes())
                    at += size
            return out

        return work

    return map_rows(found, make, "start long, n_tokens long, ids binary")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each document in the files: doc_id, start, n_tokens, ids_crc32."""
    # one row for each part that was written: at most the number of shuffle partitions
    index = read_index(spark, folder).groupBy("part").agg(F.min(F.col("start") - F.col("first_id")).alias("start"))
    found = read_chunks(spark, folder).join(F.broadcast(index), "part")

    def make():
        def work(rows: dict) -> dict:
            out: dict[str, list] = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
            for base, first, docs, sizes, planes in zip(
                rows["start"], rows["first_id"], rows["doc_ids"], rows["doc_sizes"], rows["planes"], strict=True
            ):
                ids, at = unpack(planes), 0
                for doc, size in zip(docs, sizes, strict=True):
                    out["doc_id"].append(doc)
                    out["start"].append(base + first + at)
                    out["n_tokens"].append(size)
                    out["ids_crc32"].append(zlib.crc32(ids[at : at + size].tobytes()))
                    at += size
            return out

        return work

    return map_rows(found, make, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_dir(spark, "token_files")
    write_token_files(table(spark, sf_dir, "documents"), folder)
    return read_token_files(spark, folder)
