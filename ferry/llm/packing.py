"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of its documents' ids. In a round every queue's deficit
grows by its quantum, its share of a window of ``length`` tokens; the queue
then sends as many ids as its deficit has whole tokens and keeps the fraction.
A queue that has run dry is skipped. What the rounds send, one queue after the
other, is one stream, cut into sequences of ``length`` tokens: every window of
it has the target proportions, to a token for each queue, as long as the queues
last. By default the targets are the queues' shares of all tokens, so that they
run dry together.

* A queue's deficit after r rounds is the fraction of r x quantum, so the ids
  that it has sent by then are min(total, floor(r x quantum)): a document's
  place follows from its first id's place in its queue and the ledger, which
  has two numbers for each queue. Deficits are so carried across windows and
  partitions without a task that sees them in a row. Quanta are multiples of
  2**-16 tokens, at least one.
* A document's place in its queue is the sum of the queue's tokens before it in
  its partition (found while encoding) and in earlier partitions (one row for
  each partition and queue). Nothing is shuffled but those rows, so a source
  with a third of all documents costs no more than others.
* Sequences are full but for the end of the stream, whose tokens go into
  sequences of the powers of two that add up to them, which need no padding.

Defined cases: a null text is an empty one; every document gets the end id, so
an empty one is a piece of one id. A null source is a queue of its own; past
QUEUES sources they share queues by hash. Rows with a null or repeated doc_id
are documents of their own. The order inside a queue is that of the input's
partitions: other splits of the input give another, equally mixed, packing. An
empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ferry.llm.byte_words import byte_words
from ferry.llm.common import checkpointed, map_rows, table
from ferry.session import fresh_dir

VOCABULARY = "byte_bpe_50k.json"
END_ID = 1
LENGTH = 2_048
# Queues at most: bounds the ledger that every task has.
QUEUES = 4_096
# A token, in the unit of quanta.
UNIT = 1 << 16
# Rows (partition, queue) of carried sums up to which they are broadcast.
CARRY_ROWS = 1_000_000
# Cells (piece, queue) worked out at a time.
CELLS = 1 << 21
# Bytes of texts encoded at a time, about: their distinct words are encoded once.
BLOCK_BYTES = 16 << 20

_ENCODED_DDL = "part long, queue int, doc_id long, first long, n_tokens long, ids binary"
_ENCODED = pa.schema(
    [("part", pa.int64()), ("queue", pa.int32()), ("doc_id", pa.int64()), ("first", pa.int64()),
     ("n_tokens", pa.int64()), ("ids", pa.binary())]
)


class Ledger:
    """Totals and quanta of the queues."""

    def __init__(self, totals: list[int], weights: list[float], length: int = LENGTH) -> None:
        self.totals = np.array(totals, dtype=np.int64)
        self.length, self.tokens = length, int(self.totals.sum())
        share = np.array(weights, dtype=np.float64)
        share = share / share.sum() if share.sum() > 0 else np.ones(len(totals)) / max(1, len(totals))
        self.quanta = np.maximum(1, np.round(share * length * UNIT)).astype(np.int64)
        if self.tokens and float(self.totals.max() + 1) * UNIT + self.quanta.max() >= 2.0**63:
            raise ValueError("a queue of over 2**47 tokens: pack the corpus in several runs")
        # places of the stream where the sequences of its end start
        full = self.tokens - self.tokens % length
        sizes = [1 << b for b in range(length.bit_length(), -1, -1) if self.tokens % length >> b & 1]
        self.full, self.tail = full, full + np.cumsum([0, *sizes])[: max(1, len(sizes))]

    def sent(self, rounds: np.ndarray) -> np.ndarray:
        """Ids that each queue has sent after so many rounds (rounds x queues)."""
        return np.minimum(self.totals, (rounds[:, None] * self.quanta) // UNIT)

    def round_of(self, queue: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The rounds in which the queues send their ``at``-th ids."""
        return -(-((at + 1) * UNIT) // self.quanta[queue]) - 1

    def place(self, queue: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places in the stream of the queues' ids."""
        out, step = np.empty(len(at), dtype=np.int64), max(1, CELLS // max(1, len(self.totals)))
        for k in range(0, len(at), step):
            q, some = queue[k : k + step], at[k : k + step]
            rounds, row = self.round_of(q, some), np.arange(len(q))
            before = self.sent(rounds)
            upto = np.cumsum(self.sent(rounds + 1) - before, axis=1)
            earlier = np.where(q > 0, upto[row, q - 1], 0)
            out[k : k + step] = before.sum(axis=1) + earlier + some - before[row, q]
        return out

    def sequence(self, place: np.ndarray) -> np.ndarray:
        tail = self.full // self.length + np.searchsorted(self.tail, place, side="right") - 1
        return np.where(place < self.full, place // self.length, tail)

    def start(self, sequence: np.ndarray) -> np.ndarray:
        """Places of the sequences' first ids."""
        tail = np.clip(sequence - self.full // self.length, 0, len(self.tail) - 1)
        return np.where(sequence * self.length < self.full, sequence * self.length, self.tail[tail])

    def pieces(self, queue: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """doc, start, length, sequence and offset of the pieces of documents:
        document k's ``n[k]`` ids are its queue's from the ``first[k]``-th on."""
        # what a round sends of a document; of a quantum below a token, each token
        slow = self.quanta[queue] < UNIT
        low, high = self.round_of(queue, first), self.round_of(queue, first + n - 1)
        doc, k = _within(np.where(slow, n, high - low + 1))
        cut = (low[doc] + k) * self.quanta[queue[doc]] // UNIT
        at = np.where(slow[doc], first[doc] + k, np.maximum(first[doc], cut))
        last = np.append(doc[1:] != doc[:-1], True)
        size = np.where(last, (first + n)[doc], np.append(at[1:], 0)) - at
        place = self.place(queue[doc], at)
        # cut where a sequence ends
        low, high = self.sequence(place), self.sequence(place + size - 1)
        piece, k = _within(high - low + 1)
        sequence = low[piece] + k
        begin, end = self.start(sequence), place[piece] + size[piece]
        left = np.maximum(place[piece], begin)
        right = np.where(sequence == high[piece], end, self.start(sequence + 1))
        start = (at - first[doc])[piece] + left - place[piece]
        return doc[piece], start, right - left, sequence, left - begin


def _within(times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each index ``times`` over, and the count within it."""
    index = np.repeat(np.arange(len(times)), times)
    return index, np.arange(len(index)) - np.repeat(np.cumsum(times) - times, times)


def encode_queues(
    docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, source: str = "source"
) -> tuple[DataFrame, list]:
    """The documents' ids as a table in ``folder``, each with its queue and the
    queue's tokens before it in its part; and the queues' sources (none, where
    sources share queues)."""
    path = path or public_tokenizers.path(VOCABULARY)
    found = docs.select(F.col(source).cast("string").alias("s")).distinct().limit(QUEUES + 1).collect()
    names = sorted((r.s for r in found), key=lambda s: (s is not None, s or ""))
    shared = len(names) > QUEUES
    number = {} if shared else {s: k for k, s in enumerate(names)}
    key = F.col(source).cast("string")
    queue = F.pmod(F.xxhash64(key), F.lit(QUEUES)).cast("string") if shared else key

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sums = TaskContext.get().partitionId(), {}
        words = byte_words(path, special=True)
        end, kind = np.array([end_id], dtype="<u4").tobytes(), _kind(path)
        for rows in _blocks(batches):
            ids, sizes = words.column(rows.column("text"), end, kind)
            queues = [int(s) if shared else number[s] for s in rows.column("queue").to_pylist()]
            firsts = []
            for k, n in zip(queues, sizes.tolist(), strict=True):
                firsts.append(sums.get(k, 0))
                sums[k] = firsts[-1] + n
            parts, row = np.full(len(sizes), part), _binaries(ids, sizes)
            columns = [pa.array(parts), pa.array(queues, pa.int32()), rows.column("doc_id"), pa.array(firsts, pa.int64()), pa.array(sizes), row]
            yield pa.RecordBatch.from_arrays(columns, schema=_ENCODED)

    rows = docs.select("doc_id", queue.alias("queue"), "text").mapInArrow(run, _ENCODED_DDL)
    rows.write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(_ENCODED_DDL).parquet(folder), [] if shared else names


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of even numbers of rows, small ones put together."""
    held, size = [], 0
    for batch in batches:
        step = max(1, -(-batch.num_rows // max(1, -(-batch.nbytes // BLOCK_BYTES))))
        for at in range(0, batch.num_rows, step):
            held.append(batch.slice(at, step))
            size += held[-1].nbytes
            if size >= BLOCK_BYTES // 2:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _kind(path: str) -> str:
    """Two bytes hold the ids of a vocabulary of up to 65,536."""
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values()) < 1 << 16 else "<u4"


def _binaries(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The ids of each of the texts as bytes."""
    ends = np.append(0, np.cumsum(sizes)) * ids.itemsize
    if ends[-1] >= 1 << 31:  # offsets of 32 bits: only a text of over half a gigabyte
        return pa.array([ids[a:b].tobytes() for a, b in zip(ends[:-1] // ids.itemsize, ends[1:] // ids.itemsize, strict=True)], pa.binary())
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids)])


def pack(
    docs: DataFrame,
    folder: str,
    targets: Mapping[str | None, float] | None = None,
    length: int = LENGTH,
    path: str | None = None,
    end_id: int = END_ID,
    source: str = "source",
) -> DataFrame:
    """A row for each piece: doc_id, source queue, start, length, ids, doc_tokens,
    sequence_id and offset. ``targets``: weights of sources (others: 0, which is
    served at the least rate); none: the sources' shares of all tokens."""
    if length < 1:
        raise ValueError("length is at least 1")
    path = path or public_tokenizers.path(VOCABULARY)
    encoded, names = encode_queues(docs, folder, path, end_id, source)
    if targets is not None and not names and not encoded.isEmpty():
        raise ValueError(f"targets need at most {QUEUES} sources")
    sums = checkpointed(encoded.groupBy("part", "queue").agg(F.sum("n_tokens").alias("n")))
    total = {r.queue: r.n for r in sums.groupBy("queue").agg(F.sum("n").alias("n")).collect()}  # QUEUES rows at most
    totals = [total.get(k, 0) for k in range(max(total, default=-1) + 1)]
    weights = totals if targets is None else [float(targets.get(s, 0)) for s in names]
    ledger = Ledger(totals, weights, length)
    earlier = W.partitionBy("queue").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    carry = sums.select("part", "queue", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("carry"))
    small = sums.count() <= CARRY_ROWS
    rows = encoded.join(F.broadcast(carry) if small else carry, ["part", "queue"])
    return map_rows(
        rows, partial(_cutter, ledger, _kind(path)),
        "doc_id long, queue int, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )


def _cutter(ledger: Ledger, kind: str):
    width = np.dtype(kind).itemsize

    def work(rows: dict) -> dict:
        queue, first, n = (np.array(rows[c], dtype=np.int64) for c in ("queue", "first", "n_tokens"))
        first += np.array(rows["carry"], dtype=np.int64)
        doc, start, size, sequence, offset = ledger.pieces(queue, first, n)
        ids = []
        for k, a, b in zip(doc.tolist(), (start * width).tolist(), ((start + size) * width).tolist(), strict=True):
            ids.append(np.frombuffer(rows["ids"][k][a:b], dtype=kind).astype("<u4").tobytes())
        return {
            "doc_id": [rows["doc_id"][k] for k in doc.tolist()],
            "queue": queue[doc], "start": start, "length": size, "ids": ids, "doc_tokens": n[doc],
            "sequence_id": sequence, "offset": offset,
        }

    return work


def op13_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), fresh_dir(spark, "packing"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
