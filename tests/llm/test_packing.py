"""op13: every id in one piece, windows of the target proportions, no padding."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ferry.llm import packing as P

DOCS = "doc_id long, text string, source string, queue string, first long, part string"


def make(spark, rows, partitions=4):
    return spark.createDataFrame([(d, t, s, "q", 7, "p") for d, t, s in rows], DOCS).repartition(partitions)


TOOL = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return TOOL.encode(text or "", add_special_tokens=False).ids + [1]


def stream(ledger):
    """The rounds one after the other, by their definition."""
    deficit, sent, out = [0] * len(ledger.totals), [0] * len(ledger.totals), []
    while len(out) < ledger.tokens:
        for k, quantum in enumerate(ledger.quanta.tolist()):
            deficit[k] += quantum
            n = min(deficit[k] // P.UNIT, int(ledger.totals[k]) - sent[k])
            deficit[k] -= (deficit[k] // P.UNIT) * P.UNIT
            out += [(k, sent[k] + i) for i in range(n)]
            sent[k] += n
    return out


@pytest.mark.parametrize("seed", range(6))
def test_ledger_is_the_round_robin(seed):
    rng = random.Random(seed)
    totals = [rng.choice([0, 1, 3, 40, 900, 2500]) for _ in range(rng.randrange(1, 7))]
    weights = [rng.choice([0.02, 1, 5]) for _ in totals] if seed % 2 else totals
    ledger = P.Ledger(totals, weights, 64)
    want = {x: place for place, x in enumerate(stream(ledger))}
    for queue, total in enumerate(totals):
        at = 0
        while at < total:
            n = rng.randrange(1, min(400, total - at) + 1)
            got = ledger.pieces(np.array([queue]), np.array([at]), np.array([n]))
            place = [ledger.start(np.array([s]))[0] + o + i for _, _, z, s, o in zip(*map(np.ndarray.tolist, got)) for i in range(z)]
            assert place == [want[queue, at + i] for i in range(n)]
            at += n


@pytest.mark.parametrize("few", [P.QUEUES, 3])
def test_pieces(spark, scratch, monkeypatch, few):
    monkeypatch.setattr(P, "QUEUES", few)
    random.seed(few)
    words = ["token", "naïve", "line\n", "x", "12", "Übung", "<|endoftext|>", "  "]
    rows = [(k, " ".join(random.choices(words, k=random.randrange(90))), random.choice(["a", "a", "a", "b", None, "c", "d"])) for k in range(300)]
    rows += [(300, None, "a"), (301, "", None), (None, "no id", "b"), (400, "again", "b"), (400, "again", "b"), (302, "word " * 5_000, "c")]
    length = 256
    got = P.pack(make(spark, rows), f"{scratch}/packing", length=length).collect()
    by_doc, by_sequence, source = defaultdict(list), defaultdict(list), {d: s for d, _, s in rows}
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    want = defaultdict(list)
    for d, t, _ in rows:
        want[d].append(ids_of(t))
    for d, texts in want.items():
        if len(texts) > 1:
            assert sum(r.length for r in by_doc[d]) == sum(map(len, texts))
            continue
        ids, at = [], 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(texts[0]) and 0 < r.length == len(r.ids) // 4
            at += r.length
            ids += np.frombuffer(r.ids, dtype="<u4").tolist()
        assert ids == texts[0]
    sizes, share = [], defaultdict(int)
    total = sum(len(t) for x in want.values() for t in x)
    for d, texts in want.items():
        share[source[d]] += sum(map(len, texts))
    for k in range(len(by_sequence)):
        at = 0
        for r in sorted(by_sequence[k], key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        sizes.append(at)
        if at == length and few == P.QUEUES and few > 4:
            for s, tokens in share.items():
                inside = sum(r.length for r in by_sequence[k] if source[r.doc_id] == s)
                assert abs(inside - length * tokens / total) < 5
    assert sum(sizes) == total
    assert all(s == length for s in sizes[: total // length])
    assert all(s & (s - 1) == 0 for s in sizes) and len(sizes) <= total // length + 9


def test_targets(spark, scratch):
    rows = [(k, "word " * 50, "ab"[k % 2]) for k in range(200)]
    got = P.pack(make(spark, rows), f"{scratch}/packing", {"a": 3, "b": 1}, length=128).collect()
    inside = defaultdict(lambda: [0, 0])
    for r in got:
        inside[r.sequence_id][r.queue] += r.length
    half = sorted(inside)[: len(inside) // 2]
    assert all(abs(inside[k][0] - 96) <= 2 for k in half)  # three quarters, until source a runs dry
    assert sum(r.length for r in got) == 200 * len(ids_of("word " * 50))


def test_empty_table_and_bad_length(spark, scratch):
    assert P.pack(make(spark, [(1, "x", "a")]).where("false"), f"{scratch}/packing").collect() == []
    with pytest.raises(ValueError, match="length"):
        P.pack(make(spark, [(1, "x", "a")]), f"{scratch}/other", length=0)


def test_a_word_is_encoded_once_and_with_others(spark, monkeypatch):
    """Unseen words go to the model many at a time, each distinct one once: no call for a word."""
    from ferry.llm.byte_words import ByteWords

    tool = ByteWords(public_tokenizers.path(P.VOCABULARY), special=True)
    calls, model, random_ = [], tool.model, random.Random(5)
    monkeypatch.setattr(tool, "model", lambda s: calls.append(s) or model(s))
    words = ["".join(random_.choices("abcdefghijklmnoé", k=9)) for _ in range(3_000)]
    texts = [" ".join(random_.choices(words, k=200)) + "." for _ in range(100)]
    ids, n = tool.column(pa.array(texts), np.array([1], dtype="<u4").tobytes(), "<u2")
    assert ids.tolist() == [i for t in texts for i in ids_of(t)] and n.tolist() == [len(ids_of(t)) for t in texts]
    assert len(calls) < 300


@pytest.mark.parametrize("special", [True, False])
@pytest.mark.parametrize("gather", [5, 1 << 18])
def test_column_equals_library(special, gather, monkeypatch):
    from ferry.llm import byte_words

    monkeypatch.setattr(byte_words, "GATHER", gather)
    tool = byte_words.ByteWords(public_tokenizers.path(P.VOCABULARY), special)
    rng = random.Random(8)
    pool = [*"abÉé .,'\n\t!?<|>12 \x00\x0b\x1c\x85\xa0ñß中́’ÿ\xad×²😀", "<|endoftext|>", "'s", "'ll", " the", " n'a\nÈ", "don't", "  ", " ", "x" * 70]
    for k in range(600):
        some = rng.sample(pool, 6) if k % 2 else pool
        texts = [None if rng.random() < 0.05 else "".join(rng.choices(some, k=rng.randrange(25))) for _ in range(rng.randrange(12))]
        want = [tool.library(t or "") + b"\7\0\0\0" for t in texts]
        ids, n = tool.column(pa.array([None, *texts, "cut"], pa.string())[1:-1], b"\7\0\0\0")
        assert ids.tobytes() == b"".join(want) and n.tolist() == [len(w) // 4 for w in want], texts
    assert tool.column(pa.array(["a b", ""]))[1].tolist() == [2, 0]


def test_blocks(monkeypatch):
    monkeypatch.setattr(P, "BLOCK_BYTES", 1_000)
    sizes = [3, 0, 700, 1, 1, 90, 400, 2]
    batches = [pa.RecordBatch.from_pydict({"text": ["x" * 10] * n}, pa.schema([("text", pa.string())])) for n in sizes]
    blocks = list(P._blocks(iter(batches)))
    assert sum(b.num_rows for b in blocks) == sum(sizes) and all(b.nbytes <= 1_500 for b in blocks)
    assert all(b.nbytes >= 500 for b in blocks[:-1])
    assert list(P._blocks(iter([]))) == []


def test_query_columns(spark, sf_dir):
    sf = sf_dir([(k, "some words " * k) for k in range(40)])
    df = P.op13_mixture_packing(spark, sf)
    assert df.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    for r in df.collect():
        ids = np.array(ids_of("some words " * r.doc_id)[r.start : r.start + r.length], dtype="<u4")
        assert r.ids_crc32 == zlib.crc32(ids.tobytes()) and r.doc_tokens == len(ids_of("some words " * r.doc_id))
