"""Encoding against the tiktoken library and a plain lowest-rank merge; exact round trip."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from ferry.llm import bpe
from tests.conftest import SF_SMALL

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(e, text):
    return np.frombuffer(e.encode([text])[0], dtype="<u4").tolist()


def test_rank_queue_against_a_set():
    rng, q, s = random.Random(1), bpe.RankQueue(50_256), set()
    for _ in range(5000):
        r = rng.randrange(50_256)
        if r in s:
            q.remove(r)
            s.discard(r)
        else:
            q.add(r)
            s.add(r)
        assert q.first() == min(s, default=-1)


def test_texts_against_the_library(spark, library):
    e = bpe.Encoder(PATH, P.PATTERN)
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect()]
    texts += ["", " ", "\n\n  x", "it's we'LL 'll", "a" * 3000, "ab" * 2001, "é" * 999, "☃" * 500, "<|endoftext|>", "\x00\x1c\x85  　x"]
    for t, got in zip(texts, e.encode(texts), strict=True):
        assert np.frombuffer(got, dtype="<u4").tolist() == library.encode_ordinary(t), t[:80]
        assert e.decode(got) == t.encode()


def test_every_character_cuts_as_the_library_does(library):
    e = bpe.Encoder(PATH, P.PATTERN)
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a {chr(c)}b{chr(c)}  {chr(c)}1" for c in points[k : k + 256]) for k in range(0, len(points), 256)]
    for k, (t, got) in enumerate(zip(texts, e.encode(texts), strict=True)):
        assert np.frombuffer(got, dtype="<u4").tolist() == library.encode_ordinary(t), k * 256


def test_random_pieces_against_a_plain_merge():
    """Also with a vocabulary where new pairs may merge earlier than their parts did."""
    rng = random.Random(7)
    for trial in range(60):
        alphabet = b"abc"[: rng.choice((1, 2, 3))]
        tokens = {bytes([b]) for b in range(256)}
        while len(tokens) < 256 + 30:
            tokens.add(bytes(rng.choice(alphabet) for _ in range(rng.randrange(2, 24))))
            if len(alphabet) == 1 and len(tokens) > 256 + 15:
                break
        order = sorted(tokens)
        rng.shuffle(order)
        ranks = {t: i for i, t in enumerate(order)}
        v = bpe.Vocabulary(ranks)
        pieces = [bytes(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(40)]
        for piece, got in zip(pieces, v.merge(pieces), strict=True):
            parts = [piece[i : i + 1] for i in range(len(piece))]
            while True:
                best = min(((ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(1 << 30, 0))
                if best[0] == 1 << 30:
                    break
                i = best[1]
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            assert got.tolist() == [ranks[p] for p in parts], (trial, piece)


def test_very_long_pre_token(library):
    e = bpe.Encoder(PATH, P.PATTERN)
    rng = random.Random(3)
    for t in ("z" * 200_000, "".join(rng.choice("etaoinshr") for _ in range(100_000))):
        got = ids_of(e, t)
        assert e.decode(np.array(got, dtype="<u4").tobytes()) == t.encode()
        assert got[:50] == library.encode_ordinary(t)[:50] and len(got) == len(library.encode_ordinary(t))


def test_cache_restarts_with_equal_ids(monkeypatch):
    e = bpe.Encoder(PATH, P.PATTERN)
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 2)
    assert e.encode(["one two three four"]) == e.encode(["one two three four"])


def test_query_cases(spark, sf_dir, library):
    rows = [(1, "hello world"), (1, "hello world"), (2, None), (3, ""), (None, "x  y"), (4, "long " * 50_000)]
    got = bpe.op1_bpe_encode(spark, sf_dir(rows)).collect()
    want = []
    for d, t in rows:
        ids = library.encode_ordinary(t or "")
        raw = np.array(ids, dtype="<u4").tobytes()
        want.append((d, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty_table_and_clashing_columns(spark, make_docs):
    assert bpe.encode_digests(make_docs([]).limit(0)).count() == 0
    docs = make_docs([(1, "a b"), (2, None)]).withColumn("ids", F.lit("mine")).withColumn("n_tokens", F.lit("mine"))
    out = bpe.encode_documents(docs)
    assert [r.n_tokens for r in out.orderBy("doc_id").collect()] == [2, 0]
    back = {r.doc_id: bytes(r.bytes) for r in bpe.decode_documents(out).collect()}
    assert back == {1: b"a b", 2: b""}
