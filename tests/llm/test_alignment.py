"""op12 against a plain version that lists all links."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ferry.llm import alignment as A
from ferry.llm.byte_words import ByteWords

TEXTS = [
    "The quick brown fox jumps over the lazy dog.", "", None, "hello  world\n\n\tfoo", "naïve café — 中文 ∑ 😀",
    "a b", "   ", "<|endoftext|> and </s> and <0x41>", "U+2581 ▁ is not a space", "line one\r\nline two", "12345 67,890.12",
    "aaaa" * 300, "=" * 777, "don't we'll 'tis", "zero\x00byte", "The quick brown fox jumps over the lazy dog.",
]


def plain(texts):
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    a_bytes = A.token_bytes(a)
    rows, documents = [], Counter()
    for t in texts:
        groups = []
        if t:
            ids_a, ids_b = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
            by = [[a_bytes[i] for i in ids_a], []]
            for i in ids_b:
                piece = b.id_to_piece(i)
                by[1].append(bytes([int(piece[1:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
            if all(b"".join(x) == (" " + t).encode() for x in by):
                i = j = 0
                while i < len(ids_a):
                    i0, j0, na, nb = i, j, len(by[0][i]), len(by[1][j])
                    i, j = i + 1, j + 1
                    while na != nb:
                        if na < nb:
                            na, i = na + len(by[0][i]), i + 1
                        else:
                            nb, j = nb + len(by[1][j]), j + 1
                    groups.append((ids_a[i0:i], ids_b[j0:j]))
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        documents.update(set(links))
        rows.append((groups, links))
    best = {}
    for (x, _), n in documents.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for groups, links in rows:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((
            sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), len(links),
            sum(documents[l] == best[l[0]] for l in links), sum(documents[l] for l in links),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return out


def run(spark, scratch, docs):
    return A.alignment_digests(A.write_links(docs, f"{scratch}/alignment"))


@pytest.mark.parametrize("chunk", [A.CHUNK_BYTES, 200])
def test_equals_plain(spark, scratch, make_docs, monkeypatch, chunk):
    monkeypatch.setattr(A, "CHUNK_BYTES", chunk)
    random.seed(chunk)
    words = ["the", "Übung", "niño", "x1", "::", "token", "izer", "\n", "s.", "—", "  "]
    texts = TEXTS + ["".join(random.choices([*words, " "], k=60)) for _ in range(60)]
    rows = list(enumerate(texts))
    docs = make_docs(rows)
    got = {r.doc_id: tuple(r)[1:] for r in run(spark, scratch, docs).collect()}
    assert got == dict(enumerate(plain(texts)))
    assert got[1] == (0, 0, 0, 0, 0, 0, "") == got[2] == got[8]


def test_large_groups_by_distinct_ids(spark, scratch, make_docs, monkeypatch):
    monkeypatch.setattr(A, "LINKS", 3)
    got = {r.doc_id: tuple(r)[1:] for r in run(spark, scratch, make_docs(list(enumerate(TEXTS)))).collect()}
    assert got == dict(enumerate(plain(TEXTS)))


def test_repeated_null_ids_and_extra_columns(spark, scratch):
    rows = [(1, "one two", 5, "a"), (1, "one two", 5, "b"), (None, "one two", 5, "c"), (2, "two one", 5, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pair long, chunk string")
    got = sorted((tuple(r) for r in run(spark, scratch, docs).collect()), key=str)
    want = plain([r[1] for r in rows])
    assert got == sorted([(r[0], *w) for r, w in zip(rows, want)], key=str)


def test_empty(spark, scratch, make_docs):
    assert run(spark, scratch, make_docs([])).collect() == []


def test_read_alignments(spark, make_docs):
    chunks = A.alignments(make_docs([(0, "café au lait"), (1, None)]))
    rows = {r.doc_id: r for r in A.read_alignments(chunks).collect()}
    tool = A.Aligner(*map(public_tokenizers.path, (A.BYTE_VOCABULARY, A.PIECE_VOCABULARY)))
    assert b"".join(tool.a_bytes[i] for i in rows[0].a_ids) == " café au lait".encode()
    assert b"".join(tool.b_bytes[i] for i in rows[0].b_ids) == " café au lait".encode()
    assert sum(rows[0].a_sizes) == len(rows[0].a_ids) and sum(rows[0].b_sizes) == len(rows[0].b_ids)
    assert rows[1].a_ids == [] == rows[1].b_sizes


@pytest.mark.parametrize("special", [True, False])
def test_words_equal_library(special, monkeypatch):
    from ferry.llm import byte_words

    monkeypatch.setattr(byte_words, "CACHE_BYTES", 20_000)
    monkeypatch.setattr(byte_words, "SLICE", 7)
    tool = ByteWords(public_tokenizers.path("byte_bpe_50k.json"), special)
    random.seed(8)
    pool = [*"abÉé .,'\n\t!?<|>12 \x1c\x85ñß中́’", "<|endoftext|>", "'s", "'ll", " the", "don't", "  ", "x" * 70]
    for _ in range(4_000):
        text = "".join(random.choices(pool, k=random.randrange(40)))
        assert tool.encode(text) == tool.library(text), text
    assert tool.words.held <= 20_000 + 7 * 1_000
    assert all(len(w) < byte_words.LONG for w in {*tool.words, *tool.words.older})


def test_slices_make_no_object_for_a_token():
    """Ends are looked up in arrays: the same places as a plain look-up, in less memory than an object a token."""
    import tracemalloc

    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 50, 400):
        a, b = rng.integers(0, 5, n), rng.integers(0, 5, n)
        ends = [dict(zip(np.cumsum(x).tolist(), range(1, n + 1), strict=True)) for x in (a, b)]
        common = [e for e in ends[0] if e in ends[1]]
        assert [x.tolist() for x in A.slices(a, b)] == [[e[k] for k in common] for e in ends]
    a = np.full(400_000, 2)
    tracemalloc.start()
    A.slices(a, a)
    assert tracemalloc.get_traced_memory()[1] < 100 * len(a)
    tracemalloc.stop()
