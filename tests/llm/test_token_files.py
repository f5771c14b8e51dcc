"""Token files against the tokenizers library, and exact round trips of the chunk format."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ferry.llm import token_files as tf
from ferry.session import fresh_dir
from tests.conftest import SF_SMALL

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@given(st.lists(st.integers(0, 2**32 - 1), max_size=60), st.sampled_from((1, 8)), st.integers(1, 20))
def test_planes_round_trip(ids, bits, block):
    got = tf.unpack(tf.pack(np.array(ids, dtype="<u4"), plane_bits=bits, block=block))
    assert got.tolist() == ids


def test_damaged_chunk_is_refused():
    with pytest.raises(ValueError):
        tf.unpack(b"XXXX" + tf.pack(np.arange(3, dtype="<u4"))[4:])
    with pytest.raises(ValueError):
        tf.pack(np.arange(3, dtype="<u4"), plane_bits=3)


def test_words_against_the_library(spark, library):
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect()]
    points = [c for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(f"a{chr(c)}b {chr(c)}c\t{chr(c)}" for c in points[k : k + 512]) for k in range(0, len(points), 512)]
    texts += ["", " \n", "It's <|endoftext|>x <|startoftext|> ' s", "é ́e", "각 ᆨ", "Σας ΣΑΣ", "<|ENDOFTEXT|> The,. x", "İ, K.. ǅ! ²,"]
    got = tf.WordEncoder(PATH).encode(texts)
    for t, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t[:60]


def test_generations_of_the_cache(library, monkeypatch):
    monkeypatch.setattr(tf, "CACHE_ENTRIES", 2)
    e = tf.WordEncoder(PATH)
    for t in ("one, two three.", "four two, three", "one, five. three", "Six one two, three."):
        assert np.frombuffer(e.encode([t])[0], dtype="<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def expected(library, rows):
    out, start = [], 0
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_query_on_the_small_tables(spark, library):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    got = tf.op8_token_files(spark, SF_SMALL).collect()
    assert sorted(map(tuple, got)) == expected(library, rows)


@pytest.mark.parametrize("bits", [1, 8])
def test_cases(spark, make_docs, library, monkeypatch, bits):
    rows = [(None, "x"), (1, None), (2, ""), (3, "b c"), (3, "c b"), (3, "c b"), (4, "word " * 30_000)]
    folder = fresh_dir(spark, "tests")
    tf.write_token_files(make_docs(rows[::-1]), folder, plane_bits=bits)
    got = tf.read_token_files(spark, folder).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected(library, rows), key=str)


def test_empty_table(spark, make_docs):
    folder = fresh_dir(spark, "tests")
    tf.write_token_files(make_docs([]).limit(0), folder)
    assert tf.read_token_files(spark, folder).collect() == []


def test_a_hot_doc_id_is_spread_and_one_document_is_read(spark, scratch, make_docs, monkeypatch):
    monkeypatch.setattr(tf, "CHUNK_IDS", 50)
    rows = [(7, "the same words" if k % 2 else f"words {k}") for k in range(1_000)] + [(100 + k, f"text {k}") for k in range(1_000)]
    rows += [(None, "no id")] * 30
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # it would join the small parts
    try:
        tf.write_token_files(make_docs(rows, 6), f"{scratch}/files")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = tf.read_chunks(spark, f"{scratch}/files").selectExpr("part", "size(doc_ids) n").groupBy("part").sum("n").collect()
    sizes = sorted(r[1] for r in parts)
    assert sum(sizes) == 2_030 and sizes[-1] < 2 * 2_030 / 8 + 50
    want = {r.doc_id: r for r in tf.read_token_files(spark, f"{scratch}/files").where("doc_id >= 100").collect()}
    index = tf.read_index(spark, f"{scratch}/files")
    assert index.count() > 20 and index.groupBy().sum("n_docs").first()[0] == 2_030
    assert index.where("555 between first_doc and last_doc").count() == 1
    (one,) = tf.read_document(spark, f"{scratch}/files", 555).collect()
    assert (one.start, one.n_tokens) == (want[555].start, want[555].n_tokens)
    assert zlib.crc32(one.ids) == want[555].ids_crc32
    assert tf.read_document(spark, f"{scratch}/files", 7).count() == 1_000
