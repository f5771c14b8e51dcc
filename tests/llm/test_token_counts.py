"""The rollup against a ledger kept by hand, and its batches sent again."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from ferry.llm import bpe
from ferry.llm import token_counts as tc
from ferry.session import fresh_dir
from tests.conftest import SF_SMALL


def rows_of(df):
    return Counter((r.source, r.lang, r.tokenizer, r.n_docs, r.n_tokens, r.n_chars) for r in df.collect())


@pytest.fixture
def rollup(spark):
    return tc.Rollup(spark, fresh_dir(spark, "tests"))


def change(op, key, old=(None, None), new=(None, None)):
    return (op, *key, *old, *new)


def test_random_batches_against_a_ledger(spark, rollup):
    rng = random.Random(4)
    live: dict[int, tuple] = {}
    for batch in range(4):
        changes = []
        for _ in range(40):
            if live and rng.random() < 0.5:
                d = rng.choice(list(live))
                key, old = live.pop(d)
                if rng.random() < 0.5:
                    changes.append(change("delete", key, old))
                else:
                    new = (rng.randrange(100), rng.randrange(500))
                    changes.append(change("revise", key, old, new))
                    live[d] = (key, new)
            else:
                key = (rng.choice(["a", "b", None]), rng.choice(["en", None]), rng.choice(["t1", "t2"]))
                new = (rng.randrange(100), rng.randrange(500))
                live[batch * 1000 + rng.randrange(10**9)] = (key, new)
                changes.append(change("insert", key, new=new))
        df = spark.createDataFrame(changes, tc.CHANGES).repartition(3)
        for _ in range(rng.choice((1, 2))):  # some batches are sent twice
            rollup.commit(batch, df)
        totals = defaultdict(lambda: [0, 0, 0])
        for key, (tokens, chars) in live.values():
            for i, x in enumerate((1, tokens, chars)):
                totals[key][i] += x
        assert rows_of(rollup.totals()) == Counter((*k, *v) for k, v in totals.items())


def test_compact_keeps_totals_and_later_batches(spark, rollup):
    for batch in range(4):
        key = ("s", "en", "t")
        rollup.commit(batch, spark.createDataFrame([change("insert", key, new=(batch + 1, 2))], tc.CHANGES))
    other = tc.Rollup(spark, fresh_dir(spark, "tests"))
    rollup.compact(other, 2)
    assert rows_of(other.totals()) == rows_of(rollup.totals()) == Counter({("s", "en", "t", 4, 10, 8): 1})
    other.commit(3, spark.createDataFrame([change("insert", key, new=(4, 2))], tc.CHANGES))
    assert rows_of(other.totals()) == rows_of(rollup.totals())


def test_unknown_change_is_refused(spark, rollup):
    with pytest.raises(Exception, match="unknown change"):
        rollup.commit(0, spark.createDataFrame([change("upsert", ("s", "en", "t"))], tc.CHANGES))
    assert rollup.totals().collect() == []


def by_hand(rows):
    """Totals of the first row of each text, without its repeated lines."""
    e = bpe.Encoder(*bpe._paths(None, None))
    seen: dict[str, tuple] = {}
    for d, text, lang, source in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        seen.setdefault(text or "", (lang, source))
    totals = defaultdict(lambda: [0, 0, 0])
    for text, (lang, source) in seen.items():
        new = tc.without_repeated_lines(text)
        for name, n in ((tc.WORDS, len(new.encode().split())), (tc.BYTES, len(e.encode([new])[0]) // 4)):
            for i, x in enumerate((1, n, len(new))):
                totals[(source, lang, name)][i] += x
    return Counter((*k, *v) for k, v in totals.items())


def test_query_against_a_plain_count(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    assert rows_of(tc.op7_token_counts(spark, SF_SMALL)) == by_hand(rows)


def test_cases(spark, sf_dir):
    rows = [(1, "a b\na b\nc"), (2, "a b\na b\nc"), (3, None), (4, ""), (None, "solo"), (5, "w " * 50_000), (5, "x")]
    got = rows_of(tc.op7_token_counts(spark, sf_dir(rows)))
    assert got == by_hand([(d, t, "en", "src0") for d, t in rows])


def test_empty_table(spark, sf_dir, make_docs, scratch):
    make_docs([]).limit(0).write.parquet(f"{scratch}/none/documents.parquet")
    assert tc.op7_token_counts(spark, f"{scratch}/none").collect() == []
