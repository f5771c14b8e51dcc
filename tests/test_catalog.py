"""Every registered query against its DuckDB oracle SQL (row multiset, column names)."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from ferry.plans.catalog import ORACLE_SQL, QUERIES

from .conftest import SF_SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_relay_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


# Training-data queries without an SQL form are held against brute force in tests/llm.
@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    spark_rows = df.collect()
    assert len(spark_rows) > 0
    assert _bag(df.columns, spark_rows) == _bag(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["topic", "key", "value"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["parse_timestamps", "read_after_committed", "stream_resume"])
def test_time_queries_do_not_depend_on_session_zone(spark, duck, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        rel = duck.sql(E.oracle_sql()[name])
        assert _bag(df.columns, df.collect()) == _bag(rel.columns, rel.fetchall())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
