import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["area", "population", "income", "events", "annual_rate"]


def test_every_query_has_an_oracle():
    from tessera.plans.queries import QUERIES

    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(rows):
    return sorted(tuple(repr(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rel = duck.sql(E.oracle_sql()[name])
    cols = df.columns
    assert sorted(cols) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in cols]
    expect = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert _norm(df.collect()) == _norm(expect)
