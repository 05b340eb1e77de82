"""Every registered query against its DuckDB oracle at sf0.001 (the same
comparison the correctness gate makes at sf0.01)."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from spindle.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _cell(v):
    if v is None or v is pd.NA or (isinstance(v, float) and v != v):
        return "None"
    if isinstance(v, float) and v.is_integer():
        return str(int(v))
    return str(v)


def _norm(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(tuple(_cell(v) for v in row) for row in df.itertuples(index=False))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["node", "pr_n"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _norm(got) == _norm(want)
