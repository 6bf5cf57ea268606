"""Every catalogue query against its DuckDB SQL at sf0.001 (what the driver checks at sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(n for n in E.oracle_sql() if not n.startswith("op"))     # the corpus operators' SQL is tested with them


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_is_registered():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 60


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns)[0] == digest(orows, rel.columns)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["channel", "positive", "negative", "positive_pct", "negative_pct"]
