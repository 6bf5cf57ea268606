"""SQL of the operators that SQL can express, like the driver compares it."""

import duckdb
import pytest

from voxtide.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want, got = con.sql(ORACLE_SQL[name]), QUERIES[name](spark, sf)
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    rows = [sorted(str([r[names.index(c)] for c in columns]) for r in found) for names, found in ((want.columns, want.fetchall()), (got.columns, map(tuple, got.collect())))]
    assert rows[0] == rows[1]
