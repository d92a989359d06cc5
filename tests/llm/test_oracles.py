"""Queries against their SQL on the smallest tables."""

import duckdb
import pytest

from marlstone.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = queries.queries()[name](spark, SF)
    got = sorted(map(tuple, df.collect()), key=str)
    r = con.execute(queries.oracle_sql()[name])
    cols = [c[0] for c in r.description]
    assert sorted(cols) == sorted(df.columns)
    at = [cols.index(c) for c in df.columns]
    assert got == sorted((tuple(x[i] for i in at) for x in r.fetchall()), key=str)
