"""The columns of the operators that SQL can express, on the smallest tables."""

import duckdb
import pytest

from quorate.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda rows, columns: sorted(str([dict(zip(columns, r))[c] for c in sorted(columns)]) for r in rows)
    assert rows([tuple(r) for r in got.collect()], got.columns) == rows(want.fetchall(), want.columns)
