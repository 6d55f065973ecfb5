"""Every query against its SQL on the smallest tables."""

import duckdb
import pytest

from quorate.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(frame, columns):
    def one(v):
        if v is None or v is not v or str(v) in ("<NA>", "NaT", "nan"):
            return None
        return v if isinstance(v, (str, bool)) else round(float(v), 6)

    return sorted(str(tuple(one(v) for v in row)) for row in frame[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_agrees_with_sql(spark, oracle, name):
    got = catalogue.queries()[name](spark, SF).toPandas()
    want = oracle.sql(catalogue.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert plain(got, columns) == plain(want, columns)


def test_pruned_column_is_not_read(spark):
    plan = catalogue.queries()["proj_prune"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "value" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_key_filter_reaches_the_scan(spark):
    plan = catalogue.queries()["filt_pk_eq"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(user_id,7)" in plan
