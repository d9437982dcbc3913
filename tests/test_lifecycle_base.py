"""The queries over the lifecycle base against their SQL with the base uncut: every customer with order history."""

import glob
import os

import duckdb
import pytest

from tidemark.plans.queries import ORACLE_SQL, QUERIES, SQL_BASE, base

from test_queries import SF, rows

CUT, WHOLE = "from customer where c_custkey % 3 = 0", "from customer where c_custkey in (select o_custkey from orders)"
OVER_BASE = sorted(n for n, q in ORACLE_SQL.items() if SQL_BASE in q)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def test_base_is_every_customer_with_orders(spark, duck):
    want = {r[0] for r in duck.sql("select distinct 'C' || o_custkey from orders join customer on c_custkey = o_custkey").fetchall()}
    got = [r.symbol for r in base(spark, SF).select("symbol").collect()]
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("name", OVER_BASE)
def test_equals_whole_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLE_SQL[name].replace(CUT, WHOLE)).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
