"""Every core query against its SQL in DuckDB, over the smallest tables."""

import glob
import os

import duckdb
import pytest

from tidemark.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def rows(pdf):
    pdf = pdf[sorted(pdf.columns)]
    for c in pdf.columns:
        if pdf[c].dtype.kind in "iuf" or str(pdf[c].dtype).startswith("Int"):
            pdf[c] = pdf[c].astype("float64").round(6)
    return sorted(map(str, pdf.astype(object).where(pdf.notna(), None).itertuples(index=False, name=None)))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_keys_are_made_once_a_file(spark):
    """A filter on an object's key must not be evaluated for each line item below the grouping, nor take the key apart for each date it needs."""
    plan = QUERIES["key_range_overlap"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Aggregate", 1)
    assert above.count("regexp_extract") <= 2  # nullif names it twice
    assert not any(f in below for f in ("regexp_extract", "date_format", "USDT"))


def test_odd_keys_overlap_nothing(spark):
    from pyspark.sql import functions as F

    from tidemark.functions import exprs as X

    keys = {"a-2024-02.parquet": True, "a-2024-01.parquet": False, "a-2024-02-29.parquet": True, "a-2024-02-30.parquet": False, "a-2024-13.parquet": False, "a-2024-03-01.parquet": True, "a-2024-03-02.parquet": False, "a.parquet": False, "": False, None: False}
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    got = df.select("key", X.overlaps(F.col("key"), F.lit("2024-02-29").cast("date"), F.lit("2024-03-01").cast("date")).alias("o")).collect()
    assert {r.key: r.o for r in got} == keys
