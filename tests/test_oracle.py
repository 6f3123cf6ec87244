"""Every registered query against its DuckDB oracle (the driver's check), on sf0.001."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
SLOW = {"lambda_job"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql()) - SLOW))
def test_rows_only_query_runs(spark, name):
    assert E.queries()[name](spark, SF_SMALL).count() >= 1


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "user_engagement_score" in df.columns
