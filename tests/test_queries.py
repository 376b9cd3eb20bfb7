"""Every registered query with SQL gives what DuckDB gives on the same tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from foliary.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v) -> str:
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return "NULL"
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def rows(df: pd.DataFrame) -> list[tuple]:
    df = df.reindex(sorted(df.columns), axis=1)
    return sorted(tuple(map(plain, r)) for r in df.itertuples(index=False))


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, sf_dir, duck, name):
    got = catalogue.QUERIES[name](spark, sf_dir).toPandas()
    assert len(got)
    if name in catalogue.ORACLE_SQL:
        want = duck.sql(catalogue.ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() >= 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
