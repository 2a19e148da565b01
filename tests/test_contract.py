"""Driver contract: every registered query runs and equals its DuckDB oracle at sf0.001."""
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from inputs import SF_SMALL
from threadcorpus.plans import catalog, files

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return str(int(v)) if v.is_integer() else repr(round(v, 9))
    return str(v)


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(norm(r[c]) for c in cols) for _, r in df.iterrows())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "subreddit" in df.columns


def test_every_query_has_an_oracle():
    assert set(catalog.oracle()) == set(catalog.queries())
    assert set(files.oracle()) == set(files.queries())
    assert set(catalog.queries()) | set(files.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = con.sql(entry.oracle_sql()[name]).df()
    assert rows(got) == rows(want)
