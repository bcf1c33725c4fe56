"""Every registered query with SQL gives the rows that DuckDB gives for it."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from pulseframe import plans

SQL = plans.oracle_sql()


@pytest.fixture(scope="session")
def duck(sf_dir):
    c = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}{'/*' if os.path.isdir(p) else ''}')")
    return c


def cell(x):
    if x is None or x is pd.NaT or x is pd.NA or isinstance(x, float) and x != x:
        return ""
    if isinstance(x, float):
        return str(int(x)) if x == int(x) else repr(round(x, 4))
    return str(x)


def rows(df):
    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf_dir, duck, name):
    got, expected = plans.queries()[name](spark, sf_dir).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)


def test_sampling(spark, sf_dir):
    """A seeded sample holds about its share of the rows, the same ones each time, each once."""
    assert set(plans.queries()) == set(SQL)
    sample = lambda: sorted(r.event_id for r in plans.queries()["f08_fraction_sampling"](spark, sf_dir).collect())
    events = {r.event_id for r in spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id").collect()}
    one = sample()
    assert one == sample() and len(one) == len(set(one)) and set(one) <= events
    share, deviation = len(one) / len(events), (0.1 * 0.9 / len(events)) ** 0.5
    assert abs(share - 0.1) < 4 * deviation


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
