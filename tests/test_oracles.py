"""Every registered query with SQL gives the rows that DuckDB gives."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from docfacts import catalog


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def rows(df: pd.DataFrame):
    columns = sorted(df.columns)
    return sorted(repr([None if pd.isna(x) else x for x in r]) for r in df[columns].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, duck, sf, name):
    got, want = catalog.QUERIES[name](spark, sf).toPandas(), duck.sql(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_without_sql(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
