"""Every library query against its DuckDB twin."""

import duckdb
import pandas as pd
import pytest

from tidewright.plans import library

TABLES = "region nation customer supplier part orders lineitem events".split()


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    df = df.where(pd.notna(df), None)
    return sorted(tuple("" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in df.itertuples(index=False))


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(library.QUERIES))
def test_query(spark, db, sf_dir, name):
    got, want = library.QUERIES[name](spark, sf_dir).toPandas(), db.sql(library.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
