"""Every core query against its SQL in DuckDB, on the smallest tables."""

import os

import pandas as pd
import pytest

from strataloom.plans import catalog

FOLDER = "/root/testdata/sf0.001"


def normal(frame):
    def cell(v):
        if v is None or (not isinstance(v, list) and pd.isna(v)):
            return "null"
        if isinstance(v, pd.Timestamp):
            return str(v.tz_localize(None))
        return f"{float(v):.6f}" if not isinstance(v, (str, bool)) and hasattr(v, "__float__") else str(v)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(cell, r)) for r in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return con


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_matches_sql(spark, duck, name):
    got, want = catalog.QUERIES[name](spark, FOLDER).toPandas(), duck.execute(catalog.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)
