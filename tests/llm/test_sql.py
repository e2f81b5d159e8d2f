"""The corpus queries that SQL can express against DuckDB, on the smallest tables."""

import os

import pytest

from strataloom.llm import queries

FOLDER = "/root/testdata/sf0.001"


def normal(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(f"{v:.6f}" if isinstance(v, float) else str(v) for v in r) for r in frame.itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    got, want = queries.QUERIES[name](spark, FOLDER).toPandas(), con.execute(queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and normal(got) == normal(want)
