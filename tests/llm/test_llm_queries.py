"""Queries that SQL can express, against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_gives_the_same_rows(spark, folder, name):
    con = duckdb.connect()
    for file in os.listdir(folder):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{file}'")
    con.execute(SQL[name])
    columns = [d[0] for d in con.description]
    want = sorted(con.fetchall(), key=repr)
    rows = QUERIES[name](spark, folder)
    assert sorted(rows.columns) == sorted(columns)
    assert sorted((tuple(r) for r in rows.select(*columns).collect()), key=repr) == want
