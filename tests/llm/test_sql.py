"""Queries of the training-data operators against DuckDB, exactly."""

import os
import pathlib

import duckdb
import pytest

from starkit.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(pathlib.Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert sorted(columns) == sorted(df.columns)
    found = sorted(tuple(row) for row in df.select(*columns).collect())
    assert found == sorted(expected.fetchall())
    assert found
