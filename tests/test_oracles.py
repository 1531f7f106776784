"""Every query against DuckDB on the same tables."""

import os
import pathlib

import duckdb
import pytest

from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(pathlib.Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


SAME_TYPE = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "FLOAT": "float",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def plain(value):
    if value is None or value != value:
        return None
    if isinstance(value, float):
        return float(f"{value:.9g}")
    return value


def rows_of(columns, rows):
    """Rows as tuples in the order of the column names, sorted."""
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    named = [tuple(plain(row[i]) for i in places) for row in rows]
    return sorted(named, key=lambda row: [(v is not None, str(v)) for v in row])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    expected_columns = [c[0] for c in expected.description]
    expected_types = {c[0]: SAME_TYPE[str(c[1])] for c in expected.description}
    assert dict(df.dtypes) == expected_types
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    wanted = rows_of(expected_columns, expected.fetchall())
    assert len(found) == len(wanted)
    assert found == wanted
    assert found or "sf0.001" in SF_DIR, "the comparison needs rows"
