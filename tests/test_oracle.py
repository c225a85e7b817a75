"""Every query against its SQL oracle in DuckDB, and the jobs against the queries."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from shelfcast.testkit.queries import QUERIES
from shelfcast.testkit.tables import TABLES

FOLDER = os.environ.get("SHELFCAST_TEST_TABLES", "/root/testdata/sf0.001")
ORACLES = contract.oracle_sql()
FITTED = {"boosted_forecast", "feature_importance"}
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def _text(value):
    return f"{value:.10g}" if isinstance(value, float) else str(value)


def _sorted(found, names, columns):
    places = [names.index(name) for name in columns]
    return sorted(tuple(_text(row[i]) for i in places) for row in found)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    found = df.collect()
    if name not in ORACLES:
        assert name in FITTED and found
        return
    result = duck.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    columns = sorted(df.columns)
    assert sorted(names) == columns
    kinds = {column[0]: str(column[1]) for column in result.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == kinds
    assert _sorted(found, df.columns, columns) == _sorted(result.fetchall(), names, columns)


def test_entry_is_the_training_table(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 30
    assert df.count() == 716


def test_every_oracle_belongs_to_a_query():
    assert set(QUERIES) - set(ORACLES) == FITTED
    assert set(ORACLES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())
