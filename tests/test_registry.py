"""Every registered query against its SQL oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from helixspan import registry
from tools.compare import TABLES, as_rows

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry_offers_the_registry():
    assert entry_module.queries().keys() >= QUERIES.keys()
    assert entry_module.oracle_sql().keys() >= ORACLES.keys()


def test_flagship(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    frame = QUERIES[name](spark, FOLDER)
    cursor = db.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    assert as_rows(frame.columns, frame.collect()) == as_rows(columns, cursor.fetchall())
