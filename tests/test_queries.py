"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, compare
from millrace.queries import ORACLE, REGISTRY

SF_DIR = "/root/testdata/sf0.001"
QUERIES = dict(REGISTRY)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    outcome = compare(QUERIES[name](spark, SF_DIR).toPandas(), db.sql(ORACLE[name]).df())
    assert outcome == "ok"


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["nation", "revenue", "order_count", "customers", "etl_date"]
    assert frame.count() > 0
