"""Every registered query against its SQL in another engine, on the smallest test data."""

import os

import duckdb
import pytest

from __spark_entry__ import entry
from catalogue.oracle import ORACLE
from catalogue.queries import QUERIES
from check import TABLES, rows_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, engine, name):
    frame = QUERIES[name](spark, SF_DIR)
    result = engine.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, result.fetchall())


def test_flagship(spark):
    assert entry(spark).count() > 0


def test_items_without_keys_have_no_id(spark, tmp_path):
    engine = duckdb.connect()
    items = """SELECT * REPLACE (CASE WHEN i % 7 = 0 THEN NULL ELSE l_orderkey END AS l_orderkey, CASE WHEN i % 5 = 0 THEN NULL ELSE l_linenumber END AS l_linenumber,
        CASE WHEN i % 11 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice) FROM (SELECT *, row_number() OVER () AS i FROM '{}/lineitem.parquet')"""
    for table, text in (("lineitem", items), ("supplier", "SELECT * FROM '{}/supplier.parquet'")):
        engine.execute(f"COPY ({text.format(SF_DIR)}) TO '{tmp_path}/{table}.parquet' (FORMAT parquet)")
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet'")
    frame = QUERIES["anomaly_null_and_flat"](spark, str(tmp_path))
    result = engine.execute(ORACLE["anomaly_null_and_flat"])
    assert rows_of(frame.columns, frame.collect()) == rows_of([d[0] for d in result.description], result.fetchall())
