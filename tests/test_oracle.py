"""Every registered query against its SQL, run by DuckDB on the same tables."""

import datetime
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from catalog.oracle import ORACLE
from catalog.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def plain(value):
    return value.isoformat() if isinstance(value, datetime.date) else value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], Counter(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in "lineitem events orders".split():
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    frame = contract.queries()[name](spark, SF_DIR)
    got_names, got = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    want = db.sql(contract.oracle_sql()[name])
    want_names, wanted = rows_of(want.columns, want.fetchall())
    assert got_names == want_names
    assert got
    assert got == wanted


STORED = ["stats_with_report", "gap_report", "reconciliation_summary", "gap_verdict", "final_verdict", "pass_message"]


@pytest.mark.parametrize("name", STORED)
def test_source_tables_are_read_once(spark, name):
    """These read a table that one job made from the source, and not the source again."""
    shared = spark.conf.get("spark.checkpoint.dir")
    files = QUERIES[name](spark, "/root/testdata/sf0.001").inputFiles()
    assert files and all(shared in file for file in files)


def test_entry(spark):
    assert contract.entry(spark).count() == 1
