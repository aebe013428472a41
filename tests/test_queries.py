"""Every registered query against its SQL."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from catalog.oracle import oracle
from catalog.queries import QUERIES
from check import TABLES, compare

FOLDER = "/root/testdata/sf0.01"
SQL = oracle()


@pytest.fixture(scope="module")
def database():
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{Path(FOLDER) / t}.parquet')")
    return db


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, database, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    assert len(got) > 0
    assert compare(got, database.execute(SQL[name]).df()) == ""


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 6 * (7 + 3)
