"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import TABLES, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, db, name):
    df = queries()[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in oracle_sql():
        assert got
        return
    result = db.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows(names, result.fetchall())


def test_entry(spark):
    assert entry(spark).count() == 147


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
