"""Registered queries against their SQL on the smallest tables (check.py does so at any scale)."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
import check
from headway.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_every_text_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    got = check.rows_of(df.columns, df.collect())
    text = entry.oracle_sql().get(name)
    if text is None:
        assert got[1]
        return
    cursor = db.execute(text)
    assert got == check.rows_of([d[0] for d in cursor.description], cursor.fetchall())
