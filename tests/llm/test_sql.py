"""Queries that SQL can express, against DuckDB on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from headway.llm.queries import ORACLE, QUERIES

from .conftest import SF

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cursor = db.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*names).collect()))) == sorted(map(repr, cursor.fetchall()))
