"""Snapshot reads and snapshot retention over an ingestion column."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_snapshot(df: DataFrame, column: str = "ingestion_date") -> DataFrame:
    """Rows of the newest snapshot.

    The maximum is a scalar subquery: it runs first and prunes partitions (or row
    groups) of the outer scan, and no value passes through Python.
    """
    newest = df.agg(F.max(column)).scalar()
    return df.where(F.col(column) == newest)


def retained_snapshots(df: DataFrame, column: str, days: int, keep_last: int, as_of: date) -> DataFrame:
    """Snapshot dates that retention keeps: the newest keep_last, and any younger than days."""
    snapshots = df.select(F.col(column).cast("date").alias("snapshot")).where("snapshot is not null").distinct()
    newest = snapshots.orderBy(F.desc("snapshot")).limit(keep_last)
    young = snapshots.where(F.col("snapshot") >= F.lit(as_of - timedelta(days=days)))
    return newest.union(young).distinct()
