"""Columns of a side table beside each row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enrich(
    rows: DataFrame, side: DataFrame, on: Mapping[str, str | Column], take: Mapping[str, str | Column], null_safe: Sequence[str] = (), how: str = "left"
) -> DataFrame:
    """Rows with ``take`` (new column -> column or expression of the side table) where the keys agree.

    ``on`` maps columns of the rows to columns or expressions of the side table; the keys in
    ``null_safe`` also agree when both are NULL. Names of the two tables may clash, and the
    side's keys don't appear in the result.
    """
    keys = {left: f"_key_{i}" for i, left in enumerate(on)}
    picked = [_named(value, keys[left]) for left, value in on.items()] + [_named(value, out) for out, value in take.items()]
    known = side.select(*picked)
    same = F.lit(True)
    for left, key in keys.items():
        same = same & (rows[left].eqNullSafe(known[key]) if left in null_safe else rows[left] == known[key])
    kept = [rows[c] for c in rows.columns if c not in take]
    return rows.join(known, same, how).select(*kept, *[known[c] for c in take])


def _named(value: str | Column, name: str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).alias(name)
