"""Keyed merges as pure (target, source) -> new target functions.

Every merge is one shuffle of each side on the key, an equi join that AQE may turn
into a broadcast, and a projection. Keys match null-safely by default: a NULL key part
equals another NULL, so a re-run updates such rows instead of adding them again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.clock import moment


def _one_row_per_key(source: DataFrame, keys: Sequence[str], on_duplicates: str) -> DataFrame:
    """Source with unique keys: 'raise' on a repeated key, or 'trust' the caller."""
    if on_duplicates == "trust":
        return source
    if on_duplicates != "raise":
        raise ValueError("on_duplicates must be 'raise' or 'trust'")
    values = [c for c in source.columns if c not in keys]
    grouped = source.groupBy(*keys).agg(
        F.any_value(F.struct(*(F.col(c) for c in values)) if values else F.lit(1)).alias("_v"),
        F.count("*").alias("_n"),
    )
    checked = F.when(F.col("_n") > 1, F.raise_error(F.lit("merge source repeats a key"))).otherwise(F.col("_v"))
    out = grouped.select(*keys, checked.alias("_v"))
    return out.select(*keys, *(F.col("_v")[c].alias(c) for c in values))


def _matches(keys: Sequence[str], null_safe: bool) -> Column:
    cond = F.lit(True)
    for k in keys:
        t, s = F.col(f"_t.{k}"), F.col(f"_s.{k}")
        cond = cond & (t.eqNullSafe(s) if null_safe else t == s)
    return cond


def _full_join(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    t = target.withColumn("_in_t", F.lit(True)).alias("_t")
    s = source.withColumn("_in_s", F.lit(True)).alias("_s")
    return t.join(s, _matches(keys, null_safe), "full")


def _pick(joined: DataFrame, target: DataFrame, keys: Sequence[str], source_cols, take_source: Column) -> DataFrame:
    cols = []
    for c in target.columns:
        t = F.col(f"_t.{c}")
        if c in keys or c in source_cols:
            cols.append(F.when(take_source, F.col(f"_s.{c}")).otherwise(t).alias(c))
        else:
            cols.append(t.alias(c))
    return joined.select(*cols)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: bool = True,
    on_duplicates: str = "raise",
) -> DataFrame:
    """Matched rows take all source values, unmatched source rows are added."""
    source = _one_row_per_key(source, keys, on_duplicates)
    joined = _full_join(target, source, keys, null_safe)
    return _pick(joined, target, keys, source.columns, F.col("_s._in_s").isNotNull())


def merge_versioned(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    version: str,
    strict: bool = True,
    null_safe: bool = True,
    on_duplicates: str = "raise",
) -> DataFrame:
    """Upsert that updates only when the source version is newer (or equal, if not strict).

    Late or replayed rows lose, so applying one batch twice changes nothing.
    """
    source = _one_row_per_key(source, keys, on_duplicates)
    joined = _full_join(target, source, keys, null_safe)
    s, t = F.col(f"_s.{version}"), F.col(f"_t.{version}")
    newer = F.coalesce(s > t if strict else s >= t, F.lit(False))
    take = F.col("_t._in_t").isNull() | (F.col("_s._in_s").isNotNull() & newer)
    return _pick(joined, target, keys, source.columns, take)


def merge_insert_new(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: bool = True,
    on_duplicates: str = "raise",
) -> DataFrame:
    """Only source rows with unseen keys; append them to the target."""
    source = _one_row_per_key(source, keys, on_duplicates)
    cond = F.lit(True)
    for k in keys:
        s, t = F.col(f"_s.{k}"), F.col(f"_t.{k}")
        cond = cond & (s.eqNullSafe(t) if null_safe else s == t)
    fresh = source.alias("_s").join(target.select(*keys).alias("_t"), cond, "left_anti")
    return fresh.select(*target.columns)


def merge_sync(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    now: datetime | Column,
    active: str = "is_active",
    missing: str = "missing_since",
    touched: str | None = "processed_at",
    on_duplicates: str = "raise",
) -> DataFrame:
    """Upsert from a full snapshot: active rows it lacks are closed, returning rows reopened."""
    now = now if isinstance(now, Column) else moment(now)
    source = _one_row_per_key(source, keys, on_duplicates)
    joined = _full_join(target, source, keys, True)
    present = F.col("_s._in_s").isNotNull()
    vanished = ~present & F.col(f"_t.{active}")
    cols = []
    for c in target.columns:
        t = F.col(f"_t.{c}")
        if c == active:
            col = F.when(present, F.lit(True)).when(vanished, F.lit(False)).otherwise(t)
        elif c == missing:
            col = F.when(present, F.lit(None)).when(vanished, now).otherwise(t)
        elif c == touched:
            fresh = F.col(f"_s.{c}") if c in source.columns else now
            col = F.when(present, fresh).when(vanished, now).otherwise(t)
        elif c in source.columns:
            col = F.when(present, F.col(f"_s.{c}")).otherwise(t)
        else:
            col = t
        cols.append(col.alias(c))
    return joined.select(*cols)
