"""Latest rows, intervals, shares, normalisation and top-n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order.

    ``row_number() = 1`` lets the optimizer place a group limit before the shuffle, so
    each map task sends at most one row per key and a hot key does not pile up. All
    remaining columns follow the given order, so rows that tie in it give one answer.
    """
    rest = [F.col(c).asc_nulls_first() for c, t in df.dtypes if c not in keys and "map<" not in t and t != "variant"]
    return top_n_per_group(df, keys, [*newest_first, *rest], 1)


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None
) -> DataFrame:
    """The first n rows per group, optionally numbered; limited before and after the shuffle."""
    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def min_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Whole row with the least order value per key, as an aggregate with map-side combine."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*_cols(order)))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*").select(*df.columns)


def dedup_subset(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, always the least by its other columns, so reruns agree."""
    rest = [c for c in df.columns if c not in keys]
    least = F.min(F.struct(*rest)).alias("_least")
    return df.groupBy(*keys).agg(least).select(*keys, "_least.*").select(*df.columns)


def next_in_time(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    ties: Sequence[Column | str] = (),
    out: str = "next_ts",
    slice_seconds: int = 86400,
) -> DataFrame:
    """Adds the time of the following row of the same key (NULL for the last).

    A plain ``lead`` over the key would put all rows of a hot key in one task. Here the
    key's timeline is cut into slices: inside a slice ``lead`` runs over (key, slice);
    the last row of a slice takes the head of the key's next non-empty slice, found over
    a per-slice aggregate with one row per (key, slice).
    """
    cut = df.withColumn("_slice", F.floor(F.unix_timestamp(ts) / slice_seconds))
    order = [F.col(ts), *_cols(ties)]
    inner = Window.partitionBy(*keys, "_slice").orderBy(*order)
    local = cut.withColumn("_lead", F.lead(ts).over(inner))
    heads = cut.groupBy(*keys, "_slice").agg(F.min(ts).alias("_head"))
    chained = heads.select(
        *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)),
        F.col("_slice").alias("_s"),
        F.lead("_head").over(Window.partitionBy(*keys).orderBy("_slice")).alias("_next_head"),
    ).where(F.col("_next_head").isNotNull())
    on = F.col("_slice").eqNullSafe(F.col("_s"))
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return local.join(chained, on, "left").select(
        *df.columns, F.coalesce("_lead", "_next_head").alias(out)
    )


def share_of_total(df: DataFrame, value: str, out: str, digits: int = 1) -> DataFrame:
    """Each row's percentage of the column total.

    The total is a scalar subquery over the (already grouped) input instead of a window
    over everything, which would move all rows to one task.
    """
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(out, F.round(F.try_divide(F.lit(100.0) * F.col(value), total), digits))


def minmax_normalise(value: str, group: Sequence[str], lower_is_better: bool) -> Column:
    """Value scaled to 0..1 inside its group; a constant group scores 1.

    A window, for groups with a bounded number of rows such as one search's routes.
    """
    w = Window.partitionBy(*group)
    low, high = F.min(value).over(w), F.max(value).over(w)
    part = (high - F.col(value)) if lower_is_better else (F.col(value) - low)
    return F.when(high == low, F.lit(1.0)).otherwise(part / (high - low))


def with_minmax(
    df: DataFrame, value: str, group: Sequence[str], out: str, lower_is_better: bool
) -> DataFrame:
    """Like minmax_normalise for groups of any size.

    The bounds are an aggregate with map-side combine, joined back null-safely, so a hot
    group is never gathered in one task (AQE splits its side of the join).
    """
    bounds = df.groupBy(*group).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    renamed = bounds.select(*(F.col(g).alias(f"_g{i}") for i, g in enumerate(group)), "_low", "_high")
    same = F.lit(True)
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    part = (F.col("_high") - F.col(value)) if lower_is_better else (F.col(value) - F.col("_low"))
    scaled = F.when(F.col("_high") == F.col("_low"), F.lit(1.0)).otherwise(part / (F.col("_high") - F.col("_low")))
    return df.join(renamed, same).select(*df.columns, scaled.alias(out))


def arg_max(df: DataFrame, label: str, value: str) -> DataFrame:
    """One row: the label with the greatest value, the least label on a tie."""
    best = F.min(F.struct((-F.col(value)).alias("negated"), F.col(label).alias("label")))
    return df.where(F.col(value).isNotNull()).agg(best.alias("b")).select(
        F.col("b.label").alias(label), (-F.col("b.negated")).alias(value)
    )


def page(df: DataFrame, order: Sequence[Column], limit: int | None = 100, offset: int = 0) -> DataFrame:
    """One page of a totally ordered result; all of it, in order, without a limit."""
    ordered = df.orderBy(*order)
    ordered = ordered.offset(offset) if offset else ordered
    return ordered if limit is None else ordered.limit(limit)
