"""Sketches of a table's columns, kept for each day and merged when asked.

A day's rows are read once, when they come in. What is kept of each column is counts, sums, limits,
a distinct-count sketch (HyperLogLog) and, of numbers, a quantile sketch (KLL); all merge by
addition or union, so a profile or a quantile of any range of days reads a few rows a
day and column and none of the table. Repeating a day's load replaces that day's rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.sources.tables import overwrite_partitions

# Sizes of the sketches and what follows from them. A KLL sketch of size k is off by a rank of
# 2.296 / k ** 0.9723 at most with 99 % confidence; a HyperLogLog sketch of 2 ** lg slots has a relative
# standard deviation of 1.04 / sqrt(2 ** lg).
QUANTILE_SIZE = 400
DISTINCT_LG = 12
RANK_ERROR = 2.296 / QUANTILE_SIZE**0.9723
DISTINCT_DEVIATION = 1.04 / 2 ** (DISTINCT_LG / 2)

NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def _is_number(kind: str) -> bool:
    return kind.startswith(NUMBERS)


def day_sketches(df: DataFrame, day: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(day, column, rows, known, total, low, high, low_text, high_text, distinct, ranks) a day and column.

    One scan; a day that holds a third of all rows is sketched by every task on its own rows first.
    """
    types = dict(df.dtypes)
    columns = list(columns or [c for c in df.columns if c != day])
    aggs = [F.count("*").alias("rows")]
    for i, c in enumerate(columns):
        col, number = F.col(c), _is_number(types[c])
        value = col.cast("double") if number else F.lit(None).cast("double")
        shown = F.lit(None).cast("string") if number else col.cast("string")
        aggs += [
            F.count(col).alias(f"known{i}"),
            F.sum(value).alias(f"total{i}"),
            F.min(value).alias(f"low{i}"),
            F.max(value).alias(f"high{i}"),
            F.min(shown).alias(f"low_text{i}"),
            F.max(shown).alias(f"high_text{i}"),
            F.hll_sketch_agg(F.when(col.isNotNull(), F.xxhash64(col)), F.lit(DISTINCT_LG)).alias(f"distinct{i}"),
            (F.kll_sketch_agg_double(value, F.lit(QUANTILE_SIZE)) if number else F.lit(None).cast("binary")).alias(f"ranks{i}"),
        ]
    per_day = df.groupBy(F.col(day).alias("day")).agg(*aggs)
    fields = ["known", "total", "low", "high", "low_text", "high_text", "distinct", "ranks"]
    each = [F.struct(F.lit(c).alias("column"), *[F.col(f"{f}{i}").alias(f) for f in fields]) for i, c in enumerate(columns)]
    return per_day.select("day", "rows", F.inline(F.array(*each))).select("day", "column", "rows", *fields)


def keep(sketches: DataFrame, folder: str) -> None:
    """Stores days' sketches, in place of those stored for the same days before."""
    overwrite_partitions(sketches, folder, "day")


def stored(spark: SparkSession, folder: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Stored sketches of a range of days; other days' files aren't read."""
    rows = spark.read.parquet(folder)
    if first is not None:
        rows = rows.where(F.col("day") >= F.lit(first))
    return rows if last is None else rows.where(F.col("day") <= F.lit(last))


def merged(sketches: DataFrame) -> DataFrame:
    """One row a column: the sketches of all given days together."""
    return sketches.groupBy("column").agg(
        F.count("*").alias("days"),
        F.sum("rows").alias("rows"),
        F.sum("known").alias("known"),
        F.sum("total").alias("total"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.min("low_text").alias("low_text"),
        F.max("high_text").alias("high_text"),
        F.hll_union_agg("distinct").alias("distinct"),
        # Days without a known value have an empty sketch, which has no quantile and adds nothing.
        F.kll_merge_agg_double(F.when(F.col("known") > 0, F.col("ranks"))).alias("ranks"),
    )


def profile(sketches: DataFrame) -> DataFrame:
    """(column, rows, null_pct, n_distinct, min, max, mean) from stored sketches; n_distinct within DISTINCT_DEVIATION."""
    number = F.col("low").isNotNull()
    n = F.col("rows")
    return merged(sketches).select(
        "column",
        "rows",
        F.round(F.try_divide(100.0 * (n - F.col("known")), n), 2).alias("null_pct"),
        F.hll_sketch_estimate("distinct").alias("n_distinct"),
        F.when(number, F.col("low").cast("string")).otherwise(F.col("low_text")).alias("min"),
        F.when(number, F.col("high").cast("string")).otherwise(F.col("high_text")).alias("max"),
        F.round(F.try_divide(F.col("total"), F.when(number, F.col("known"))), 4).alias("mean"),
    )


def quantiles(sketches: DataFrame, fractions: Sequence[float]) -> DataFrame:
    """(column, fraction, value) of the columns of numbers; a value's rank is within RANK_ERROR of the fraction."""
    each = [F.struct(F.lit(float(f)).alias("fraction"), F.kll_sketch_get_quantile_double("ranks", F.lit(float(f))).alias("value")) for f in fractions]
    return merged(sketches).where("low IS NOT NULL").select("column", F.inline(F.array(*each)))


def rank_misses(df: DataFrame, found: Sequence[tuple[str, float, float]]) -> DataFrame:
    """(column, fraction, miss): how far each value's true ranks in the table lie from the asked fraction.

    ``found`` lists (column, fraction, value). A value that occurs often has a range of ranks and misses only
    what lies outside of it.
    """
    aggs, out = [], []
    for i, (c, fraction, value) in enumerate(found):
        col = F.col(c).cast("double")
        aggs += [F.count_if(col < value).alias(f"b{i}"), F.count_if(col <= value).alias(f"u{i}"), F.count(col).alias(f"n{i}")]
        below, upto = F.col(f"b{i}") / F.col(f"n{i}"), F.col(f"u{i}") / F.col(f"n{i}")
        miss = F.greatest(F.lit(0.0), below - fraction, fraction - upto)
        out.append(F.struct(F.lit(c).alias("column"), F.lit(float(fraction)).alias("fraction"), F.col(f"n{i}").alias("rows"), miss.alias("miss")))
    return df.agg(*aggs).select(F.inline(F.array(*out)))


def cutoff_day(sketches: DataFrame, column: str, fraction: float) -> Column:
    """The day (a date) at a fraction of a column of day numbers, as a value for a plan."""
    day = quantiles(sketches.where(F.col("column") == column), [fraction]).select("value").scalar()
    return F.date_from_unix_date(day.cast("int"))
