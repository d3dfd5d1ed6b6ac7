"""Written tables, salted joins and gapless numbering that the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.session import shared_folder


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for a table, below the folder that all executors share."""
    return f"{shared_folder(spark)}/headway-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "snappy", slim: bool = False) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends here, lost executors cost nothing.

    A slim table, of rows that a shuffle has already reduced, is written by fewer tasks, so
    that many shuffle partitions don't leave many small files: two a core, or one for sixteen
    partitions where that is more, which bounds a task however large the input is.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    few = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 16)
    rows = df.coalesce(few) if slim else df
    rows.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that the frame doesn't have."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name = f"{name}_"
        have.add(name.lower())
        out.append(name)
    return out


def same(left: DataFrame, right: DataFrame, keys: Iterable[str]) -> Column:
    """Null-safe equality of the keys."""
    condition = None
    for key in keys:
        equal = left[key].eqNullSafe(right[key])
        condition = equal if condition is None else condition & equal
    return condition


def salted_join(rows: DataFrame, stats: DataFrame, keys: list[str], spread_by: str, how: str = "left", salts: int = 16) -> DataFrame:
    """Joins statistics, one row a key, to rows of which one key may hold a third.

    Each key is dealt to ``salts`` places by ``spread_by``; the statistics go to all of them.
    """
    places = F.explode(F.array(*[F.lit(i) for i in range(salts)]))
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    right = stats.withColumnsRenamed({k: f"_r_{k}" for k in keys}).withColumn("_salt_r", places)
    condition = left["_salt"] == right["_salt_r"]
    for key in keys:
        condition &= left[key].eqNullSafe(right[f"_r_{key}"])
    return left.join(right, condition, how).drop("_salt", "_salt_r", *[f"_r_{k}" for k in keys])


def numbered(df: DataFrame, groups: list[str], draw: str, order: list[str], name: str, blocks: int = 64) -> DataFrame:
    """Adds a gapless long from 0 within each group, without bringing a group together.

    A group is dealt to blocks by the hash of ``draw``; a block is numbered by a window, in
    ``order``, and offset by the rows of the blocks before it.
    """
    dealt = df.withColumn("_block", F.pmod(F.xxhash64(draw), F.lit(blocks)))
    sizes = dealt.groupBy(*groups, "_block").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*groups, "_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inner = Window.partitionBy(*groups, "_block").orderBy(*order)
    ranked = dealt.withColumn("_rank", F.row_number().over(inner) - 1)
    joined = ranked.join(starts, [*groups, "_block"])
    return joined.withColumn(name, F.col("_start") + F.col("_rank")).drop("_block", "_start", "_rank")


TABLE_BITS = 23


def bit_table(marks: DataFrame, name: str) -> np.ndarray:
    """The bytes of 2 ** TABLE_BITS bits, those set that the marks' low bits name: 1 MB for any number of marks.

    A mark whose bit isn't set isn't among them, so rows can be left out before a shuffle;
    the join that follows settles the others.
    """
    slot = F.col(name).bitwiseAND(F.lit((1 << TABLE_BITS) - 1))
    parts = marks.select(F.shiftright(slot, 5).alias("place"), F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(31)).cast("int")).alias("bit"))
    table = np.zeros(1 << (TABLE_BITS - 5), np.uint32)
    for place, bit in parts.groupBy("place").agg(F.bit_or("bit").alias("bits")).toLocalIterator():
        table[place] = bit
    return table.view(np.uint8)


def in_table(table: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Whether the bits of 64-bit marks are set."""
    slot = (marks & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)
    return (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def in_table_column(spark: SparkSession, table: np.ndarray, name: str) -> Column:
    """The same as a column: the table is one value that every task has, a bit is cut out of it."""
    bits = spark.createDataFrame([(bytearray(table.tobytes()),)], "bits binary").scalar()
    slot = F.col(name).bitwiseAND(F.lit((1 << TABLE_BITS) - 1))
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(slot, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, slot.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1


def batches(blocks: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Non-empty batches of at most ``rows`` rows, so that long texts don't add up."""
    for block in blocks:
        for at in range(0, block.num_rows, rows):
            yield block.slice(at, rows)
