"""Stored parquet tables: partitioned appends and versioned full refreshes on plain folders."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "version="


# --- folders ---------------------------------------------------------------


def _fs(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _children(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _fs(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def exists(spark: SparkSession, folder: str) -> bool:
    fs, path = _fs(spark, folder)
    return bool(fs.exists(path))


# --- schema and partition columns ------------------------------------------


def fit(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Columns in the declared order and types; missing nullable columns become NULL."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.to(declared)


def partition_value(spec: str) -> tuple[str, Column]:
    """(column name, expression) of 'route_type', 'month(date)' or 'day(batch_time)'."""
    for kind, pattern in (("month", "yyyy-MM"), ("day", "yyyy-MM-dd")):
        if spec.startswith(f"{kind}("):
            source = spec[len(kind) + 1 : -1]
            return f"{source}_{kind}", F.date_format(source, pattern)
    return spec, F.col(spec)


def with_partition(df: DataFrame, spec: str | None) -> tuple[DataFrame, list[str]]:
    if spec is None:
        return df, []
    name, value = partition_value(spec)
    return (df if name in df.columns else df.withColumn(name, value)), [name]


def _writer(df: DataFrame, columns: Sequence[str]):
    """Writer with rows gathered per partition value, so tasks do not each open every folder.

    A rebalance lets adaptive execution cut a hot value into several files and join small ones.
    """
    return (df.hint("rebalance", *columns) if columns else df).write.partitionBy(*columns)


# --- bronze ----------------------------------------------------------------


def append_bronze(df: DataFrame, folder: str, partition: str | None = "ingestion_date") -> None:
    """Adds rows; later loads may have more columns, which readers see through schema merging."""
    df, columns = with_partition(df, partition)
    _writer(df, columns).mode("append").parquet(folder)


def overwrite_partitions(df: DataFrame, folder: str, partition: str = "ingestion_date") -> None:
    """Replaces just the partitions the rows fall in, so repeating a day's load changes nothing."""
    df, columns = with_partition(df, partition)
    _writer(df, columns).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(folder)


def read_bronze(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(folder)


def audit_append(rows: DataFrame, extra: DataFrame, folder: str, partition: str | None = "ingestion_date") -> DataFrame:
    """Self-test of a store's write path: rows go in, then an extra one; one row with the counts and the verdict.

    Counts are taken from what is read again after each write, less what the folder held before.
    """
    spark = rows.sparkSession

    def count() -> int:
        filled = any(not name.startswith(("_", ".")) for name in _children(spark, folder))
        return read_bronze(spark, folder).count() if filled else 0

    before = count()
    append_bronze(rows, folder, partition)
    first = count() - before
    append_bronze(extra, folder, partition)
    second = count() - before
    expected, more = rows.count(), extra.count()
    passed = first == expected and second == expected + more
    return spark.createDataFrame([(expected, first, second, passed)], "n_rows long, n_first long, n_second long, passed boolean")


# --- versioned full refresh ------------------------------------------------


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Complete versions, oldest first. A version counts once its job has written _SUCCESS."""
    found = [int(n[len(VERSION) :]) for n in _children(spark, folder) if n.startswith(VERSION)]
    return sorted(v for v in found if exists(spark, f"{folder}/{VERSION}{v}/_SUCCESS"))


def _next_version(spark: SparkSession, folder: str) -> int:
    """Beyond all that were started, whether they are complete or not."""
    return max((int(n[len(VERSION) :]) for n in _children(spark, folder) if n.startswith(VERSION)), default=0) + 1


def publish(df: DataFrame, folder: str, partition: str | None = None, complete: bool = True) -> int:
    """Writes a new version beside the old ones; readers switch when it is complete.

    The job may read the version it replaces, and a failed job leaves readers where they were.
    A version that isn't to be complete yet waits for its mark.
    """
    spark = df.sparkSession
    version = _next_version(spark, folder)
    df, columns = with_partition(df, partition)
    writer = _writer(df, columns).mode("errorifexists")
    writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", complete).parquet(f"{folder}/{VERSION}{version}")
    return version


def current(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The newest complete version, or a named older one."""
    done = versions(spark, folder)
    if not done or (version is not None and version not in done):
        raise ValueError(f"no complete version {version or ''} in {folder}")
    return spark.read.parquet(f"{folder}/{VERSION}{version or done[-1]}")


def expire_versions(spark: SparkSession, folder: str, keep_last: int, remove: bool = False) -> list[int]:
    """Versions beyond the newest keep_last; deleted only if asked."""
    old = versions(spark, folder)[: -max(keep_last, 1)]
    if remove:
        for v in old:
            fs, path = _fs(spark, f"{folder}/{VERSION}{v}")
            fs.delete(path, True)
    return old


def publish_if_valid(
    staged: DataFrame, folder: str, checks: Callable[[DataFrame], DataFrame], partition: str | None = None
) -> DataFrame:
    """Write, audit, publish: the staged table replaces the current one only if all checks pass.

    The candidate is written once, as a version without its mark, and audited as written; the
    mark is all that publishes it. A rejected one stays beside the versions, unseen by readers.
    Returns the check results.
    """
    spark = staged.sparkSession
    path = f"{folder}/{VERSION}{publish(staged, folder, partition, complete=False)}"
    results = checks(spark.read.schema(with_partition(staged, partition)[0].schema).parquet(path)).persist()
    if results.where(~F.col("passed")).isEmpty():
        fs, mark = _fs(spark, f"{path}/_SUCCESS")
        fs.create(mark).close()
    return results


# --- compaction ------------------------------------------------------------


def compact(spark: SparkSession, folder: str, target_bytes: int, min_files: int, partition: str | None = None) -> bool:
    """Rewrites the current version into files near target_bytes when it has too many small ones."""
    done = versions(spark, folder)
    if not done:
        return False
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(f"{folder}/{VERSION}{done[-1]}")
        .agg(F.count("*").alias("n"), F.count_if(F.col("length") < target_bytes * 3 // 4).alias("small"), F.sum("length").alias("bytes"))
        .first()
    )
    if files.small < min_files:
        return False
    parts = max(1, -(-files.bytes // target_bytes))
    if files.n <= parts:
        return False
    df, columns = with_partition(current(spark, folder), partition)
    version = _next_version(spark, folder)
    # By partition value, a rebalance cuts hot values; otherwise an even split into parts.
    writer = _writer(df, columns) if columns else df.repartition(parts).write
    writer.parquet(f"{folder}/{VERSION}{version}")
    return True
