"""Layer upkeep of stored tables: retention, compaction, orphan files."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.clock import moment

MB = 1024 * 1024


@dataclass(frozen=True)
class LayerPolicy:
    """Retention and file-size rules of one layer."""

    snapshot_days: int
    keep_snapshots: int
    orphan_days: int
    target_bytes: int
    min_files: int


# Policies per layer.
POLICIES = {
    "bronze": LayerPolicy(30, 10, 7, 256 * MB, 5),
    "silver": LayerPolicy(10, 5, 5, 256 * MB, 5),
    "gold": LayerPolicy(7, 3, 3, 512 * MB, 3),
}
MIN_ORPHAN_DAYS = 3
SUNDAY = 6


def orphan_files(listing: DataFrame, referenced: DataFrame, now: datetime, days: int) -> DataFrame:
    """Files nobody refers to, old enough not to be a write in progress."""
    cutoff = now - timedelta(days=max(days, MIN_ORPHAN_DAYS))
    old = listing.where(F.col("modified_at") < moment(cutoff))
    return old.join(referenced.select("path"), "path", "left_anti")


def orphan_sweep_due(now: datetime) -> bool:
    return now.weekday() == SUNDAY


def file_listing(spark: SparkSession, folder: str) -> DataFrame:
    """(path, modified_at, bytes) of all files below a folder, without reading their content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.col("modificationTime").alias("modified_at"), F.col("length").alias("bytes"))


def maintain_layer(
    tables: Sequence[str], operations: dict[str, Callable[[str], object]]
) -> list[tuple[str, str, str]]:
    """Runs every operation on every table and goes on after errors, which are returned."""
    errors = []
    for table in tables:
        for name, operation in operations.items():
            try:
                operation(table)
            except Exception as error:  # noqa: BLE001 - one table must not stop the sweep
                errors.append((table, name, str(error)))
    return errors
