"""Session settings shared by tests, the bench and jobs."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "headway", cores: str | int = "*", **conf: str) -> SparkSession:
    """A session; where none was submitted, a local one for tests and benches.

    A submitted application brings its master, and with it memory and partition counts,
    which are then left alone; only the time zone, on which results depend, is always set.
    """
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    if not SparkConf().contains("spark.master"):
        builder = (
            builder.master(f"local[{cores}]")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
            .config("spark.sql.shuffle.partitions", "8")
        )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


_fallback: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and written tables.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a local master
    gets a fresh local folder, one per application; any other is refused, for its
    executors would write to disks of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        app = spark.sparkContext.applicationId
        if app not in _fallback:
            _fallback[app] = tempfile.mkdtemp(prefix="headway-shared-")
        folder = _fallback[app]
    return folder.rstrip("/")


def settled(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: a loop's next round reads them and doesn't compute them again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/headway/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
