"""Registry of queries and assembly of their SQL from shared table expressions."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Builders of the tables that queries share, in the order in which they build on each other.
STORED: list[Callable] = []

# Named table expressions shared by the SQL counterparts; later ones may use earlier ones.
VIEWS: dict[str, str] = {}


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql.strip()


def _needed(sql: str, found: set[str]) -> set[str]:
    for word in set(re.findall(r"\bv_\w+", sql)):
        if word in VIEWS and word not in found:
            found.add(word)
            _needed(VIEWS[word], found)
    return found


def with_views(sql: str) -> str:
    """The query with the table expressions it names, whether or not it has its own."""
    used = _needed(sql, set())
    ctes = [f"{name} AS (\n{body}\n)" for name, body in VIEWS.items() if name in used]
    sql = sql.strip()
    if not ctes:
        return sql
    head = "WITH " + ",\n".join(ctes)
    return f"{head},\n{sql[5:]}" if sql.startswith("WITH ") else f"{head}\n{sql}"


class Tables:
    """The given parquet tables of one scale factor.

    A table is opened once per application: opening reads file footers in a small job.
    """

    _opened: dict[tuple[str, str], DataFrame] = {}

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        key = (self.spark.sparkContext.applicationId, path)
        if key not in self._opened:
            df = self.spark.read.parquet(path)
            # Stored stamps carry no zone; with the session pinned to UTC the cast keeps them.
            casts = {c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"}
            self._opened[key] = df.withColumns(casts) if casts else df
        return self._opened[key]


def shared(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Builds a feed's or table's plan once per application and folder.

    Frames are lazy, so this shares plans and not data; queries that use one frame in
    several places also give Spark equal exchanges to reuse.
    """

    @functools.wraps(build)
    def get(t: Tables) -> DataFrame:
        key = (t.spark.sparkContext.applicationId, f"{t.folder}#{build.__name__}")
        if key not in Tables._opened:
            Tables._opened[key] = build(t)
        return Tables._opened[key]

    return get


def stored(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """A silver or gold table as the jobs leave it: written once, then read by its users.

    The table goes to the shared folder, once per application and data folder. Queries
    over it plan against a scan instead of the whole chain from the raw feeds, and lost
    executors cost no recomputation of that chain. ``plan`` is the unwritten table.
    """
    plan = shared(build)

    @functools.wraps(build)
    def get(t: Tables) -> DataFrame:
        app = t.spark.sparkContext.applicationId
        key = (app, f"{t.folder}@{build.__name__}")
        if key not in Tables._opened:
            place = hashlib.sha1(t.folder.encode()).hexdigest()[:12]
            path = f"{shared_folder(t.spark)}/headway/{app}/{place}/{build.__name__}"
            plan(t).write.mode("overwrite").parquet(path)
            Tables._opened[key] = t.spark.read.parquet(path)
        return Tables._opened[key]

    get.plan = plan
    STORED.append(get)
    return get


def query(name: str, sql: str | None = None):
    """Registers a builder Tables -> DataFrame, with its SQL if it has any."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = build(Tables(spark, folder))
            stamps = {c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"}
            return df.withColumns(stamps) if stamps else df

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def oracle_texts() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in ORACLE.items()}
