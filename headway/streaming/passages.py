"""Passage streams: bronze envelopes to changes of the silver table, changes to three gold tables.

The silver stream keeps each passage's newest version in its state and appends what changes. One stream of
changes feeds the schedule and the delay log, another the statistics of a line at a stop, whose
counts follow a passage that moves to another line. No stream reads a table again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.plans import gold, silver
from headway.streaming import keyed
from headway.streaming.ingest import read_log, write_batch

KEYS = silver.SILVER_KEYS["next_stop"]

SILVER_SCHEMA = (
    "journey_ref string, stop_point_ref string, line_ref string, published_line string, direction string, "
    "destination_ref string, destination_name string, aimed_arrival timestamp, expected_arrival timestamp, "
    "aimed_departure timestamp, expected_departure timestamp, arrival_status string, departure_status string, "
    "recorded_at timestamp, batch_time timestamp, arrival_delay_sec long, departure_delay_sec long"
)
CHANGES = f"sign int, {SILVER_SCHEMA}"


def silver_changes(bronze: DataFrame, kept: str = keyed.KEPT) -> DataFrame:
    """Changes of the silver table by bronze rows (raw_json, batch_time), for silver/next_stop."""
    calls = silver.passage_calls(silver.parse_passages(bronze))
    return keyed.changes(calls, KEYS, "batch_time", ["recorded_at", "aimed_arrival", "expected_arrival", "expected_departure"], kept)


def passages(spark: SparkSession, root: str) -> DataFrame:
    """The silver table: the newest version of every passage."""
    return keyed.standing(read_log(spark, f"{root}/silver/next_stop", CHANGES), KEYS, "batch_time")


GOLD = {"next_stop_schedule": gold.next_stop_schedule, "next_stop_delays": gold.next_stop_delays}


def gold_batch(root: str) -> Callable[[DataFrame, int], None]:
    """One batch of changes, read once, into the schedule's versions and the log of delays."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        new = batch.where("sign = 1").drop("sign").persist()
        for table, build in GOLD.items():
            write_batch(build(new), f"{root}/gold/{table}", batch_id)
        new.unpersist()

    return apply


def schedule(spark: SparkSession, root: str) -> DataFrame:
    """Newest version of every passage in the schedule."""
    log = spark.read.parquet(f"{root}/gold/next_stop_schedule").drop("batch_id")
    return keyed.latest_per_key(log, KEYS, [F.desc("batch_time")])


def delays(spark: SparkSession, root: str) -> DataFrame:
    """Every version of a passage that was late."""
    return spark.read.parquet(f"{root}/gold/next_stop_delays").drop("batch_id")


COUNTS = "stop_point_ref string, line_ref string, published_line string, n long, late long, seconds long, most long, revision long"


def delay_statistics(signed: DataFrame, threshold: int = gold.DELAY_THRESHOLD_SEC) -> DataFrame:
    """Delay counts of the lines and stops that changes touch, for gold/delays_by_stop."""
    return keyed.delay_counts(signed, gold.LINE_AT_STOP, "arrival_delay_sec", threshold)


def delays_by_stop(spark: SparkSession, root: str) -> DataFrame:
    """The statistics as they stand; a line that has lost all its passages at a stop has none."""
    last = keyed.last_revision(read_log(spark, f"{root}/gold/delays_by_stop", COUNTS), gold.LINE_AT_STOP).where("n > 0")
    return gold.delay_measures(last)
