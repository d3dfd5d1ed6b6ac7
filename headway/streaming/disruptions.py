"""Disruption streams: bronze envelopes to changes of three silver tables, changes to two gold tables.

Each silver stream keeps the newest version of a message, section or period in its state. The active
table's state holds a disruption's message, periods and lines together; the day counts of a line hold the
disruptions and severities that stand. Neither reads a stored table again.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from headway.functions.clock import moment
from headway.plans import gold, silver
from headway.streaming import keyed
from headway.streaming.ingest import read_log

TABLES = {
    "disruption_messages": silver.disruption_messages,
    "disruption_stops": silver.section_rows,
    "disruption_periods": silver.period_rows,
}
SCHEMAS = {
    "disruption_messages": "sign int, id string, cause string, severity string, title string, short_message string, message string, last_update timestamp, batch_time timestamp",
    "disruption_stops": "sign int, id string, line_id string, from_id string, from_name string, to_id string, to_name string, title string, severity string, batch_time timestamp",
    "disruption_periods": "sign int, id string, title string, severity string, begin_time timestamp, end_time timestamp, batch_time timestamp",
}
KEEP_MS = 90 * 24 * 3600 * 1000


def silver_changes(bronze: DataFrame, table: str, kept: str = keyed.KEPT) -> DataFrame:
    """Changes of one silver table by bronze rows (raw_json, batch_time)."""
    order = ["last_update"] if table == "disruption_messages" else []
    return keyed.changes(TABLES[table](silver.parse_disruptions(bronze)), silver.SILVER_KEYS[table], "batch_time", order, kept)


def silver_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A silver table: the newest version of each of its rows."""
    return keyed.standing(read_log(spark, f"{root}/silver/{table}", SCHEMAS[table]), silver.SILVER_KEYS[table], "batch_time")


class Disruption(StatefulProcessor):
    """A disruption's message, and how often each of its periods and lines stands."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.message = handle.getValueState("message", "payload string, revision long")
        self.parts = {kind: handle.getMapState(kind, "value string", "n long") for kind in ("period", "line")}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        payload, revision = self.message.get() or (None, 0)
        for some in rows:
            told = some[(some["kind"] == "message") & (some["sign"] == 1)]
            payload = max(told["payload"], key=lambda p: p[: p.index(" ")]) if len(told) else payload
            for kind, counts in self.parts.items():
                for value, change in keyed._net(iter([some[some["kind"] == kind]]), "payload").items():
                    keyed._add(counts, value, change)
        self.message.update((payload, revision + 1))
        if payload is not None:
            parts = [sorted(k[0] for k in counts.keys()) for counts in self.parts.values()]
            yield pd.DataFrame([[key[0], payload[payload.index(" ") + 1 :], *parts, revision + 1]], columns=["id", "message", "periods", "lines", "revision"])

    def close(self) -> None:
        pass


_PERIOD = "begin_time timestamp, end_time timestamp"
ACTIVE = (
    "id string, cause string, severity string, title string, short_message string, message string, begin_time timestamp, end_time timestamp, "
    f"last_update timestamp, impacted_lines array<string>, batch_time timestamp, periods array<struct<begin_time: timestamp, end_time: timestamp>>, revision long"
)


def active_disruptions(messages: DataFrame, stops: DataFrame, periods: DataFrame) -> DataFrame:
    """Disruptions that changes of their messages, sections or periods touch, with all their periods, for gold/disruptions_active."""
    keyed.use_state_store(messages.sparkSession)
    columns = [c for c in messages.columns if c != "sign"]
    stamp = F.date_format("batch_time", "yyyyMMddHHmmssSSSSSS")
    told = F.concat_ws(" ", stamp, F.to_json(F.struct(*columns), keyed.JSON))
    parts = [(messages, "message", told), (stops.where("line_id IS NOT NULL"), "line", F.col("line_id")), (periods, "period", F.to_json(F.struct("begin_time", "end_time"), keyed.JSON))]
    every = [df.select("id", F.lit(kind).alias("kind"), payload.alias("payload"), "sign") for df, kind, payload in parts]
    both = every[0].unionByName(every[1]).unionByName(every[2])
    found = both.groupBy("id").transformWithStateInPandas(Disruption(), "id string, message string, periods array<string>, lines array<string>, revision long", "Append", "None")
    message = F.from_json("message", messages.schema, keyed.JSON).alias("m")
    times = F.transform("periods", lambda p: F.from_json(p, _PERIOD, keyed.JSON)).alias("periods")
    typed = found.select("id", message, times, F.when(F.size("lines") > 0, F.col("lines")).alias("impacted_lines"), "revision")
    return typed.select(
        *[F.col(f"m.{c}") for c in gold.MESSAGE_TEXT],
        F.array_min(F.col("periods.begin_time")).alias("begin_time"),
        F.array_max(F.col("periods.end_time")).alias("end_time"),
        "m.last_update",
        "impacted_lines",
        "m.batch_time",
        "periods",
        "revision",
    )


def active_at(spark: SparkSession, root: str, at: datetime) -> DataFrame:
    """All stored disruptions and whether they run at a moment, by their periods; null for those without one."""
    now = moment(at)
    last = keyed.last_revision(read_log(spark, f"{root}/gold/disruptions_active", ACTIVE), ["id"])
    running = F.exists("periods", lambda p: F.coalesce(now.between(p["begin_time"], p["end_time"]), F.lit(False)))
    return last.withColumn("is_active", F.when(F.size("periods") > 0, running)).drop("periods")


def active_now(spark: SparkSession, root: str, at: datetime) -> DataFrame:
    """The stored disruptions that run at a moment."""
    return active_at(spark, root, at).where("is_active")


BY_LINE = "line_id string, day date, id array<string>, severity array<string>, revision long"


def line_days(stops: DataFrame, keep_ms: int = KEEP_MS) -> DataFrame:
    """Disruptions and severities of the lines and days that changes of sections touch, for gold/disruptions_by_line."""
    dated = stops.where("line_id IS NOT NULL").withColumn("day", F.to_date("batch_time"))
    return keyed.value_sets(dated, ["line_id", "day"], ["id", "severity"], keep_ms)


def disruptions_by_line(spark: SparkSession, root: str) -> DataFrame:
    """The day counts as they stand."""
    last = keyed.last_revision(read_log(spark, f"{root}/gold/disruptions_by_line", BY_LINE), ["line_id", "day"])
    return last.where(F.size("id") > 0).select("line_id", "day", F.size("id").cast("long").alias("nb_disruptions"), F.col("severity").alias("severities"))
