"""Broker records to bronze envelopes, and streams over stored tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from headway.sources import feeds

# Trigger interval and per-batch file limit of all streams.
TRIGGER = "60 seconds"
FILES_PER_BATCH = 100

BRONZE = (
    "event_id string, payload_type string, source string, fetched_at string, event_date string, "
    "batch_time timestamp, raw_json string, processing_time timestamp, batch_date date"
)


def kafka_source(
    spark: SparkSession, servers: str, topic: str, offsets: str = "latest", group_prefix: str | None = None
) -> DataFrame:
    """Records of a topic. Offsets lost to retention do not stop the stream."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", offsets)
        .option("failOnDataLoss", "false")
    )
    return (reader.option("groupIdPrefix", group_prefix) if group_prefix else reader).load()


def file_source(spark: SparkSession, folder: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Text files of one record per line with the broker's value column."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).load(folder)
    return lines.select(F.col("value").cast("binary").alias("value"))


def table_stream(spark: SparkSession, folder: str, schema: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """New files of a parquet folder as a stream, a bounded number per batch.

    A repeated batch upstream replaces its files; the replaced ones are skipped and the
    new ones read, which state by key downstream absorbs.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.option("ignoreMissingFiles", True).parquet(folder)


def bronze_rows(records: DataFrame) -> DataFrame:
    """Well-formed and malformed records in one typed frame; the latter have no event id."""
    return feeds.decode_envelope(records).withColumns(
        {"processing_time": F.current_timestamp(), "batch_date": F.to_date("batch_time")}
    )


def _trigger(writer, once: bool):
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=TRIGGER)


def stream_append(df: DataFrame, folder: str, checkpoint: str, partition: str | None, once: bool = False) -> StreamingQuery:
    """Appends a stream to a parquet folder; the checkpoint makes restarts exact."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", folder)
    return _trigger(writer.partitionBy(partition) if partition else writer, once).start()


def stream_apply(
    df: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Runs a function on every non-empty micro-batch."""

    def guarded(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            apply(batch, batch_id)

    return _trigger(df.writeStream.foreachBatch(guarded).option("checkpointLocation", checkpoint), once).start()


def start_bronze(
    records: DataFrame, folder: str, quarantine: str, checkpoint: str, once: bool = False
) -> list[StreamingQuery]:
    """Broker records to the bronze table by day, malformed ones to a quarantine folder.

    Two queries with a checkpoint each; the sink's own log makes both exactly-once.
    """
    rows = bronze_rows(records)
    return [
        stream_append(feeds.well_formed(rows), folder, f"{checkpoint}/bronze", "batch_date", once),
        stream_append(feeds.quarantined(rows), quarantine, f"{checkpoint}/quarantine", None, once),
    ]


def write_batch(rows: DataFrame, folder: str, batch_id: int) -> None:
    """A micro-batch's rows as a partition of their own, which a repeat of the batch replaces."""
    writer = rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch_id").parquet(folder)


def read_log(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A folder that a stream appends to: complete files only, by the sink's own log."""
    return spark.read.schema(schema).parquet(folder)
