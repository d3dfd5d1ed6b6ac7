"""Delimited files, archives and file-tolerant loads."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Members of a timetable archive and their columns.
GTFS_SCHEMAS = {
    "stops": "stop_id string, stop_code string, stop_name string, stop_desc string, stop_lon double, stop_lat double, "
    "zone_id string, stop_url string, location_type string, parent_station string, stop_timezone string, "
    "level_id string, wheelchair_boarding string, platform_code string",
    "stop_times": "trip_id string, arrival_time string, departure_time string, start_pickup_drop_off_window string, "
    "end_pickup_drop_off_window string, stop_id string, stop_sequence int, pickup_type int, drop_off_type int, "
    "local_zone_id string, stop_headsign string, timepoint int, pickup_booking_rule_id string, "
    "drop_off_booking_rule_id string",
    "trips": "route_id string, service_id string, trip_id string, trip_headsign string, trip_short_name string, "
    "direction_id int, block_id string, shape_id string, wheelchair_accessible int, bikes_allowed int",
    "routes": "route_id string, agency_id string, route_short_name string, route_long_name string, route_desc string, "
    "route_type int, route_url string, route_color string, route_text_color string, route_sort_order string",
    "calendar": "service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, "
    "sunday int, start_date string, end_date string",
    "calendar_dates": "service_id string, date string, exception_type int",
    "transfers": "from_stop_id string, to_stop_id string, transfer_type string, min_transfer_time string",
    "pathways": "pathway_id string, from_stop_id string, to_stop_id string, pathway_mode int, is_bidirectional int, "
    "length double, traversal_time int, stair_count int, max_slope double, min_width double, signposted_as string, "
    "reversed_signposted_as string",
}
DELIMITERS = ["\t", ";", ","]

VALIDATION_COLUMNS = [
    "JOUR",
    "CODE_STIF_TRNS",
    "CODE_STIF_RES",
    "CODE_STIF_ARRET",
    "LIBELLE_ARRET",
    "ID_REFA_LDA",
    "CATEGORIE_TITRE",
    "NB_VALD",
]
PROFILE_COLUMNS = [
    "CODE_STIF_TRNS",
    "CODE_STIF_RES",
    "CODE_STIF_ARRET",
    "LIBELLE_ARRET",
    "ID_REFA_LDA",
    "CAT_JOUR",
    "TRNC_HORR_60",
    "pourc_validations",
]
HEADER_SYNONYMS = {"lda": "ID_REFA_LDA", "ID_ZDC": "ID_REFA_LDA", "Pourcentage_validations": "pourc_validations"}


def read_gtfs(spark: SparkSession, folder: str, member: str) -> DataFrame:
    """One timetable member. Types are declared, so there is no inference pass over the data.

    Columns are matched to the file's own header by name; the file may lack or reorder some.
    """
    path = f"{folder.rstrip('/')}/{member}.txt"
    wanted = dict(part.strip().split(" ") for part in GTFS_SCHEMAS[member].split(","))
    header = spark.read.option("header", True).csv(path)
    names = [c.replace("﻿", "").strip() for c in header.columns]
    typed = header.toDF(*names)
    return typed.select(
        *[F.col(c).try_cast(t).alias(c) if c in names else F.lit(None).cast(t).alias(c) for c, t in wanted.items()]
    )


def read_open_csv(spark: SparkSession, path: str) -> DataFrame:
    """Open-data export: semicolons, quoted values that may hold delimiters and line breaks."""
    return spark.read.options(header=True, sep=";", quote='"', escape='"', multiLine=True).csv(path)


# --- delimiter sniffing and header repair ----------------------------------


def delimiter_of(line: Column) -> Column:
    """Most frequent of tab, semicolon, comma in a header line (in that order on a tie); NULL if none occurs."""
    counts = [F.length(line) - F.length(F.replace(line, F.lit(d))) for d in DELIMITERS]
    top = F.greatest(*counts)
    picked = F.coalesce(*[F.when(n == top, F.lit(d)) for d, n in zip(DELIMITERS, counts)])
    return F.when(top > 0, picked)


def layouts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, delimiter, header) per file, the header being its first line; NULL delimiter for none or text that is not UTF-8.

    The whole file is checked and the whole first line counted, on the executors.
    """
    files = spark.read.format("binaryFile").load(list(paths)).select("path", "content")
    text = F.try_validate_utf8(F.col("content").cast("string"))
    first = F.get(F.split(F.ltrim(text, F.lit("﻿")), r"\r\n|\r|\n", 2), F.lit(0))
    return files.select("path", delimiter_of(first).alias("delimiter"), first.alias("header"))


def sniff_delimiter(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, delimiter) per file."""
    return layouts(spark, paths).select("path", "delimiter")


def clean_header(name: str) -> str:
    """Header without byte order mark and replacement characters, blanks joined by underscores."""
    return re.sub(r"\s+", "_", name.replace("﻿", "").replace("�", "").strip())


def conform(df: DataFrame, expected: Sequence[str], synonyms: dict[str, str] | None = None) -> DataFrame | None:
    """Repaired header, known synonyms renamed, only the expected columns, all as text.

    None when the file was not split (a single column with delimiters in its name) or
    lacks an expected column.
    """
    df = df.toDF(*[clean_header(c) for c in df.columns])
    if len(df.columns) == 1 and any(d in df.columns[0] for d in DELIMITERS):
        return None
    for old, new in (synonyms or {}).items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    if not set(expected) <= set(df.columns):
        return None
    return df.select(*[F.col(c).cast("string").alias(c) for c in expected])


def load_tolerant(
    spark: SparkSession,
    paths: Sequence[str],
    expected: Sequence[str],
    synonyms: dict[str, str] | None = None,
    reader: Callable[[SparkSession, list[str], str], DataFrame] | None = None,
) -> tuple[DataFrame | None, DataFrame]:
    """(rows of all good files, rejected (path, reason)); a bad file never stops the load.

    Files of one delimiter and header are read together, so jobs and plans are as many as
    layouts, not files; the driver has one small row a file.
    """
    read = reader or (lambda s, p, d: s.read.options(header=True, sep=d).csv(p))
    good, bad = [], []
    groups = layouts(spark, paths).groupBy("delimiter", "header").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    for row in sorted(groups.collect(), key=lambda r: r.paths[0]):
        if row.delimiter is None:
            bad += [(path, "encoding or delimiter") for path in row.paths]
            continue
        try:
            fitted = conform(read(spark, row.paths, row.delimiter), expected, synonyms)
        except Exception as error:  # noqa: BLE001 - any reader failure rejects these files only
            bad += [(path, type(error).__name__) for path in row.paths]
            continue
        if fitted is None:
            bad += [(path, "columns") for path in row.paths]
        else:
            good.append(fitted)
    rejected = spark.createDataFrame(bad, "path string, reason string")
    return (reduce(DataFrame.unionByName, good) if good else None), rejected


# --- archives --------------------------------------------------------------


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of the text members of each archive, in chunks so a large member never sits in memory whole."""
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for info in archive.infolist():
                    if info.is_dir() or not info.filename.endswith(".txt"):
                        continue
                    with archive.open(info) as raw:
                        lines, first = [], 0
                        for number, line in enumerate(io.TextIOWrapper(raw, encoding="utf-8", errors="replace", newline="")):
                            lines.append(line.rstrip("\r\n"))
                            if len(lines) == 20000:
                                yield _chunk(path, info.filename, first, lines)
                                lines, first = [], number + 1
                        if lines:
                            yield _chunk(path, info.filename, first, lines)


def _chunk(path: str, member: str, first: int, lines: list[str]) -> pd.DataFrame:
    return pd.DataFrame(
        {"archive": path, "member": member, "line_no": range(first, first + len(lines)), "line": lines}
    )


def unzip_members(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, line_no, line) of the .txt members of zip archives, one task per archive."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(_members, "archive string, member string, line_no long, line string")
