"""Disruption messages, feeds and JSON operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions import text
from headway.functions.measures import sorted_set
from headway.plans import analytics, silver
from headway.queries import adapters as a
from headway.queries.registry import Tables, query
from headway.sources import feeds, files


@query("disruption_messages", "SELECT * FROM v_messages")
def disruption_messages(t: Tables) -> DataFrame:
    return silver.disruption_messages(a.disruptions(t))


@query("disruption_stops", "SELECT * FROM v_dis_stops")
def disruption_stops(t: Tables) -> DataFrame:
    return silver.disruption_stops(a.disruptions(t))


@query("disruption_periods", "SELECT * FROM v_dis_periods")
def disruption_periods(t: Tables) -> DataFrame:
    return silver.disruption_periods(a.disruptions(t))


_LINES = "array_to_string(impacted_lines, ',') AS impacted_lines"


@query("disruptions_active", f"SELECT * EXCLUDE (impacted_lines), {_LINES} FROM v_active")
def disruptions_active(t: Tables) -> DataFrame:
    return a.active.plan(t).withColumn("impacted_lines", F.array_join("impacted_lines", ","))


@query(
    "disruptions_by_line",
    "SELECT line_id, day, nb_disruptions, array_to_string(severities, ',') AS severities FROM v_by_line",
)
def disruptions_by_line(t: Tables) -> DataFrame:
    return a.by_line.plan(t).withColumn("severities", F.array_join("severities", ","))


def _iso(column: str) -> str:
    return f"strftime(v_active.{column}, '%Y-%m-%dT%H:%M:%S') AS {column}"


@query(
    "active_disruptions",
    f"""
SELECT id, cause, severity, title, short_message, message, coalesce(array_to_string(impacted_lines, ','), '') AS impacted_lines,
       {_iso('begin_time')}, {_iso('end_time')}, {_iso('last_update')}, {_iso('batch_time')}
FROM v_active
WHERE is_active AND (contains(upper(coalesce(title, '')), 'WORKS') OR contains(upper(coalesce(short_message, '')), 'WORKS')
      OR contains(upper(coalesce(message, '')), 'WORKS'))
ORDER BY v_active.last_update DESC NULLS LAST, id LIMIT 100
""",
)
def active_disruptions(t: Tables) -> DataFrame:
    rows = analytics.active_disruptions(a.active(t), search="works")
    return rows.withColumn("impacted_lines", F.array_join("impacted_lines", ","))


@query(
    "array_any_match",
    "SELECT id, coalesce(list_contains(impacted_lines, 'C5'), FALSE) AS hits FROM v_active",
)
def array_any_match(t: Tables) -> DataFrame:
    """Some impacted line equals the term; a missing list has none."""
    return a.active(t).select("id", text.any_item_equals("impacted_lines", " c5").alias("hits"))


@query(
    "disruption_history",
    """
SELECT line_id, strftime(day, '%Y-%m-%d') AS date, nb_disruptions AS disruptions, array_to_string(severities, ',') AS severities
FROM v_by_line WHERE contains(line_id, 'C1') AND day >= DATE '2024-01-10'
ORDER BY day DESC, nb_disruptions DESC, line_id LIMIT 100
""",
)
def disruption_history(t: Tables) -> DataFrame:
    rows = analytics.disruption_history(a.by_line(t), line="c1", date_from="2024-01-10")
    return rows.withColumn("severities", F.array_join("severities", ","))


@query(
    "agg_collect_set",
    "SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds FROM events GROUP BY user_id",
)
def agg_collect_set(t: Tables) -> DataFrame:
    kinds = t.events.groupBy("user_id").agg(sorted_set("event_type").alias("kinds"))
    return kinds.withColumn("kinds", F.array_join("kinds", ","))


@query(
    "json_flatten",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS missing FROM events",
)
def json_flatten(t: Tables) -> DataFrame:
    """JSON text to typed columns; absent members are NULL."""
    raw = feeds.parse_once(t.events, "props", "k long, missing string", "event_id")
    return raw.select("event_id", "raw.k", "raw.missing")


@query(
    "json_explode",
    """
SELECT 'D'||user_id AS id, ts AS batch_time, lineId AS line_ref, pos
FROM (SELECT user_id, ts, 'line:X:C'||(user_id % 27) AS lineId, 0 AS pos FROM events
      UNION ALL
      SELECT user_id, ts, CASE WHEN event_id % 4 <> 0 THEN 'line:X:C'||((user_id + 5) % 27) END, 1 FROM events)
""",
)
def json_explode(t: Tables) -> DataFrame:
    """Nested arrays to rows, keeping messages without items."""
    parsed = silver.parse_disruptions(a.raw_disruptions(t))
    rows = parsed.select("id", "batch_time", F.posexplode_outer("impacted_sections").alias("pos", "section"))
    return rows.select("id", "batch_time", F.col("section.lineId").alias("line_ref"), "pos")


@query(
    "json_map_explode",
    "SELECT event_id, 'k' AS date, json_extract_string(props, '$.k') AS libelle FROM events",
)
def json_map_explode(t: Tables) -> DataFrame:
    return feeds.json_map_to_rows(t.events.select("event_id", "props"), "props")


@query(
    "json_list_explode",
    """
SELECT o_orderkey, 'Zone C' AS zones, strftime(o_orderdate, '%Y-%m-%d') AS start_date, CAST(NULL AS VARCHAR) AS location FROM orders
UNION ALL
SELECT o_orderkey, CAST(o_custkey AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d'), o_orderstatus FROM orders
""",
)
def json_list_explode(t: Tables) -> DataFrame:
    """A JSON array of records to rows; numbers come out as text, absent members as NULL."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    lists = t.orders.select(
        "o_orderkey",
        a.cat(
            '[{"zones":"Zone C","start_date":"', day, '"},{"zones":', a.txt("o_custkey"), ',"start_date":"', day,
            '","location":"', F.col("o_orderstatus"), '"}]',
        ).alias("payload"),
    )
    return feeds.json_list_to_rows(lists, "payload", ["zones", "start_date", "location"])


def _journeys(t: Tables) -> DataFrame:
    """Events as polled payloads: nested journeys as list or single object, or an unknown layout."""
    e = F.col("event_id")
    journey = lambda n: a.cat('{"DatedVehicleJourneyRef":{"value":"J', a.txt(e * 2 + n), '"},"n":', a.txt(e), "}")
    many = a.cat("[", journey(0), ",", journey(1), "]")
    frame = lambda inner: a.cat('{"EstimatedVehicleJourney":', inner, "}")
    body = (
        F.when(e % 4 == 0, a.cat('[{"EstimatedJourneyVersionFrame":[', frame(many), "]}]"))
        .when(e % 4 == 1, a.cat('{"EstimatedJourneyVersionFrame":', frame(journey(0)), "}"))
        .when(e % 4 == 2, a.cat('[{"EstimatedJourneyVersionFrame":', frame(many), '},{"EstimatedJourneyVersionFrame":[]}]'))
    )
    siri = a.cat('{"Siri":{"ServiceDelivery":{"EstimatedTimetableDelivery":', body, "}}}")
    return t.events.select("event_id", F.col("ts").alias("fetched_at"), F.coalesce(siri, F.col("props")).alias("payload"))


_ITEMS = """
SELECT event_id, ts, 'estimated_vehicle_journey' AS payload_type, 'J'||(event_id * 2 + n) AS ref,
       '{"DatedVehicleJourneyRef":{"value":"J'||(event_id * 2 + n)||'"},"n":'||event_id||'}' AS raw_json
FROM events, (VALUES (0), (1)) AS s(n) WHERE event_id % 4 IN (0, 2) OR (event_id % 4 = 1 AND n = 0)
UNION ALL
SELECT event_id, ts, 'raw_payload', NULL, replace(props, ' ', '') FROM events WHERE event_id % 4 = 3
"""


@query("feed_explode", f"SELECT event_id, payload_type, raw_json FROM ({_ITEMS})")
def feed_explode(t: Tables) -> DataFrame:
    """Payloads to one row per item, whether levels hold a list or a single object."""
    return feeds.explode_feed(_journeys(t), "passages").select("event_id", "payload_type", "raw_json")


@query(
    "event_envelope",
    f"""
SELECT coalesce(ref, sha1(raw_json)) AS event_id, payload_type, 'poll' AS source,
       strftime(ts, '%Y-%m-%dT%H:%M:%S')||'Z' AS fetched_at, strftime(ts, '%Y-%m-%d') AS event_date,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS batch_time, raw_json
FROM ({_ITEMS})
""",
)
def event_envelope(t: Tables) -> DataFrame:
    """Envelope rows with the item's own id, or its SHA-1 where it has none."""
    return feeds.event_envelope(feeds.explode_feed(_journeys(t), "passages"), feeds.PASSAGE_ID_KEYS, "poll")


@query(
    "sniff_delimiter",
    """
SELECT doc_id, CASE WHEN greatest(tabs, semis, commas) = 0 THEN NULL
                    WHEN tabs = greatest(tabs, semis, commas) THEN 'tab'
                    WHEN semis = greatest(tabs, semis, commas) THEN 'semicolon' ELSE 'comma' END AS delimiter
FROM (SELECT doc_id, len(first) - len(replace(first, chr(9), '')) AS tabs, len(first) - len(replace(first, ';', '')) AS semis,
             len(first) - len(replace(first, ',', '')) AS commas
      FROM (SELECT doc_id, split_part(replace(replace(text, ' the ', ';'), ' de ', chr(9)), chr(10), 1) AS first FROM documents))
""",
)
def sniff_delimiter(t: Tables) -> DataFrame:
    """Most frequent delimiter of each text's first line; some words stand in for delimiters."""
    line = F.substring_index(F.replace(F.replace("text", F.lit(" the "), F.lit(";")), F.lit(" de "), F.lit("\t")), "\n", 1)
    found = files.delimiter_of(F.col("line"))
    names = F.when(found == "\t", "tab").when(found == ";", "semicolon").when(found == ",", "comma")
    return t.documents.select("doc_id", line.alias("line")).select("doc_id", names.alias("delimiter"))


@query(
    "conform_header",
    """
SELECT CAST(o_orderdate AS DATE)::VARCHAR AS "JOUR", CAST(o_custkey AS VARCHAR) AS "CODE_STIF_ARRET",
       CAST(o_orderkey AS VARCHAR) AS "ID_REFA_LDA", o_orderpriority AS "CATEGORIE_TITRE"
FROM orders
""",
)
def conform_header(t: Tables) -> DataFrame:
    """Headers with a byte order mark, blanks and a synonym repaired; extra columns dropped, all text."""
    odd = t.orders.select(
        F.to_date("o_orderdate").alias("﻿JOUR"),
        F.col("o_custkey").alias(" CODE STIF ARRET "),
        F.col("o_orderkey").alias("lda"),
        F.col("o_orderpriority").alias("CATEGORIE�_TITRE"),
        F.col("o_orderstatus").alias("extra"),
    )
    expected = ["JOUR", "CODE_STIF_ARRET", "ID_REFA_LDA", "CATEGORIE_TITRE"]
    return files.conform(odd, expected, files.HEADER_SYNONYMS)
