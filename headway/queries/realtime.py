"""Passages, delays, keyed merges and streams' batch twins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions import clock
from headway.functions.measures import count_where, percent, weighted_mean
from headway.operators.merge import merge_insert_new, merge_upsert, merge_versioned
from headway.operators.ranking import arg_max, min_per_key, page, top_n_per_group, with_minmax
from headway.plans import analytics, gold, silver
from headway.queries import adapters as a
from headway.queries.registry import Tables, query, view
from headway.sources import feeds


@query("next_stop_calls", "SELECT * FROM v_calls")
def next_stop_calls(t: Tables) -> DataFrame:
    """Journey messages to one row per call, with both delays."""
    return a.calls(t)


@query("latest_per_key", "SELECT * FROM v_passages")
def latest_per_key(t: Tables) -> DataFrame:
    return a.passages.plan(t)


@query("next_stop_schedule", "SELECT * EXCLUDE (destination_ref, arrival_delay_sec, departure_delay_sec) FROM v_passages")
def next_stop_schedule(t: Tables) -> DataFrame:
    return gold.next_stop_schedule(a.passages(t))


@query(
    "delayed_passages",
    "SELECT * EXCLUDE (destination_ref, recorded_at) FROM v_passages WHERE arrival_delay_sec >= 60 OR departure_delay_sec >= 60",
)
def delayed_passages(t: Tables) -> DataFrame:
    return gold.next_stop_delays(a.passages(t))


@query("delays_by_stop", "SELECT * FROM v_delays_by_stop")
def delays_by_stop(t: Tables) -> DataFrame:
    return a.delays_by_stop.plan(t)


_PUNCTUALITY = """
CAST(sum(nb_passages) AS BIGINT) AS passages, CAST(sum(nb_delayed) AS BIGINT) AS delayed_passages,
round(sum(CAST(round(avg_arrival_delay_sec * 10) AS BIGINT) * nb_passages) / 10.0::DOUBLE / sum(nb_passages), 1) AS avg_arrival_delay_sec,
max(max_arrival_delay_sec) AS max_arrival_delay_sec,
round(100 * (1 - CAST(sum(nb_delayed) AS DOUBLE) / sum(nb_passages)), 1) AS on_time_pct
"""


@query(
    "delays_summary",
    f"""
SELECT count(DISTINCT stop_point_ref) AS stops, count(DISTINCT coalesce(published_line, line_ref)) AS lines, {_PUNCTUALITY}
FROM v_delays_by_stop
""",
)
def delays_summary(t: Tables) -> DataFrame:
    return analytics.delays_summary(a.delays_by_stop(t))


@query(
    "delays_by_line",
    f"""
SELECT line_ref, published_line, count(DISTINCT stop_point_ref) AS stops, {_PUNCTUALITY}
FROM v_delays_by_stop GROUP BY line_ref, published_line
ORDER BY on_time_pct NULLS FIRST, passages DESC, line_ref NULLS LAST, published_line NULLS LAST LIMIT 100
""",
)
def delays_by_line(t: Tables) -> DataFrame:
    return analytics.delays_by_line(a.delays_by_stop(t))


@query(
    "recent_delays",
    f"""
SELECT journey_ref, stop_point_ref, line_ref, published_line, direction, destination_name,
       strftime(aimed_arrival, '%Y-%m-%dT%H:%M:%S') AS aimed_arrival,
       strftime(expected_arrival, '%Y-%m-%dT%H:%M:%S') AS expected_arrival, arrival_delay_sec, departure_delay_sec,
       arrival_status, departure_status, strftime(batch_time, '%Y-%m-%dT%H:%M:%S') AS batch_time
FROM v_passages
WHERE greatest(coalesce(arrival_delay_sec, 0), coalesce(departure_delay_sec, 0)) >= 90
  AND (contains(upper(published_line), 'L1') OR contains(upper(line_ref), 'L1'))
  AND v_passages.batch_time >= {a.AS_OF_SQL} - INTERVAL 72 HOUR
ORDER BY v_passages.batch_time DESC, greatest(coalesce(arrival_delay_sec, 0), coalesce(departure_delay_sec, 0)) DESC,
         journey_ref, stop_point_ref LIMIT 100
""",
)
def recent_delays(t: Tables) -> DataFrame:
    late = gold.next_stop_delays(a.passages(t))
    return analytics.recent_delays(late, a.AS_OF, line="l1", min_delay_sec=90, since_hours=72)


view(
    "v_features",
    """
SELECT n.journey_ref, n.stop_point_ref, n.line_ref, n.published_line, n.direction, CAST(n.aimed_arrival AS DATE) AS service_date,
       CAST(hour(n.aimed_arrival) AS INTEGER) AS hour, c.day_of_week, c.is_weekend, c.is_holiday, c.is_school_holiday, c.cat_jour,
       h.avg_arrival_delay_sec AS hist_avg_arrival_delay_sec, h.pct_on_time AS hist_pct_on_time, n.arrival_delay_sec,
       n.arrival_delay_sec >= 60 AS is_delayed
FROM v_passages n LEFT JOIN v_calendar c ON CAST(n.aimed_arrival AS DATE) = c.date
LEFT JOIN v_delays_by_stop h ON n.stop_point_ref = h.stop_point_ref AND n.line_ref IS NOT DISTINCT FROM h.line_ref
      AND n.published_line IS NOT DISTINCT FROM h.published_line
WHERE n.arrival_delay_sec IS NOT NULL AND n.aimed_arrival IS NOT NULL
""",
)


def features(t: Tables) -> DataFrame:
    return gold.next_stop_features(a.passages(t), a.calendar(t), a.delays_by_stop(t))


@query("delay_features", "SELECT * FROM v_features")
def delay_features(t: Tables) -> DataFrame:
    return features(t)


@query(
    "join_null_safe",
    """
SELECT p.journey_ref, p.stop_point_ref, p.line_ref, h.nb_passages
FROM v_passages p JOIN v_delays_by_stop h ON p.stop_point_ref = h.stop_point_ref
     AND p.line_ref IS NOT DISTINCT FROM h.line_ref AND p.published_line IS NOT DISTINCT FROM h.published_line
""",
)
def join_null_safe(t: Tables) -> DataFrame:
    """Lines match even where both are unknown; the join still hashes on the key."""
    p, h = a.passages(t).alias("p"), a.delays_by_stop(t).alias("h")
    same = F.lit(True)
    for c in ("stop_point_ref", "line_ref", "published_line"):
        same = same & F.col(f"p.{c}").eqNullSafe(F.col(f"h.{c}"))
    return p.join(h, same).select("p.journey_ref", "p.stop_point_ref", "p.line_ref", "h.nb_passages")


@query(
    "stream_envelope",
    """
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS payload_type, 'events' AS source,
       strftime(ts, '%Y-%m-%dT%H:%M:%S')||'Z' AS fetched_at, strftime(ts, '%Y-%m-%d') AS event_date,
       date_trunc('second', ts) AS batch_time, props AS raw_json
FROM events
""",
)
def stream_envelope(t: Tables) -> DataFrame:
    """Batch twin of the broker decode: bytes to envelope to typed columns."""
    ts = F.col("ts")
    envelope = F.struct(
        a.txt("event_id").alias("event_id"),
        F.col("event_type").alias("payload_type"),
        F.lit("events").alias("source"),
        a.cat(a.iso(ts), "Z").alias("fetched_at"),
        F.date_format(ts, "yyyy-MM-dd").alias("event_date"),
        F.date_format(ts, clock.STAMP_FORMAT).alias("batch_time"),
        F.col("props").alias("raw_json"),
    )
    records = t.events.select(F.to_json(envelope).cast("binary").alias("value"))
    return feeds.well_formed(feeds.decode_envelope(records))


# --- merges ----------------------------------------------------------------

KEYS = ["journey_ref", "stop_point_ref"]


def _between(t: Tables, first: int, last: int) -> DataFrame:
    """Latest passages among the calls of some days of the month."""
    day = F.col("batch_time")
    part = a.calls(t).where((day >= clock.moment(datetime(2024, 1, first))) & (day < clock.moment(datetime(2024, 1, last))))
    return silver.latest_passages(part)


def _sql_between(first: int, last: int) -> str:
    return (
        f"(SELECT * EXCLUDE (rn) FROM (SELECT *, {a.LATEST_CALL} AS rn FROM v_calls WHERE batch_time >= "
        f"TIMESTAMP '2024-01-{first:02d}' AND batch_time < TIMESTAMP '2024-01-{last:02d}') WHERE rn = 1)"
    )


_SHOWN = "journey_ref, stop_point_ref, line_ref, arrival_delay_sec, batch_time"


def _shown(df: DataFrame) -> DataFrame:
    return df.select(*[c.strip() for c in _SHOWN.split(",")])


@query(
    "merge_upsert",
    f"""
SELECT {_SHOWN} FROM {_sql_between(12, 20)}
UNION ALL
SELECT {_SHOWN} FROM {_sql_between(1, 16)} t
WHERE NOT EXISTS (SELECT 1 FROM {_sql_between(12, 20)} s WHERE s.journey_ref = t.journey_ref AND s.stop_point_ref = t.stop_point_ref)
""",
)
def upsert(t: Tables) -> DataFrame:
    return _shown(merge_upsert(_between(t, 1, 16), _between(t, 12, 20), KEYS))


@query(
    "merge_versioned",
    f"""
SELECT journey_ref, stop_point_ref,
       CASE WHEN u THEN s_line ELSE t_line END AS line_ref, CASE WHEN u THEN s_delay ELSE t_delay END AS arrival_delay_sec,
       CASE WHEN u THEN s_time ELSE t_time END AS batch_time
FROM (SELECT coalesce(s.journey_ref, t.journey_ref) AS journey_ref, coalesce(s.stop_point_ref, t.stop_point_ref) AS stop_point_ref,
             s.line_ref AS s_line, t.line_ref AS t_line, s.arrival_delay_sec AS s_delay, t.arrival_delay_sec AS t_delay,
             s.batch_time AS s_time, t.batch_time AS t_time,
             t.batch_time IS NULL OR (s.batch_time IS NOT NULL AND s.batch_time > t.batch_time) AS u
      FROM {_sql_between(10, 20)} t FULL JOIN {_sql_between(1, 15)} s
      ON s.journey_ref = t.journey_ref AND s.stop_point_ref = t.stop_point_ref)
""",
)
def versioned(t: Tables) -> DataFrame:
    """A late batch meets a newer table: only newer or unseen rows enter."""
    return _shown(merge_versioned(_between(t, 10, 20), _between(t, 1, 15), KEYS, "batch_time"))


@query(
    "merge_insert_new",
    f"""
SELECT {_SHOWN} FROM {_sql_between(5, 31)} s
WHERE NOT EXISTS (SELECT 1 FROM {_sql_between(1, 20)} t WHERE s.journey_ref = t.journey_ref AND s.stop_point_ref = t.stop_point_ref
                  AND s.line_ref IS NOT DISTINCT FROM t.line_ref)
""",
)
def insert_new(t: Tables) -> DataFrame:
    return _shown(merge_insert_new(_between(t, 1, 20), _between(t, 5, 31), [*KEYS, "line_ref"]))


# --- aggregates, windows and rankings over passages ------------------------


@query(
    "agg_conditional",
    """
SELECT direction, count(*) AS passages, CAST(sum(CASE WHEN arrival_delay_sec >= 60 THEN 1 ELSE 0 END) AS BIGINT) AS late,
       CAST(sum(CASE WHEN arrival_delay_sec IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unknown
FROM v_passages GROUP BY direction
""",
)
def agg_conditional(t: Tables) -> DataFrame:
    d = F.col("arrival_delay_sec")
    return a.passages(t).groupBy("direction").agg(
        F.count("*").alias("passages"),
        F.sum(F.when(d >= 60, 1).otherwise(0)).alias("late"),
        count_where(d.isNull()).alias("unknown"),
    )


@query(
    "agg_ratio",
    """
SELECT line_ref, round(100.0::DOUBLE * sum(nb_delayed) / nullif(sum(nb_passages), 0), 1) AS pct_late
FROM v_delays_by_stop GROUP BY line_ref
""",
)
def agg_ratio(t: Tables) -> DataFrame:
    late = percent(F.sum("nb_delayed"), F.sum("nb_passages")).alias("pct_late")
    return a.delays_by_stop(t).groupBy("line_ref").agg(late)


@query(
    "agg_weighted",
    """
SELECT line_ref, round(CAST(sum(max_arrival_delay_sec * nb_passages) AS DOUBLE) / nullif(sum(nb_passages), 0), 1) AS weighted_max
FROM v_delays_by_stop GROUP BY line_ref
""",
)
def agg_weighted(t: Tables) -> DataFrame:
    mean = weighted_mean("max_arrival_delay_sec", "nb_passages", 1).alias("weighted_max")
    return a.delays_by_stop(t).groupBy("line_ref").agg(mean)


@query(
    "agg_distinct",
    """
SELECT direction, count(DISTINCT stop_point_ref) AS stops, count(DISTINCT coalesce(published_line, stop_point_ref)) AS lines_or_stops
FROM v_calls GROUP BY direction
""",
)
def agg_distinct(t: Tables) -> DataFrame:
    return a.calls(t).groupBy("direction").agg(
        F.countDistinct("stop_point_ref").alias("stops"),
        F.countDistinct(F.coalesce("published_line", "stop_point_ref")).alias("lines_or_stops"),
    )


@query(
    "agg_global",
    """
SELECT count(*) AS calls, min(aimed_arrival) AS first_arrival, max(aimed_arrival) AS last_arrival,
       CAST(sum(arrival_delay_sec) AS BIGINT) AS total_delay, max(departure_delay_sec) AS worst FROM v_calls
""",
)
def agg_global(t: Tables) -> DataFrame:
    return a.calls(t).agg(
        F.count("*").alias("calls"),
        F.min("aimed_arrival").alias("first_arrival"),
        F.max("aimed_arrival").alias("last_arrival"),
        F.sum("arrival_delay_sec").alias("total_delay"),
        F.max("departure_delay_sec").alias("worst"),
    )


@query(
    "agg_having",
    """
SELECT stop_point_ref, count(*) AS passages, max(arrival_delay_sec) AS worst FROM v_passages
GROUP BY stop_point_ref HAVING max(arrival_delay_sec) >= 200 AND count(*) > 20
""",
)
def agg_having(t: Tables) -> DataFrame:
    stops = a.passages(t).groupBy("stop_point_ref").agg(
        F.count("*").alias("passages"), F.max("arrival_delay_sec").alias("worst")
    )
    return stops.where((F.col("worst") >= 200) & (F.col("passages") > 20))


@query("arg_max", "SELECT published_line, n FROM (SELECT published_line, count(*) AS n FROM v_calls WHERE published_line IS NOT NULL GROUP BY 1) ORDER BY n DESC, published_line LIMIT 1")
def arg_max_line(t: Tables) -> DataFrame:
    counts = a.calls(t).where("published_line is not null").groupBy("published_line").agg(F.count("*").alias("n"))
    return arg_max(counts, "published_line", "n")


@query(
    "min_per_key",
    """
SELECT stop_point_ref, journey_ref, arrival_delay_sec, batch_time FROM (
    SELECT *, row_number() OVER (PARTITION BY stop_point_ref ORDER BY arrival_delay_sec, batch_time, journey_ref) AS rn
    FROM v_calls WHERE arrival_delay_sec IS NOT NULL) WHERE rn = 1
""",
)
def min_per_stop(t: Tables) -> DataFrame:
    rows = a.calls(t).where("arrival_delay_sec is not null")
    rows = rows.select("stop_point_ref", "journey_ref", "arrival_delay_sec", "batch_time")
    return min_per_key(rows, ["stop_point_ref"], ["arrival_delay_sec", "batch_time", "journey_ref"])


@query(
    "top_n_per_group",
    """
SELECT * FROM (
    SELECT line_ref, stop_point_ref, nb_delayed, CAST(row_number() OVER (
        PARTITION BY line_ref ORDER BY nb_delayed DESC, stop_point_ref) AS INTEGER) AS rank FROM v_delays_by_stop)
WHERE rank <= 3
""",
)
def top_n(t: Tables) -> DataFrame:
    rows = a.delays_by_stop(t).select("line_ref", "stop_point_ref", "nb_delayed")
    return top_n_per_group(rows, ["line_ref"], [F.col("nb_delayed").desc(), F.col("stop_point_ref")], 3, "rank")


@query(
    "minmax_normalise",
    """
SELECT stop_point_ref, line_ref,
       CASE WHEN max(nb_passages) OVER w = min(nb_passages) OVER w THEN 1.0
            ELSE CAST(max(nb_passages) OVER w - nb_passages AS DOUBLE) / (max(nb_passages) OVER w - min(nb_passages) OVER w) END AS low_scaled,
       CASE WHEN max(nb_passages) OVER w = min(nb_passages) OVER w THEN 1.0
            ELSE CAST(nb_passages - min(nb_passages) OVER w AS DOUBLE) / (max(nb_passages) OVER w - min(nb_passages) OVER w) END AS high_scaled
FROM v_delays_by_stop WINDOW w AS (PARTITION BY line_ref)
""",
)
def minmax(t: Tables) -> DataFrame:
    rows = a.delays_by_stop(t).select("stop_point_ref", "line_ref", "nb_passages")
    low = with_minmax(rows, "nb_passages", ["line_ref"], "low_scaled", True)
    both = with_minmax(low, "nb_passages", ["line_ref"], "high_scaled", False)
    return both.select("stop_point_ref", "line_ref", "low_scaled", "high_scaled")


@query(
    "delay_seconds",
    """
SELECT journey_ref, stop_point_ref, batch_time, CAST(epoch(expected_arrival) - epoch(aimed_arrival) AS BIGINT) AS late_sec,
       CAST(epoch(date_trunc('second', batch_time)) - epoch(aimed_arrival) AS BIGINT) AS ahead_sec FROM v_calls
""",
)
def delay_seconds(t: Tables) -> DataFrame:
    return a.calls(t).select(
        "journey_ref",
        "stop_point_ref",
        "batch_time",
        clock.seconds_between("aimed_arrival", "expected_arrival").alias("late_sec"),
        clock.seconds_between("aimed_arrival", "batch_time").alias("ahead_sec"),
    )


@query(
    "parse_timestamps",
    """
SELECT event_id, date_trunc('second', ts) AS spaced, date_trunc('second', ts) AS compact, date_trunc('second', ts) AS iso,
       CAST(NULL AS TIMESTAMP) AS bad FROM events
""",
)
def parse_timestamps(t: Tables) -> DataFrame:
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        clock.stamp(F.date_format(ts, clock.STAMP_FORMAT), clock.STAMP_FORMAT).alias("spaced"),
        clock.stamp(F.date_format(ts, clock.COMPACT_STAMP_FORMAT), clock.COMPACT_STAMP_FORMAT).alias("compact"),
        clock.stamp(a.cat(a.iso(ts), "Z")).alias("iso"),
        clock.stamp("event_type", clock.STAMP_FORMAT).alias("bad"),
    )


@query(
    "parse_dates",
    """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS compact, CAST(o_orderdate AS DATE) AS prefixed, CAST(NULL AS DATE) AS bad FROM orders
""",
)
def parse_dates(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        clock.compact_date(F.date_format(d, "yyyyMMdd").cast("int")).alias("compact"),
        clock.prefix_date(a.cat(F.date_format(d, "yyyy-MM-dd"), "T00:00:00+01:00")).alias("prefixed"),
        clock.compact_date("o_orderpriority").alias("bad"),
    )


@query(
    "calendar_parts",
    """
SELECT event_id, CAST(isodow(ts) % 7 + 1 AS INTEGER) AS sunday_first, CAST(isodow(ts) AS INTEGER) AS monday_first, dayname(ts) AS day_name,
       CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year, CAST(hour(ts) AS INTEGER) AS hour, isodow(ts) >= 6 AS is_weekend
FROM events
""",
)
def calendar_parts(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        F.dayofweek("ts").alias("sunday_first"),
        clock.iso_weekday("ts").alias("monday_first"),
        clock.day_name("ts").alias("day_name"),
        F.month("ts").alias("month"),
        F.year("ts").alias("year"),
        F.hour("ts").alias("hour"),
        clock.is_weekend("ts").alias("is_weekend"),
    )


@query(
    "iso_text",
    "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS stamp FROM events",
)
def iso_text(t: Tables) -> DataFrame:
    return t.events.select("event_id", clock.iso_date("ts").alias("day"), clock.iso_stamp("ts").alias("stamp"))


@query(
    "latest_calls_page",
    """
SELECT journey_ref, stop_point_ref, batch_time FROM v_passages
ORDER BY batch_time DESC, journey_ref, stop_point_ref LIMIT 50 OFFSET 50
""",
)
def latest_calls_page(t: Tables) -> DataFrame:
    rows = a.passages(t).select("journey_ref", "stop_point_ref", "batch_time")
    return page(rows, [F.col("batch_time").desc(), F.col("journey_ref"), F.col("stop_point_ref")], 50, 50)
