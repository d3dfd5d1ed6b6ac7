"""Lift states, outages and step-free access."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions import clock, text
from headway.functions.measures import count_where
from headway.operators.merge import merge_insert_new, merge_sync
from headway.operators.ranking import next_in_time
from headway.plans import analytics, silver
from headway.queries import adapters as a
from headway.queries.registry import Tables, query


@query("surrogate_key", "SELECT elevator_key, elevator_id, elevator_external_id, status_updated_at, state_code FROM v_lift_states")
def surrogate_key(t: Tables) -> DataFrame:
    return a.lift_states(t).select(
        "elevator_key", "elevator_id", "elevator_external_id", "status_updated_at", "state_code"
    )


@query("tri_state", "SELECT status, is_available, count(*) AS n FROM v_lift_states GROUP BY 1, 2")
def tri_state(t: Tables) -> DataFrame:
    """Availability from status text, with NULL for an unknown status."""
    states = a.lift_states(t).select("status", text.availability_flag("status").alias("is_available"))
    return states.groupBy("status", "is_available").agg(F.count("*").alias("n"))


@query("elevator_current", "SELECT * FROM v_lifts_current")
def elevator_current(t: Tables) -> DataFrame:
    return a.lifts_current.plan(t)


@query(
    "latest_nulls_last",
    f"SELECT elevator_key, status, status_updated_at FROM (SELECT *, {a.LATEST_LIFT} AS rn FROM v_lift_states) WHERE rn = 1",
)
def latest_nulls_last(t: Tables) -> DataFrame:
    """Newest row by two sort keys, unknown times last."""
    return silver.elevators_current(a.lift_states(t)).select("elevator_key", "status", "status_updated_at")


@query("elevator_history", "SELECT * FROM v_lifts_history")
def elevator_history(t: Tables) -> DataFrame:
    return a.lifts_history.plan(t)


_OLD = "status_updated_at < TIMESTAMP '2024-01-20'"


@query(
    "history_append",
    f"""
SELECT elevator_key, status_updated_at, status, state_code, severity_code, is_available FROM v_lifts_history s
WHERE NOT EXISTS (SELECT 1 FROM v_lifts_history t WHERE t.{_OLD} AND t.elevator_key = s.elevator_key
    AND t.status_updated_at IS NOT DISTINCT FROM s.status_updated_at AND t.status IS NOT DISTINCT FROM s.status
    AND t.state_code IS NOT DISTINCT FROM s.state_code AND t.severity_code IS NOT DISTINCT FROM s.severity_code
    AND t.is_available IS NOT DISTINCT FROM s.is_available)
""",
)
def history_append(t: Tables) -> DataFrame:
    """State tuples the stored history lacks, matched null-safely."""
    history, keys = a.lifts_history(t), silver.SILVER_KEYS["elevators_history"]
    stored = history.where(F.col("status_updated_at") < clock.moment(datetime(2024, 1, 20)))
    return merge_insert_new(stored, history, keys).select(*keys)


_SYNC_COLS = "elevator_key, status, status_updated_at"
_SYNC_T = f"(SELECT * FROM (SELECT *, {a.LATEST_LIFT} AS rn FROM v_lift_states WHERE {_OLD}) WHERE rn = 1)"
_SYNC_S = (
    f"(SELECT * FROM (SELECT *, {a.LATEST_LIFT} AS rn FROM v_lift_states "
    "WHERE status_updated_at >= TIMESTAMP '2024-01-30 12:00:00') WHERE rn = 1)"
)


@query(
    "merge_sync",
    f"""
SELECT coalesce(s.elevator_key, t.elevator_key) AS elevator_key,
       CASE WHEN s.elevator_key IS NOT NULL THEN s.status ELSE t.status END AS status,
       CASE WHEN s.elevator_key IS NOT NULL THEN s.status_updated_at ELSE t.status_updated_at END AS status_updated_at,
       s.elevator_key IS NOT NULL AS is_active,
       CASE WHEN s.elevator_key IS NULL THEN {a.AS_OF_SQL} END AS missing_since
FROM {_SYNC_T} t FULL JOIN {_SYNC_S} s ON t.elevator_key = s.elevator_key
""",
)
def sync(t: Tables) -> DataFrame:
    """A snapshot meets the stored lifts: those it lacks are closed, the rest updated or added."""
    states = a.lift_states(t)
    stored = silver.elevators_current(states.where(F.col("status_updated_at") < clock.moment(datetime(2024, 1, 20))))
    stored = stored.withColumns({"is_active": F.lit(True), "missing_since": F.lit(None).cast("timestamp")})
    snapshot = silver.elevators_current(states.where(F.col("status_updated_at") >= clock.moment(datetime(2024, 1, 30, 12))))
    merged = merge_sync(stored, snapshot, ["elevator_key"], a.AS_OF)
    return merged.select("elevator_key", "status", "status_updated_at", "is_active", "missing_since")


@query("elevator_availability", "SELECT * FROM v_availability")
def elevator_availability(t: Tables) -> DataFrame:
    return a.availability.plan(t)


@query("elevator_downtime", "SELECT * FROM v_downtime")
def elevator_downtime(t: Tables) -> DataFrame:
    return a.downtime.plan(t)


@query(
    "state_intervals",
    """
SELECT elevator_key, status_updated_at, is_available, lead(status_updated_at) OVER (
           PARTITION BY elevator_key ORDER BY status_updated_at, status NULLS FIRST, state_code, severity_code) AS ended_at
FROM v_lifts_history
""",
)
def state_intervals(t: Tables) -> DataFrame:
    """Each state until the lift's next one; the last stays open."""
    history = a.lifts_history(t)
    ties = [F.col(c).asc_nulls_first() for c in ("status", "state_code", "severity_code")]
    spans = next_in_time(history, ["elevator_key"], "status_updated_at", ties, "ended_at")
    return spans.select("elevator_key", "status_updated_at", "is_available", "ended_at")


@query("elevator_reliability", "SELECT * FROM v_reliability")
def elevator_reliability(t: Tables) -> DataFrame:
    return a.reliability.plan(t)


@query(
    "lookback_metrics",
    f"""
SELECT station_area_id, count(*) FILTER (WHERE status_updated_at >= {a.AS_OF_SQL} - INTERVAL 7 DAY) AS states_7d,
       count(*) FILTER (WHERE status_updated_at >= {a.AS_OF_SQL} - INTERVAL 14 DAY) AS states_14d, count(*) AS states
FROM v_lift_states GROUP BY station_area_id
""",
)
def lookback_metrics(t: Tables) -> DataFrame:
    """Several look-back windows in one pass."""
    since = lambda n: F.col("status_updated_at") >= clock.moment(a.AS_OF) - F.expr(f"interval {n} days")
    return a.lift_states(t).groupBy("station_area_id").agg(
        count_where(since(7)).alias("states_7d"), count_where(since(14)).alias("states_14d"), F.count("*").alias("states")
    )


@query(
    "agg_first",
    """
SELECT elevator_key, arg_min(status_reason, status_updated_at) FILTER (WHERE status_reason IS NOT NULL AND rn = 1) AS first_reason
FROM (SELECT *, row_number() OVER (PARTITION BY elevator_key ORDER BY status_reason IS NULL, status_updated_at, status_reason) AS rn
      FROM v_lift_states) GROUP BY elevator_key
""",
)
def agg_first(t: Tables) -> DataFrame:
    """First known reason per lift, by time and then text, so the pick does not depend on row order."""
    known = F.when(F.col("status_reason").isNotNull(), F.struct("status_updated_at", "status_reason"))
    first = F.min_by("status_reason", known).alias("first_reason")
    return a.lift_states(t).groupBy("elevator_key").agg(first)


_LIST = """
station_area_id, station_name, transport_mode, nb_elevators AS elevators_total, coalesce(nb_available, 0) AS elevators_available,
nb_elevators - coalesce(nb_available, 0) AS elevators_unavailable, pct_available AS availability_pct,
station_latitude AS latitude, station_longitude AS longitude
"""


@query(
    "elevator_list",
    f"""
SELECT {_LIST} FROM v_availability WHERE contains(upper(trim(station_name)), 'NATION') AND nb_available > 0
ORDER BY station_name, transport_mode, station_area_id LIMIT 100
""",
)
def elevator_list(t: Tables) -> DataFrame:
    return analytics.elevator_list(a.availability(t), search="nation", available="true")


@query(
    "elevator_worst",
    """
SELECT station_area_id, station_name, transport_mode, nb_elevators AS elevators_total, nb_outages_30d AS outages_30d,
       downtime_minutes_30d, avg_outage_minutes_30d, nb_outages_90d AS outages_90d, downtime_minutes_90d, avg_outage_minutes_90d,
       pct_uptime_30d AS uptime_30d_pct, pct_uptime_90d AS uptime_90d_pct
FROM v_reliability ORDER BY pct_uptime_30d NULLS FIRST, station_name, transport_mode, station_area_id LIMIT 100
""",
)
def elevator_worst(t: Tables) -> DataFrame:
    return analytics.elevator_worst(a.reliability(t))


@query(
    "outage_events",
    f"""
SELECT elevator_key, elevator_id, station_area_id, station_name, transport_mode, status, status_reason AS reason,
       strftime(status_updated_at, '%Y-%m-%dT%H:%M:%S') AS started_at, strftime(v_downtime.ended_at, '%Y-%m-%dT%H:%M:%S') AS ended_at,
       v_downtime.ended_at IS NULL AS ongoing, sec AS downtime_sec, round(sec / 60.0::DOUBLE, 1) AS downtime_minutes
FROM (SELECT *, coalesce(downtime_sec, CAST(epoch({a.AS_OF_SQL}) - epoch(status_updated_at) AS BIGINT)) AS sec FROM v_downtime) v_downtime
WHERE status_updated_at >= {a.AS_OF_SQL} - INTERVAL 14 DAY
ORDER BY 8 DESC, elevator_key, status, reason NULLS LAST, sec LIMIT 100
""",
)
def outage_events(t: Tables) -> DataFrame:
    return analytics.outage_events(a.downtime(t), a.AS_OF, since_days=14)


def _texts(df: DataFrame) -> DataFrame:
    """Arrays as comma texts, which both engines print alike."""
    arrays = {c: F.array_join(F.col(c).cast("array<string>"), ",") for c, ty in df.dtypes if ty.startswith("array")}
    return df.withColumns(arrays) if arrays else df


@query(
    "station_accessibility",
    """
SELECT * EXCLUDE (lines_served, modes_served), array_to_string(lines_served, ',') AS lines_served,
       array_to_string(modes_served, ',') AS modes_served FROM v_station_access
""",
)
def station_accessibility(t: Tables) -> DataFrame:
    return _texts(a.station_access.plan(t))


@query("transfer_accessibility", "SELECT * FROM v_transfer_access")
def transfer_accessibility(t: Tables) -> DataFrame:
    return a.transfer_access.plan(t)


@query(
    "transfer_list",
    """
SELECT t.from_stop_id, f.stop_name AS from_stop_name, t.to_stop_id, x.stop_name AS to_stop_name, t.transfer_type,
       t.min_transfer_time AS min_transfer_time_sec, t.pathway_length_m, t.pathway_traversal_time AS pathway_traversal_time_sec,
       t.has_stairs, t.has_escalator, t.has_elevator, t.nb_elevators AS elevators_total, t.nb_available AS elevators_available,
       t.pct_uptime_30d AS elevator_uptime_30d_pct, t.accessible_transfer AS accessible
FROM v_transfer_access t LEFT JOIN v_dim_stops f ON t.from_stop_id = f.stop_id LEFT JOIN v_dim_stops x ON t.to_stop_id = x.stop_id
WHERE (contains(upper(f.stop_name), 'STOP') OR contains(upper(x.stop_name), 'STOP')) AND t.accessible_transfer
ORDER BY t.pathway_length_m DESC NULLS LAST, t.from_stop_id, t.to_stop_id LIMIT 100
""",
)
def transfer_list(t: Tables) -> DataFrame:
    return analytics.transfer_list(a.transfer_access(t), a.dim_stops(t), search="stop", accessible=True)


_STATION_AGG = """
SELECT parent_station_id, max(parent_station_name) AS station_name, max(CASE WHEN wheelchair_boarding = 1 THEN 1 ELSE 0 END) = 1 AS accessible,
       count(DISTINCT stop_id) AS stop_count, max(coalesce(nb_elevators, 0)) AS lifts, max(coalesce(nb_available, 0)) AS working,
       max(pct_elevators_available) AS availability, max(coalesce(nb_outages_30d, 0)) AS outages, max(pct_uptime_30d) AS uptime,
       max(nb_lines_served) AS lines_count, max(nb_active_disruptions_today) AS disruptions,
       max(avg_daily_validations_30d) AS daily, max(peak_hour_pct_validations) AS peak
FROM v_station_access WHERE parent_station_id IS NOT NULL GROUP BY parent_station_id
"""


@query(
    "accessibility_summary",
    f"""
SELECT count(*) AS total_stations, CAST(sum(CAST(accessible AS INTEGER)) AS BIGINT) AS accessible_stations,
       count(*) - CAST(sum(CAST(accessible AS INTEGER)) AS BIGINT) AS non_accessible_or_unknown_stations,
       round(100.0::DOUBLE * sum(CAST(accessible AS INTEGER)) / count(*), 1) AS accessible_rate,
       count(*) FILTER (WHERE lifts > 0) AS stations_with_elevators,
       count(*) FILTER (WHERE lifts > 0 AND working = 0) AS stations_without_available_elevator,
       round(avg(availability), 1) AS avg_elevator_availability, round(avg(uptime), 1) AS avg_elevator_uptime_30d
FROM ({_STATION_AGG})
""",
)
def accessibility_summary(t: Tables) -> DataFrame:
    return analytics.accessibility_summary(a.station_access(t))


@query(
    "accessibility_stations",
    f"""
SELECT parent_station_id AS station_id, station_name, accessible,
       CASE WHEN accessible THEN 'accessible' ELSE 'non_accessible_or_unknown' END AS accessibility_status, stop_count,
       lifts AS elevators_total, working AS elevators_available, availability AS availability_pct, outages AS outages_30d,
       uptime AS uptime_30d_pct, lines_count, disruptions AS active_disruptions_today, daily AS avg_daily_validations_30d,
       peak AS peak_hour_validations_pct
FROM ({_STATION_AGG}) WHERE accessible AND contains(upper(station_name), 'NATION')
ORDER BY station_name, station_id LIMIT 100
""",
)
def accessibility_stations(t: Tables) -> DataFrame:
    return analytics.accessibility_stations(a.station_access(t), search="nation", accessible=True)


@query(
    "name_key_join",
    """
SELECT a.station_id, k.lifts FROM v_stop_areas a JOIN (
    SELECT upper(trim(station_name)) AS name_key, count(*) AS lifts FROM v_lifts_current GROUP BY 1) k
ON upper(trim(a.station_name)) = k.name_key
""",
)
def name_key_join(t: Tables) -> DataFrame:
    """Tables that share only a name meet on its upper-cased, trimmed form, reduced to one row per key."""
    lifts = a.lifts_current(t).groupBy(text.name_key("station_name").alias("k")).agg(F.count("*").alias("lifts"))
    return a.stop_areas(t).join(lifts, text.name_key("station_name") == F.col("k")).select("station_id", "lifts")
