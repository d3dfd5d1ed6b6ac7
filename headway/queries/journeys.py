"""Journey recommendation for all subscriptions at once."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.plans import recommend
from headway.queries import adapters as a
from headway.queries.accounts import notifications, subscriptions
from headway.queries.registry import VIEWS, Tables, query, shared, stored, view
from headway.queries.timetable import HAVERSINE

NOW = datetime(2024, 1, 31, 8, 30)


@query(
    "due_requests",
    """
SELECT s.* FROM v_subs s WHERE s.active AND s.notify_time // 60 = 8 * 60 + 30
  AND NOT EXISTS (SELECT 1 FROM v_notes n WHERE n.subscription_id = s.id AND n.notify_date = DATE '2024-01-31')
""",
)
def due_requests(t: Tables) -> DataFrame:
    return recommend.due_requests(subscriptions(t), notifications(t), NOW)


@shared
def requests(t: Tables) -> DataFrame:
    return recommend.with_hour(subscriptions(t).where("active"))


@stored
def searches(t: Tables) -> DataFrame:
    return recommend.searches_of(requests(t))


@stored
def places(t: Tables) -> DataFrame:
    return searches(t).select(*recommend.PLACE).distinct()


@stored
def origins(t: Tables) -> DataFrame:
    return recommend.stops_by_prefix(places(t), "origin_station", a.dim_stops(t))


@stored
def destinations(t: Tables) -> DataFrame:
    return recommend.stops_by_prefix(places(t), "destination_station", a.dim_stops(t))


@stored
def demanded_calls(t: Tables) -> DataFrame:
    return recommend.demanded_calls(a.schedule_rows(t), a.walking(t), origins(t), destinations(t))


def _legs(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Legs without a change and with one."""
    return (
        recommend.fastest_rides(demanded_calls(t), origins(t), destinations(t), places(t)),
        recommend.transfer_legs(demanded_calls(t), a.walking(t), origins(t), destinations(t), places(t)),
    )


@stored
def options(t: Tables) -> DataFrame:
    return recommend.asked_options(*_legs(t), origins(t), destinations(t), places(t))


@shared
def ranked(t: Tables) -> DataFrame:
    criteria = recommend.with_criteria(
        options(t),
        recommend.line_reliability(a.delays_by_stop(t)),
        recommend.station_crowding(a.crowding(t)),
        recommend.elevator_status(a.availability(t)),
        recommend.travel_day(a.AS_OF.date(), a.calendar(t)),
    )
    return recommend.score_routes(searches(t), criteria)


_PLACE = "origin_station, destination_station, hour"
_PREFS = "accessible_required, crowding_sensitivity, minimize_walking, max_transfers"

view("v_requests", "SELECT *, CAST(notify_time // 3600 AS INTEGER) AS hour FROM v_subs WHERE active")
view("v_places", f"SELECT DISTINCT {_PLACE} FROM v_requests")
for _role in ("origin", "destination"):
    view(
        f"v_{_role}s",
        f"""
SELECT DISTINCT {_role}_station, stop_id FROM (SELECT DISTINCT {_role}_station FROM v_places) p JOIN v_dim_stops d
ON starts_with(upper(trim(d.stop_name)), upper(trim({_role}_station)))
   OR starts_with(upper(trim(d.parent_station_name)), upper(trim({_role}_station)))
""",
    )
view(
    "v_boards",
    """
SELECT h.hour, s.* FROM v_schedule s JOIN (SELECT DISTINCT hour FROM v_places) h
ON s.departure_seconds BETWEEN h.hour * 3600 - 1800 AND h.hour * 3600 + 7200
WHERE s.stop_id IN (SELECT stop_id FROM v_origins)
""",
)
view(
    "v_rides",
    """
SELECT o.hour, o.route_short_name AS line, o.route_type, o.stop_id AS board_stop_id, o.stop_name AS board_stop,
       d.stop_id AS alight_stop_id, d.stop_name AS alight_stop, min(d.arrival_seconds - o.departure_seconds) AS duration_sec
FROM v_boards o JOIN v_schedule d ON o.trip_id = d.trip_id AND d.stop_sequence > o.stop_sequence
WHERE d.arrival_seconds > o.departure_seconds AND d.stop_id IN (SELECT stop_id FROM v_destinations)
GROUP BY ALL
""",
)
view(
    "v_direct",
    """
SELECT r.*, o.origin_station, d.destination_station
FROM v_rides r JOIN v_origins o ON r.board_stop_id = o.stop_id JOIN v_destinations d ON r.alight_stop_id = d.stop_id
JOIN v_places p ON p.origin_station = o.origin_station AND p.destination_station = d.destination_station AND p.hour = r.hour
""",
)
view(
    "v_changes",
    """
SELECT f.hour, f.line1, f.route_type1, s.line2, s.route_type2, f.board_stop_id, f.board_stop, f.leave_stop, s.enter_stop,
       s.alight_stop_id, s.alight_stop, min(s.arr2 - f.dep1) AS duration_sec, min(w.pathway_length_m) AS walking_m,
       bool_and(coalesce(w.has_stairs, FALSE)) AS stairs_all, bool_or(coalesce(w.has_elevator, FALSE)) AS elevator_any
FROM (SELECT DISTINCT o.hour, o.route_short_name AS line1, o.route_type AS route_type1, o.stop_id AS board_stop_id, o.stop_name AS board_stop,
             o.departure_seconds AS dep1, x.stop_id AS x_stop, x.stop_name AS leave_stop, x.arrival_seconds AS arr_x
      FROM v_boards o JOIN v_schedule x ON o.trip_id = x.trip_id AND x.stop_sequence > o.stop_sequence
      WHERE x.stop_id IN (SELECT from_stop_id FROM v_walking)) f
JOIN v_walking w ON w.from_stop_id = f.x_stop
JOIN (SELECT DISTINCT y.route_short_name AS line2, y.route_type AS route_type2, y.stop_id AS y_stop, y.stop_name AS enter_stop,
             y.departure_seconds AS dep_y, d.stop_id AS alight_stop_id, d.stop_name AS alight_stop, d.arrival_seconds AS arr2
      FROM v_schedule y JOIN v_schedule d ON d.trip_id = y.trip_id AND y.stop_sequence < d.stop_sequence
      WHERE d.stop_id IN (SELECT stop_id FROM v_destinations) AND y.stop_id IN (SELECT to_stop_id FROM v_walking)) s
ON s.y_stop = w.to_stop_id AND s.dep_y BETWEEN f.arr_x + coalesce(w.min_transfer_time, 180) AND f.arr_x + 1800
   AND s.arr2 > f.dep1 AND f.line1 <> s.line2
GROUP BY ALL
""",
)
view(
    "v_transfer",
    """
SELECT r.*, o.origin_station, d.destination_station
FROM v_changes r JOIN v_origins o ON r.board_stop_id = o.stop_id JOIN v_destinations d ON r.alight_stop_id = d.stop_id
JOIN v_places p ON p.origin_station = o.origin_station AND p.destination_station = d.destination_station AND p.hour = r.hour
""",
)
view(
    "v_found",
    f"""
SELECT {_PLACE}, 0 AS transfers, [line] AS lines, board_stop_id, board_stop, alight_stop_id, alight_stop,
       [board_stop, alight_stop] AS stations, CAST([] AS VARCHAR[]) AS transfer_stations, duration_sec, 0.0::DOUBLE AS walking_m,
       FALSE AS blocked FROM v_direct
UNION ALL
SELECT {_PLACE}, 1, [line1, line2], board_stop_id, board_stop, alight_stop_id, alight_stop,
       [board_stop, leave_stop, enter_stop, alight_stop], [leave_stop, enter_stop], duration_sec, coalesce(walking_m, 0.0::DOUBLE),
       stairs_all AND NOT elevator_any FROM v_transfer
""",
)
view(
    "v_candidates",
    f"""
SELECT * EXCLUDE (rn, blocked) FROM (
    SELECT s.accessible_required, s.crowding_sensitivity, s.minimize_walking, s.max_transfers, f.*,
           row_number() OVER (PARTITION BY f.origin_station, f.destination_station, f.hour, s.accessible_required, s.crowding_sensitivity,
                              s.minimize_walking, s.max_transfers, board_stop_id, alight_stop_id, lines
                              ORDER BY duration_sec, transfers, walking_m, stations, transfer_stations) AS rn
    FROM (SELECT DISTINCT {_PLACE}, {_PREFS} FROM v_requests) s JOIN v_found f
    ON s.origin_station = f.origin_station AND s.destination_station = f.destination_station AND s.hour = f.hour
    WHERE f.transfers <= s.max_transfers AND NOT (s.accessible_required AND f.blocked) AND f.duration_sec >= 60)
WHERE rn = 1
""",
)
view(
    "v_ranked",
    f"""
SELECT {_PLACE}, {_PREFS}, CAST(rank AS INTEGER) AS rank, score, lines, transfers, board_stop, alight_stop, transfer_stations,
       round(duration_sec / 60.0::DOUBLE, 1) AS duration_min, round(walking_m, 1) AS walking_m,
       round(reliability_pct, 1) AS reliability_pct, round(crowding_est, 1) AS crowding_est
FROM (SELECT *, row_number() OVER (PARTITION BY {_PLACE}, {_PREFS} ORDER BY score DESC, transfers, duration_sec,
                                   coalesce(lines[1], ''), coalesce(lines[2], ''), board_stop_id, alight_stop_id) AS rank
      FROM (SELECT *, round(wd / tot * d + wr / tot * r + wc / tot * c + ww / tot * w, 4) AS score
            FROM (SELECT *, wd + wr + wc + ww AS tot,
                         CASE WHEN max(duration_sec) OVER s = min(duration_sec) OVER s THEN 1.0::DOUBLE
                              ELSE CAST(max(duration_sec) OVER s - duration_sec AS DOUBLE) / (max(duration_sec) OVER s - min(duration_sec) OVER s) END AS d,
                         CASE WHEN max(reliability_pct) OVER s = min(reliability_pct) OVER s THEN 1.0::DOUBLE
                              ELSE (reliability_pct - min(reliability_pct) OVER s) / (max(reliability_pct) OVER s - min(reliability_pct) OVER s) END AS r,
                         CASE WHEN max(crowding_est) OVER s = min(crowding_est) OVER s THEN 1.0::DOUBLE
                              ELSE (max(crowding_est) OVER s - crowding_est) / (max(crowding_est) OVER s - min(crowding_est) OVER s) END AS c,
                         CASE WHEN max(walking_m) OVER s = min(walking_m) OVER s THEN 1.0::DOUBLE
                              ELSE (max(walking_m) OVER s - walking_m) / (max(walking_m) OVER s - min(walking_m) OVER s) END AS w
                  FROM (SELECT *, 0.4::DOUBLE AS wd, 0.25::DOUBLE AS wr, 0.2::DOUBLE * (1 + 0.5::DOUBLE * crowding_sensitivity) AS wc,
                               0.15::DOUBLE * CASE WHEN minimize_walking THEN 2 ELSE 1 END AS ww,
                               round(coalesce(known, avg(known) OVER (PARTITION BY {_PLACE}, {_PREFS}), 0.0), 6) AS crowding_est
                        FROM (SELECT c.*, round(coalesce((SELECT avg(p) FROM (SELECT upper(trim(published_line)) AS k, avg(pct_on_time) AS p FROM v_delays_by_stop GROUP BY 1) q
                                                    WHERE k IN (upper(trim(c.lines[1])), upper(trim(c.lines[2])))), 85.0::DOUBLE), 6) AS reliability_pct,
                                     kc.known
                              FROM v_candidates c LEFT JOIN (
                                  SELECT {_PLACE}, {_PREFS}, board_stop_id, alight_stop_id, lines, sum(crowd) AS known
                                  FROM (SELECT {_PLACE}, {_PREFS}, board_stop_id, alight_stop_id, lines, unnest(stations) AS st FROM v_candidates) e
                                  JOIN (SELECT upper(trim(libelle_arret)) AS k, hour_start, avg(estimated_validations) AS crowd FROM v_crowding
                                        WHERE cat_jour = (SELECT coalesce((SELECT cat_jour FROM v_calendar WHERE date = DATE '2024-01-31'), 'JOHV'))
                                        GROUP BY 1, 2) cr
                                  ON upper(trim(e.st)) = cr.k AND e.hour = cr.hour_start GROUP BY ALL) kc
                              USING (origin_station, destination_station, hour, accessible_required, crowding_sensitivity, minimize_walking, max_transfers,
                                     board_stop_id, alight_stop_id, lines)
                              WHERE NOT (c.accessible_required AND EXISTS (
                                  SELECT 1 FROM (SELECT upper(trim(station_name)) AS k, min(pct_available) AS p FROM v_availability GROUP BY 1) l
                                  WHERE p <= 0 AND list_contains(list_transform(c.transfer_stations, lambda x: upper(trim(x))), k)))))
                  WINDOW s AS (PARTITION BY {_PLACE}, {_PREFS}))))
WHERE rank <= 3
""",
)


@query("direct_routes", "SELECT * FROM v_direct")
def direct_routes(t: Tables) -> DataFrame:
    return recommend.direct_routes(demanded_calls(t), origins(t), destinations(t), places(t))


@query("transfer_routes", "SELECT * FROM v_transfer")
def transfer_routes(t: Tables) -> DataFrame:
    return recommend.transfer_routes(demanded_calls(t), a.walking(t), origins(t), destinations(t), places(t))


@query(
    "connections",
    "SELECT hour, line1, line2, leave_stop, enter_stop, count(*) AS pairs, min(duration_sec) AS fastest FROM v_changes GROUP BY ALL",
)
def connections(t: Tables) -> DataFrame:
    """The time-band join alone: changes between lines at each walk."""
    return _legs(t)[1].groupBy("hour", "line1", "line2", "leave_stop", "enter_stop").agg(
        F.count("*").alias("pairs"), F.min("duration_sec").alias("fastest")
    )


_JOINED = "coalesce(array_to_string(lines, '/'), '') AS lines, coalesce(array_to_string(transfer_stations, '/'), '') AS transfer_stations"


def _joined(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.array_join(c, "/") for c in ("lines", "transfer_stations")})


@query(
    "route_candidates",
    f"""
SELECT {_PLACE}, {_PREFS}, transfers, board_stop_id, alight_stop_id, duration_sec, walking_m, {_JOINED} FROM v_candidates
""",
)
def route_candidates(t: Tables) -> DataFrame:
    cols = [*recommend.SEARCH, "transfers", "board_stop_id", "alight_stop_id", "duration_sec", "walking_m"]
    found = recommend.route_candidates(searches(t), options(t))
    return _joined(found.select(*cols, "lines", "transfer_stations"))


@query(
    "score_routes",
    f"SELECT * EXCLUDE (lines, transfer_stations), coalesce(array_to_string(lines, '/'), '') AS lines, "
    "coalesce(array_to_string(CASE WHEN len(transfer_stations) = 2 AND transfer_stations[1] = transfer_stations[2] "
    "THEN transfer_stations[1:1] ELSE transfer_stations END, '/'), '') AS transfer_stations FROM v_ranked",
)
def score_routes(t: Tables) -> DataFrame:
    return _joined(ranked(t))


@query(
    "notification_rows",
    f"""
SELECT r.id AS subscription_id, DATE '2024-01-31' AS notify_date, CASE WHEN x.n IS NULL THEN 'no_route' ELSE 'sent' END AS status,
       CASE WHEN x.n IS NULL THEN r.origin_station||' -> '||r.destination_station||': aucun itineraire disponible aujourd''hui.'
            ELSE r.origin_station||' -> '||r.destination_station||', top '||x.n||':'||chr(10)||x.body END AS message
FROM v_requests r LEFT JOIN (
    SELECT {_PLACE}, {_PREFS}, count(*) AS n,
           string_agg('#'||rank||' '||coalesce(array_to_string(lines, '/'), '')||' '||duration_min||'min '||transfers||' corresp. fiab '||reliability_pct||'%',
                      chr(10) ORDER BY rank) AS body
    FROM v_ranked GROUP BY {_PLACE}, {_PREFS}) x
USING (origin_station, destination_station, hour, accessible_required, crowding_sensitivity, minimize_walking, max_transfers)
""",
)
def notification_rows(t: Tables) -> DataFrame:
    return recommend.notification_rows(requests(t), ranked(t), a.AS_OF.date())


# --- requests from coordinates ----------------------------------------------


@shared
def point_requests(t: Tables) -> DataFrame:
    """Active subscriptions, half of which start and a quarter of which end at a point and not at a named stop."""
    rows = requests(t)

    def point(side: str, every: int, key: str, lat: int, lon: int) -> dict:
        given = F.col("id") % every == 0
        degrees = {"lat": 48.0 + (F.col(key) % lat).cast("double") / 100, "lon": 2.0 + (F.col(key) % lon).cast("double") / 100}
        return {f"{side}_{c}": F.when(given, value) for c, value in degrees.items()}

    return rows.withColumns(point("origin", 2, "user_id", 97, 71) | point("destination", 4, "id", 89, 67))


_CHAIN = ("places", "boards", "rides", "direct", "changes", "transfer", "found", "candidates", "ranked")


def _of_points(sql: str) -> str:
    return re.sub(r"\bv_(requests|origins|destinations|%s)\b" % "|".join(_CHAIN), r"v_pt_\1", sql)


view(
    "v_pt_requests",
    """
SELECT * REPLACE (CASE WHEN origin_lat IS NULL THEN origin_station ELSE origin_lat||','||origin_lon END AS origin_station,
                  CASE WHEN destination_lat IS NULL THEN destination_station ELSE destination_lat||','||destination_lon END AS destination_station)
FROM (SELECT *, CASE WHEN id % 2 = 0 THEN 48.0::DOUBLE + CAST(user_id % 97 AS DOUBLE) / 100 END AS origin_lat,
             CASE WHEN id % 2 = 0 THEN 2.0::DOUBLE + CAST(user_id % 71 AS DOUBLE) / 100 END AS origin_lon,
             CASE WHEN id % 4 = 0 THEN 48.0::DOUBLE + CAST(id % 89 AS DOUBLE) / 100 END AS destination_lat,
             CASE WHEN id % 4 = 0 THEN 2.0::DOUBLE + CAST(id % 67 AS DOUBLE) / 100 END AS destination_lon FROM v_requests)
""",
)
for _role in ("origin", "destination"):
    view(
        f"v_pt_{_role}s",
        f"""
SELECT DISTINCT {_role}_station, stop_id, 0.0::DOUBLE AS distance_m
FROM (SELECT DISTINCT {_role}_station FROM v_pt_requests WHERE {_role}_lat IS NULL) p JOIN v_dim_stops d
ON starts_with(upper(trim(d.stop_name)), upper(trim({_role}_station)))
   OR starts_with(upper(trim(d.parent_station_name)), upper(trim({_role}_station)))
UNION ALL
SELECT {_role}_station, stop_id, distance_m
FROM (SELECT *, row_number() OVER (PARTITION BY {_role}_station ORDER BY distance_m, stop_id) AS near_rank
      FROM (SELECT {_role}_station, stop_id, round({HAVERSINE.format('lat', 'lon', 'stop_lat', 'stop_lon')}, 3) AS distance_m
            FROM (SELECT DISTINCT {_role}_station, {_role}_lat AS lat, {_role}_lon AS lon FROM v_pt_requests WHERE {_role}_lat IS NOT NULL), v_dim_stops)
      WHERE distance_m <= 5000)
WHERE near_rank <= 4 AND (distance_m <= 1500 OR near_rank = 1)
""",
    )
for _name in _CHAIN:
    _sql = _of_points(VIEWS[f"v_{_name}"])
    if _name == "candidates":
        _sql = f"""
SELECT c.* REPLACE (c.walking_m + coalesce(o.distance_m, 0) + coalesce(d.distance_m, 0) AS walking_m)
FROM ({_sql}) c LEFT JOIN v_pt_origins o ON o.origin_station = c.origin_station AND o.stop_id = c.board_stop_id
LEFT JOIN v_pt_destinations d ON d.destination_station = c.destination_station AND d.stop_id = c.alight_stop_id
"""
    view(f"v_pt_{_name}", _sql)


@query(
    "recommend_points",
    f"""
SELECT r.id, CASE WHEN o.origin_station IS NULL THEN 'origin out of reach'
                  WHEN d.destination_station IS NULL THEN 'destination out of reach' ELSE 'ok' END AS reach,
       x.rank, x.score, x.transfers, x.board_stop, x.alight_stop, x.duration_min, x.walking_m,
       CASE WHEN x.rank IS NOT NULL THEN coalesce(array_to_string(x.lines, '/'), '') END AS lines
FROM v_pt_requests r LEFT JOIN (SELECT DISTINCT origin_station FROM v_pt_origins) o ON o.origin_station = r.origin_station
LEFT JOIN (SELECT DISTINCT destination_station FROM v_pt_destinations) d ON d.destination_station = r.destination_station
LEFT JOIN v_pt_ranked x ON {' AND '.join(f'x.{c} = r.{c}' for c in recommend.SEARCH)}
""",
)
def recommend_points(t: Tables) -> DataFrame:
    """Requests from names and coordinates end to end, with the walks to and from stops."""
    asked, stops = point_requests(t), a.dim_stops(t)
    routes = recommend.recommend(
        asked, a.schedule_rows(t), a.walking(t), stops, a.delays_by_stop(t), a.crowding(t), a.availability(t), a.calendar(t), a.AS_OF.date()
    )
    found = recommend.routes_per_request(asked, stops, routes)
    columns = ["id", "reach", "rank", "score", "transfers", "board_stop", "alight_stop", "duration_min", "walking_m"]
    return found.select(*columns, F.array_join("lines", "/").alias("lines"))
