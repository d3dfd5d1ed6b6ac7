"""Timetable tables and network queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions import clock, geo, text
from headway.operators import search
from headway.operators.calendars import explode_days, in_ranges
from headway.operators.nearby import nearest_anywhere as nearest_any
from headway.operators.ranking import dedup_subset, page
from headway.plans import analytics, gold, recommend, silver
from headway.queries import adapters as a
from headway.queries.registry import Tables, query, stored


@query("gtfs_seconds", "SELECT trip_id, stop_sequence, arrival_time, arrival_seconds, departure_seconds FROM v_stop_times")
def gtfs_seconds(t: Tables) -> DataFrame:
    return a.raw_stop_times(t).select(
        "trip_id",
        "stop_sequence",
        "arrival_time",
        clock.gtfs_seconds("arrival_time").alias("arrival_seconds"),
        clock.gtfs_seconds("departure_time").alias("departure_seconds"),
    )


@query("silver_stop_times", "SELECT * FROM v_stop_times")
def silver_stop_times(t: Tables) -> DataFrame:
    return a.stop_times.plan(t)


@query(
    "silver_stops",
    """
SELECT 'point' AS kind, stop_id, stop_name, parent_station, stop_lon, stop_lat, zone_id FROM v_stop_points
UNION ALL
SELECT 'area', station_id, station_name, NULL, station_lon, station_lat, NULL FROM v_stop_areas
UNION ALL
SELECT 'entrance', entrance_id, entrance_name, parent_station, entrance_lon, entrance_lat, NULL FROM v_stop_entrances
""",
)
def silver_stops(t: Tables) -> DataFrame:
    """Stops, stations and entrances of one feed, one under the other."""
    raw = a.raw_stops(t)
    none = F.lit(None).cast("int")
    names = ["stop_id", "stop_name", "parent_station", "stop_lon", "stop_lat", "zone_id"]
    points = silver.stop_points(raw).select(F.lit("point").alias("kind"), *names)
    areas = silver.stop_areas(raw).select(
        F.lit("area"), "station_id", "station_name", none, "station_lon", "station_lat", none
    )
    gates = silver.stop_entrances(raw).select(
        F.lit("entrance"), "entrance_id", "entrance_name", "parent_station", "entrance_lon", "entrance_lat", none
    )
    return points.union(areas).union(gates)


@query("silver_wheelchairs", "SELECT * FROM v_wheelchairs")
def silver_wheelchairs(t: Tables) -> DataFrame:
    return silver.wheelchairs(a.raw_stops(t))


@query("silver_trips", "SELECT * FROM v_trips")
def silver_trips(t: Tables) -> DataFrame:
    return silver.trips(a.raw_trips(t))


@query("silver_routes", "SELECT * FROM v_routes")
def silver_routes(t: Tables) -> DataFrame:
    return silver.routes(a.raw_routes(t))


@query("silver_calendars", "SELECT * FROM v_calendars")
def silver_calendars(t: Tables) -> DataFrame:
    return silver.calendars(a.raw_calendars(t))


@query("silver_calendar_dates", "SELECT * FROM v_calendar_dates")
def silver_calendar_dates(t: Tables) -> DataFrame:
    return silver.calendar_dates(a.raw_calendar_dates(t))


@query(
    "silver_edges",
    """
SELECT 'transfer' AS kind, NULL AS pathway_id, from_stop_id, to_stop_id, transfer_type AS code, min_transfer_time AS seconds
FROM v_transfers
UNION ALL
SELECT 'pathway', pathway_id, from_stop_id, to_stop_id, pathway_mode, traversal_time FROM v_pathways
""",
)
def silver_edges(t: Tables) -> DataFrame:
    """Transfers (one per stop pair) and pathways."""
    transfers = silver.transfers(a.raw_transfers(t)).select(
        F.lit("transfer").alias("kind"),
        F.lit(None).cast("string").alias("pathway_id"),
        "from_stop_id",
        "to_stop_id",
        F.col("transfer_type").alias("code"),
        F.col("min_transfer_time").alias("seconds"),
    )
    walks = silver.pathways(a.raw_pathways(t)).select(
        F.lit("pathway"), "pathway_id", "from_stop_id", "to_stop_id", "pathway_mode", "traversal_time"
    )
    return transfers.union(walks)


@query("silver_accessibility", "SELECT * FROM v_accessibility")
def silver_accessibility(t: Tables) -> DataFrame:
    return silver.accessibility_gares(a.raw_accessibility(t))


@query("dim_stops", "SELECT * FROM v_dim_stops")
def dim_stops(t: Tables) -> DataFrame:
    return a.dim_stops.plan(t)


@query("trip_schedule", "SELECT * FROM v_schedule")
def trip_schedule(t: Tables) -> DataFrame:
    return a.schedule.plan(t)


@query(
    "service_calendar",
    """
SELECT service_id, date, dayname(date) AS day_of_week, isodow(date) >= 6 AS is_weekend
FROM (
    SELECT service_id, date FROM (
        SELECT *, CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS date FROM v_calendars)
    WHERE CASE isodow(date) WHEN 1 THEN monday WHEN 2 THEN tuesday WHEN 3 THEN wednesday WHEN 4 THEN thursday
               WHEN 5 THEN friday WHEN 6 THEN saturday ELSE sunday END = 1
    UNION
    SELECT service_id, date FROM v_calendar_dates WHERE exception_type = 1
    EXCEPT
    SELECT service_id, date FROM v_calendar_dates WHERE exception_type = 2)
""",
)
def service_calendar(t: Tables) -> DataFrame:
    return gold.service_calendar(
        silver.calendars(a.raw_calendars(t)), silver.calendar_dates(a.raw_calendar_dates(t))
    )


@query("transfer_walking", "SELECT * FROM v_walking")
def transfer_walking(t: Tables) -> DataFrame:
    return a.walking.plan(t)


@query("station_lines", "SELECT * FROM v_lines")
def station_lines(t: Tables) -> DataFrame:
    return a.lines.plan(t)


@query(
    "network_lines",
    """
SELECT route_id, max(route_short_name) AS route_short_name, max(route_long_name) AS route_long_name,
       max(route_type) AS route_type,
       CASE max(route_type) WHEN 0 THEN 'tram' WHEN 1 THEN 'metro' WHEN 2 THEN 'rail' WHEN 3 THEN 'bus'
            WHEN 4 THEN 'ferry' ELSE 'unknown' END AS transport_mode,
       max(agency_id) AS agency_id, count(DISTINCT coalesce(parent_station_id, stop_id)) AS stations,
       count(DISTINCT stop_id) AS stops
FROM v_lines WHERE route_id IS NOT NULL AND (contains(upper(route_id), 'C1') OR contains(upper(route_short_name), 'C1')
      OR contains(upper(route_long_name), 'C1'))
GROUP BY route_id ORDER BY max(route_type), max(route_short_name), route_id LIMIT 100
""",
)
def network_lines(t: Tables) -> DataFrame:
    return analytics.network_lines(a.lines(t), search=" c1 ")


@query(
    "line_stations",
    """
SELECT coalesce(l.parent_station_id, l.stop_id) AS station_id, max(coalesce(l.parent_station_name, d.stop_name)) AS station_name,
       max(coalesce(d.parent_station_lat, d.stop_lat)) AS latitude, max(coalesce(d.parent_station_lon, d.stop_lon)) AS longitude,
       count(DISTINCT l.stop_id) AS stops
FROM v_lines l LEFT JOIN v_dim_stops d ON l.stop_id = d.stop_id
WHERE l.route_id = 'C7' GROUP BY 1 ORDER BY station_name, station_id LIMIT 500
""",
)
def line_stations(t: Tables) -> DataFrame:
    return analytics.line_stations(a.lines(t), a.dim_stops(t), "C7")


@query(
    "resolve_station",
    """
SELECT DISTINCT stop_id, parent_station_name FROM v_dim_stops
WHERE starts_with(upper(trim(stop_name)), 'NATION_1') OR starts_with(upper(trim(parent_station_name)), 'NATION_1')
""",
)
def resolve_station(t: Tables) -> DataFrame:
    return analytics.resolve_station(a.dim_stops(t), " nation_1")


@query(
    "text_search",
    """
SELECT c_custkey, c_mktsegment, contains(upper(trim(c_mktsegment)), 'MACH') AS has_term,
       starts_with(upper(trim(c_mktsegment)), 'FURN') AS has_prefix, upper(trim(c_mktsegment)) = 'BUILDING' AS is_term
FROM customer
WHERE contains(upper(trim(c_name)), '1') OR contains(upper(trim(c_mktsegment)), '1')
""",
)
def text_search(t: Tables) -> DataFrame:
    """Contains, prefix and equality, ignoring case and outer blanks; % and _ are literal."""
    return t.customer.where(text.contains_term(" 1 ", "c_name", "c_mktsegment")).select(
        "c_custkey",
        "c_mktsegment",
        text.contains_term(" mach", "c_mktsegment").alias("has_term"),
        text.name_key("c_mktsegment").startswith(F.upper(F.trim(F.lit("furn ")))).alias("has_prefix"),
        text.equals_term(" building", "c_mktsegment").alias("is_term"),
    )


_ASKED = "substr(stop_name, 1 + stop_id % 7, 1 + stop_id % 5)"


@stored
def stop_name_index(t: Tables) -> DataFrame:
    return search.name_index(a.dim_stops(t), "stop_id", "stop_name", "parent_station_name")


@query(
    "contains_search",
    f"""
SELECT asked, count(*) AS stops, min(stop_id) AS first_stop, max(stop_id) AS last_stop
FROM (SELECT DISTINCT {_ASKED} AS asked FROM v_dim_stops) JOIN v_dim_stops
ON trim(asked) <> '' AND (contains(upper(trim(stop_name)), upper(trim(asked))) OR contains(upper(trim(parent_station_name)), upper(trim(asked))))
GROUP BY asked
""",
)
def contains_search(t: Tables) -> DataFrame:
    """Pieces of one to five letters of all stop names, each searched in all stop and station names."""
    asked = a.dim_stops(t).select(F.expr(_ASKED).alias("asked"))
    found = search.contains_search(asked, "asked", stop_name_index(t), "stop_id")
    return found.groupBy("asked").agg(F.count("*").alias("stops"), F.min("stop_id").alias("first_stop"), F.max("stop_id").alias("last_stop"))


@query("route_type_name", """
SELECT n_nationkey, n_nationkey AS code, CASE n_nationkey WHEN 0 THEN 'tram' WHEN 1 THEN 'metro' WHEN 2 THEN 'rail'
    WHEN 3 THEN 'bus' WHEN 4 THEN 'ferry' WHEN 5 THEN 'cable_tram' WHEN 6 THEN 'aerial_lift' WHEN 7 THEN 'funicular'
    WHEN 11 THEN 'trolleybus' WHEN 12 THEN 'monorail' ELSE 'unknown' END AS mode FROM nation
""")
def route_type_name(t: Tables) -> DataFrame:
    return t.nation.select(
        "n_nationkey", F.col("n_nationkey").alias("code"), text.route_type_name("n_nationkey").alias("mode")
    )


@query("wkt_point", "SELECT stop_id, stop_geo_point, stop_lon AS lon, stop_lat AS lat FROM v_dim_stops")
def wkt_point(t: Tables) -> DataFrame:
    """Points written as text and read back."""
    points = a.stop_points(t).select("stop_id", geo.wkt_point("stop_lon", "stop_lat").alias("stop_geo_point"))
    lon, lat = geo.wkt_coordinates("stop_geo_point")
    return points.select("stop_id", "stop_geo_point", lon.alias("lon"), lat.alias("lat"))


@query("geo_pair", """
SELECT p_partkey, stop_point_latitude AS lat, stop_point_longitude AS lon
FROM part JOIN v_accessibility ON stop_point_id = 'X:'||p_partkey
""")
def geo_pair(t: Tables) -> DataFrame:
    lat, lon = geo.geo_pair("stop_point_geopoint")
    return a.raw_accessibility(t).select(
        text.first_int("stop_point_id").cast("long").alias("p_partkey"), lat.alias("lat"), lon.alias("lon")
    )


HAVERSINE = """asin(least(sqrt(pow(sin(radians({0} - {2}) / 2), 2) + cos(radians({2})) * cos(radians({0})) *
    pow(sin(radians({1} - {3}) / 2), 2)), 1.0)) * 12742020.0"""


@query(
    "great_circle",
    f"""
SELECT stop_id, CAST(round({HAVERSINE.format('parent_station_lat', 'parent_station_lon', 'stop_lat', 'stop_lon')}) AS BIGINT) AS metres
FROM v_dim_stops WHERE parent_station_id IS NOT NULL
""",
)
def great_circle(t: Tables) -> DataFrame:
    """Metres from each stop to its station."""
    stops = a.dim_stops(t).where(F.col("parent_station_id").isNotNull())
    metres = geo.great_circle_m(
        F.col("stop_lat"), F.col("stop_lon"), F.col("parent_station_lat"), F.col("parent_station_lon")
    )
    return stops.select("stop_id", F.round(metres).cast("long").alias("metres"))


@query(
    "nearest_stops",
    f"""
SELECT c_custkey, stop_id, stop_name, round(distance_m, 1) AS distance_m, CAST(near_rank AS INTEGER) AS near_rank
FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY distance_m, stop_id) AS near_rank
      FROM (SELECT c_custkey, stop_id, stop_name,
                   round({HAVERSINE.format('lat', 'lon', 'stop_lat', 'stop_lon')}, 3) AS distance_m
            FROM (SELECT c_custkey, 48.0::DOUBLE + CAST(c_custkey % 97 AS DOUBLE) / 100 AS lat,
                         2.0::DOUBLE + CAST(c_custkey % 71 AS DOUBLE) / 100 AS lon FROM customer) c, v_stop_points s)
      WHERE distance_m <= 5000)
WHERE near_rank <= 4 AND (distance_m <= 1500 OR near_rank = 1)
""",
)
def nearest_stops(t: Tables) -> DataFrame:
    """Stops a person's coordinates lead to: up to four in walking distance, else the nearest."""
    k = F.col("c_custkey")
    people = t.customer.select(
        "c_custkey",
        (F.lit(48.0) + (k % 97).cast("double") / 100).alias("lat"),
        (F.lit(2.0) + (k % 71).cast("double") / 100).alias("lon"),
    )
    near = recommend.stops_near(people, ["c_custkey"], a.stop_points(t))
    return near.withColumn("distance_m", F.round("distance_m", 1))


_NORTH, _EAST = "CAST(({0} * {1}) % 1800 AS DOUBLE) / 10 - 90", "CAST(({0} * {1}) % 3600 AS DOUBLE) / 10 - 180"


@query(
    "nearest_anywhere",
    f"""
SELECT c_custkey, s_suppkey, distance_m, CAST(near_rank AS INTEGER) AS near_rank
FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY distance_m, s_suppkey) AS near_rank
      FROM (SELECT c_custkey, s_suppkey, round({HAVERSINE.format('lat', 'lon', 'p_lat', 'p_lon')}, 3) AS distance_m
            FROM (SELECT c_custkey, {_NORTH.format('c_custkey', 37)} AS lat, {_EAST.format('c_custkey', 53)} AS lon FROM customer) c,
                 (SELECT s_suppkey, {_NORTH.format('s_suppkey', 71)} AS p_lat, {_EAST.format('s_suppkey', 97)} AS p_lon FROM supplier) s))
WHERE near_rank <= 3
""",
)
def nearest_anywhere(t: Tables) -> DataFrame:
    """Three nearest suppliers of every customer, both spread over the whole earth, its poles and the date line."""

    def spread(key: str, north: int, east: int) -> list:
        k = F.col(key)
        return [((k * north) % 1800).cast("double") / 10 - 90, ((k * east) % 3600).cast("double") / 10 - 180]

    (lat, lon), (p_lat, p_lon) = spread("c_custkey", 37, 53), spread("s_suppkey", 71, 97)
    people = t.customer.select("c_custkey", lat.alias("lat"), lon.alias("lon"))
    points = t.supplier.select("s_suppkey", p_lat.alias("point_lat"), p_lon.alias("point_lon"))
    near = nearest_any(people, points, ["c_custkey"], "s_suppkey", 3, first_reach_m=250_000.0)
    return near.select("c_custkey", "s_suppkey", "distance_m", "near_rank")


@query(
    "date_spine",
    """
SELECT service_id, CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS date FROM v_calendars
""",
)
def date_spine(t: Tables) -> DataFrame:
    return explode_days(silver.calendars(a.raw_calendars(t)), "start_date", "end_date").select("service_id", "date")


@query(
    "join_range",
    """
SELECT DISTINCT date FROM (SELECT CAST(o_orderdate AS DATE) + 8218 AS date FROM orders) o
WHERE EXISTS (SELECT 1 FROM v_breaks b WHERE o.date >= b.s AND o.date < b.e)
""",
)
def join_range(t: Tables) -> DataFrame:
    """Order days inside some break [start, end)."""
    days = t.orders.select(a.order_day().alias("date"))
    return in_ranges(days, "date", silver.school_breaks(a.raw_breaks(t)), "start_d", "end_d")


@query(
    "pairs_on_trip",
    """
SELECT o.stop_id AS board_stop_id, d.stop_id AS alight_stop_id, count(*) AS rides,
       min(d.arrival_seconds - o.departure_seconds) AS fastest_sec
FROM v_stop_times o JOIN v_stop_times d ON o.trip_id = d.trip_id AND d.stop_sequence > o.stop_sequence
JOIN (SELECT DISTINCT o_custkey % 10 AS b, o_orderkey % 10 AS e FROM orders) ON o.stop_id = b AND d.stop_id = e
GROUP BY 1, 2
""",
)
def pairs_on_trip(t: Tables) -> DataFrame:
    """Rides between asked stop pairs: each call meets later calls of its trip at an asked stop only."""
    asked = t.orders.select(
        (F.col("o_custkey") % 10).alias("board_stop_id"), (F.col("o_orderkey") % 10).alias("alight_stop_id")
    ).distinct()
    calls = a.stop_times(t)
    boards = calls.select(
        "trip_id",
        F.col("stop_id").alias("board_stop_id"),
        F.col("stop_sequence").alias("board_seq"),
        F.col("departure_seconds").alias("dep"),
    ).join(asked, "board_stop_id")
    alights = calls.select(
        "trip_id",
        F.col("stop_id").alias("alight_stop_id"),
        F.col("stop_sequence").alias("alight_seq"),
        F.col("arrival_seconds").alias("arr"),
    )
    return (
        boards.join(alights, ["trip_id", "alight_stop_id"])
        .where(F.col("alight_seq") > F.col("board_seq"))
        .groupBy("board_stop_id", "alight_stop_id")
        .agg(F.count("*").alias("rides"), F.min(F.col("arr") - F.col("dep")).alias("fastest_sec"))
    )


@query(
    "role_playing_join",
    """
SELECT w.from_stop_id, f.stop_name AS from_name, w.to_stop_id, x.stop_name AS to_name, w.pathway_length_m
FROM v_walking w LEFT JOIN v_stop_points f ON w.from_stop_id = f.stop_id LEFT JOIN v_stop_points x ON w.to_stop_id = x.stop_id
""",
)
def role_playing_join(t: Tables) -> DataFrame:
    """The stop table joined twice, for both ends of a transfer."""
    stops = a.stop_points(t)
    ends = [
        stops.select(F.col("stop_id").alias(f"{e}_stop_id"), F.col("stop_name").alias(f"{e}_name"))
        for e in ("from", "to")
    ]
    walks = a.walking(t).select("from_stop_id", "to_stop_id", "pathway_length_m")
    return walks.join(ends[0], "from_stop_id", "left").join(ends[1], "to_stop_id", "left")


@query(
    "agg_bool",
    """
SELECT from_stop_id, bool_or(pathway_mode = 2) AS any_stairs, bool_and(pathway_mode <> 5) AS no_lift
FROM v_pathways GROUP BY from_stop_id
""",
)
def agg_bool(t: Tables) -> DataFrame:
    mode = F.col("pathway_mode")
    return silver.pathways(a.raw_pathways(t)).groupBy("from_stop_id").agg(
        F.bool_or(mode == 2).alias("any_stairs"), F.bool_and(mode != 5).alias("no_lift")
    )


@query(
    "agg_basic",
    """
SELECT l_suppkey, CAST(sum(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) AS qty, count(*) AS n,
       round(avg(CAST(floor(l_quantity) AS BIGINT)), 4) AS mean_qty, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
FROM lineitem GROUP BY l_suppkey
""",
)
def agg_basic(t: Tables) -> DataFrame:
    q = F.floor("l_quantity").cast("long")
    return t.lineitem.groupBy("l_suppkey").agg(
        F.sum(q).alias("qty"),
        F.count("*").alias("n"),
        F.round(F.avg(q), 4).alias("mean_qty"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )


@query(
    "dedup_subset",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) AS rn
    FROM lineitem) WHERE rn = 1
""",
)
def dedup(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return dedup_subset(rows, ["l_orderkey", "l_linenumber"])


@query("set_distinct", "SELECT DISTINCT from_stop_id, to_stop_id FROM v_pathways")
def set_distinct(t: Tables) -> DataFrame:
    return silver.pathways(a.raw_pathways(t)).select("from_stop_id", "to_stop_id").distinct()


@query(
    "set_union",
    "SELECT date AS day FROM v_calendar_dates UNION ALL SELECT start_date FROM v_calendars UNION ALL SELECT end_date FROM v_calendars",
)
def set_union(t: Tables) -> DataFrame:
    """By name for equal frames, by position for renamed ones."""
    services = silver.calendars(a.raw_calendars(t))
    days = silver.calendar_dates(a.raw_calendar_dates(t)).select(F.col("date").alias("day"))
    return days.unionByName(services.select(F.col("start_date").alias("day"))).union(services.select("end_date"))


@query("join_inner", "SELECT st.trip_id, st.stop_sequence, tr.route_id FROM v_stop_times st JOIN v_trips tr ON st.trip_id = tr.trip_id")
def join_inner(t: Tables) -> DataFrame:
    trips = silver.trips(a.raw_trips(t)).select("trip_id", "route_id")
    return a.stop_times(t).join(trips, "trip_id").select("trip_id", "stop_sequence", "route_id")


@query(
    "join_left",
    "SELECT t.trip_id, t.route_id, r.route_short_name FROM v_trips t LEFT JOIN v_routes r ON t.route_id = r.route_id",
)
def join_left(t: Tables) -> DataFrame:
    names = silver.routes(a.raw_routes(t)).select("route_id", "route_short_name")
    return silver.trips(a.raw_trips(t)).join(names, "route_id", "left").select("trip_id", "route_id", "route_short_name")


@query(
    "join_anti",
    """
SELECT service_id, start_date FROM v_calendars c
WHERE NOT EXISTS (SELECT 1 FROM v_calendar_dates d WHERE d.service_id = c.service_id AND d.exception_type = 2)
""",
)
def join_anti(t: Tables) -> DataFrame:
    removed = silver.calendar_dates(a.raw_calendar_dates(t)).where("exception_type = 2")
    return silver.calendars(a.raw_calendars(t)).join(removed, "service_id", "left_anti").select("service_id", "start_date")


@query(
    "join_semi",
    "SELECT trip_id, stop_sequence, stop_id FROM v_stop_times WHERE stop_id IN (SELECT from_stop_id FROM v_transfers)",
)
def join_semi(t: Tables) -> DataFrame:
    starts = silver.transfers(a.raw_transfers(t)).select(F.col("from_stop_id").alias("stop_id"))
    return a.stop_times(t).join(starts, "stop_id", "left_semi").select("trip_id", "stop_sequence", "stop_id")


@query(
    "order_nulls",
    """
SELECT from_stop_id, to_stop_id, min_transfer_time FROM v_transfers
ORDER BY min_transfer_time DESC NULLS LAST, from_stop_id, to_stop_id
""",
)
def order_nulls(t: Tables) -> DataFrame:
    edges = silver.transfers(a.raw_transfers(t)).select("from_stop_id", "to_stop_id", "min_transfer_time")
    return edges.orderBy(F.col("min_transfer_time").desc_nulls_last(), "from_stop_id", "to_stop_id")


@query("page", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 200")
def page_of_orders(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return page(rows, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 100, 200)


@query(
    "page_envelope",
    """
SELECT count(*) AS count, 50 AS limit_, 10 AS offset_, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS keys
FROM (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 10)
""",
)
def page_envelope(t: Tables) -> DataFrame:
    items = page(t.orders.select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), F.col("o_orderkey")], 50, 10)
    return analytics.page_envelope(items, 50, 10).select(
        "count",
        F.col("limit").alias("limit_"),
        F.col("offset").alias("offset_"),
        F.array_join(F.sort_array("items.o_orderkey"), ",").alias("keys"),
    )


@query("code_extract", """
SELECT doc_id, TRY_CAST(regexp_extract(lang||doc_id||source, '(\\d+)', 1) AS INTEGER) AS first_int,
       regexp_extract('STIF:Line::C'||doc_id||':', '([A-Za-z0-9]+):?$', 1) AS token,
       regexp_extract(CASE WHEN doc_id % 3 = 0 THEN 'abc:' ELSE 'Q:'||doc_id||':' END, '(\\d+):?$', 1) AS digits
FROM documents
""")
def code_extract(t: Tables) -> DataFrame:
    d = a.txt("doc_id")
    ref = F.when(F.col("doc_id") % 3 == 0, F.lit("abc:")).otherwise(a.cat("Q:", d, ":"))
    return t.documents.select(
        "doc_id",
        text.first_int(F.concat("lang", d, "source")).alias("first_int"),
        text.tail_token(a.cat("STIF:Line::C", d, ":")).alias("token"),
        text.tail_digits(ref).alias("digits"),
    )


@query("code_split", """
SELECT o_orderkey, split_part('X:C'||o_custkey||':v1', ':', 2) AS second, CASE WHEN o_orderkey % 2 = 0 THEN 'v1' END AS third,
       split_part(o_orderpriority, '-', -1) AS last_part
FROM orders
""")
def code_split(t: Tables) -> DataFrame:
    """Segments by index (NULL past the end) and the last segment."""
    code = a.cat("X:C", a.txt("o_custkey"), F.when(F.col("o_orderkey") % 2 == 0, ":v1").otherwise(""))
    return t.orders.select(
        "o_orderkey",
        text.segment(code, 1).alias("second"),
        text.segment(code, 2).alias("third"),
        text.last_segment("o_orderpriority", "-").alias("last_part"),
    )


@query("clean_string", """
SELECT doc_id, nullif(trim(CASE WHEN doc_id % 5 = 0 THEN '  ' ELSE ' '||lang||' ' END), '') AS code,
       nullif(trim(regexp_replace(text, '[ \\t\\n\\r\\f\\v]+', ' ', 'g')), '') AS label
FROM documents
""")
def clean_string(t: Tables) -> DataFrame:
    padded = F.when(F.col("doc_id") % 5 == 0, F.lit("  ")).otherwise(a.cat(" ", F.col("lang"), " "))
    return t.documents.select(
        "doc_id", text.clean_string(padded).alias("code"), text.clean_label("text").alias("label")
    )
