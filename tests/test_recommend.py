from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from headway.plans import recommend

DAY = dt.date(2025, 1, 7)


@pytest.fixture(scope="module")
def network(spark):
    """Line A: 1 -> 2 (30 min) -> 3 (60 min); line B: 4 -> 5; a walk 2 -> 4 with stairs."""
    calls = [
        ("A1", "A", 1, 1, 8 * 3600), ("A1", "A", 2, 2, 8 * 3600 + 1800), ("A1", "A", 3, 3, 8 * 3600 + 3600),
        ("A2", "A", 1, 1, 9 * 3600), ("A2", "A", 2, 2, 9 * 3600 + 1500),
        ("B1", "B", 4, 1, 8 * 3600 + 1800 + 240), ("B1", "B", 5, 2, 8 * 3600 + 3000),
        ("B2", "B", 4, 1, 8 * 3600 + 1800 + 60), ("B2", "B", 5, 2, 8 * 3600 + 1900),
        ("C1", "C", 1, 1, 20 * 3600), ("C1", "C", 5, 2, 20 * 3600 + 600),
    ]
    schedule = spark.createDataFrame(
        [(t, ln, 1, s, f"Stop {s}", q, sec, sec) for t, ln, s, q, sec in calls],
        "trip_id string, route_short_name string, route_type int, stop_id int, stop_name string, stop_sequence int, "
        "arrival_seconds int, departure_seconds int",
    )
    walking = spark.createDataFrame(
        [(2, 4, 2, None, 80.0, True, False)],
        "from_stop_id int, to_stop_id int, transfer_type int, min_transfer_time int, pathway_length_m double, has_stairs boolean, has_elevator boolean",
    )
    stops = spark.createDataFrame(
        [(s, f"Stop {s}", f"Gare {s}") for s in range(1, 6)], "stop_id int, stop_name string, parent_station_name string"
    )
    return schedule, walking, stops


def requests(spark, *rows):
    schema = (
        "id int, origin_station string, destination_station string, notify_time int, accessible_required boolean, "
        "crowding_sensitivity int, minimize_walking boolean, max_transfers int, active boolean"
    )
    return recommend.with_hour(spark.createDataFrame(rows, schema))


def ranked(spark, network, *rows):
    schedule, walking, stops = network
    delays = spark.createDataFrame([("a", 90.0)], "published_line string, pct_on_time double")
    crowd = spark.createDataFrame([("STOP 1", 8, "JOHV", 100.0)], "libelle_arret string, hour_start int, cat_jour string, estimated_validations double")
    lifts = spark.createDataFrame([("stop 4", 0.0)], "station_name string, pct_available double")
    calendar = spark.createDataFrame([(DAY, "JOHV")], "date date, cat_jour string")
    return recommend.recommend(requests(spark, *rows), schedule, walking, stops, delays, crowd, lifts, calendar, DAY)


def test_direct_ride_takes_the_fastest_trip(spark, network, rows):
    out = ranked(spark, network, (1, "gare 1", "Stop 2", 8 * 3600, False, 0, False, 2, True))
    assert rows(out, "lines", "duration_min", "transfers", "reliability_pct") == [(["A"], 25.0, 0, 90.0)]


def test_one_change_respects_waiting_time(spark, network, rows):
    out = ranked(spark, network, (1, "gare 1", "gare 5", 8 * 3600, False, 0, False, 2, True))
    (row,) = out.collect()
    assert row.lines == ["A", "B"] and row.duration_min == 50.0 and row.walking_m == 80.0
    assert row.transfer_stations == ["Stop 2", "Stop 4"] and row.crowding_est == 100.0


def test_preferences_filter_routes(spark, network, rows):
    assert ranked(spark, network, (1, "gare 1", "gare 5", 8 * 3600, False, 0, False, 0, True)).isEmpty()
    assert ranked(spark, network, (1, "gare 1", "gare 5", 8 * 3600, True, 0, False, 2, True)).isEmpty()


def test_out_of_order_lift_drops_a_route(spark, network, rows):
    schedule, walking, stops = network
    step_free = walking.withColumn("has_stairs", F.lit(False))
    out = ranked(spark, (schedule, step_free, stops), (1, "gare 1", "gare 5", 8 * 3600, True, 0, False, 2, True))
    assert out.isEmpty()


def test_window_of_departure(spark, network):
    assert ranked(spark, network, (1, "gare 1", "gare 5", 20 * 3600, False, 0, False, 0, True)).count() == 1
    assert ranked(spark, network, (1, "gare 1", "gare 5", 23 * 3600, False, 0, False, 0, True)).isEmpty()


def test_equal_searches_are_routed_once(spark):
    many = requests(spark, *[(i, "a", "b", 8 * 3600, False, 0, False, 2, True) for i in range(20)])
    assert recommend.searches_of(many).count() == 1


def test_prefix_resolution(spark, network, rows):
    asked = spark.createDataFrame([("gare",), (" STOP 3",), ("",), ("nowhere",)], "name string")
    out = recommend.stops_by_prefix(asked, "name", network[2])
    assert rows(out) == sorted([("gare", s) for s in range(1, 6)] + [(" STOP 3", 3)], key=repr)


def test_due_requests(spark, rows):
    subs = requests(
        spark,
        (1, "a", "b", 8 * 3600 + 30 * 60, False, 0, False, 2, True),
        (2, "a", "b", 8 * 3600 + 31 * 60, False, 0, False, 2, True),
        (3, "a", "b", 8 * 3600 + 30 * 60, False, 0, False, 2, False),
        (4, "a", "b", 8 * 3600 + 30 * 60 + 20, False, 0, False, 2, True),
    )
    sent = spark.createDataFrame([(4, DAY), (1, dt.date(2025, 1, 6))], "subscription_id int, notify_date date")
    assert rows(recommend.due_requests(subs, sent, dt.datetime(2025, 1, 7, 8, 30, 59)), "id") == [(1,)]


def test_messages(spark, network):
    asked = [(1, "gare 1", "Stop 2", 8 * 3600, False, 0, False, 2, True), (2, "gare 9", "Stop 2", 8 * 3600, False, 0, False, 2, True)]
    out = recommend.notification_rows(requests(spark, *asked), ranked(spark, network, *asked), DAY)
    texts = {r.subscription_id: (r.status, r.message) for r in out.collect()}
    assert texts[1] == ("sent", "gare 1 -> Stop 2, top 1:\n#1 A 25.0min 0 corresp. fiab 90.0%")
    assert texts[2] == ("no_route", "gare 9 -> Stop 2: aucun itineraire disponible aujourd'hui.")


def test_scores_use_weights(spark):
    kept = spark.createDataFrame(
        [("o", "d", 8, False, 0, False, 2, 1, 2, ["A"], 0, 600, 0.0, 90.0, None), ("o", "d", 8, False, 0, False, 2, 1, 2, ["B"], 1, 1200, 100.0, 80.0, 50.0)],
        "origin_station string, destination_station string, hour int, accessible_required boolean, crowding_sensitivity int, "
        "minimize_walking boolean, max_transfers int, board_stop_id int, alight_stop_id int, lines array<string>, transfers int, "
        "duration_sec int, walking_m double, reliability_pct double, known_crowd double",
    ).withColumns({"board_stop": F.lit("x"), "alight_stop": F.lit("y"), "transfer_stations": F.array(F.lit("p"), F.lit("p"))})
    best, second = recommend.rank_scored(kept).orderBy("rank").collect()
    assert (best.lines, best.score, best.crowding_est) == (["A"], 1.0, 50.0)
    assert (second.score, second.transfer_stations) == (0.2, ["p"])


def test_step_free_option_beyond_the_fastest_forty(spark, network, rows):
    """Sixty faster changes over stairs don't hide the one without."""
    schedule, walking, stops = network
    calls = []
    for i in range(60):
        calls += [(f"F{i}", f"F{i}", 1, 1, 8 * 3600 + i), (f"F{i}", f"F{i}", 2, 2, 8 * 3600 + 600 + i)]
    calls += [("G", "G", 1, 1, 8 * 3600), ("G", "G", 3, 2, 8 * 3600 + 1800), ("H", "H", 4, 1, 8 * 3600 + 1200), ("H", "H", 5, 2, 8 * 3600 + 1500)]
    calls += [("K", "K", 6, 1, 8 * 3600 + 2400), ("K", "K", 5, 2, 8 * 3600 + 3600)]
    many = spark.createDataFrame([(t, ln, 1, s, f"Stop {s}", q, sec, sec) for t, ln, s, q, sec in calls], schedule.schema)
    walks = spark.createDataFrame([(2, 4, 2, None, 80.0, True, False), (3, 6, 2, None, 90.0, False, False)], walking.schema)
    asked = (1, "gare 1", "gare 5", 8 * 3600, True, 0, False, 2, True)
    assert rows(ranked(spark, (many, walks, stops), asked), "lines", "duration_min") == [(["G", "K"], 60.0)]
    assert ranked(spark, (many, walks, stops), (*asked[:4], False, *asked[5:])).count() == 3


def test_points_lead_to_near_stops_and_walks_count(spark, network, rows):
    schedule, walking, stops = network
    placed = stops.withColumns({"stop_lat": F.lit(48.0) + F.col("stop_id") / 10, "stop_lon": F.lit(2.0)})
    asked = requests(
        spark,
        (1, None, "Stop 2", 8 * 3600, False, 0, False, 2, True),
        (2, None, "Stop 2", 8 * 3600, False, 0, False, 2, True),
        (3, "gare 1", "nowhere", 8 * 3600, False, 0, False, 2, True),
    )
    lat = F.when(F.col("id") == 1, 48.101).when(F.col("id") == 2, 40.0)
    pointed = asked.withColumns({"origin_lat": lat, "origin_lon": F.when(lat.isNotNull(), 2.0), "destination_lat": F.lit(None).cast("double"), "destination_lon": F.lit(None).cast("double")})
    delays = spark.createDataFrame([], "published_line string, pct_on_time double")
    crowd = spark.createDataFrame([], "libelle_arret string, hour_start int, cat_jour string, estimated_validations double")
    lifts = spark.createDataFrame([], "station_name string, pct_available double")
    calendar = spark.createDataFrame([(DAY, "JOHV")], "date date, cat_jour string")
    routes = recommend.recommend(pointed, schedule, walking, placed, delays, crowd, lifts, calendar, DAY)
    found = rows(recommend.routes_per_request(pointed, placed, routes), "id", "reach", "rank", "walking_m")
    assert found == [(1, "ok", 1, 111.2), (2, "origin out of reach", None, None), (3, "destination out of reach", None, None)]


# --- changes from fronts ------------------------------------------------------

FIRST = "hour int, line1 string, route_type1 int, board_stop_id int, board_stop string, x_stop int, leave_stop string, dep1 int, arr_x int"
SECOND = "line2 string, route_type2 int, y_stop int, enter_stop string, alight_stop_id int, alight_stop string, dep_y int, arr2 int"
WALKS = "from_stop_id int, to_stop_id int, min_transfer_time int, pathway_length_m double"


def fastest(pairs):
    """Per lines, stops and walk: the least time, and that there is a change at all."""
    keys = ["hour", *recommend.CHANGE, "x_stop", "y_stop", "min_transfer_time", "pathway_length_m"]
    return sorted(map(repr, map(tuple, pairs.groupBy(*keys).agg(F.min(F.col("arr2") - F.col("dep1")).alias("least")).collect())))


@pytest.mark.parametrize("seed", range(4))
def test_fronts_hold_the_fastest_changes(spark, seed):
    rng = random.Random(seed)
    cfg = recommend.RouteSettings(max_wait_sec=40, default_transfer_sec=5)
    # Short times and many rides: overtaking, ties, rides back in time, waits that end between two rides.
    first = [(8, rng.choice("AB"), 1, rng.randint(1, 2), "s", rng.randint(1, 3), "x", d, d + rng.randint(-3 if seed > 1 else 0, 60)) for d in rng.choices(range(200), k=150)]
    second = [(rng.choice("BC"), 1, rng.randint(4, 5), "y", rng.randint(6, 7), "z", d, d + rng.randint(-3 if seed > 1 else 1, 60)) for d in rng.choices(range(260), k=150)]
    walks = [(x, y, rng.choice([None, 0, 3, 15, 45, *([-10] if seed == 3 else [])]), float(x + y)) for x in (1, 2, 3) for y in (4, 5)]
    frames = [spark.createDataFrame(sorted(set(r)), schema) for r, schema in ((first, FIRST), (second, SECOND))]
    walks = spark.createDataFrame(walks, WALKS)
    want = fastest(recommend.all_connections(frames[0], walks, frames[1], cfg))
    assert want and fastest(recommend.connections(frames[0], walks, frames[1], cfg)) == want


def test_a_hub_has_as_many_changes_as_its_lesser_front(spark):
    """A ride a minute in, one every two minutes out, thirty minutes of wait: all pairs are fifteen times as many."""
    first = spark.createDataFrame([(8, f"A{i}", 1, 1, "s", 1, "x", d, d + 600) for i in range(3) for d in range(0, 7200, 60)], FIRST)
    second = spark.createDataFrame([(f"B{i}", 1, 2, "y", 3, "z", d, d + 900) for i in range(3) for d in range(0, 10800, 120)], SECOND)
    walks = spark.createDataFrame([(1, 2, 180, 50.0)], WALKS)
    every, kept = recommend.all_connections(first, walks, second), recommend.connections(first, walks, second)
    pairs = {(r.line1, r.line2): r["count"] for r in kept.groupBy("line1", "line2").count().collect()}
    assert len(pairs) == 9 and max(pairs.values()) <= 90  # the second rides of a line
    assert every.count() > 12 * kept.count()
    assert fastest(kept) == fastest(every)
