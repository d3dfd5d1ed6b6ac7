"""Work that must not grow with the product of two tables: rows that joins give, read from the plan that ran."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from headway.operators.nearby import nearest_points
from headway.plans import gold, recommend, silver
from headway.queries import adapters, journeys
from headway.queries.registry import Tables


def join_rows(df) -> list[int]:
    """Collects the frame, and the rows that each join of its last plan gave."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "Join" in (name := node.getClass().getSimpleName()):
            found.append(node.metrics().apply("numOutputRows").value())
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_a_place_in_a_dense_town_meets_few_points(spark, rows):
    rng = random.Random(3)
    spots = [(i, 48 + rng.random() / 100, 2 + rng.random() / 100) for i in range(3000)]
    people = [(i, 48 + rng.random() / 100, 2 + rng.random() / 100) for i in range(50)]
    points = spark.createDataFrame(spots, "stop_id int, point_lat double, point_lon double")
    near = nearest_points(spark.createDataFrame(people, "person int, lat double, lon double"), points, ["person"], "stop_id", 4, 5000.0)
    assert near.count() == 200
    assert max(join_rows(near)) < 50 * 300


def test_repeated_requests_keep_their_rows(spark, rows):
    points = spark.createDataFrame([(1, 48.0, 2.0), (2, 48.001, 2.0), (2, 48.001, 2.0)], "stop_id int, point_lat double, point_lon double")
    asked = spark.createDataFrame([(1, 48.0, 2.0), (1, 48.0, 2.0), (2, 48.0, 2.0), (3, None, 2.0)], "person int, lat double, lon double")
    near = nearest_points(asked, points, ["person"], "stop_id", 3, 5000.0)
    assert rows(near, "person", "near_rank", "stop_id") == [(1, 1, 1), (1, 2, 1), (1, 3, 2), (2, 1, 1), (2, 2, 2), (2, 3, 2)]


def many_options(spark, n):
    """Options of one place; many lines and stations have the same values."""
    i = F.col("id")
    columns = {
        "origin_station": F.lit("o"), "destination_station": F.lit("d"), "hour": F.lit(8), "accessible_required": F.lit(False),
        "transfers": (i % 2).cast("int"), "lines": F.array(F.concat(F.lit("L"), (i % 7).cast("string"))), "board_stop_id": i.cast("int"), "alight_stop_id": i.cast("int"),
        "board_stop": F.lit("x"), "alight_stop": F.lit("y"), "stations": F.array(F.concat(F.lit("S"), (i % 5).cast("string")), F.lit("y")),
        "transfer_stations": F.array().cast("array<string>"), "duration_sec": (60 + i * 37 % 1009).cast("int"), "walking_m": (i * 11 % 13).cast("double"),
    }
    return spark.range(n).select(*[v.alias(k) for k, v in columns.items()])


def scored_options(spark, n):
    known = spark.createDataFrame([("L0", 90.0), ("L3", 70.0)], "line_key string, pct_on_time double")
    crowd = spark.createDataFrame([("S1", 8, "JOHV", 5.0), ("S2", 8, "JOHV", 9.0), ("Y", 8, "JOHV", 1.0), ("S1", 9, "JOHV", 50.0)], "station_key string, hour int, cat_jour string, crowd double")
    lifts = spark.createDataFrame([], "station_key string, pct_available double")
    return recommend.with_criteria(many_options(spark, n), known, crowd, lifts, F.lit("JOHV"))


def all_searches(spark):
    wanted = [("o", "d", 8, False, c, m, t) for c in range(4) for m in (False, True) for t in (0, 2)]
    return spark.createDataFrame(wanted, "origin_station string, destination_station string, hour int, accessible_required boolean, crowding_sensitivity int, minimize_walking boolean, max_transfers int")


def test_options_take_the_values_of_their_lines_and_stations(spark):
    found = {r.board_stop_id: (r.reliability_pct, r.known_crowd) for r in scored_options(spark, 70).collect()}
    assert len(found) == 70
    assert found[0] == (90.0, 1.0) and found[3] == (70.0, 1.0) and found[1] == (85.0, 6.0) and found[7] == (90.0, 10.0)


def test_only_leading_options_are_sorted_for_each_search(spark):
    """Sixteen searches and two thousand options: few of the pairs reach the ranking, and they hold the best."""
    best = recommend.score_routes(all_searches(spark), scored_options(spark, 2000))
    assert max(join_rows(best)) < 2000
    found = best.collect()
    assert len(found) == 48
    whole = recommend._rounded(scored_options(spark, 2000)).collect()
    for s in all_searches(spark).collect():
        mine = [r for r in whole if r.transfers <= s.max_transfers]
        mean = round(sum(r.known_crowd for r in mine if r.known_crowd is not None) / sum(r.known_crowd is not None for r in mine), 6)

        def scaled(value, low, high):
            return 1.0 if high == low else (high - value) / (high - low)

        spans = [([r[c] if r[c] is not None else mean for r in mine], w) for c, w in (("duration_sec", 0.4), ("_crowd", 0.2 * (1 + 0.5 * s.crowding_sensitivity)), ("walking_m", 0.3 if s.minimize_walking else 0.15))]
        rel = [r.reliability_pct for r in mine]
        total = 0.25 + sum(w for _, w in spans)
        scores = [sum(w * scaled(v[i], min(v), max(v)) for v, w in spans) / total + 0.25 / total * (rel[i] - min(rel)) / (max(rel) - min(rel)) for i in range(len(mine))]
        order = sorted(range(len(mine)), key=lambda i: (-round(scores[i], 4), mine[i].transfers, mine[i].duration_sec, mine[i].lines, mine[i].board_stop_id))[:3]
        same = sorted((r for r in found if all(r[c] == s[c] for c in recommend.SEARCH)), key=lambda r: r["rank"])
        assert [r.lines for r in same] == [mine[i].lines for i in order]
        assert [r.score for r in same] == [round(scores[i], 4) for i in order]


def test_only_the_newest_batch_of_a_disruption_is_sorted(spark):
    rows = [(f"D{i % 10}", None, i, f"m{i}") for i in range(1000)] + [("D3", 5, 993, "again"), ("E", 1, None, "no time")]
    parsed = spark.createDataFrame(rows, "id string, last_update int, batch_time int, message string")
    latest = silver.latest_disruptions(parsed)
    assert max(join_rows(latest)) == 12
    assert {r.id: r.message for r in latest.collect()} == {f"D{i}": f"m{990 + i}" for i in range(10)} | {"D3": "again", "E": "no time"}


def test_days_of_services_are_dealt_out_before_they_are_grouped(spark, rows):
    """No task groups the days of the calendars it reads: these meet a hash table behind the exchange only."""
    week = spark.range(50).select(F.col("id").cast("string").alias("service_id"), *[F.lit(1).alias(d) for d in gold.WEEKDAYS], F.lit("2024-01-01").cast("date").alias("start_date"), F.lit("2024-01-10").cast("date").alias("end_date"))
    special = spark.createDataFrame([("1", 3, 2), ("1", 20, 1), (None, 3, 1), (None, 3, 2), ("2", 4, 1), ("2", 4, 2), ("3", 4, 7)], "service_id string, d int, exception_type int")
    special = special.select("service_id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d") - 1).alias("date"), "exception_type")
    out = gold.service_calendar(week, special.unionByName(special))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.rindex("Aggregate") < plan.index("Exchange")
    assert out.count() == 50 * 10 - 2 + 1 + 1
    assert [r.date.day for r in out.where("service_id = '1'").orderBy("date").collect()] == [1, 2, 4, 5, 6, 7, 8, 9, 10, 20]
    assert [r.date.day for r in out.where("service_id IS NULL").collect()] == [3]


def test_lines_of_stops_need_no_written_schedule(spark):
    """Lines read the order lines and carry a call's stop and trip alone; no table of all calls stands between."""
    lines = adapters.lines.plan(Tables(spark, "/root/testdata/sf0.001"))
    files = lines.inputFiles()
    assert any("lineitem" in f for f in files) and not any("/schedule/" in f or "/stop_times/" in f for f in files)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(l_suppkey" in plan and "partial_min(l_orderkey" not in plan and "partial_min(l_linenumber" not in plan


def test_order_lines_are_shuffled_once_before_trips_meet_them(spark):
    """The grouping of order lines and the join with trips use one dealing by trip."""
    plan = adapters.lines.plan(Tables(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(trip_id") <= 2 and "Exchange hashpartitioning(l_orderkey" not in plan


def test_reliability_of_lifts_needs_no_written_outages(spark):
    """Outages come from their plan, without the columns that reliability doesn't ask for."""
    reliability = adapters.reliability.plan(Tables(spark, "/root/testdata/sf0.001"))
    assert not any("/downtime/" in f for f in reliability.inputFiles())
    assert "status_reason" not in reliability._jdf.queryExecution().executedPlan().toString()


# --- legs meet places ---------------------------------------------------------

PLACES = "origin_station string, destination_station string, hour int"


def named(spark, side, names):
    return spark.createDataFrame(names, f"{side}_station string, stop_id int")


def legs_of(spark, pairs):
    rides = [(h, "A", 1, b, f"s{b}", a, f"s{a}", 600) for h, b, a in pairs]
    return spark.createDataFrame(rides, "hour int, line string, route_type int, board_stop_id int, board_stop string, alight_stop_id int, alight_stop string, duration_sec int")


def plain_demand(legs, origins, destinations, places):
    return sorted((o, d, h, b, a) for h, b, a in legs for o, x in origins for d, y in destinations if x == b and y == a and (o, d, h) in places)


def check_demand(spark, pairs, origins, destinations, places, most):
    found = recommend._demanded(legs_of(spark, pairs), named(spark, "origin", origins), named(spark, "destination", destinations), spark.createDataFrame(places, PLACES))
    assert max(join_rows(found)) <= most
    got = sorted((r.origin_station, r.destination_station, r.hour, r.board_stop_id, r.alight_stop_id) for r in found.collect())
    assert got == plain_demand(pairs, origins, destinations, set(places))
    return got


def test_legs_of_an_origin_with_many_destinations_meet_their_own(spark):
    """A town asks for fifty others; a leg to one of them doesn't meet the places of all fifty."""
    pairs = [(8, b, 100 + a) for b in range(10) for a in range(50)]
    places = [("town", f"d{a}", h) for a in range(50) for h in (8, 9)]
    assert len(check_demand(spark, pairs, [("town", b) for b in range(10)], [(f"d{a}", 100 + a) for a in range(50)], places, 500)) == 500


def test_legs_between_stops_of_many_names_meet_the_places_asked(spark):
    """Stops 1 and 2 lie near a hundred points each, which ask for one another in pairs and not all for all."""
    pairs = [(8, 1, 2), (9, 1, 2), (8, 1, 4), (8, 3, 2), (8, 3, 4), (8, 4, 1)]
    origins = [(f"o{i}", 1) for i in range(100)] + [("o0", 3), ("o7", 3), ("o1", 4)]
    destinations = [(f"d{i}", 2) for i in range(100)] + [("d3", 4), ("d7", 4), ("d0", 1)]
    places = [(f"o{i}", f"d{i}", 8) for i in range(100)] + [("o7", "d3", 8), ("o0", "d3", 9), ("o1", "d0", 8)]
    check_demand(spark, pairs, origins, destinations, places, 500)


def test_options_chosen_before_places_are_those_chosen_after(spark, rows):
    """Also where the fastest change has stairs, where two are equal, and where a stop has two names."""
    rng = random.Random(5)
    pairs = [(h, b, a) for h in (8, 9) for b in (1, 2, 3) for a in (4, 5)]
    rides = [(h, ln, t, b, n, a, f"s{a}", rng.choice([50, 300, 600])) for h, b, a in pairs for ln, t, n in (("A", 1, f"s{b}"), ("A", 2, "z"), ("B", 1, None))]
    direct = spark.createDataFrame(rides, legs_of(spark, pairs).schema)
    changes = [
        (h, "A", 1, ln, t, b, f"s{b}", x, y, a, f"s{a}", rng.choice([300, 400, 500]), rng.choice([None, 0.0, 10.0]), rng.random() < 0.5, rng.random() < 0.3)
        for h, b, a in pairs for ln in ("B", "C") for t in (1, 2) for x in ("x", "v") for y in ("y", None)
    ]
    transfer = spark.createDataFrame(changes, "hour int, line1 string, route_type1 int, line2 string, route_type2 int, board_stop_id int, board_stop string, leave_stop string, enter_stop string, alight_stop_id int, alight_stop string, duration_sec int, walking_m double, stairs_all boolean, elevator_any boolean")
    origins = named(spark, "origin", [("o", 1), ("o", 2), ("p", 2), ("p", 3)])
    destinations = named(spark, "destination", [("d", 4), ("e", 4), ("e", 5)])
    places = spark.createDataFrame([("o", "d", 8), ("o", "e", 8), ("p", "e", 9), ("p", "x", 8)], PLACES)
    sides = (origins, destinations, places)
    after = recommend.route_options(recommend.all_candidates(recommend._demanded(direct, *sides), recommend._demanded(transfer, *sides)))
    before = recommend.asked_options(direct, transfer, *sides)
    want = rows(after, *after.columns)
    assert want and rows(before, *after.columns) == want
    # And the plain choice.
    plain = {}
    for r in recommend.all_candidates(recommend._demanded(direct, *sides), recommend._demanded(transfer, *sides)).where("duration_sec >= 60").collect():
        for needs in (False,) if r.blocked_no_elevator else (False, True):
            key = (r.origin_station, r.destination_station, r.hour, needs, r.board_stop_id, r.alight_stop_id, tuple(r.lines))
            value = (r.duration_sec, r.transfers, r.walking_m, *[tuple((v is not None, v or "") for v in x) for x in (r.stations, r.transfer_stations)])
            plain[key] = min(plain.get(key, value), value)
    got = {tuple(map(lambda v: tuple(v) if isinstance(v, list) else v, (r[c] for c in recommend.OPTION))): r for r in before.collect()}
    assert got.keys() == plain.keys() and before.count() == len(plain)
    assert all((got[k].duration_sec, got[k].transfers, got[k].walking_m) == v[:3] for k, v in plain.items())


def test_options_go_through_one_exchange_as_one_row_for_all_travellers(spark):
    """Before the choice no candidate is repeated for travellers with and without steps, nor held beside its own order."""
    sides = (named(spark, "origin", [("o", 1)]), named(spark, "destination", [("d", 2)]), spark.createDataFrame([("o", "d", 8)], PLACES))
    candidates = recommend.all_candidates(recommend._demanded(legs_of(spark, [(8, 1, 2)]), *sides), recommend._demanded(legs_of(spark, []), *sides).select(
        *recommend.PLACE, "board_stop_id", "board_stop", "alight_stop_id", "alight_stop", "duration_sec", F.lit("A").alias("line1"), F.lit("B").alias("line2"),
        F.lit("x").alias("leave_stop"), F.lit("y").alias("enter_stop"), F.lit(0.0).alias("walking_m"), F.lit(True).alias("stairs_all"), F.lit(False).alias("elevator_any"),
    ))
    options = recommend.route_options(candidates)
    plan = options._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Aggregate") and "min_by" not in plan
    assert sorted(r.accessible_required for r in options.collect()) == [False, True]


def test_calls_are_marked_once_for_all_their_uses(spark, rows):
    calls = [("T", "A", 1, s, f"s{s}", s or 9, 100 * i, 100 * i + 30) for i, s in enumerate([1, 2, 3, 4, 5, None])]
    schedule = spark.createDataFrame(calls, ", ".join(f"{c} {t}" for c, t in zip(recommend.CALL, ("string", "string", "int", "int", "string", "int", "int", "int"), strict=True)))
    walks = spark.createDataFrame([(2, 3), (2, 4), (None, 1)], "from_stop_id int, to_stop_id int")
    marked = recommend.demanded_calls(schedule, walks, named(spark, "origin", [("o", 1), ("p", 1), ("o", 2)]), named(spark, "destination", [("d", 4)]))
    uses = ["at_origin", "at_destination", "at_leave", "at_enter"]
    assert rows(marked, "stop_id", *uses) == [(1, True, False, False, True), (2, True, False, True, False), (3, False, False, False, True), (4, False, True, False, True)]
    places = spark.createDataFrame([("o", "d", 0)], PLACES)
    sides = (named(spark, "origin", [("o", 1), ("o", 2)]), named(spark, "destination", [("d", 4)]), places)
    assert rows(recommend.fastest_rides(marked, *sides)) == rows(recommend.fastest_rides(schedule, *sides)) != []
    assert "LeftSemi" not in recommend.fastest_rides(marked, *sides)._jdf.queryExecution().optimizedPlan().toString()


def test_legs_that_meet_names_in_several_ways_are_made_once(spark):
    sides = named(spark, "origin", [(f"o{i}", 1) for i in range(20)]), named(spark, "destination", [(f"d{i}", 2) for i in range(20)])
    places = spark.createDataFrame([(f"o{i}", f"d{i}", 8) for i in range(20)], PLACES)
    found = recommend._demanded(legs_of(spark, [(8, 1, 2)]), *sides, places)
    assert any("/legs-" in f for f in found.inputFiles()) and found.count() == 20
    few = recommend._demanded(legs_of(spark, [(8, 1, 2)]), named(spark, "origin", [("o0", 1)]), named(spark, "destination", [("d0", 2)]), places)
    assert not any("/legs-" in f for f in few.inputFiles()) and few.count() == 1


def test_walks_to_stops_come_with_the_stops_names(spark, monkeypatch):
    """Options of points have the metres from the join with places: nothing is joined with them by place again."""
    given, plain = [], recommend.with_criteria
    monkeypatch.setattr(recommend, "with_criteria", lambda options, *rest, **more: given.append((options, rest[4:], more)) or plain(options, *rest, **more))
    calls = [("T", "A", 1, s, f"s{s}", s, 8 * 3600 + 600 * s, 8 * 3600 + 600 * s) for s in (1, 2)]
    schedule = spark.createDataFrame(calls, "trip_id string, route_short_name string, route_type int, stop_id int, stop_name string, stop_sequence int, arrival_seconds int, departure_seconds int")
    walks = spark.createDataFrame([], "from_stop_id int, to_stop_id int, min_transfer_time int, pathway_length_m double, has_stairs boolean, has_elevator boolean")
    # The first stop is found by the point and by a text that reads like it.
    stops = spark.createDataFrame([(1, "48.0,2.0 hall", None, 48.001, 2.0), (2, "s2", None, 48.1, 2.0)], "stop_id int, stop_name string, parent_station_name string, stop_lat double, stop_lon double")
    asked = [(1, None, "s2", 48.0, 2.0), (2, "48.0,2.0", None, None, None), (3, "48.0,2.0", "s2", None, None)]
    asked = spark.createDataFrame(asked, "id int, origin_station string, destination_station string, origin_lat double, origin_lon double")
    asked = asked.select("*", F.when(F.col("id") == 2, 48.101).alias("destination_lat"), F.when(F.col("id") == 2, 2.0).alias("destination_lon"), F.lit(8).alias("hour"), F.lit(False).alias("accessible_required"), F.lit(0).alias("crowding_sensitivity"), F.lit(False).alias("minimize_walking"), F.lit(2).alias("max_transfers"))
    delays = spark.createDataFrame([], "published_line string, pct_on_time double")
    crowd = spark.createDataFrame([("s1", 8, "JOHV", 100.0)], "libelle_arret string, hour_start int, cat_jour string, estimated_validations double")
    lifts = spark.createDataFrame([], "station_name string, pct_available double")
    day = dt.date(2025, 1, 7)
    calendar = spark.createDataFrame([(day, "JOHV")], "date date, cat_jour string")
    routes = recommend.recommend(asked, schedule, walks, stops, delays, crowd, lifts, calendar, day)
    found = {r.destination_station: (r.walking_m, r.crowding_est) for r in routes.collect()}
    assert found == {"s2": (0.0, 200.0), "48.101,2.0": (111.2, 200.0)}
    ((options, walks_given, more),) = given
    assert not walks_given and not {"access", "egress"} & more.keys()
    assert {r.destination_station: r._times for r in options.collect()} == {"s2": 2, "48.101,2.0": 2}


def test_calls_of_routes_need_no_written_schedule(spark):
    """Messages and scores come from marked calls: no table of all stop times or of the whole schedule is written for them."""
    files = journeys.demanded_calls.plan(Tables(spark, "/root/testdata/sf0.001")).inputFiles()
    assert any("lineitem" in f for f in files) and not any("/schedule/" in f or "/stop_times/" in f for f in files)


def test_scored_options_come_from_legs_and_not_from_written_routes(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    files = journeys.options.plan(t).inputFiles()
    assert any("/demanded_calls/" in f for f in files) and not any("/direct/" in f or "/changing/" in f for f in files)
    # Searches are written once: joins with options know that they are few.
    assert any("/searches/" in f for f in journeys.searches(t).inputFiles())
