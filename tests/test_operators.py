from __future__ import annotations

import datetime as dt
import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from headway.functions.geo import great_circle_m
from headway.operators import search
from headway.operators.calendars import explode_days, in_ranges
from headway.operators.nearby import nearest_anywhere, nearest_points, walkable_stops
from headway.operators.ranking import (
    arg_max,
    dedup_subset,
    latest_per_key,
    min_per_key,
    minmax_normalise,
    next_in_time,
    page,
    share_of_total,
    with_minmax,
)
from headway.operators.snapshot import latest_snapshot, retained_snapshots


def day(n):
    return dt.date(2025, 1, n)


def test_latest_snapshot(spark, rows):
    df = spark.createDataFrame([(1, day(1)), (2, day(2)), (3, day(2))], "id int, ingestion_date date")
    assert rows(latest_snapshot(df), "id") == [(2,), (3,)]


def test_retained_snapshots(spark, rows):
    df = spark.createDataFrame([(day(n),) for n in (1, 2, 10, 11, 11, 12)], "d date")
    kept = retained_snapshots(df, "d", 1, 3, day(12))
    assert rows(kept) == [(day(10),), (day(11),), (day(12),)]
    assert len(rows(retained_snapshots(df, "d", 30, 1, day(12)))) == 5


def test_latest_per_key_limits_before_the_shuffle(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", None, "z")], "k string, v int, t string")
    out = latest_per_key(df, ["k"], [F.col("v").desc_nulls_last()])
    assert rows(out) == [("a", 2, "y"), ("b", None, "z")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_next_in_time_equals_lead_over_the_key(spark, rows):
    rng = random.Random(3)
    data = [(f"k{rng.randrange(3)}", dt.datetime(2025, 1, 1) + dt.timedelta(seconds=rng.randrange(400000)), i) for i in range(300)]
    df = spark.createDataFrame(data, "k string, ts timestamp, i int")
    plain = df.withColumn("next_ts", F.lead("ts").over(Window.partitionBy("k").orderBy("ts", "i")))
    assert rows(next_in_time(df, ["k"], "ts", ["i"])) == rows(plain)
    assert rows(next_in_time(df, ["k"], "ts", ["i"], slice_seconds=600)) == rows(plain)


def test_share_of_total_and_normalise(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, n int")
    assert rows(share_of_total(df, "n", "pct"), "pct") == [(25.0,), (75.0,)]
    bound = with_minmax(spark.createDataFrame([(None, 1), (None, 3), ("h", 2)], "g string, v int"), "v", ["g"], "s", False)
    assert rows(bound, "v", "s") == [(1, 0.0), (2, 1.0), (3, 1.0)]
    three = spark.createDataFrame([("g", 10), ("g", 20), ("g", 30), ("h", 5), ("h", 5)], "g string, v int")
    assert rows(three.select("v", minmax_normalise("v", ["g"], True).alias("s"))) == [
        (10, 1.0),
        (20, 0.5),
        (30, 0.0),
        (5, 1.0),
        (5, 1.0),
    ]


def test_picks_do_not_depend_on_order(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, None)], "k int, v string")
    assert rows(dedup_subset(df, ["k"])) == [(1, "a"), (2, None)]
    assert rows(min_per_key(df, ["k"], ["v"])) == [(1, "a"), (2, None)]
    best = arg_max(spark.createDataFrame([("x", 1.0), ("z", 2.0), ("y", 2.0), ("w", None)], "l string, v double"), "l", "v")
    assert rows(best) == [("y", 2.0)]


def test_pages_do_not_overlap(spark):
    df = spark.range(25)
    ids = [r.id for start in (0, 10, 20) for r in page(df, [F.col("id")], 10, start).collect()]
    assert ids == list(range(25))


def test_explode_days_skips_reversed_intervals(spark, rows):
    df = spark.createDataFrame([(1, day(1), day(3)), (2, day(3), day(1)), (3, None, day(1))], "id int, s date, e date")
    assert rows(explode_days(df, "s", "e"), "id", "date") == [(1, day(n)) for n in (1, 2, 3)]
    assert rows(explode_days(df, "s", "e", closed=False), "id", "date") == [(1, day(1)), (1, day(2))]


def test_in_ranges_is_half_open(spark, rows):
    days = spark.createDataFrame([(day(n),) for n in range(1, 8)], "d date")
    spans = spark.createDataFrame([(day(2), day(4)), (day(3), day(5))], "s date, e date")
    assert rows(in_ranges(days, "d", spans, "s", "e")) == [(day(2),), (day(3),), (day(4),)]


def test_nearest_points_match_brute_force(spark, rows):
    rng = random.Random(5)
    people = [(i, 48 + rng.random() * 0.4, 2 + rng.random() * 0.4) for i in range(40)]
    spots = [(i, 48 + rng.random() * 0.4, 2 + rng.random() * 0.4) for i in range(60)]
    spots += [(100 + i, spots[0][1], spots[0][2]) for i in range(9)]
    asked = spark.createDataFrame(people, "person int, lat double, lon double")
    points = spark.createDataFrame(spots, "stop_id int, point_lat double, point_lon double")
    near = nearest_points(asked, points, ["person"], "stop_id", 4, 5000.0)
    distance = F.round(great_circle_m(F.col("point_lat"), F.col("point_lon"), F.col("lat"), F.col("lon")), 3)
    every = asked.crossJoin(points).withColumn("distance_m", distance).where("distance_m <= 5000")
    order = Window.partitionBy("person").orderBy("distance_m", "stop_id")
    brute = every.withColumn("near_rank", F.row_number().over(order)).where("near_rank <= 4")
    columns = ["person", "stop_id", "distance_m", "near_rank"]
    assert rows(near, *columns) == rows(brute, *columns)


def test_nearest_points_near_the_pole(spark, rows):
    asked = spark.createDataFrame([(1, 80.0, 10.0)], "person int, lat double, lon double")
    points = spark.createDataFrame([(7, 80.0, 10.25)], "stop_id int, point_lat double, point_lon double")
    assert rows(nearest_points(asked, points, ["person"], "stop_id", 4, 5000.0), "stop_id") == [(7,)]


def brute_nearest(asked, points, limit):
    distance = F.round(great_circle_m(F.col("point_lat"), F.col("point_lon"), F.col("lat"), F.col("lon")), 3)
    order = Window.partitionBy("person").orderBy("distance_m", "stop_id")
    every = asked.crossJoin(points).withColumn("distance_m", distance).where("lat IS NOT NULL AND point_lat IS NOT NULL")
    return every.withColumn("near_rank", F.row_number().over(order)).where(F.col("near_rank") <= limit)


def test_nearest_points_across_the_date_line(spark, rows):
    asked = spark.createDataFrame([(1, 0.0, 179.99), (2, -16.8, -179.98), (3, 10.0, 180.0), (4, 10.0, -180.0)], "person int, lat double, lon double")
    spots = [(1, 0.0, -179.99), (2, 0.0, 179.98), (3, -16.8, 179.99), (4, 10.0, -179.999), (5, 10.01, 179.99)]
    points = spark.createDataFrame(spots, "stop_id int, point_lat double, point_lon double")
    columns = ["person", "stop_id", "distance_m", "near_rank"]
    found = nearest_points(asked, points, ["person"], "stop_id", 4, 5000.0)
    assert rows(found, *columns) == rows(brute_nearest(asked, points, 4).where("distance_m <= 5000"), *columns)
    assert found.count() == 7


@pytest.mark.parametrize("first", [500.0, 3_000_000.0])
def test_nearest_anywhere_matches_brute_force(spark, rows, first):
    """A dense town, a few places over the whole earth, both poles and the date line, lone requests, null coordinates."""
    rng = random.Random(8)
    town = [(i, 48 + rng.random() / 10, 2 + rng.random() / 10) for i in range(80)]
    world = [(100 + i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(25)] + [(200, 90.0, 0.0), (201, -89.99, 77.0), (202, 5.0, 180.0), (203, 5.0, -179.9), (204, None, 1.0)]
    people = [(i, 48 + rng.random() / 10, 2 + rng.random() / 10) for i in range(10)]
    people += [(50 + i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(15)] + [(90, 89.95, -120.0), (91, -90.0, 0.0), (92, 5.0, -180.0), (93, -35.0, 140.0), (94, None, None)]
    asked = spark.createDataFrame(people, "person int, lat double, lon double")
    points = spark.createDataFrame(town + world, "stop_id int, point_lat double, point_lon double")
    columns = ["person", "stop_id", "distance_m", "near_rank"]
    assert rows(nearest_anywhere(asked, points, ["person"], "stop_id", 3, first), *columns) == rows(brute_nearest(asked, points, 3), *columns)


def test_nearest_anywhere_of_too_few_points(spark, rows):
    asked = spark.createDataFrame([(1, 0.0, 0.0), (2, 10.0, 170.0)], "person int, lat double, lon double")
    points = spark.createDataFrame([(7, -60.0, -20.0), (8, 60.0, 175.0)], "stop_id int, point_lat double, point_lon double")
    found = nearest_anywhere(asked, points, ["person"], "stop_id", 5, 10_000_000.0)
    assert rows(found, "person", "stop_id", "near_rank") == [(1, 7, 1), (1, 8, 2), (2, 7, 2), (2, 8, 1)]
    assert nearest_anywhere(asked, points.limit(0), ["person"], "stop_id", 5, 10_000_000.0).isEmpty()


def test_walking_rule(spark, rows):
    near = spark.createDataFrame(
        [(1, 900.0, 1), (1, 1400.0, 2), (1, 1600.0, 3), (2, 2000.0, 1), (2, 2100.0, 2)],
        "p int, distance_m double, near_rank int",
    )
    assert rows(walkable_stops(near, 1500.0), "p", "near_rank") == [(1, 1), (1, 2), (2, 1)]


def test_latest_is_one_answer_in_any_order(spark, rows):
    from headway.operators.ranking import latest_per_key

    states = [(1, 5, name, i) for i, name in enumerate("CABD")]
    for order in (states, states[::-1], states[2:] + states[:2]):
        df = spark.createDataFrame(order, "k int, at int, name string, n int").repartition(3)
        assert rows(latest_per_key(df, ["k"], [F.col("at").desc()])) == [(1, 5, "A", 1)]


def test_page_without_limit(spark, rows):
    from headway.operators.ranking import page

    assert page(spark.range(900), [F.col("id")], None).count() == 900


def test_shared_folder_is_required_on_a_cluster(spark):
    from types import SimpleNamespace

    from headway.session import shared_folder

    def session(master, folder=None):
        conf = SimpleNamespace(get=lambda key, default=None: folder or default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app"))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077"))
    assert shared_folder(session("yarn", "hdfs://a/b/")) == "hdfs://a/b"
    assert shared_folder(session("local[4]"))


def test_contains_search_matches_brute_force(spark, rows):
    rng = random.Random(6)
    names = [(i, "".join(rng.choices("ab é", k=rng.randint(0, 9))), "".join(rng.choices("abC%_", k=rng.randint(0, 6)))) for i in range(120)]
    names += [(200, None, "Gare"), (201, " gare du nord ", None), (202, None, None), (200, "x", "gare")]
    asked = ["".join(rng.choices("abc é", k=rng.randint(1, 6))) for _ in range(80)] + ["GARE", " gare ", "re du no", "%", "b_", "", "  ", None, "nowhere", "É"]
    stops = spark.createDataFrame(names, "stop int, own string, station string")
    texts = spark.createDataFrame([(x,) for x in asked], "asked string")
    index = search.name_index(stops, "stop", "own", "station")
    hit = F.coalesce(contains_term_column("own"), F.lit(False)) | F.coalesce(contains_term_column("station"), F.lit(False))
    brute = texts.distinct().where(F.trim("asked") != "").crossJoin(stops).where(hit).select("asked", "stop").distinct()
    found = search.contains_search(texts, "asked", index, "stop")
    assert rows(found, "asked", "stop") == rows(brute, "asked", "stop")
    assert {r.asked for r in found.collect()} >= {"GARE", " gare ", "re du no", "É"}
    assert search.contains_search(texts, "asked", search.name_index(stops.limit(0), "stop", "own"), "stop").isEmpty()


def contains_term_column(c):
    return F.contains(F.upper(F.trim(c)), F.upper(F.trim("asked")))
