"""Journey recommendation for a whole table of requests at once.

Requests are first reduced to distinct searches, so a hot origin-destination pair is
routed and scored once however many people asked for it; every later step is a join on
the search. Schedules are reduced to demanded stops and to distinct clock times before
they are joined, which bounds each stop pair by the seconds of a day and not by the
number of trips.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions import clock, text
from headway.functions.measures import all_true, any_true
from headway.operators.nearby import nearest_points, walkable_stops
from headway.operators.ranking import min_per_key, top_n_per_group
from headway.session import settled


@dataclass(frozen=True)
class RouteSettings:
    """Search windows, limits and score weights."""

    top_routes: int = 3
    default_transfer_sec: int = 180
    max_wait_sec: int = 1800
    lookback_sec: int = 1800
    window_sec: int = 7200
    nearest_stops: int = 4
    max_access_walk_m: float = 1500.0
    max_access_reach_m: float = 5000.0
    min_duration_sec: int = 60
    default_reliability: float = 85.0
    weight_duration: float = 0.40
    weight_reliability: float = 0.25
    weight_crowding: float = 0.20
    weight_walking: float = 0.15


DEFAULTS = RouteSettings()

PLACE = ["origin_station", "destination_station", "hour"]
OPTION = PLACE + ["accessible_required", "board_stop_id", "alight_stop_id", "lines"]
PREFERENCES = ["accessible_required", "crowding_sensitivity", "minimize_walking", "max_transfers"]
SEARCH = PLACE + PREFERENCES


# --- requests --------------------------------------------------------------


def due_requests(subscriptions: DataFrame, sent: DataFrame, now: datetime) -> DataFrame:
    """Active subscriptions whose hour and minute have come and that have no row for today."""
    minute = F.floor(F.col("notify_time") / 60)
    due = subscriptions.where(F.col("active") & (minute == now.hour * 60 + now.minute))
    today = sent.where(F.col("notify_date") == F.lit(now.date())).select(F.col("subscription_id").alias("id"))
    return due.join(today, "id", "left_anti")


def with_hour(requests: DataFrame) -> DataFrame:
    return requests.withColumn("hour", F.floor(F.col("notify_time") / 3600).cast("int"))


def searches_of(requests: DataFrame) -> DataFrame:
    return requests.select(*SEARCH).distinct()


def stops_by_prefix(names: DataFrame, name: str, stops: DataFrame) -> DataFrame:
    """(name, stop_id) for every asked text and each stop whose own or station name starts with it.

    A stop yields the prefixes of its two names that are as long as some asked text, and
    these meet the asked texts by equality; a LIKE join would compare every pair. The
    lengths are few: no more than the longest name has letters.
    """
    asked = names.select(name).distinct().where(F.trim(name) != "").withColumn("_key", text.name_key(name))
    lengths = asked.agg(F.array_sort(F.collect_set(F.length("_key")))).scalar()

    def prefixes(c: str) -> Column:
        key = text.name_key(c)
        fitting = F.filter("_lengths", lambda n: n <= F.length(key))
        return F.coalesce(F.transform(fitting, lambda n: F.substring(key, F.lit(1), n)), F.array().cast("array<string>"))

    both = F.array_union(prefixes("stop_name"), prefixes("parent_station_name"))
    stops = stops.where(F.col("stop_id").isNotNull()).withColumn("_lengths", lengths)
    known = stops.select("stop_id", F.explode(both).alias("_key"))
    return known.join(asked, "_key").select(name, "stop_id").distinct()


def stops_near(requests: DataFrame, keys: list[str], stops: DataFrame, cfg: RouteSettings = DEFAULTS) -> DataFrame:
    """The stops a request's coordinates lead to, with distance_m; none when out of reach."""
    points = stops.select(
        "stop_id", "stop_name", F.col("stop_lat").alias("point_lat"), F.col("stop_lon").alias("point_lon")
    )
    near = nearest_points(requests, points, keys, "stop_id", cfg.nearest_stops, cfg.max_access_reach_m)
    return walkable_stops(near, cfg.max_access_walk_m).select(*keys, "stop_id", "stop_name", "distance_m", "near_rank")


# --- legs ------------------------------------------------------------------

CALL = ["trip_id", "route_short_name", "route_type", "stop_id", "stop_name", "stop_sequence", "arrival_seconds", "departure_seconds"]


def demanded_calls(schedule: DataFrame, walking: DataFrame, origins: DataFrame, destinations: DataFrame) -> DataFrame:
    """Calls where somebody boards, alights or changes, with a mark for each such use of their stop.

    Routes use a call up to four times; one join by stop marks it for all of them, and only the
    columns that routes need go on.
    """
    uses = [
        origins.select("stop_id", F.lit("origin").alias("_use")),
        destinations.select("stop_id", F.lit("destination").alias("_use")),
        walking.select(F.col("from_stop_id").alias("stop_id"), F.lit("leave").alias("_use")),
        walking.select(F.col("to_stop_id").alias("stop_id"), F.lit("enter").alias("_use")),
    ]
    marks = [any_true(F.col("_use") == use).alias(f"at_{use}") for use in ("origin", "destination", "leave", "enter")]
    return schedule.select(*CALL).join(reduce(DataFrame.unionByName, uses).groupBy("stop_id").agg(*marks), "stop_id")


def _calls_at(schedule: DataFrame, use: str, stop_ids: DataFrame) -> DataFrame:
    """Calls at the given stops; where calls are marked, those marked for that use."""
    if f"at_{use}" in schedule.columns:
        return schedule.where(f"at_{use}")
    return schedule.join(stop_ids.select("stop_id").distinct(), "stop_id", "left_semi")


def _hours_of_departure(places: DataFrame, cfg: RouteSettings) -> DataFrame:
    """Departure windows of the asked hours, cut into half hours for an equality join."""
    step = 1800
    first = F.col("hour") * 3600 - cfg.lookback_sec
    last = F.col("hour") * 3600 + cfg.window_sec
    hours = places.select("hour").distinct()
    return hours.select(
        "hour",
        first.alias("_first"),
        last.alias("_last"),
        F.explode(F.sequence(F.floor(first / step), F.floor(last / step))).alias("_slot"),
    )


def _boardings(schedule: DataFrame, origins: DataFrame, places: DataFrame, cfg: RouteSettings) -> DataFrame:
    """Departures from demanded origin stops inside an asked hour's window."""
    departures = (
        _calls_at(schedule, "origin", origins)
        .where(F.col("departure_seconds").isNotNull())
        .withColumn("_slot", F.floor(F.col("departure_seconds") / 1800))
    )
    inside = F.col("departure_seconds").between(F.col("_first"), F.col("_last"))
    return (
        departures.join(_hours_of_departure(places, cfg), "_slot")
        .where(inside)
        .select(
            "hour",
            "trip_id",
            F.col("route_short_name").alias("line"),
            "route_type",
            F.col("stop_id").alias("board_stop_id"),
            F.col("stop_name").alias("board_stop"),
            F.col("stop_sequence").alias("board_seq"),
            F.col("departure_seconds").alias("dep"),
        )
    )


def _alightings(schedule: DataFrame, use: str, stop_ids: DataFrame) -> DataFrame:
    return (
        _calls_at(schedule, use, stop_ids)
        .where(F.col("arrival_seconds").isNotNull())
        .select(
            "trip_id",
            F.col("stop_id").alias("alight_stop_id"),
            F.col("stop_name").alias("alight_stop"),
            F.col("stop_sequence").alias("alight_seq"),
            F.col("arrival_seconds").alias("arr"),
        )
    )


RIDE = ["line", "route_type", "board_stop_id", "board_stop", "alight_stop_id", "alight_stop"]


def fastest_rides(
    schedule: DataFrame, origins: DataFrame, destinations: DataFrame, places: DataFrame, cfg: RouteSettings = DEFAULTS
) -> DataFrame:
    """Least ride time per hour, line and stop pair among demanded stops, without a change.

    Rides pair a boarding with later calls of its own trip only, and both sides hold
    demanded stops only; the minimum combines map-side before the shuffle on the pair.
    """
    boards = _boardings(schedule, origins, places, cfg)
    alights = _alightings(schedule, "destination", destinations)
    rides = boards.join(alights, "trip_id").where(
        (F.col("alight_seq") > F.col("board_seq")) & (F.col("arr") > F.col("dep"))
    )
    return rides.groupBy("hour", *RIDE).agg(F.min(F.col("arr") - F.col("dep")).alias("duration_sec"))


# Names of a stop up to which its legs take them all.
FEW_NAMES = 8

BY_NAMES, BY_ORIGIN, BY_DESTINATION = 0, 1, 2


def _ways(legs: DataFrame, boards: DataFrame, alights: DataFrame, asked: DataFrame) -> DataFrame:
    """Legs with a number, ``_leg``, and ``_way``: by which of three joins each meets the fewest names and places. Written, as they
    are read for each.

    Rows are counted of the pairs of names of the leg's stops, of the places asked from its first stop at its hour, and of
    those asked to its last one. Legs without any are left out.
    """

    def counts(side: DataFrame, stop: str, name: str) -> DataFrame:
        places = asked.groupBy(name, "hour").agg(F.count("*").alias("_asked"))
        found = side.join(places, name).groupBy(stop, "hour").agg(F.sum("_asked").alias(f"_asked_{stop}"))
        return settled(found.join(side.groupBy(stop).agg(F.count("*").alias(f"_names_{stop}")), stop), f"counts_by_{stop}")

    known = legs.join(counts(boards, "board_stop_id", "origin_station"), ["board_stop_id", "hour"])
    known = known.join(counts(alights, "alight_stop_id", "destination_station"), ["alight_stop_id", "hour"])
    pairs = F.col("_names_board_stop_id") * F.col("_names_alight_stop_id")
    from_here, to_there = F.col("_asked_board_stop_id"), F.col("_asked_alight_stop_id")
    way = F.when(pairs <= F.least(from_here, to_there), BY_NAMES).when(from_here <= to_there, BY_ORIGIN).otherwise(BY_DESTINATION)
    return settled(known.select(*legs.columns, way.alias("_way"), F.monotonically_increasing_id().alias("_leg")), "legs")


def _demanded(legs: DataFrame, origins: DataFrame, destinations: DataFrame, places: DataFrame) -> DataFrame:
    """Legs with the (origin, destination, hour) that asked for their stop pair.

    A leg takes the names of both its stops, and those pairs stay that are asked for at its hour. Stops with many names
    would make many pairs of which few are asked for: where there are such stops, a leg may take the places asked from its
    first stop (or to its last one) instead, of which those stay that end (or begin) at its other stop. There only a leg's
    number, stops and hour go through these joins. Names are written, so that their size is known before the legs meet them.
    """
    boards = settled(origins.withColumnRenamed("stop_id", "board_stop_id"), "names_of_origins")
    alights = settled(destinations.withColumnRenamed("stop_id", "alight_stop_id"), "names_of_destinations")
    asked = places.select(*PLACE)

    def few(side: DataFrame, stop: str) -> bool:
        return side.groupBy(stop).count().where(F.col("count") > FEW_NAMES).isEmpty()

    if few(boards, "board_stop_id") and few(alights, "alight_stop_id"):
        return legs.join(boards, "board_stop_id").join(alights, "alight_stop_id").join(asked, PLACE)
    legs = _ways(legs, boards, alights, asked)
    starts, ends = ["origin_station", "board_stop_id"], ["destination_station", "alight_stop_id"]
    begin, end = boards.select(*starts), alights.select(*ends)

    def of(way: int) -> DataFrame:
        return legs.where(F.col("_way") == way).select("_leg", "hour", "board_stop_id", "alight_stop_id")

    named = of(BY_NAMES).join(begin, "board_stop_id").join(end, "alight_stop_id").join(asked, PLACE)
    from_here = of(BY_ORIGIN).join(begin, "board_stop_id").join(asked, ["origin_station", "hour"]).join(end, ends)
    to_there = of(BY_DESTINATION).join(end, "alight_stop_id").join(asked, ["destination_station", "hour"]).join(begin, starts)
    met = reduce(DataFrame.unionByName, (named, from_here, to_there)).select("_leg", "origin_station", "destination_station")
    found = met.join(legs, "_leg").drop("_leg", "_way")
    for side, keys in ((boards, starts), (alights, ends)):
        found = found.join(side, keys) if set(side.columns) - set(keys) else found
    return found


def direct_routes(
    schedule: DataFrame, origins: DataFrame, destinations: DataFrame, places: DataFrame, cfg: RouteSettings = DEFAULTS
) -> DataFrame:
    """All rides without a change for each (origin, destination, hour)."""
    return _demanded(fastest_rides(schedule, origins, destinations, places, cfg), origins, destinations, places)


CHANGE = [
    "line1",
    "route_type1",
    "line2",
    "route_type2",
    "board_stop_id",
    "board_stop",
    "leave_stop",
    "enter_stop",
    "alight_stop_id",
    "alight_stop",
]


FIRST = ["hour", "line1", "route_type1", "board_stop_id", "board_stop", "x_stop", "leave_stop"]
SECOND = ["line2", "route_type2", "y_stop", "enter_stop", "alight_stop_id", "alight_stop"]


def _minimum(cfg: RouteSettings) -> Column:
    return F.coalesce("min_transfer_time", F.lit(cfg.default_transfer_sec))


def all_connections(first: DataFrame, walks: DataFrame, second: DataFrame, cfg: RouteSettings = DEFAULTS) -> DataFrame:
    """Every pair of rides joined by a walk: the second leaves within [minimum, maximum] wait."""
    leaving = first.join(walks, F.col("x_stop") == F.col("from_stop_id"))
    leaving = leaving.withColumns({"_low": F.col("arr_x") + _minimum(cfg), "_high": F.col("arr_x") + cfg.max_wait_sec})
    return _in_band(leaving, second, cfg).drop("_low", "_high", "_slot")


def _in_band(leaving: DataFrame, second: DataFrame, cfg: RouteSettings) -> DataFrame:
    """First rides with a walk meet second rides from its end that depart within [_low, _high].

    The band is cut into slots, so each first ride looks into a few of them by equality and a
    hub's rides are spread over many; the exact bounds are a residual.
    """
    slot = max(1, cfg.max_wait_sec // 4)
    asked = leaving.where(F.col("_low") <= F.col("_high")).withColumn(
        "_slot", F.explode(F.sequence(F.floor(F.col("_low") / slot), F.floor(F.col("_high") / slot)))
    )
    entering = second.withColumn("_at", F.floor(F.col("dep_y") / slot))
    met = asked.join(entering, (F.col("to_stop_id") == F.col("y_stop")) & (F.col("_slot") == F.col("_at"))).drop("_at")
    return met.where(
        F.col("dep_y").between(F.col("_low"), F.col("_high")) & (F.col("arr2") > F.col("dep1")) & (F.col("line1") != F.col("line2"))
    )


def arrival_front(first: DataFrame) -> DataFrame:
    """First rides of a line and stop pair that can begin a fastest change, with what bounds their use.

    Of rides that arrive together only the last to depart stays. The others form a front, on
    which later arrivals departed later; ``next_arr`` is the front's next arrival, from which on
    a change is better made from that ride. A ride off the front departed no later than one that
    arrived before it, at ``best_arr``, and is of use only where that one's wait is too long.
    """
    rides = first.groupBy(*FIRST, "arr_x").agg(F.max("dep1").alias("dep1"))
    order = Window.partitionBy(*FIRST).orderBy("arr_x")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    ahead = rides.withColumn("_ahead", F.coalesce(F.col("dep1") > F.max("dep1").over(before), F.lit(True)))
    on = F.when(F.col("_ahead"), F.col("arr_x"))
    marked = ahead.withColumns({"next_arr": F.min(on).over(after), "best_arr": F.max(on).over(before)})
    return marked.withColumns({c: F.when(F.col("_ahead") == own, F.col(c)) for c, own in (("next_arr", True), ("best_arr", False))}).drop("_ahead")


def departure_front(second: DataFrame) -> DataFrame:
    """Second rides of a line and stop pair that can end a fastest change, with what bounds their use.

    Of rides that depart together only the first to arrive stays. On the front, later
    departures arrive later; ``prev_dep`` is the front's departure before. A ride off the front arrives no
    earlier than one that departs after it, at ``best_dep``, and is of use only to who can't wait for that.
    """
    rides = second.groupBy(*SECOND, "dep_y").agg(F.min("arr2").alias("arr2"))
    order = Window.partitionBy(*SECOND).orderBy("dep_y")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    ahead = rides.withColumn("_ahead", F.coalesce(F.col("arr2") < F.min("arr2").over(after), F.lit(True)))
    on = F.when(F.col("_ahead"), F.col("dep_y"))
    marked = ahead.withColumns({"prev_dep": F.max(on).over(before), "best_dep": F.min(on).over(after)})
    return marked.withColumns({c: F.when(F.col("_ahead") == own, F.col(c)) for c, own in (("prev_dep", True), ("best_dep", False))}).drop("_ahead")


def front_connections(first: DataFrame, walks: DataFrame, second: DataFrame, cfg: RouteSettings = DEFAULTS) -> DataFrame:
    """Pairs of rides among which are the fastest of every line and stop pair on both sides of every walk.

    Rides must arrive after they depart. On the fronts, a change is kept only from the last arrival
    that makes the departure to the first departure after that arrival, so a pair of lines has at most as many
    as the lesser of its fronts; rides off a front keep the seconds in which the ride that beats
    them is out of the wait.
    """
    leaving = arrival_front(first).join(walks, F.col("x_stop") == F.col("from_stop_id"))
    latest = F.col("arr_x") + cfg.max_wait_sec
    # From the ready time, or from when the better ride's wait is over, to the last second before the next ride's.
    low = F.greatest(F.col("arr_x") + _minimum(cfg), F.col("best_arr") + cfg.max_wait_sec + 1)
    high = F.least(latest, F.col("next_arr") + _minimum(cfg) - 1)
    leaving = leaving.withColumns({"_low": low, "_high": high, "_latest": latest})
    met = _in_band(leaving, departure_front(second), cfg)
    first_after = F.col("prev_dep").isNull() | (F.col("prev_dep") < F.col("_low"))
    needed = first_after & (F.col("best_dep").isNull() | (F.col("best_dep") > F.col("_latest")))
    return met.where(needed).drop("_low", "_high", "_latest", "_slot", "next_arr", "best_arr", "prev_dep", "best_dep")


def connections(first: DataFrame, walks: DataFrame, second: DataFrame, cfg: RouteSettings = DEFAULTS) -> DataFrame:
    """Pairs of rides joined by a walk that hold the fastest change of every line and stop pair.

    Rides that arrive no later than they depart and walks of negative time are faults of the
    data for which no ride is better than another; they meet everything. Without such faults
    their joins are dropped as soon as a side is known to be empty.
    """
    sane1, sane2 = F.col("arr_x") >= F.col("dep1"), F.col("arr2") > F.col("dep_y")
    usual = _minimum(cfg) >= 0
    good, odd = walks.where(usual), walks.where(~usual)
    pairs = front_connections(first.where(sane1), good, second.where(sane2), cfg)
    for some1, some, some2 in ((first.where(~sane1), good, second), (first.where(sane1), good, second.where(~sane2)), (first, odd, second)):
        pairs = pairs.unionByName(all_connections(some1, some, some2, cfg))
    return pairs


def transfer_legs(
    schedule: DataFrame,
    walking: DataFrame,
    origins: DataFrame,
    destinations: DataFrame,
    places: DataFrame,
    cfg: RouteSettings = DEFAULTS,
) -> DataFrame:
    """Least total time per hour and pair of lines with one walk between them.

    Rides to a walk's start and from a walk's end are reduced to distinct clock times
    (many trips share them) and to their fronts before the time-band join.
    """
    walks = walking.select(
        "from_stop_id", "to_stop_id", "min_transfer_time", "pathway_length_m", "has_stairs", "has_elevator"
    )
    leave_at = walks.select(F.col("from_stop_id").alias("stop_id"))
    enter_at = walks.select(F.col("to_stop_id").alias("stop_id"))
    first = (
        _boardings(schedule, origins, places, cfg)
        .join(_alightings(schedule, "leave", leave_at), "trip_id")
        .where(F.col("alight_seq") > F.col("board_seq"))
        .select(
            "hour",
            F.col("line").alias("line1"),
            F.col("route_type").alias("route_type1"),
            "board_stop_id",
            "board_stop",
            F.col("dep").alias("dep1"),
            F.col("alight_stop_id").alias("x_stop"),
            F.col("alight_stop").alias("leave_stop"),
            F.col("arr").alias("arr_x"),
        )
        .distinct()
    )
    starts = (
        _calls_at(schedule, "enter", enter_at)
        .where(F.col("departure_seconds").isNotNull())
        .select(
            "trip_id",
            F.col("route_short_name").alias("line2"),
            F.col("route_type").alias("route_type2"),
            F.col("stop_id").alias("y_stop"),
            F.col("stop_name").alias("enter_stop"),
            F.col("stop_sequence").alias("y_seq"),
            F.col("departure_seconds").alias("dep_y"),
        )
    )
    second = (
        starts.join(_alightings(schedule, "destination", destinations), "trip_id")
        .where(F.col("alight_seq") > F.col("y_seq"))
        .select(
            "line2", "route_type2", "y_stop", "enter_stop", "dep_y", "alight_stop_id", "alight_stop", F.col("arr").alias("arr2")
        )
        .distinct()
    )
    return (
        connections(first, walks, second, cfg)
        .groupBy("hour", *CHANGE)
        .agg(
            F.min(F.col("arr2") - F.col("dep1")).alias("duration_sec"),
            F.min("pathway_length_m").alias("walking_m"),
            all_true(F.coalesce("has_stairs", F.lit(False))).alias("stairs_all"),
            any_true(F.coalesce("has_elevator", F.lit(False))).alias("elevator_any"),
        )
    )


def transfer_routes(
    schedule: DataFrame,
    walking: DataFrame,
    origins: DataFrame,
    destinations: DataFrame,
    places: DataFrame,
    cfg: RouteSettings = DEFAULTS,
) -> DataFrame:
    """All rides with one change for each (origin, destination, hour)."""
    legs = transfer_legs(schedule, walking, origins, destinations, places, cfg)
    return _demanded(legs, origins, destinations, places)


# --- candidates and scores -------------------------------------------------


def _strings(*cols: str) -> Column:
    return F.array(*cols)


def all_candidates(direct: DataFrame, transfer: DataFrame) -> DataFrame:
    """Both route kinds in one shape, for places or, before legs have met these, for hours."""
    place = [c for c in PLACE if c in direct.columns]
    straight = direct.select(
        *place,
        F.lit(0).alias("transfers"),
        _strings("line").alias("lines"),
        "board_stop_id",
        "board_stop",
        "alight_stop_id",
        "alight_stop",
        _strings("board_stop", "alight_stop").alias("stations"),
        F.array().cast("array<string>").alias("transfer_stations"),
        "duration_sec",
        F.lit(0.0).alias("walking_m"),
        F.lit(False).alias("blocked_no_elevator"),
    )
    changing = transfer.select(
        *place,
        F.lit(1).alias("transfers"),
        _strings("line1", "line2").alias("lines"),
        "board_stop_id",
        "board_stop",
        "alight_stop_id",
        "alight_stop",
        _strings("board_stop", "leave_stop", "enter_stop", "alight_stop").alias("stations"),
        _strings("leave_stop", "enter_stop").alias("transfer_stations"),
        "duration_sec",
        F.coalesce("walking_m", F.lit(0.0)).alias("walking_m"),
        (F.col("stairs_all") & ~F.col("elevator_any")).alias("blocked_no_elevator"),
    )
    return straight.unionByName(changing)


def _fastest(candidates: DataFrame, cfg: RouteSettings) -> DataFrame:
    """The fastest candidate per (board, alight, lines) once for all travellers whose it is, with ``_needs``: theirs of
    ``accessible_required``.

    The row itself is ordered, so it is held once; those that are no use without steps are kept apart, so a
    change has two rows only where the fastest one of all is among them.
    """
    keys = [c for c in OPTION if c in candidates.columns and c != "accessible_required"]
    order = ["duration_sec", "transfers", "walking_m", "stations", "transfer_stations"]
    row = F.struct(*order, *[c for c in candidates.columns if c not in (*keys, *order, "blocked_no_elevator")])
    steps = F.coalesce("blocked_no_elevator", F.lit(False))
    valid = candidates.where(F.col("duration_sec") >= cfg.min_duration_sec).repartition(*keys)
    best = valid.groupBy(*keys).agg(F.min(F.when(steps, row)).alias("_steps"), F.min(F.when(~steps, row)).alias("_free"))

    def of(row: str, *needs: bool) -> Column:
        return F.struct(F.col(row).alias("row"), F.array(*map(F.lit, needs)).alias("needs"))

    apart = F.when(F.col("_free").isNull(), F.array(of("_steps", False))).when(
        F.col("_steps") < F.col("_free"), F.array(of("_steps", False), of("_free", True))
    )
    kinds = best.select(*keys, F.explode(F.coalesce(apart, F.array(of("_free", False, True)))).alias("_kind"))
    return kinds.select(*keys, "_kind.row.*", F.col("_kind.needs").alias("_needs"))


def _for_travellers(fastest: DataFrame) -> DataFrame:
    return fastest.withColumn("accessible_required", F.explode("_needs")).drop("_needs")


def route_options(candidates: DataFrame, cfg: RouteSettings = DEFAULTS) -> DataFrame:
    """The fastest candidate per (board, alight, lines), for travellers with and without steps.

    The choice depends on the place and on ``accessible_required`` alone, so it is made
    here once per place and not once per search.
    """
    return _for_travellers(_fastest(candidates, cfg))


def asked_options(
    direct: DataFrame, transfer: DataFrame, origins: DataFrame, destinations: DataFrame, places: DataFrame, cfg: RouteSettings = DEFAULTS
) -> DataFrame:
    """The route options of every place, from legs without a change and with one.

    All places of an hour choose alike between two stops, so the choice is made before legs meet places. Columns that
    origins and destinations have beside their stops stay.
    """
    fastest = _fastest(all_candidates(direct, transfer), cfg)
    return _for_travellers(_demanded(fastest, origins, destinations, places))


def route_candidates(searches: DataFrame, options: DataFrame) -> DataFrame:
    """The options each search allows."""
    fitting = searches.join(options, PLACE + ["accessible_required"])
    return fitting.where(F.col("transfers") <= F.col("max_transfers"))


def line_reliability(delays_by_stop: DataFrame) -> DataFrame:
    return (
        delays_by_stop.groupBy(text.name_key("published_line").alias("line_key"))
        .agg(F.avg("pct_on_time").alias("pct_on_time"))
        .where(F.col("line_key").isNotNull() & F.col("pct_on_time").isNotNull())
    )


def station_crowding(crowding: DataFrame) -> DataFrame:
    """Mean estimated validations per station name, hour and day type."""
    return (
        crowding.groupBy(
            text.name_key("libelle_arret").alias("station_key"), F.col("hour_start").alias("hour"), "cat_jour"
        )
        .agg(F.avg("estimated_validations").alias("crowd"))
        .where(F.col("station_key").isNotNull() & F.col("crowd").isNotNull())
    )


def elevator_status(availability: DataFrame) -> DataFrame:
    return (
        availability.groupBy(text.name_key("station_name").alias("station_key"))
        .agg(F.min("pct_available").alias("pct_available"))
        .where(F.col("station_key").isNotNull() & F.col("pct_available").isNotNull())
    )


def _valued(options: DataFrame, names: str, values: DataFrame, key: str, folded: Column, at: Sequence[str] = ()) -> DataFrame:
    """What the values of an array's names come to, once for every different array and ``at``; without those that have none.

    Options share few arrays of lines and stations. The table is written, so that its size is
    known when options meet it.
    """
    lists = options.select(names, *at).distinct()
    items = lists.select("*", F.explode(names).alias("_name")).withColumn(key, text.name_key("_name"))
    return settled(items.join(values, [key, *at]).groupBy(names, *at).agg(folded), f"values_of_{names}")


def _with_walk(c: DataFrame, walk: DataFrame, stop: str) -> DataFrame:
    """Options with the metres to or from a stop added; ``_times`` counts how often the stop is listed."""
    keys = [*[k for k in PLACE if k in walk.columns], "stop_id"]
    metres = _metres(walk, keys, "_m", "_n").withColumnRenamed("stop_id", stop)
    on = [k for k in metres.columns if k not in ("_m", "_n")]
    known = c.join(metres, on, "left")
    longer = {"walking_m": F.col("walking_m") + F.coalesce("_m", F.lit(0.0)), "_times": F.col("_times") * F.coalesce("_n", F.lit(1))}
    return known.withColumns(longer).drop("_m", "_n")


def _metres(walk: DataFrame, keys: Sequence[str], metres: str, times: str) -> DataFrame:
    return walk.groupBy(*keys).agg(F.min("distance_m").alias(metres), F.count("*").alias(times))


def with_criteria(
    options: DataFrame,
    reliability: DataFrame,
    crowding: DataFrame,
    lifts: DataFrame,
    service_day: Column,
    access: DataFrame | None = None,
    egress: DataFrame | None = None,
    cfg: RouteSettings = DEFAULTS,
) -> DataFrame:
    """Options with line reliability and station crowding; step-free ones need working lifts.

    ``service_day`` is the day type of the travel date. ``access``/``egress`` add walking
    metres per (place or its named side, stop) for requests that began from coordinates; ``options`` that hold
    these already have ``_times``.
    Values are looked up once for every different array of lines or stations, and options
    take them by the whole array: no option is repeated for its names. ``options`` are read for
    each lookup, so callers pass a written table.
    """
    today = crowding.where(F.col("cat_jour") == service_day).select("station_key", "hour", "crowd")
    lookups = [
        (_valued(options, "lines", reliability, "line_key", F.avg("pct_on_time").alias("_reliability")), ["lines"]),
        (_valued(options, "stations", today, "station_key", F.sum("crowd").alias("_crowd"), ["hour"]), ["stations", "hour"]),
        (_valued(options, "transfer_stations", lifts, "station_key", F.min("pct_available").alias("_worst_lift")), ["transfer_stations"]),
    ]
    c = options if "_times" in options.columns else options.withColumn("_times", F.lit(1).cast("long"))
    for walk, stop in ((access, "board_stop_id"), (egress, "alight_stop_id")):
        c = c if walk is None else _with_walk(c, walk, stop)
    for values, keys in lookups:
        c = c.join(values, keys, "left")
    usable = ~(F.col("accessible_required") & (F.coalesce("_worst_lift", F.lit(100.0)) <= 0))
    criteria = {
        "reliability_pct": F.coalesce("_reliability", F.lit(cfg.default_reliability)),
        "known_crowd": F.col("_crowd") * F.col("_times"),
    }
    return c.where(usable).select(*[k for k in c.columns if not k.startswith("_")], *[v.alias(k) for k, v in criteria.items()])


# Options that are alike share searches; those of one kind are allowed to the same ones.
KIND = PLACE + ["accessible_required", "transfers"]


def score_routes(searches: DataFrame, criteria: DataFrame, cfg: RouteSettings = DEFAULTS) -> DataFrame:
    """The top routes of each search by weighted, min-max scaled criteria.

    A search may have any number of options, and an option many searches. Bounds and sums are
    aggregates of each kind of options, which searches then combine. Options meet
    their searches only inside tasks: the first time for the best score of each of a search's lots, from
    which follows what a top route scores at least, the second time for the options that reach it.
    """
    criteria = settled(_rounded(criteria), "criteria")
    sums = criteria.groupBy(*KIND).agg(
        F.sum("known_crowd").alias("_sum"),
        F.count("known_crowd").alias("_known"),
        *[f(c).alias(f"_{end}_{c}") for c in BOUNDED for end, f in (("low", F.min), ("high", F.max))],
    )
    allowed = searches.join(sums, KIND[:-1]).where(F.col("transfers") <= F.col("max_transfers"))
    bounds = allowed.groupBy(*SEARCH).agg(
        F.round(F.coalesce(F.try_divide(F.sum("_sum"), F.sum("_known")), F.lit(0.0)), 6).alias("_mean"),
        *[f(f"_{end}_{c}").alias(f"_{end}_{c}") for c in BOUNDED for end, f in (("low", F.min), ("high", F.max))],
    )
    bounds = settled(bounds.withColumn("_search", F.monotonically_increasing_id()), "searches")
    scored = _scored(criteria.join(bounds, KIND[:-1]).where(F.col("transfers") <= F.col("max_transfers")), cfg)
    # The order's first three terms as one number: what has less can't come before what has more.
    late = F.least(F.col("duration_sec").cast("long"), F.lit((1 << 31) - 1))
    worth = (F.round((F.coalesce("score", F.lit(-1.0)) + 1) * 10000).cast("long") * 64 - F.least("transfers", F.lit(63))) * (1 << 31) - late
    lot = F.pmod(F.xxhash64("board_stop_id", "alight_stop_id", "lines"), F.lit(LOTS))
    best = scored.groupBy("_search", lot.alias("_lot")).agg(F.max(worth).alias("_worth")).groupBy("_search")
    least = best.agg(F.get(F.sort_array(F.collect_list("_worth"), asc=False), F.lit(cfg.top_routes - 1)).alias("_least"))
    bounds = settled(bounds.join(least, "_search"), "least")
    again = _scored(criteria.join(bounds, KIND[:-1]).where(F.col("transfers") <= F.col("max_transfers")), cfg)
    return _top_routes(again.where(F.col("_least").isNull() | (worth >= F.col("_least"))), cfg)


# Lots into which the options of a search are dealt: the best ones are nearly always in different lots.
LOTS = 16
BOUNDED = ("duration_sec", "reliability_pct", "walking_m", "known_crowd")


def _rounded(kept: DataFrame) -> DataFrame:
    """Criteria are rounded to six digits before scaling. The mean of equal values can be off
    by one bit from the values, which min-max scaling would blow up to a full 0..1 step."""
    return kept.withColumns({"reliability_pct": F.round("reliability_pct", 6), "_crowd": F.round("known_crowd", 6)})


def rank_scored(kept: DataFrame, cfg: RouteSettings = DEFAULTS) -> DataFrame:
    """The top routes among options that stand beside their search, as ``route_candidates`` gives them."""
    wanted = kept.select(*SEARCH).distinct()
    options = kept.drop(*[c for c in PREFERENCES if c != "accessible_required"])
    return score_routes(wanted, options.distinct(), cfg)


def _scored(beside: DataFrame, cfg: RouteSettings) -> DataFrame:
    """Options beside a search's bounds, with their score; unknown crowding takes the search's mean.

    The mean is within the known values, so it moves no bound unless none is known.
    """
    filled = beside.withColumns(
        {
            "crowding_est": F.coalesce("_crowd", "_mean"),
            "_low_crowding_est": F.coalesce(F.round("_low_known_crowd", 6), "_mean"),
            "_high_crowding_est": F.coalesce(F.round("_high_known_crowd", 6), "_mean"),
        }
    )

    def scaled(value: str, lower_is_better: bool) -> Column:
        low, high = F.col(f"_low_{value}"), F.col(f"_high_{value}")
        part = (high - F.col(value)) if lower_is_better else (F.col(value) - low)
        return F.when(high == low, F.lit(1.0)).otherwise(part / (high - low))

    parts = filled.withColumns(
        {
            "_d": scaled("duration_sec", True),
            "_r": scaled("reliability_pct", False),
            "_c": scaled("crowding_est", True),
            "_w": scaled("walking_m", True),
        }
    )
    w_duration, w_reliability = F.lit(cfg.weight_duration), F.lit(cfg.weight_reliability)
    w_crowding = F.lit(cfg.weight_crowding) * (1 + 0.5 * F.col("crowding_sensitivity"))
    w_walking = F.lit(cfg.weight_walking) * F.when(F.col("minimize_walking"), 2).otherwise(1)
    total = w_duration + w_reliability + w_crowding + w_walking
    return parts.withColumn(
        "score",
        F.round(
            w_duration / total * F.col("_d")
            + w_reliability / total * F.col("_r")
            + w_crowding / total * F.col("_c")
            + w_walking / total * F.col("_w"),
            4,
        ),
    )


def _top_routes(scored: DataFrame, cfg: RouteSettings) -> DataFrame:
    order = [
        F.col("score").desc(),
        F.col("transfers"),
        F.col("duration_sec"),
        F.col("lines"),
        F.col("board_stop_id"),
        F.col("alight_stop_id"),
    ]
    ranked = top_n_per_group(scored, SEARCH, order, cfg.top_routes, "rank")
    return ranked.select(
        *SEARCH,
        "rank",
        "score",
        "lines",
        "transfers",
        "board_stop",
        "alight_stop",
        F.array_distinct("transfer_stations").alias("transfer_stations"),
        F.round(F.col("duration_sec") / 60, 1).alias("duration_min"),
        F.round("walking_m", 1).alias("walking_m"),
        F.round("reliability_pct", 1).alias("reliability_pct"),
        F.round("crowding_est", 1).alias("crowding_est"),
    )


def travel_day(day: date, calendar: DataFrame) -> Column:
    """Day type of a date: the calendar's, else by the weekday."""
    known = calendar.where(F.col("date") == F.lit(day)).agg(F.max("cat_jour")).scalar()
    return F.coalesce(known, clock.fallback_day_category(F.lit(day)))


def place_names(requests: DataFrame, stops: DataFrame, side: str, cfg: RouteSettings = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """Requests whose ``side`` (origin or destination) is named, and the stops of each name with metres to walk.

    A side given by coordinates is named by them, and leads to the stops near the point;
    a point out of reach keeps its name and leads nowhere, so its request gets no route.
    """
    lat, lon, station = f"{side}_lat", f"{side}_lon", f"{side}_station"
    point = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    named = requests.withColumn(station, F.when(point, F.concat_ws(",", F.col(lat), F.col(lon))).otherwise(F.col(station)))
    points = named.where(point).select(station, F.col(lat).alias("lat"), F.col(lon).alias("lon")).distinct()
    near = stops_near(points, [station], stops, cfg).select(station, "stop_id", "distance_m")
    texts = stops_by_prefix(named.where(~point), station, stops).withColumn("distance_m", F.lit(0.0))
    return named, near.unionByName(texts)


def with_reach(requests: DataFrame, origins: DataFrame, destinations: DataFrame) -> DataFrame:
    """Requests with ``reach``: ok, or which side leads to no stop, the origin before the destination."""
    out = requests
    for side, places in (("origin", origins), ("destination", destinations)):
        known = places.select(F.col(f"{side}_station").alias(f"_{side}")).distinct()
        out = out.join(known, F.col(f"{side}_station").eqNullSafe(F.col(f"_{side}")), "left")
    lacking = [F.when(F.col(f"_{s}").isNull(), F.lit(f"{s} out of reach")) for s in ("origin", "destination")]
    return out.withColumn("reach", F.coalesce(*lacking, F.lit("ok"))).drop("_origin", "_destination")


def routes_per_request(requests: DataFrame, stops: DataFrame, routes: DataFrame, cfg: RouteSettings = DEFAULTS) -> DataFrame:
    """Every request with its ranked routes; one row without a rank, and the reach, where there are none."""
    named, origins = place_names(requests, stops, "origin", cfg)
    named, destinations = place_names(named, stops, "destination", cfg)
    asked = with_reach(named, origins, destinations).select("id", "reach", *SEARCH)
    found = routes.withColumnsRenamed({c: f"_s_{c}" for c in SEARCH})
    same = F.lit(True)
    for c in SEARCH:
        same = same & asked[c].eqNullSafe(found[f"_s_{c}"])
    return asked.join(found, same, "left").drop(*SEARCH, *[f"_s_{c}" for c in SEARCH])


def recommend(
    requests: DataFrame,
    schedule: DataFrame,
    walking: DataFrame,
    stops: DataFrame,
    delays_by_stop: DataFrame,
    crowding: DataFrame,
    availability: DataFrame,
    calendar: DataFrame,
    day: date,
    cfg: RouteSettings = DEFAULTS,
) -> DataFrame:
    """Ranked routes of every distinct search among the requests.

    Where requests have origin_lat, origin_lon, destination_lat and destination_lon, a side
    with coordinates starts or ends at the stops near them, and the walk there counts.
    """
    pointed = "origin_lat" in requests.columns
    if pointed:
        requests, origins = place_names(requests, stops, "origin", cfg)
        requests, destinations = place_names(requests, stops, "destination", cfg)
    searches = settled(searches_of(requests), "searches_asked")
    places = settled(searches.select(*PLACE).distinct(), "places")
    if pointed:
        origins = _metres(origins, ["origin_station", "stop_id"], "_access_m", "_access_n")
        destinations = _metres(destinations, ["destination_station", "stop_id"], "_egress_m", "_egress_n")
    else:
        origins = stops_by_prefix(places, "origin_station", stops)
        destinations = stops_by_prefix(places, "destination_station", stops)
    origins, destinations = settled(origins, "origins"), settled(destinations, "destinations")
    calls = settled(demanded_calls(schedule, walking, origins, destinations), "calls")
    direct = fastest_rides(calls, origins, destinations, places, cfg)
    transfer = transfer_legs(calls, walking, origins, destinations, places, cfg)
    options = asked_options(direct, transfer, origins, destinations, places, cfg)
    if pointed:
        metres = [F.coalesce(c, F.lit(0.0)) for c in ("_access_m", "_egress_m")]
        walked = {"walking_m": F.col("walking_m") + metres[0] + metres[1], "_times": F.col("_access_n") * F.col("_egress_n")}
        options = options.withColumns(walked).drop("_access_m", "_access_n", "_egress_m", "_egress_n")
    criteria = with_criteria(
        settled(options, "options"),
        line_reliability(delays_by_stop),
        station_crowding(crowding),
        elevator_status(availability),
        travel_day(day, calendar),
        cfg=cfg,
    )
    return score_routes(searches, criteria, cfg)


# --- notifications ---------------------------------------------------------

# Texts of the message.
NO_ROUTE_TEXT = ": aucun itineraire disponible aujourd'hui."
TOP_TEXT = ", top "
MINUTES_TEXT = "min "
RELIABILITY_TEXT = " corresp. fiab "


def notification_rows(requests: DataFrame, routes: DataFrame, day: date) -> DataFrame:
    """One row per request and day with status and message text.

    Routes are folded to one message tail per search (at most ``top_routes`` lines)
    before they meet the requests.
    """
    line = F.concat(
        F.lit("#"),
        F.col("rank").cast("string"),
        F.lit(" "),
        F.array_join("lines", "/"),
        F.lit(" "),
        F.col("duration_min").cast("string"),
        F.lit(MINUTES_TEXT),
        F.col("transfers").cast("string"),
        F.lit(RELIABILITY_TEXT),
        F.col("reliability_pct").cast("string"),
        F.lit("%"),
    )
    tails = (
        routes.withColumn("_line", line)
        .groupBy(*SEARCH)
        .agg(F.sort_array(F.collect_list(F.struct("rank", "_line"))).alias("_lines"))
    )
    head = F.concat(F.col("origin_station"), F.lit(" -> "), F.col("destination_station"))
    count = F.size("_lines").cast("string")
    body = F.concat(head, F.lit(TOP_TEXT), count, F.lit(":\n"), F.array_join("_lines._line", "\n"))
    found = F.col("_lines").isNotNull()
    return requests.join(tails, SEARCH, "left").select(
        F.col("id").alias("subscription_id"),
        F.lit(day).alias("notify_date"),
        F.when(found, "sent").otherwise("no_route").alias("status"),
        F.when(found, body).otherwise(F.concat(head, F.lit(NO_ROUTE_TEXT))).alias("message"),
    )
