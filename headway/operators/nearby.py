"""Nearest points by geo cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.geo import great_circle_m
from headway.operators.ranking import top_n_per_group
from headway.session import settled

# Metres in one degree of latitude, rounded down so that cell rings never come out short.
DEGREE_M = 111000.0


# Metres half way round the earth, rounded up: everything is within them.
FARTHEST_M = 20_100_000.0


def _cells_around(cell_deg: float) -> int:
    """Cells of a ring of longitudes: a whole number, so that the ring closes at 180 degrees."""
    return max(1, int(360 // cell_deg))


# Metres in one degree along a great circle, rounded up so that bounds never come out short.
DEGREE_UP_M = 111200.0

# How often cells are halved where points lie close.
LEVELS = 10


class _Grid:
    """Cells of the given size at level 0, of half the size at each next level."""

    def __init__(self, cell_deg: float):
        self.around = _cells_around(cell_deg)
        self.height, self.width = cell_deg, 360.0 / self.around

    def _parts(self) -> Column:
        return F.pow(F.lit(2.0), F.col("_level"))

    def ring(self) -> Column:
        return (F.lit(self.around) * self._parts()).cast("long")

    def row(self, lat: Column) -> Column:
        return F.floor(lat / (F.lit(self.height) / self._parts())).cast("long")

    def column(self, lon: Column) -> Column:
        """The cell counted on along the parallel, not yet closed to a ring."""
        return F.floor(lon / (F.lit(self.width) / self._parts())).cast("long")

    def placed(self, rows: DataFrame, lat: str, lon: str) -> DataFrame:
        """Every row once a level, with its cell."""
        leveled = rows.withColumn("_level", F.explode(F.lit(list(range(LEVELS + 1)))))
        return leveled.withColumns({"_cy": self.row(F.col(lat)), "_cx": F.pmod(self.column(F.col(lon)), self.ring())})

    def farthest_m(self, lat: Column, lon: Column) -> Column:
        """Metres from a place within which its whole cell lies: along the parallel to the farther side, then along the meridian."""
        height, width = F.lit(self.height) / self._parts(), F.lit(self.width) / self._parts()
        north, east = lat - self.row(lat) * height, lon - self.column(lon) * width
        up, along = F.greatest(north, height - north), F.greatest(east, width - east)
        return (up + along * F.cos(F.radians(lat))) * DEGREE_UP_M + 0.01


def nearest_points(
    requests: DataFrame,
    points: DataFrame,
    request_keys: Sequence[str],
    point_id: str,
    limit: int,
    reach_m: float,
    cell_deg: float = 0.05,
    lat: str = "lat",
    lon: str = "lon",
    point_lat: str = "point_lat",
    point_lon: str = "point_lon",
) -> DataFrame:
    """The ``limit`` nearest points within ``reach_m`` of each request, with distance_m.

    Every place asked from is answered once. Places are matched to points by equality on grid cells: a place is
    repeated for the few cells its reach can touch (more in longitude near the poles, all where the reach
    covers a pole). Cells of longitude form a ring, so those on both sides of 180 degrees are neighbours. The
    grid has levels of ever smaller cells: a place whose own cell holds ``limit`` points needs to reach no
    farther than that cell does, and looks at cells of that size, so it meets few points however
    close they lie. Points stacked on one spot are cut to the ``limit`` least ids, which is exact
    as they tie on distance.
    """
    grid = _Grid(cell_deg)
    known = points.where(F.col(point_lat).isNotNull() & F.col(point_lon).isNotNull() & F.col(point_id).isNotNull())
    spots = grid.placed(top_n_per_group(known, [point_lat, point_lon], [F.col(point_id)], limit), point_lat, point_lon)
    cell = ["_level", "_cy", "_cx"]
    full = spots.groupBy(*cell).count().where(F.col("count") >= limit).select(*cell, F.col("_level").alias("_full"))
    places = requests.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).distinct()
    levels = grid.placed(places, "_lat", "_lon").join(full, cell, "left").groupBy("_lat", "_lon").agg(F.max("_full").alias("_full"))
    y, x = F.col("_lat"), F.col("_lon")
    asked = levels.withColumn("_level", F.coalesce("_full", F.lit(0)))
    asked = asked.withColumn("_reach", F.when(F.col("_full").isNull(), F.lit(reach_m)).otherwise(F.least(F.lit(reach_m), grid.farthest_m(y, x))))
    reach_lat = F.col("_reach") / DEGREE_M
    # Along a parallel the reach is widest nearest to the pole: sin(half the difference) = sin(half the reach) / cos(latitude).
    wide = F.sin(F.radians(F.least(reach_lat / 2, F.lit(90.0)))) / F.cos(F.radians(F.least(F.abs(y) + reach_lat, F.lit(89.9))))
    polar = (F.abs(y) + reach_lat >= 89.9) | (wide >= 1)
    asked = asked.withColumns({"_polar": polar, "_reach_lat": reach_lat, "_reach_lon": F.when(~polar, 2 * F.degrees(F.asin(F.least(wide, F.lit(1.0)))))})
    # A ring of small cells would be long.
    asked = asked.withColumn("_level", F.when(F.col("_polar"), F.lit(0)).otherwise(F.col("_level")))
    first, last = grid.column(x - F.col("_reach_lon")), grid.column(x + F.col("_reach_lon"))
    ring = F.sequence(F.lit(0).cast("long"), grid.ring() - 1)
    some = F.transform(F.sequence(first, last), lambda c: F.pmod(c, grid.ring()))
    south, north = F.greatest(y - F.col("_reach_lat"), F.lit(-90.0)), F.least(y + F.col("_reach_lat"), F.lit(90.0))
    asked = asked.withColumn("_cy", F.explode(F.sequence(grid.row(south), grid.row(north)))).withColumn(
        "_cx", F.explode(F.when(F.col("_polar") | (last - first + 1 >= grid.ring()), ring).otherwise(some))
    )
    # Rounded to the millimetre so that equal distances compare equal and ids break the tie.
    distance = F.round(great_circle_m(F.col(point_lat), F.col(point_lon), y, x), 3)
    pairs = asked.select("_lat", "_lon", "_reach", *cell).join(spots, cell).withColumn("distance_m", distance).where(F.col("distance_m") <= F.col("_reach"))
    order = [F.col("distance_m"), F.col(point_id)]
    near = top_n_per_group(pairs.drop("_reach", *cell), ["_lat", "_lon"], order, limit)
    answered = requests.join(near, (F.col(lat) == y) & (F.col(lon) == x)).drop("_lat", "_lon")
    return top_n_per_group(answered, list(request_keys), order, limit, "near_rank")


def nearest_anywhere(
    requests: DataFrame,
    points: DataFrame,
    request_keys: Sequence[str],
    point_id: str,
    limit: int,
    first_reach_m: float = 1000.0,
    **columns: str,
) -> DataFrame:
    """The ``limit`` nearest points of each request however far they are, with distance_m and near_rank.

    Rings grow by doubling: a request that finds ``limit`` points within the reach has its answer, as all
    points within the reach were compared; only the others look further, in cells that grow with
    the reach. So a request meets few points however far apart dense and empty regions are. Request keys are unique and not null.
    """
    left, reach, parts = requests, first_reach_m, []
    while True:
        everything = reach >= FARTHEST_M
        near = nearest_points(left, points, request_keys, point_id, limit, reach, min(max(reach / DEGREE_M / 2, 0.001), 30.0), **columns)
        near = settled(near, "nearest")
        full = near.where(F.col("near_rank") == limit).select(*request_keys)
        if everything:
            parts.append(near)
            break
        parts.append(near.join(full, list(request_keys), "left_semi"))
        left = settled(left.join(full, list(request_keys), "left_anti"), "unanswered")
        if left.isEmpty():
            break
        reach *= 2
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def walkable_stops(near: DataFrame, walk_m: float, rank: str = "near_rank") -> DataFrame:
    """Keep stops within walking distance, else the single nearest within reach.

    The nearest stop alone decides: if it is beyond walking distance no other is nearer,
    so "none within walk_m" equals "the rank-1 row is beyond walk_m".
    """
    return near.where((F.col("distance_m") <= walk_m) | (F.col(rank) == 1))
