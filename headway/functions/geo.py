"""Points, coordinate pairs and distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.text import _col

# Fixed value: mean earth radius in metres used for great-circle distances.
EARTH_RADIUS_M = 6371010.0


def wkt_point(lon: Column | str, lat: Column | str) -> Column:
    """'POINT (lon lat)', NULL unless both are known."""
    lon, lat = _col(lon), _col(lat)
    return F.concat(F.lit("POINT ("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))


def wkt_coordinates(c: Column | str) -> tuple[Column, Column]:
    """(longitude, latitude) of a WKT point, NULLs when it does not parse."""
    pattern = r"\(\s*(\S+)\s+([^\s)]+)"
    return (
        F.regexp_extract(_col(c), pattern, 1).try_cast("double"),
        F.regexp_extract(_col(c), pattern, 2).try_cast("double"),
    )


def geo_pair(c: Column | str) -> tuple[Column, Column]:
    """(latitude, longitude) of a 'lat, lon' text with optional signs."""
    return (
        F.regexp_extract(_col(c), r"^\s*([-+]?\d+(?:\.\d+)?)", 1).try_cast("double"),
        F.regexp_extract(_col(c), r",\s*([-+]?\d+(?:\.\d+)?)", 1).try_cast("double"),
    )


def great_circle_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance in metres."""
    dlat = F.radians(lat2 - lat1) / 2
    dlon = F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2)
    return F.asin(F.least(F.sqrt(h), F.lit(1.0))) * (2 * EARTH_RADIUS_M)
