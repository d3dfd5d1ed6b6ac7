from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from headway.functions import clock, geo, measures, text


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t}" for k, t in _types(values)))
    return df.select(column.alias("x")).first()[0]


def _types(values):
    kinds = {int: "long", float: "double", bool: "boolean", dt.date: "date", dt.datetime: "timestamp", list: "array<string>"}
    return [(k, kinds.get(type(v), "string")) for k, v in values.items()]


@pytest.mark.parametrize(
    "clock_text, seconds", [("25:10:05", 90605), ("00:00:00", 0), ("", None), (None, None), ("7:05", None), ("a:b:c", None)]
)
def test_gtfs_seconds(spark, clock_text, seconds):
    assert one(spark, clock.gtfs_seconds("t"), t=clock_text) == seconds


@pytest.mark.parametrize(
    "value, cleaned", [("  a  b ", "a b"), ("   ", None), ("", None), (None, None), ("x\n\ty", "x y")]
)
def test_clean_label(spark, value, cleaned):
    assert one(spark, text.clean_label("t"), t=value) == cleaned


def test_references(spark):
    assert one(spark, text.tail_token("t"), t="STIF:Line::C01371:") == "C01371"
    assert one(spark, text.tail_digits("t"), t="STIF:StopPoint:Q:22125:") == "22125"
    assert one(spark, text.tail_digits("t"), t="abc:") == ""
    assert one(spark, text.tail_digits("t"), t=None) is None
    assert one(spark, text.first_int("t"), t="X:0042:7") == 42
    assert one(spark, text.first_int("t"), t="none") is None
    assert one(spark, text.segment("t", 1), t="a") is None
    assert one(spark, text.last_segment("t"), t="a:b:c") == "c"


@pytest.mark.parametrize(
    "value, count, masked", [("Moins de 5", None, True), ("12", 12, False), (None, None, None), ("1.5", None, True)]
)
def test_masked_count(spark, value, count, masked):
    assert one(spark, text.masked_count("t"), t=value) == count
    assert one(spark, ~text.is_number("t"), t=value) == masked


def test_numbers_in_text(spark):
    assert one(spark, text.decimal_comma("t"), t="4,25") == 4.25
    assert one(spark, text.whole_number("t"), t="123.0") == 123
    assert one(spark, text.whole_number("t"), t="?") is None
    start, end = clock.hour_band("t")
    assert one(spark, start, t="7H-8H") == 7
    assert one(spark, end, t="7H-8H") == 8
    assert one(spark, start, t="ND") is None


def test_dates(spark):
    assert one(spark, clock.compact_date("d"), d=20250131) == dt.date(2025, 1, 31)
    assert one(spark, clock.compact_date("d"), d="soon") is None
    assert one(spark, clock.prefix_date("d"), d="2025-07-04T22:00:00+00:00") == dt.date(2025, 7, 4)
    assert one(spark, clock.stamp("d", clock.COMPACT_STAMP_FORMAT), d="20250102T030405") == dt.datetime(2025, 1, 2, 3, 4, 5)
    assert one(spark, clock.stamp("d"), d="2025-01-02T03:04:05.000Z") == dt.datetime(2025, 1, 2, 3, 4, 5)
    assert one(spark, clock.stamp("d"), d="later") is None


@pytest.mark.parametrize(
    "day, holiday, in_break, expected",
    [
        (dt.date(2025, 1, 5), False, False, "DIJFP"),
        (dt.date(2025, 1, 1), True, False, "DIJFP"),
        (dt.date(2025, 1, 4), False, True, "SAVS"),
        (dt.date(2025, 1, 4), False, False, "SAHV"),
        (dt.date(2025, 1, 7), False, True, "JOVS"),
        (dt.date(2025, 1, 7), False, False, "JOHV"),
        (dt.date(2025, 1, 4), True, True, "DIJFP"),
    ],
)
def test_day_category(spark, day, holiday, in_break, expected):
    assert one(spark, clock.day_category(F.col("d"), F.col("h"), F.col("b")), d=day, h=holiday, b=in_break) == expected


def test_weekday_numbers(spark):
    assert one(spark, clock.iso_weekday("d"), d=dt.date(2025, 1, 6)) == 1
    assert one(spark, clock.day_name("d"), d=dt.date(2025, 1, 6)) == "Monday"


def test_points(spark):
    assert one(spark, geo.wkt_point("a", "b"), a=2.5, b=48.0) == "POINT (2.5 48.0)"
    lon, lat = geo.wkt_coordinates("p")
    assert one(spark, lon, p="POINT (2.347 48.858)") == 2.347
    assert one(spark, lat, p="POINT (2.347 48.858)") == 48.858
    assert one(spark, lat, p="POINT") is None
    lat, lon = geo.geo_pair("p")
    assert one(spark, lat, p="-48.5, +2.25") == -48.5
    assert one(spark, lon, p="-48.5, +2.25") == 2.25


def test_great_circle_quarter(spark):
    quarter = geo.great_circle_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0))
    assert one(spark, F.round(quarter), x=1) == pytest.approx(geo.EARTH_RADIUS_M * 3.141592653589793 / 2, abs=1)


@pytest.mark.parametrize("status, flag", [("available", True), ("notavailable", False), (None, None)])
def test_availability_flag(spark, status, flag):
    assert one(spark, text.availability_flag("s"), s=status) is flag


@pytest.mark.parametrize("code, name", [(1, "metro"), (12, "monorail"), (99, "unknown"), (None, "unknown")])
def test_route_type_names(spark, code, name):
    df = spark.createDataFrame([(code,)], "c int")
    assert df.select(text.route_type_name("c")).first()[0] == name


def test_search_terms(spark):
    assert one(spark, text.contains_term(" chât ", "n"), n="Châtelet") is True
    assert one(spark, text.contains_term("%", "n"), n="Châtelet") is False
    assert one(spark, text.any_item_equals("a", " c1 "), a=["C1", "C2"]) is True
    df = spark.createDataFrame([(None,)], "a array<string>")
    assert df.select(text.any_item_equals("a", "c1")).first()[0] is False


def test_percent_of_nothing(spark):
    assert one(spark, measures.percent(F.col("a"), F.col("b")), a=1, b=0) is None
    assert one(spark, measures.percent(F.col("a"), F.col("b")), a=1, b=3) == 33.3
