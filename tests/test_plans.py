"""Golden cases with hand-computed answers on the feeds' own schemas."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from headway.plans import analytics, gold, params, silver

T0 = dt.datetime(2025, 1, 10, 8)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def day(n):
    return dt.date(2025, 1, n)


def test_service_calendar(spark, rows):
    week = spark.createDataFrame(
        [("S1", 1, 1, 1, 1, 1, 0, 0, day(1), day(7)), ("S2", 1, 1, 1, 1, 1, 1, 1, day(7), day(1))],
        "service_id string, " + ", ".join(f"{d} int" for d in gold.WEEKDAYS) + ", start_date date, end_date date",
    )
    special = spark.createDataFrame([("S1", day(5), 1), ("S1", day(6), 2)], "service_id string, date date, exception_type int")
    out = gold.service_calendar(week, special)
    assert rows(out, "service_id", "date") == [("S1", day(n)) for n in (1, 2, 3, 5, 7)]
    assert rows(out.where("is_weekend"), "day_of_week") == [("Sunday",)]


def test_day_type_calendar_break_end_is_outside(spark):
    holidays = spark.createDataFrame([("2025-01-01",), ("bad",)], "date string")
    breaks = spark.createDataFrame(
        [("Zone C", "2025-01-06T00:00", "2025-01-08T00:00"), ("Zone A", "2024-01-01", "2025-12-31")],
        "zones string, start_date string, end_date string",
    )
    out = {r.date: r for r in silver.day_type_calendar(holidays, breaks).collect()}
    assert sorted(out) == [day(n) for n in range(1, 9)]
    assert out[day(1)].cat_jour == "DIJFP" and out[day(1)].is_holiday
    assert [out[day(n)].cat_jour for n in (6, 7, 8)] == ["JOVS", "JOVS", "JOHV"]


def history(spark, states):
    schema = "elevator_key string, is_available boolean, status_updated_at timestamp"
    df = spark.createDataFrame(states, schema)
    extra = {c: F.lit(None).cast(t) for c, t in {
        "elevator_id": "long", "station_area_id": "long", "status": "string", "status_reason": "string",
        "state_code": "int", "severity_code": "int"}.items()}
    return df.withColumns(extra).withColumns({"station_name": F.lit("A"), "transport_mode": F.lit("METRO")})


def test_downtime_intervals(spark, rows):
    states = history(spark, [("k", False, at(0)), ("k", True, at(10)), ("k", False, at(20))])
    out = gold.elevators_downtime(states)
    assert rows(out, "status_updated_at", "ended_at", "downtime_sec") == [(at(0), at(10), 600), (at(20), None, None)]


@pytest.mark.parametrize("minutes, uptime", [(432, 99.0), (99999, 0.0)])
def test_uptime(spark, minutes, uptime):
    lifts = spark.createDataFrame([(1, "A", "METRO", True)], "station_area_id long, station_name string, transport_mode string, is_active boolean")
    down = spark.createDataFrame(
        [(1, "A", "METRO", at(0), at(minutes))],
        "station_area_id long, station_name string, transport_mode string, status_updated_at timestamp, ended_at timestamp",
    )
    out = gold.elevators_reliability(lifts, down, dt.datetime(2025, 1, 31)).first()
    assert out.pct_uptime_30d == uptime and out.nb_outages_30d == 1


def test_reliability_without_outages_is_filled(spark):
    lifts = spark.createDataFrame([(1, "A", "METRO", True), (2, "B", "RER", False)], "station_area_id long, station_name string, transport_mode string, is_active boolean")
    none = spark.createDataFrame([], "station_area_id long, station_name string, transport_mode string, status_updated_at timestamp, ended_at timestamp")
    (row,) = gold.elevators_reliability(lifts, none, T0).collect()
    assert (row.nb_outages_30d, row.downtime_minutes_90d, row.avg_outage_minutes_30d, row.pct_uptime_30d) == (0, 0.0, None, 100.0)


def test_delays_by_stop(spark):
    df = spark.createDataFrame(
        [("7", "C1", "1", d) for d in (0, 59, 60, 300, None)],
        "stop_point_ref string, line_ref string, published_line string, arrival_delay_sec long",
    )
    row = gold.delays_by_stop(df).first()
    assert (row.nb_passages, row.nb_delayed, row.pct_on_time) == (4, 2, 50.0)
    assert (row.avg_arrival_delay_sec, row.max_arrival_delay_sec) == (104.8, 300)


@pytest.mark.parametrize(
    "modes, available, accessible", [([2], 5, False), ([2, 5], 0, False), ([2, 5], 1, True), ([1], None, True)]
)
def test_accessible_transfer(spark, modes, available, accessible):
    transfers = spark.createDataFrame([(1, 2, 2, 120)], "from_stop_id int, to_stop_id int, transfer_type int, min_transfer_time int")
    paths = spark.createDataFrame(
        [(f"p{m}", 1, 2, m, 10.0, 20) for m in modes],
        "pathway_id string, from_stop_id int, to_stop_id int, pathway_mode int, length double, traversal_time int",
    )
    walking = gold.transfer_walking(transfers, paths)
    stops = spark.createDataFrame([(1, " Gare ")], "stop_id int, parent_station_name string")
    lifts = spark.createDataFrame([("GARE", 5, available)], "station_name string, nb_elevators long, nb_available long")
    uptime = spark.createDataFrame([("gare", 90.0)], "station_name string, pct_uptime_30d double")
    row = gold.transfer_accessibility(walking, stops, lifts, uptime).first()
    assert row.accessible_transfer is accessible
    assert row.pct_uptime_30d == 90.0 and row.pathway_length_m == 10.0 * len(modes)


def disruption(**over):
    body = {
        "id": "D1", "severity": "BLOQUANTE", "title": "t", "lastUpdate": "20250110T080000",
        "applicationPeriods": [{"begin": "20250110T070000", "end": "20250110T090000"}],
        "impactedSections": [
            {"lineId": "line:X:C1", "from": {"id": "stop:X:1", "name": "A"}, "to": {"id": "stop:X:2", "name": "B"}},
            {"lineId": "line:X:C1", "from": {"id": "stop:X:1", "name": "A"}, "to": {"id": "stop:X:2", "name": "B"}},
            {"lineId": None},
        ],
    }
    return json.dumps({**body, **over})


def test_disruption_tables(spark, rows):
    bronze = spark.createDataFrame(
        [(disruption(title="old"), at(0)), (disruption(), at(5)), ("nope", at(6)), (disruption(id="D2", applicationPeriods=None, impactedSections=None), at(1))],
        "raw_json string, batch_time timestamp",
    )
    latest = silver.latest_disruptions(silver.parse_disruptions(bronze))
    assert rows(silver.disruption_messages(latest), "id", "title", "batch_time") == [("D1", "t", at(5)), ("D2", "t", at(1))]
    assert rows(silver.disruption_stops(latest), "line_id", "from_id", "to_id") == [("C1", "1", "2")]
    active = gold.disruptions_active(
        silver.disruption_messages(latest), silver.disruption_periods(latest), silver.disruption_stops(latest), T0
    )
    assert rows(active, "id", "is_active", "impacted_lines") == [("D1", True, ["C1"]), ("D2", None, None)]


def test_open_end_needs_the_flag(spark):
    bronze = spark.createDataFrame(
        [(disruption(applicationPeriods=[{"begin": "20250110T070000", "end": None}]), at(0))], "raw_json string, batch_time timestamp"
    )
    latest = silver.latest_disruptions(silver.parse_disruptions(bronze))
    tables = silver.disruption_messages(latest), silver.disruption_periods(latest), silver.disruption_stops(latest)
    assert not gold.disruptions_active(*tables, T0).first().is_active
    assert gold.disruptions_active(*tables, T0, open_end_is_active=True).first().is_active


def passage(stop="STIF:StopPoint:Q:22125:", expected="2025-01-10T08:02:00Z"):
    call = {"StopPointRef": {"value": stop}, "AimedArrivalTime": "2025-01-10T08:00:00Z", "ExpectedArrivalTime": expected}
    return json.dumps(
        {
            "DatedVehicleJourneyRef": {"value": "J1"}, "LineRef": {"value": "STIF:Line::C01371:"},
            "PublishedLineName": [{"value": "1"}], "EstimatedCalls": {"EstimatedCall": [call, call]},
        }
    )


def test_passages(spark, rows):
    bronze = spark.createDataFrame(
        [(passage(), at(0)), (passage(expected="2025-01-10T08:05:00Z"), at(1)), (passage(stop="abc:"), at(2)), ("{}", at(3)), ("", at(4))],
        "raw_json string, batch_time timestamp",
    )
    calls = silver.passage_calls(silver.parse_passages(bronze))
    assert calls.count() == 6
    latest = silver.latest_passages(calls)
    assert rows(latest, "stop_point_ref", "line_ref", "arrival_delay_sec") == [("", "C01371", 120), ("22125", "C01371", 300)]


def test_silver_stops(spark, rows):
    raw = spark.createDataFrame(
        [
            (" X:5 ", " A   b ", "X:90", None, None, "4", 2.0, 48.0),
            ("X:90", "Gare", "", "1", "1", None, 2.0, 48.0),
            ("X:90", "Gare", "", "1", "1", None, 2.0, 48.0),
            ("X:7", "Door", "X:90", "2", None, None, 2.0, 48.0),
        ],
        "stop_id string, stop_name string, parent_station string, location_type string, wheelchair_boarding string, zone_id string, stop_lon double, stop_lat double",
    )
    assert rows(silver.stop_points(raw)) == [(5, "A b", 4, 90, 2.0, 48.0)]
    assert rows(silver.stop_areas(raw)) == [(90, "Gare", 2.0, 48.0)]
    assert rows(silver.stop_entrances(raw)) == [(7, "Door", 90, 2.0, 48.0)]
    assert rows(silver.wheelchairs(raw)) == [(5, "A b", 0, 0)]


# --- queries ---------------------------------------------------------------


def test_crowding_station_row(spark):
    crowd = spark.createDataFrame(
        [(71517, 1, 1, 1, "Châtelet", day(1), 8, 1000, 80.0, "JOHV", "POINT (2.347 48.858)"), (71517, None, 1, 1, "Châtelet", day(1), 9, 500, 20.0, "JOHV", None)],
        "id_refa_lda long, stif_trns int, stif_res int, stif_arret int, libelle_arret string, jour date, hour_start int, "
        "daily_total_validations long, estimated_validations double, cat_jour string, geo_point string",
    )
    (row,) = analytics.crowding_stations(crowd).collect()
    assert (row.longitude, row.latitude, row.transport_modes) == (2.347, 48.858, [1])
    assert row.avg_daily_validations == 1500.0 and row.peak_hour_validations_pct == 5.3


def test_open_outage_runs_to_now(spark):
    down = spark.createDataFrame(
        [("k", 1, 2, "A", "METRO", "notavailable", None, T0, None, None)],
        "elevator_key string, elevator_id long, station_area_id long, station_name string, transport_mode string, status string, "
        "status_reason string, status_updated_at timestamp, ended_at timestamp, downtime_sec long",
    )
    (row,) = analytics.outage_events(down, at(60)).collect()
    assert (row.ongoing, row.downtime_sec, row.downtime_minutes, row.started_at) == (True, 3600, 60.0, "2025-01-10T08:00:00")
    assert analytics.outage_events(down, at(60), ongoing=False).isEmpty()


def test_line_catalogue(spark):
    lines = spark.createDataFrame(
        [("r1", "1", "La Défense", 1, "a", s, p) for s, p in ((1, 10), (2, 10), (3, None))],
        "route_id string, route_short_name string, route_long_name string, route_type int, agency_id string, stop_id int, parent_station_id int",
    )
    (row,) = analytics.network_lines(lines, search="défense").collect()
    assert (row.transport_mode, row.stations, row.stops) == ("metro", 2, 3)


def test_kpi_and_page_envelope(spark):
    items = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    (row,) = analytics.page_envelope(items, 100, 0).collect()
    assert (row["count"], row["limit"], len(row["items"])) == (2, 100, 2)


@pytest.mark.parametrize(
    "call",
    [
        lambda: params.whole("hour", 24, 0, 23),
        lambda: params.whole("hour", "x"),
        lambda: params.whole("since_hours", 0, 1, 744),
        lambda: params.whole("since_days", 0, 1),
        lambda: params.real("max_distance_m", -1, 0),
        lambda: params.real("max_distance_m", "nan", 0),
        lambda: params.flag("accessible", "maybe"),
        lambda: params.day_range("2025-02-01", "2025-01-01"),
        lambda: params.day("date_from", "01/02/2025"),
        lambda: params.page_bounds(0, 0),
        lambda: params.page_bounds(501, 0),
        lambda: params.page_bounds(10, -1),
    ],
)
def test_bad_parameters(call):
    with pytest.raises(ValueError):
        call()


def test_good_parameters():
    assert params.flag("a", "Yes") is True and params.flag("a", "0") is False and params.flag("a", None) is None
    assert params.day_range("2025-01-01", "") == (day(1), None)
    assert params.page_bounds() == (100, 0)
    assert params.term("  ") is None
