"""Streams over files must equal the batch functions, and repeats must change nothing."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from headway.operators.ranking import latest_per_key
from headway.plans import gold, silver
from headway.sources import feeds
from headway.streaming import disruptions, ingest, passages

T0 = dt.datetime(2025, 1, 10, 8)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Each partition of a stream's state is a store of its own; small fixtures need few."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def stamp(minutes):
    return (T0 + dt.timedelta(minutes=minutes)).strftime("%Y-%m-%d %H:%M:%S")


def envelope(event_id, minutes, body):
    return json.dumps({"event_id": event_id, "batch_time": stamp(minutes), "raw_json": json.dumps(body)})


def passage(journey, stop, line, late):
    call = {
        "StopPointRef": {"value": f"Q:{stop}:"},
        "AimedArrivalTime": "2025-01-10T08:00:00Z",
        "ExpectedArrivalTime": (T0 + dt.timedelta(seconds=late)).strftime("%Y-%m-%dT%H:%M:%SZ"),
    }
    return {
        "DatedVehicleJourneyRef": {"value": journey},
        "LineRef": {"value": f"L:{line}:"},
        "PublishedLineName": [{"value": line}],
        "EstimatedCalls": {"EstimatedCall": [call]},
    }


def run(queries):
    for q in queries if isinstance(queries, list) else [queries]:
        q.awaitTermination(120)
        assert q.exception() is None


def bronze(spark, root):
    source = ingest.file_source(spark, f"{root}/topic")
    run(ingest.start_bronze(source, f"{root}/bronze", f"{root}/quarantine", f"{root}/ck", once=True))


def drop(root, name, lines):
    (root / "topic").mkdir(exist_ok=True)
    (root / "topic" / name).write_text("\n".join(lines) + "\n")


def envelopes(spark, lines):
    return feeds.well_formed(feeds.decode_envelope(spark.createDataFrame([(x,) for x in lines], "value string")))


def passage_steps(spark, root, kept="30 days"):
    """Every stream once, over what has come since."""
    bronze(spark, root)
    stored = ingest.table_stream(spark, f"{root}/bronze", ingest.BRONZE)
    run(ingest.stream_append(passages.silver_changes(stored, kept), f"{root}/silver/next_stop", f"{root}/ck/silver", None, once=True))
    changes = ingest.table_stream(spark, f"{root}/silver/next_stop", passages.CHANGES)
    run(ingest.stream_apply(changes, passages.gold_batch(str(root)), f"{root}/ck/gold", once=True))
    run(ingest.stream_append(passages.delay_statistics(changes), f"{root}/gold/delays_by_stop", f"{root}/ck/stats", None, once=True))


def test_passage_streams(spark, tmp_path, rows):
    first = [
        envelope("e1", 0, passage("J1", 7, "C1", 0)),
        envelope("e2", 1, passage("J1", 7, "C1", 90)),
        envelope("e3", 0, passage("J2", 7, "C1", 30)),
        envelope("e4", 0, passage("J3", 8, "C2", 300)),
        envelope("e0", 0, passage("J4", 8, "C2", 20)),
        "not json",
    ]
    drop(tmp_path, "a.txt", first)
    passage_steps(spark, tmp_path)
    assert spark.read.parquet(f"{tmp_path}/quarantine").count() == 1
    # The late row loses, J2 moves to another line, J3's greatest delay is taken back, the repeat changes nothing.
    second = [
        envelope("e5", -5, passage("J1", 7, "C1", 999)),
        envelope("e6", 9, passage("J2", 7, "C9", 70)),
        envelope("e7", 9, passage("J3", 8, "C2", 10)),
        first[3],
    ]
    drop(tmp_path, "b.txt", second)
    passage_steps(spark, tmp_path)

    expected = silver.latest_passages(silver.passage_calls(silver.parse_passages(envelopes(spark, [x for x in first + second if x != "not json"]))))
    assert rows(passages.passages(spark, tmp_path), *expected.columns) == rows(expected, *expected.columns)
    scheduled = gold.next_stop_schedule(expected)
    assert rows(passages.schedule(spark, tmp_path), *scheduled.columns) == rows(scheduled, *scheduled.columns)
    stats = gold.delays_by_stop(expected)
    assert rows(passages.delays_by_stop(spark, tmp_path), *stats.columns) == rows(stats)
    assert rows(stats, "published_line", "max_arrival_delay_sec") == [("C1", 90), ("C2", 20), ("C9", 70)]
    assert rows(passages.delays(spark, tmp_path), "journey_ref", "arrival_delay_sec") == [("J1", 90), ("J2", 70), ("J3", 300)]
    # Four passages came first and one of them twice; then two gave way to newer versions.
    log = spark.read.schema(passages.CHANGES).parquet(f"{tmp_path}/silver/next_stop")
    assert rows(log.groupBy("sign").count()) == [(-1, 2), (1, 6)]

    # A repeat of everything changes no version, no count and no file of changes.
    drop(tmp_path, "c.txt", first + second)
    passage_steps(spark, tmp_path)
    assert rows(spark.read.schema(passages.CHANGES).parquet(f"{tmp_path}/silver/next_stop").groupBy("sign").count()) == [(-1, 2), (1, 6)]
    assert rows(passages.delays_by_stop(spark, tmp_path), *stats.columns) == rows(stats)


def test_state_ends_with_its_time(spark, tmp_path):
    """Passages that the newest batch has left behind by more than is kept leave no state, and later rows of theirs are dropped."""

    def state_rows():
        stored = ingest.table_stream(spark, f"{tmp_path}/bronze", ingest.BRONZE)
        query = ingest.stream_append(passages.silver_changes(stored, "1 hour"), f"{tmp_path}/silver", f"{tmp_path}/ck/silver", None, once=True)
        run(query)
        return query.recentProgress[-1]["stateOperators"][0]["customMetrics"], spark.read.schema(passages.CHANGES).parquet(f"{tmp_path}/silver").count()

    drop(tmp_path, "a.txt", [envelope(f"e{i}", i, passage(f"J{i}", 7, "C1", i)) for i in range(20)])
    bronze(spark, tmp_path)
    assert state_rows()[1] == 20
    drop(tmp_path, "b.txt", [envelope("f", 300, passage("K", 7, "C1", 0))])
    bronze(spark, tmp_path)
    assert state_rows()[1] == 21
    drop(tmp_path, "c.txt", [envelope("g", 10, passage("J3", 7, "C1", 500)), envelope("h", 301, passage("K", 7, "C1", 60))])
    bronze(spark, tmp_path)
    metrics, n = state_rows()
    assert n == 23  # K's new version takes the place of its old one; the row of J3 is too late
    state = spark.read.format("statestore").option("stateVarName", "latest").load(f"{tmp_path}/ck/silver")
    assert [r["key"][0] for r in state.collect()] == ["K"]


def test_random_passages_equal_the_batch_twin(spark, tmp_path, rows):
    rng = random.Random(4)
    lines = [envelope(f"e{i}", rng.randint(0, 40), passage(f"J{rng.randint(0, 12)}", rng.randint(1, 3), f"C{rng.randint(1, 2)}", rng.randint(-30, 400))) for i in range(150)]
    for i in range(2):
        drop(tmp_path, f"{i}.txt", lines[75 * i : 75 * i + 75])
        passage_steps(spark, tmp_path)
    calls = silver.passage_calls(silver.parse_passages(envelopes(spark, lines)))
    # Streams keep the first of rows with equal versions that they meet; the batch twin is asked for the versions.
    newest = rows(calls.groupBy(*passages.KEYS).agg(F.max("batch_time")))
    found = passages.passages(spark, tmp_path)
    assert rows(found, *passages.KEYS, "batch_time") == newest
    assert rows(found.exceptAll(calls)) == []
    stats = gold.delays_by_stop(found)
    assert rows(passages.delays_by_stop(spark, tmp_path), *stats.columns) == rows(stats)


def disruption(ident, line, begin="20250110T070000", end="20250110T090000", severity="S"):
    return {
        "id": ident, "severity": severity, "title": "t", "lastUpdate": "20250110T070000",
        "applicationPeriods": [{"begin": begin, "end": end}] if begin else [], "impactedSections": [{"lineId": f"line:X:{line}"}],
    }


def test_disruption_streams(spark, tmp_path, rows):
    def steps():
        bronze(spark, tmp_path)
        stored = ingest.table_stream(spark, f"{tmp_path}/bronze", ingest.BRONZE)
        for name in disruptions.TABLES:
            run(ingest.stream_append(disruptions.silver_changes(stored, name), f"{tmp_path}/silver/{name}", f"{tmp_path}/ck/{name}", None, once=True))
        messages, stops, periods = (ingest.table_stream(spark, f"{tmp_path}/silver/{name}", disruptions.SCHEMAS[name]) for name in disruptions.TABLES)
        active = disruptions.active_disruptions(messages, stops, periods)
        run(ingest.stream_append(active, f"{tmp_path}/gold/disruptions_active", f"{tmp_path}/ck/active", None, once=True))
        run(ingest.stream_append(disruptions.line_days(stops), f"{tmp_path}/gold/disruptions_by_line", f"{tmp_path}/ck/lines", None, once=True))

    first = [envelope("e1", 0, disruption("D1", "C1")), envelope("e2", 0, disruption("D2", "C1", end="20250110T073000")), envelope("e9", 0, disruption("D4", "C1", begin=None))]
    drop(tmp_path, "a.txt", first)
    steps()
    # D3 is new, D1 gets another severity and period, D2's repeat changes nothing.
    second = [envelope("e3", 5, disruption("D3", "C2")), envelope("e4", 6, disruption("D1", "C1", end="20250110T100000", severity="T")), first[1]]
    drop(tmp_path, "b.txt", second)
    steps()

    # The batch twin merges every message's sections and periods into tables by key.
    parsed = silver.parse_disruptions(envelopes(spark, first + second))
    messages = silver.latest_disruptions(parsed)
    stops = latest_per_key(silver.section_rows(parsed), silver.SILVER_KEYS["disruption_stops"], [F.desc("batch_time")])
    periods = latest_per_key(silver.period_rows(parsed), silver.SILVER_KEYS["disruption_periods"], [F.desc("batch_time")])
    for name, twin in (("disruption_stops", stops), ("disruption_periods", periods)):
        assert rows(disruptions.silver_table(spark, tmp_path, name), *twin.columns) == rows(twin, *twin.columns)
    want = gold.disruptions_active(silver.disruption_messages(messages), periods, stops, T0)
    assert rows(disruptions.active_at(spark, tmp_path, T0), *want.columns) == rows(want, *want.columns)
    counts = gold.disruptions_by_line(stops)
    assert rows(disruptions.disruptions_by_line(spark, tmp_path), *counts.columns) == rows(counts, *counts.columns)
    assert rows(counts, "line_id", "nb_disruptions", "severities") == [("C1", 3, ["S", "T"]), ("C2", 1, ["S"])]
    assert rows(disruptions.active_now(spark, tmp_path, T0), "id") == [("D1",), ("D3",)]
    # In the tenth hour one still runs and after it none, though no message has changed.
    assert rows(disruptions.active_now(spark, tmp_path, T0 + dt.timedelta(minutes=90)), "id") == [("D1",)]
    assert disruptions.active_now(spark, tmp_path, T0 + dt.timedelta(hours=3)).isEmpty()
