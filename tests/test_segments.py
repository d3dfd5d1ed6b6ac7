"""The segment source: start offsets, restarts, growing, removed and half-written segments."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import StreamingQueryException

from headway.streaming import ingest
from headway.streaming.segments import segment_source


@pytest.fixture
def topic(spark, tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()

    def put(base, records, tail=""):
        (folder / f"{base:020d}.log").write_text("".join(f"r{i}\n" for i in records) + tail)

    def read(name, offsets="earliest", strict=False):
        """What a run of the query adds, and the rows of all its runs."""
        source = segment_source(spark, str(folder), offsets, strict)
        query = ingest.stream_append(source, f"{tmp_path}/{name}", f"{tmp_path}/ck-{name}", None, once=True)
        query.awaitTermination(120)
        rows = spark.read.schema("offset long, value binary").parquet(f"{tmp_path}/{name}").collect()
        return sorted((r.offset, bytes(r.value).decode()) for r in rows)

    return folder, put, read


def records(*numbers):
    return [(i, f"r{i}") for i in numbers]


def test_offsets_and_restarts(topic):
    folder, put, read = topic
    put(0, range(3))
    put(3, range(3, 5), tail="half a rec")
    assert read("all") == records(0, 1, 2, 3, 4)
    assert read("some", "2") == records(2, 3, 4)
    assert read("late", "latest") == []
    put(3, range(3, 7))
    put(7, range(7, 8))
    # Each goes on from where it was; half a record was none.
    assert read("all") == records(*range(8)) and read("some", "2") == records(*range(2, 8)) and read("late", "latest") == records(5, 6, 7)
    assert read("all") == records(*range(8))


def test_removed_segments(topic):
    folder, put, read = topic
    put(0, range(2))
    assert read("loose") == read("strict", strict=True) == records(0, 1)
    put(2, range(2, 4))
    put(4, range(4, 6))
    put(6, range(6, 7))
    (folder / f"{2:020d}.log").unlink()
    assert read("loose") == records(0, 1, 4, 5, 6)
    with pytest.raises(StreamingQueryException, match="records 2 to 3"):
        read("strict", strict=True)
    assert read("begin", "1") == records(1, 4, 5, 6)


def test_bronze_from_segments(spark, topic, tmp_path, rows):
    folder, _, _ = topic
    lines = [json.dumps({"event_id": f"e{i}", "batch_time": "2025-01-10 08:00:00", "raw_json": "{}"}) for i in range(3)]
    (folder / f"{0:020d}.log").write_text("\n".join([*lines, "not json"]) + "\n")
    for query in ingest.start_bronze(segment_source(spark, str(folder), "earliest"), f"{tmp_path}/bronze", f"{tmp_path}/bad", f"{tmp_path}/ck", once=True):
        query.awaitTermination(120)
    assert rows(spark.read.parquet(f"{tmp_path}/bronze"), "event_id") == [("e0",), ("e1",), ("e2",)]
    assert spark.read.parquet(f"{tmp_path}/bad").count() == 1


def test_wrong_start_is_refused(topic):
    _, _, read = topic
    with pytest.raises(Exception, match="startingOffsets"):
        read("x", "yesterday")
