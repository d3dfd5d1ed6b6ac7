from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from headway.operators.merge import merge_insert_new, merge_sync, merge_upsert, merge_versioned

NOW = dt.datetime(2025, 1, 10)


def frame(spark, rows, schema="k int, v string, ver int"):
    return spark.createDataFrame(rows, schema)


def test_upsert_updates_and_inserts(spark, rows):
    out = merge_upsert(frame(spark, [(1, "a", 1), (2, "b", 1)]), frame(spark, [(2, "B", 2), (3, "C", 1)]), ["k"])
    assert rows(out) == [(1, "a", 1), (2, "B", 2), (3, "C", 1)]


def test_upsert_can_set_null(spark, rows):
    out = merge_upsert(frame(spark, [(1, "a", 1)]), frame(spark, [(1, None, 2)]), ["k"])
    assert rows(out) == [(1, None, 2)]


def test_null_keys_match_once(spark, rows):
    schema = "id int, line string, v string"
    target, source = frame(spark, [(1, None, "a")], schema), frame(spark, [(1, None, "b")], schema)
    assert rows(merge_upsert(target, source, ["id", "line"])) == [(1, None, "b")]
    assert len(rows(merge_upsert(target, source, ["id", "line"], null_safe=False))) == 2
    assert rows(merge_insert_new(target, source, ["id", "line"])) == []


def test_repeated_source_key_raises(spark):
    source = frame(spark, [(1, "a", 1), (1, "b", 2)])
    with pytest.raises(PySparkException, match="repeats a key"):
        merge_upsert(frame(spark, []), source, ["k"]).collect()


@pytest.mark.parametrize("strict, value", [(True, "old"), (False, "new")])
def test_equal_version(spark, rows, strict, value):
    out = merge_versioned(frame(spark, [(1, "old", 5)]), frame(spark, [(1, "new", 5)]), ["k"], "ver", strict)
    assert rows(out, "v") == [(value,)]


def test_older_version_is_ignored(spark, rows):
    out = merge_versioned(frame(spark, [(1, "old", 5)]), frame(spark, [(1, "late", 4), (2, "x", 1)]), ["k"], "ver")
    assert rows(out) == [(1, "old", 5), (2, "x", 1)]


def test_sync_closes_and_reopens(spark, rows):
    schema = "k int, v string, is_active boolean, missing_since timestamp, processed_at timestamp"
    day0 = dt.datetime(2025, 1, 1)
    target = frame(spark, [(1, "a", True, None, day0), (2, "b", True, None, day0), (3, "c", False, day0, day0)], schema)
    source = frame(spark, [(2, "B", NOW), (4, "D", NOW)], "k int, v string, processed_at timestamp")
    first = merge_sync(target, source, ["k"], NOW)
    assert rows(first) == [
        (1, "a", False, NOW, NOW),
        (2, "B", True, None, NOW),
        (3, "c", False, day0, day0),
        (4, "D", True, None, NOW),
    ]
    later = dt.datetime(2025, 1, 11)
    back = merge_sync(first, frame(spark, [(1, "A", later)], "k int, v string, processed_at timestamp"), ["k"], later)
    assert ("A", True, None) in rows(back, "v", "is_active", "missing_since")
    assert rows(back.where("k = 3"), "missing_since") == [(day0,)]
    assert rows(back.where("k in (2, 4)"), "is_active") == [(False,), (False,)]


BATCH = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 6)), max_size=6, unique_by=lambda r: r[0])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(first=BATCH, second=BATCH)
def test_versioned_merge_is_idempotent_and_order_free(spark, rows, first, second):
    schema = "k int, ver int"
    a, b, none = frame(spark, first, schema), frame(spark, second, schema), frame(spark, [], schema)

    def apply(*batches):
        out = none
        for batch in batches:
            out = merge_versioned(out, batch, ["k"], "ver", on_duplicates="trust")
        return rows(out)

    assert apply(a, b) == apply(b, a) == apply(a, b, a, b)


def test_insert_new_refuses_repeated_keys(spark, rows):
    source = frame(spark, [(1, "a", 1), (1, "b", 2)])
    with pytest.raises(PySparkException, match="repeats a key"):
        merge_insert_new(frame(spark, []), source, ["k"]).collect()
    assert len(rows(merge_insert_new(frame(spark, []), source, ["k"], on_duplicates="trust"))) == 2
