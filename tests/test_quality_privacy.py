from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from headway.plans import privacy, quality
from headway.plans.quality import Check

NOW = dt.datetime(2025, 1, 10)


@pytest.fixture(scope="module")
def accounts(spark):
    users = spark.createDataFrame(
        [(1, "a@x.org", "h", "Ann", "A", "+33 6 11 22 33", NOW), (2, "b@x.org", "h", "Bob", "B", "+33 6 44 55 66", NOW)],
        "id long, email string, password_hash string, first_name string, last_name string, phone string, created_at timestamp",
    )
    subs = spark.createDataFrame(
        [(10, 1, "o", 4, NOW), (11, 1, "p", 2, NOW), (12, 9, "q", 1, NOW)],
        "id long, user_id long, origin_station string, crowding_sensitivity int, created_at timestamp",
    ).withColumn("max_transfers", F.lit(2))
    notes = spark.createDataFrame(
        [(100, 10, NOW.date(), "sent", NOW), (101, 10, NOW.date(), "sent", NOW), (102, 99, NOW.date(), "sent", NOW)],
        "id long, subscription_id long, notify_date date, status string, created_at timestamp",
    )
    return users, subs, notes


def test_checks_count_offenders_and_skip_nulls(spark):
    df = spark.createDataFrame([(1, 5.0), (1, None), (None, 200.0)], "id int, pct double")
    checks = [
        Check("nn", "not_null", "id"),
        Check("un", "unique", "id"),
        Check("bt", "between", "pct", 0, 100),
        Check("in", "in_set", "id", values=(2, 3)),
        Check("rc", "row_count", low=1, high=2),
        Check("cond", "condition", condition="pct > id", threshold=5),
    ]
    got = {r.test: (r.failed, r.passed) for r in quality.run_checks("t", df, checks).collect()}
    assert got == {"nn": (1, False), "un": (1, False), "bt": (1, False), "in": (2, False), "rc": (3, False), "cond": (1, True)}


def test_curated_list_replaces_the_baseline(spark, rows):
    tables = {"a": spark.range(2), "b": spark.range(0)}
    out = quality.run_suite(tables, {"a": [Check("only", "unique", "id")]})
    assert rows(out, "test", "passed") == [("b_id_not_null", True), ("b_row_count_positive", False), ("only", True)]


def test_contract_reports_missing_columns(spark):
    df = spark.createDataFrame([(1, 50.0, NOW), (None, 120.0, NOW)], "accessibility_level_id int, pct_elevators_available double, at timestamp")
    contract = quality.Contract(
        "t",
        {"accessibility_level_id": "int", "stop_point_latitude": "double"},
        {"level": "accessibility_level_id IS NOT NULL", "pct": "pct_elevators_available BETWEEN 0 AND 100"},
        unique=("accessibility_level_id",),
        fresh_column="at",
        max_age_hours=1,
    )
    out = {r.check: r.violations for r in quality.check_contract("c", contract, df, NOW + dt.timedelta(hours=2)).collect()}
    assert out == {
        "accessibility_level_id": 0, "stop_point_latitude": 1, "level": 1, "pct": 1, "accessibility_level_id-unique": 0, "freshness": 1,
    }


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, "b")], "n int, s string")
    got = {r.column: r for r in quality.profile_columns("t", df, None, exact=True).collect()}
    assert (got["s"].null_pct, got["s"].distinct_pct, got["s"].min, got["s"].max) == (25.0, 50.0, "a", "b")
    assert (got["n"].mean, got["n"].distinct_pct) == (2.5, 100.0)


def test_personal_data_columns(accounts):
    got = {(r.column, r.kind): r for r in quality.pii_columns("people", accounts[0]).collect()}
    assert got["email", "email"].tag == "PII.Sensitive" and got["email", "email"].pct == 100.0
    assert got["phone", "phone"].tag == "PII.Sensitive" and got["first_name", "email"].tag is None
    tagged = {r.column: r.tag for r in quality.pii_columns("users", accounts[0]).collect()}
    assert tagged["password_hash"] == "PII.Sensitive"


def test_constraints(accounts):
    got = {r.test: r.failed for r in quality.constraint_check(*accounts).collect()}
    assert got["subscriptions_sensitivity_range"] == 1
    assert got["subscriptions_user_exists"] == 1
    assert got["notifications_subscription_exists"] == 1
    assert got["notifications_one_per_day"] == 1
    assert got["users_email_unique"] == 0


def test_export_holds_no_password(accounts):
    records = privacy.person_export(*accounts).where("user_id = 1").collect()
    assert sorted(r.record for r in records) == ["account", "notification", "notification", "subscription", "subscription"]
    assert all("password" not in r.content for r in records)
    account = json.loads(next(r.content for r in records if r.record == "account"))
    assert account["email"] == "a@x.org" and account["created_at"] == "2025-01-10T00:00:00"


def test_documents_are_nested_in_order(accounts, tmp_path):
    privacy.write_documents(privacy.person_export(*accounts), str(tmp_path / "d"))
    lines = [json.loads(x) for f in (tmp_path / "d").glob("part-*") for x in f.read_text().split("\x1e") if x]
    found = {d["account"]["id"] if d["account"] else None: d for d in lines}
    assert len(lines) == len(found) == accounts[0].count() + 1  # and one owner without an account
    first = found[1]
    assert first["account"]["email"] == "a@x.org" and "password_hash" not in first["account"]
    assert [s["id"] for s in first["subscriptions"]] == [10, 11]
    assert [[n["id"] for n in s["notifications"]] for s in first["subscriptions"]] == [[100, 101], []]
    assert all(n["subscription_id"] == s["id"] for d in lines for s in d["subscriptions"] for n in s["notifications"])
    assert found[None]["subscriptions"]


def test_a_person_of_very_many_records(spark, accounts, tmp_path):
    """A quarter of a million records of one person become one document; its pieces are no longer than its records."""
    users, subs, notes = accounts
    many = spark.range(1000, 251_000).select("id", F.lit(10).cast("long").alias("subscription_id"), *[F.lit(None).cast(notes.schema[c].dataType).alias(c) for c in notes.columns[2:]])
    records = privacy.person_export(users, subs, notes.unionByName(many.select(*notes.columns)))
    assert privacy.person_documents(records).agg(F.max(F.length("piece"))).first()[0] < 500
    privacy.write_documents(records, str(tmp_path / "d"))
    lines = [x for f in (tmp_path / "d").glob("part-*") for x in f.read_text().split("\x1e")]
    longest = json.loads(max(lines, key=len))
    assert [n["id"] for n in longest["subscriptions"][0]["notifications"]] == [100, 101, *range(1000, 251_000)]


def test_rectification(spark, accounts):
    users = accounts[0]
    updates = spark.createDataFrame(
        [(1, " NEW@x.org ", None), (2, "new@x.org", "Bee"), (3, "z@x.org", None)], "id long, email string, last_name string"
    )
    reasons = {r.id: r.refused for r in privacy.rectification_outcomes(users, updates).collect()}
    assert reasons == {1: None, 2: "email already used", 3: "unknown person"}
    after = {r.id: (r.email, r.last_name) for r in privacy.person_rectify(users, updates).collect()}
    assert after == {1: ("new@x.org", "A"), 2: ("b@x.org", "B")}
    odd = spark.createDataFrame([(1, "b@x.org", None), (2, None, None)], "id long, email string, last_name string")
    assert {r.id: r.refused for r in privacy.rectification_outcomes(users, odd).collect()} == {1: "email already used", 2: "nothing to change"}
    blank = spark.createDataFrame([(1, None, "  ")], "id long, email string, last_name string")
    assert privacy.rectification_outcomes(users, blank).first().refused == "blank value"


def test_erasure_cascades(spark, accounts, rows):
    gone = spark.createDataFrame([(1,), (77,)], "id long")
    users, subs, notes, counts = privacy.person_erase(*accounts, gone)
    assert rows(users, "id") == [(2,)] and rows(subs, "id") == [(12,)] and rows(notes, "id") == [(102,)]
    assert rows(counts) == [(1, 1, 2, 2)]
