from __future__ import annotations

import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from headway.plans.quality import Check, run_checks
from headway.sources import feeds, files, maintenance, tables


def test_open_csv_keeps_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id;txt\n1;"say ""hi"";\nnext"\n2;x\n', encoding="utf-8")
    got = files.read_open_csv(spark, str(tmp_path / "a.csv")).collect()
    assert [(r.id, r.txt) for r in got] == [("1", 'say "hi";\nnext'), ("2", "x")]


def test_gtfs_member_is_typed_by_name(spark, tmp_path):
    (tmp_path / "calendar_dates.txt").write_text("﻿date,service_id,exception_type\n20250101,S:1,1\n20250102,S:1,x\n", encoding="utf-8")
    got = files.read_gtfs(spark, str(tmp_path), "calendar_dates").collect()
    assert [tuple(r) for r in got] == [("S:1", "20250101", 1), ("S:1", "20250102", None)]


def test_tolerant_load(spark, tmp_path):
    header = "JOUR;CODE STIF ARRET;lda"
    (tmp_path / "good.txt").write_text(f"﻿{header}\n2025-01-01;7;9\n", encoding="utf-8")
    (tmp_path / "tabs.txt").write_text("JOUR\tCODE_STIF_ARRET\tID_ZDC\n2025-01-02\t8\t9\n", encoding="utf-8")
    (tmp_path / "none.txt").write_text("JOUR\n2025-01-01\n", encoding="utf-8")
    (tmp_path / "short.txt").write_text("JOUR;x\n2025-01-01;1\n", encoding="utf-8")
    (tmp_path / "latin.txt").write_bytes("é;b\n".encode("latin-1"))
    paths = [str(tmp_path / n) for n in ("good.txt", "tabs.txt", "none.txt", "short.txt", "latin.txt")]
    expected = ["JOUR", "CODE_STIF_ARRET", "ID_REFA_LDA"]
    good, bad = files.load_tolerant(spark, paths, expected, files.HEADER_SYNONYMS)
    assert sorted(tuple(r) for r in good.collect()) == [("2025-01-01", "7", "9"), ("2025-01-02", "8", "9")]
    reasons = {r.path.rsplit("/", 1)[1]: r.reason for r in bad.collect()}
    assert reasons == {"none.txt": "encoding or delimiter", "short.txt": "columns", "latin.txt": "encoding or delimiter"}


def test_files_of_one_layout_are_read_together(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.txt").write_text(f"a;b\n{i};x\n", encoding="utf-8")
    calls = []

    def read(session, paths, delimiter):
        calls.append(paths)
        return session.read.options(header=True, sep=delimiter).csv(paths)

    good, bad = files.load_tolerant(spark, [str(tmp_path / f"{i}.txt") for i in range(5)], ["a", "b"], reader=read)
    assert len(calls) == 1 and bad.isEmpty()
    assert sorted(r.a for r in good.collect()) == list("01234")


def test_zip_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("dir/x.txt", "l1\r\nl2\n")
        z.writestr("y.csv", "no")
    got = files.unzip_members(spark, str(tmp_path / "a.zip")).orderBy("line_no").collect()
    assert [(r.member, r.line_no, r.line) for r in got] == [("dir/x.txt", 0, "l1"), ("dir/x.txt", 1, "l2")]


DISRUPTION_PAYLOADS = [
    ({"disruptions": [{"id": "a"}, {"id": "b"}]}, ["disruption"] * 2, ["a", "b"]),
    ({"Disruption": [{"disruption_id": 7}]}, ["disruption"], ["7"]),
    (
        {"Siri": {"ServiceDelivery": {"SituationExchangeDelivery": {"Situations": {"PtSituationElement": {"SituationNumber": {"value": "s1"}}}}}}},
        ["pt_situation"],
        ["s1"],
    ),
    ({"other": 1}, ["raw_payload"], [None]),
]


@pytest.mark.parametrize("payload, kinds, ids", DISRUPTION_PAYLOADS)
def test_disruption_payloads(spark, payload, kinds, ids):
    df = spark.createDataFrame([(json.dumps(payload), dt.datetime(2025, 1, 1))], "payload string, fetched_at timestamp")
    items = feeds.explode_feed(df, "disruptions")
    rows = sorted(feeds.event_envelope(items, feeds.DISRUPTION_ID_KEYS, "poll").collect(), key=lambda r: r.event_id)
    assert [r.payload_type for r in rows] == kinds
    for row, wanted in zip(rows, ids):
        assert row.event_id == wanted if wanted else len(row.event_id) == 40
        assert row.batch_time == "2025-01-01 00:00:00"


def test_payload_that_is_not_json_is_dropped(spark):
    df = spark.createDataFrame([("{oops", dt.datetime(2025, 1, 1))], "payload string, fetched_at timestamp")
    assert feeds.explode_feed(df, "passages").isEmpty()


def test_malformed_envelopes_go_to_quarantine(spark, rows):
    df = spark.createDataFrame([('{"event_id":"e","batch_time":"2025-01-01 00:00:00"}',), ("nope",), ("",)], "value string")
    decoded = feeds.decode_envelope(df)
    assert rows(feeds.well_formed(decoded), "event_id", "batch_time") == [("e", dt.datetime(2025, 1, 1))]
    assert rows(feeds.quarantined(decoded)) == [("",), ("nope",)]


def test_append_and_count(spark, tmp_path):
    """Self-test of the bronze write path: append N, insert one with a new column, count N + 1."""
    folder = str(tmp_path / "t")
    tables.append_bronze(spark.range(5).withColumn("ingestion_date", F.lit("2025-01-01")), folder)
    extra = spark.createDataFrame([(9, "n", "2025-01-02")], "id long, note string, ingestion_date string")
    tables.append_bronze(extra, folder)
    stored = tables.read_bronze(spark, folder)
    assert stored.count() == 6 and stored.where("note = 'n'").count() == 1


def test_append_audit(spark, tmp_path, rows):
    folder = str(tmp_path / "t")
    some = spark.range(5).withColumn("ingestion_date", F.lit("2025-01-01"))
    extra = spark.createDataFrame([(9, "n", "2025-01-02")], "id long, note string, ingestion_date string")
    for _ in range(2):
        assert rows(tables.audit_append(some, extra, folder)) == [(5, 5, 6, True)]
    assert rows(tables.audit_append(some.limit(0), extra, str(tmp_path / "u"))) == [(0, 0, 1, True)]


def test_overwrite_touches_only_its_partitions(spark, tmp_path, rows):
    folder = str(tmp_path / "t")
    schema = "id int, ingestion_date string"
    tables.overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], schema), folder)
    for _ in range(2):
        tables.overwrite_partitions(spark.createDataFrame([(3, "b")], schema), folder)
    assert rows(spark.read.parquet(folder)) == [(1, "a"), (3, "b")]


def test_versions_and_retention(spark, tmp_path, rows):
    folder = str(tmp_path / "t")
    df = spark.createDataFrame([(1, dt.date(2025, 1, 31))], "id int, d date")
    tables.publish(df, folder, "month(d)")
    again = tables.current(spark, folder).drop("d_month").withColumn("id", F.col("id") + 1)
    tables.publish(again, folder, "month(d)")
    assert rows(tables.current(spark, folder), "id", "d_month") == [(2, "2025-01")]
    assert rows(tables.current(spark, folder, 1), "id") == [(1,)]
    (tmp_path / "t" / "version=3").mkdir()
    assert tables.versions(spark, folder) == [1, 2]
    assert tables.expire_versions(spark, folder, 1) == [1] and tables.versions(spark, folder) == [1, 2]
    tables.expire_versions(spark, folder, 1, remove=True)
    assert tables.versions(spark, folder) == [2]


def test_publish_only_if_valid(spark, tmp_path, rows):
    folder = str(tmp_path / "t")

    def audit(df):
        return run_checks("t", df, [Check("positive", "between", "id", 1)])

    tables.publish_if_valid(spark.createDataFrame([(1,)], "id int"), folder, audit)
    results = tables.publish_if_valid(spark.createDataFrame([(-1,)], "id int"), folder, audit)
    assert rows(results, "passed") == [(False,)]
    assert rows(tables.current(spark, folder)) == [(1,)] and tables.versions(spark, folder) == [1]
    tables.publish_if_valid(spark.createDataFrame([(5,)], "id int"), folder, audit)
    assert rows(tables.current(spark, folder)) == [(5,)] and tables.versions(spark, folder) == [1, 3]


def test_compaction(spark, tmp_path):
    folder = str(tmp_path / "t")
    spark.range(1000).repartition(8).write.parquet(f"{folder}/version=1")
    assert tables.compact(spark, folder, 10**7, 5)
    assert tables.versions(spark, folder) == [1, 2] and tables.current(spark, folder).count() == 1000
    assert not tables.compact(spark, folder, 10**7, 5)


def test_sniff_reads_the_whole_first_line_and_file(spark, tmp_path):
    header = ",".join(f"a{i}" for i in range(400)) + ";" * 500
    (tmp_path / "long.txt").write_text(header + "\n1\n", encoding="utf-8")
    (tmp_path / "late.txt").write_bytes(b"a;b\n" + b"1;2\n" * 2000 + "é;2\n".encode("latin-1"))
    found = {r.path.rsplit("/", 1)[1]: r.delimiter for r in files.sniff_delimiter(spark, [str(tmp_path / n) for n in ("long.txt", "late.txt")]).collect()}
    assert found == {"long.txt": ";", "late.txt": None}


def test_schema_fit(spark):
    out = tables.fit(spark.createDataFrame([(1,)], "b int"), "a string, b bigint")
    assert out.dtypes == [("a", "string"), ("b", "bigint")]


def test_orphans_and_sweep(spark, rows):
    now = dt.datetime(2025, 1, 10)
    listing = spark.createDataFrame(
        [("a", dt.datetime(2025, 1, 1)), ("b", dt.datetime(2025, 1, 1)), ("c", dt.datetime(2025, 1, 8))], "path string, modified_at timestamp"
    )
    used = spark.createDataFrame([("a",)], "path string")
    assert rows(maintenance.orphan_files(listing, used, now, 1), "path") == [("b",)]
    assert maintenance.orphan_sweep_due(dt.datetime(2025, 1, 12)) and not maintenance.orphan_sweep_due(now)
    seen = []

    def fail(table):
        raise RuntimeError("no")

    errors = maintenance.maintain_layer(["t1", "t2"], {"bad": fail, "good": seen.append})
    assert seen == ["t1", "t2"] and errors == [("t1", "bad", "no"), ("t2", "bad", "no")]
