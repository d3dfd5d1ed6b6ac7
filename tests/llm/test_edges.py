"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import math
import zlib

import duckdb
import pytest

from headway.llm import decontaminate, html, jaccard, lm, mixing, oracle, passages, quality, sharding, stages, templates, toxicity


def by_id(df, *columns):
    return sorted((tuple(r) for r in df.select("doc_id", *columns).collect()), key=repr)


def test_sharding(odd):
    rows = sharding.shard(odd).collect()
    assert len(rows) == 13 and {r.law for r in rows} == {"rows"}
    assert sorted(r.shard for r in rows) == list(range(13))
    assert all(r.slot == 0 and r.grown_shard is None for r in rows)
    assert [(r["size"], r.text_crc32) for r in rows if r.doc_id == 1] == [(1, 0), (1, 0)]
    smiling = next(r for r in rows if r.doc_id == 8)
    text = odd.where("doc_id = 8").first().text.encode()
    assert (smiling["size"], smiling.text_crc32) == (len(text) + 1, zlib.crc32(text))


def test_jaccard(odd):
    found = by_id(jaccard.jaccard_components(odd, 3, 90, 100), "n_shingles", "component_id")
    assert found.count((1, 0, 1)) == 2 and (2, 0, 2) in found and (3, 0, 3) in found
    assert (4, 1, 4) in found and found.count((5, 1, 4)) == 2
    sixes = [x for x in found if x[0] in (6, 7)]
    assert [x[2] for x in sixes] == [6, 6] and sixes[0][1] > 20_000
    assert sum(x[0] is None for x in found) == 2 and len(found) == 13


def test_toxicity(odd, labels):
    found = by_id(toxicity.toxicity(odd, labels), "held_out", "score", "predicted")
    assert len(found) == 13 and all(0 <= s <= 1 and p == int(s >= 0.7) for _, _, s, p in found)
    assert all(s == 0 for i, _, s, _ in found if i in (1, 2, 3))
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h, _, _ in found if i is not None)


def test_toxicity_without_toxic_labels(odd, labels):
    assert all(s < 1e-9 for _, s in by_id(toxicity.toxicity(odd, labels.where("toxic = 0")), "score"))


def test_html(spark):
    pages = [(1, None, None), (2, "http://a.b/x", ""), (None, "http://a.b/y", "<p>Text &amp; more"), (3, "http://a.b/y", "<p>Text &amp; more"), (3, "no url", "<p>" + "w " * 50_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS _row", "3 AS lines", "4 AS _host")
    found = sorted((tuple(r) for r in html.extract(df).collect()), key=repr)
    assert [x[2] for x in found if x[0] in (1, 2)] == ["", ""]
    assert [x[2:] for x in found if x[1] == "http://a.b/y"] == [("Text & more", 11)] * 2
    assert [x[3] for x in found if x[1] == "no url"] == [99_999]
    assert html.extract(df.limit(0)).count() == 0


def test_lm(odd):
    found = by_id(lm.lm_scores(odd), "held_out", "n_tokens", "n_known", "base_score", "score")
    assert len(found) == 13 and all(s < 0 and b < 0 and k <= n for _, _, n, k, b, s in found)
    assert [n for i, _, n, _, _, _ in found if i in (1, 2, 3)] == [1, 1, 1, 1]
    assert len({s for i, *_, s in found if i in (1, 2)}) == 1


def test_mixing(odd):
    rows = mixing.mix(odd, keep=["doc_id", "source"]).collect()
    assert len(rows) == 13 and all(r.taken == r.copies * r["size"] and 0 <= r.copies <= 3 for r in rows)
    totals = {r.source: (r.source_size, r.target) for r in rows}
    assert math.isclose(sum(t for _, t in totals.values()), sum(s for s, _ in totals.values()))
    assert totals["a"] == (0, 0.0)


def test_decontamination(odd, benchmark):
    found = {r.doc_id: r for r in decontaminate.decontamination(odd.where("doc_id IS NOT NULL"), benchmark).collect()}
    assert (found[1].n_words, found[1].n_hit, found[1].n_items, found[1].contaminated) == (0, 0, 0, False)
    assert found[1].items_sha256 == hashlib.sha256(b"").hexdigest()
    assert (found[5].n_hit, found[5].n_items, found[5].contaminated) == (1, 1, True)
    assert found[5].items_sha256 == hashlib.sha256(b"4").hexdigest()
    loose = [r for r in decontaminate.decontamination(odd.where("doc_id IS NULL"), benchmark).collect() if r.n_hit]
    assert [(r.n_hit, r.n_items, r.items_sha256) for r in loose] == [(20, 2, hashlib.sha256(b"1,5").hexdigest())]


def test_templates(spark, odd):
    found = by_id(templates.drop_templates(odd), "text", "n_lines", "n_dropped")
    assert len(found) == 13 and all(d == 0 for *_, d in found)
    assert (1, None, 0, 0) in found
    many = spark.createDataFrame([(i, f"Page {i} of 9\n{'x' * i} own words here") for i in range(6)] + [(None, None), (6, "")], "doc_id long, text string")
    assert by_id(templates.drop_templates(many), "n_dropped") == [(0, 0), (1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (6, 0), (None, 0)]


def test_templates_generalise_the_fourth_token(spark):
    docs = spark.createDataFrame([(i, f"own line {'x' * i} here\nPosted by user Name{'abcdefghijklmnopqrst'[i]} on the forum page today") for i in range(20)], "doc_id long, text string")
    assert by_id(templates.drop_templates(docs), "n_dropped") == sorted([(0, 0)] + [(i, 1) for i in range(1, 20)], key=repr)


def test_templates_beside_a_frequent_line(spark):
    """A leaf may hold any number of templates, and many copies of one line don't decide for the others."""
    names = [f"Name{a}{b}" for a in "abcde" for b in "fghi"]
    lines = ["Posted by user staff in the old archive of pages"] * 600
    lines += [f"Posted by user {name} on our forum page again today" for name in names]
    lines += [f"Posted by user {name} from {name[::-1]} with nine kind regards" for name in names[:10]]  # two fields
    lines += [f"Posted by user {name} but each says another thing {name * 2}".replace("each", name[4] * 3).replace("another", name[5] * 4) for name in names[:4]]
    docs = spark.createDataFrame([(i, f"own {'x' * i} words\n{line}") for i, line in enumerate(lines)], "doc_id long, text string").cache()
    found = dict(by_id(templates.drop_templates(docs), "n_dropped"))
    firsts = {0, 600, 620}
    assert found == {i: int(i < 630 and i not in firsts) for i in range(len(lines))}
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert dict((r[0], r[3]) for r in con.execute(oracle.TEMPLATES).fetchall()) == found


def test_passages(odd):
    rows = passages.shared_passages(odd).collect()
    assert {frozenset((r.doc_id, r.kept_id)) for r in rows} == {frozenset((6, 7))}
    assert [(r.begin, r.end, r.n_same) for r in rows] == [(0, 30_000, 30_000)]


def test_quality(odd):
    found = {r.doc_id: r for r in quality.quality_rules(odd).collect()}
    assert found[1].base_failed and not found[1].kept and found[1].n_words == 0
    assert found[3].base_failed and found[6].kept and found[6].n_words == 30_000
    assert (found[9].n_dup_lines, found[9].n_lines, found[9].n_repeat_words) == (1, 2, 50)


@pytest.mark.parametrize(
    "operator",
    [sharding.shard, jaccard.jaccard_components, lm.lm_scores, mixing.mix, templates.drop_templates, passages.shared_passages, quality.quality_rules],
)
def test_no_documents(odd, operator):
    assert operator(odd.limit(0)).count() == 0


def test_no_documents_or_items(odd, labels, benchmark):
    assert toxicity.toxicity(odd.limit(0), labels).count() == 0
    assert decontaminate.decontamination(odd.limit(0), benchmark).count() == 0
    assert {r.n_hit for r in decontaminate.decontamination(odd, benchmark.limit(0)).collect()} == {0}


@pytest.mark.parametrize("stage", [stages.quality_rules, stages.near_duplicates, stages.mix_sources])
def test_stages_keep_columns(spark, odd, stage):
    assert stage(spark, odd, "").columns == odd.columns
    assert stage(spark, odd.limit(0), "").count() == 0


def folder_with(benchmark, tmp_path):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_quality_stage_drops_what_the_rules_reject(spark, odd):
    """Null, empty and short texts go, and the one whose lines are all repeated (9)."""
    kept = by_id(stages.quality_rules(spark, odd, ""))
    assert kept == sorted([(i,) for i in (6, 7, None, None, 8)], key=repr)


def test_decontamination_stage(spark, odd, benchmark, tmp_path):
    """The text that holds a benchmark passage and those equal to a short item go; null, empty and other texts stay whole."""
    folder = folder_with(benchmark, tmp_path)
    kept = stages.decontaminate(spark, odd, folder)
    assert kept.columns == odd.columns and stages.decontaminate(spark, odd.limit(0), folder).count() == 0
    assert by_id(kept) == sorted([(i,) for i in (1, 1, 2, 3, 6, 7, None, 8, 9)], key=repr)
    whole = {(r.doc_id, r.text) for r in odd.collect()}
    assert all((r.doc_id, r.text) in whole for r in kept.collect())


def test_empty_benchmark_stays_without_effect(spark, odd, benchmark, tmp_path):
    assert stages.decontaminate(spark, odd, folder_with(benchmark.limit(0), tmp_path)).count() == odd.count()


def test_shard_stage(spark, odd):
    rows = stages.shard(spark, odd, "").collect()
    assert len(rows) == odd.count() and stages.shard(spark, odd.limit(0), "").count() == 0
    assert sorted(r.shard for r in rows) == list(range(len(rows))) and {r.slot for r in rows} == {0}
    assert sorted(r.text_crc32 for r in rows if r["size"] == 1) == [0, 0, 0]


def test_near_duplicates_keep_one(spark, odd):
    kept = by_id(stages.near_duplicates(spark, odd, ""))
    assert kept == sorted([(1,), (1,), (2,), (3,), (4,), (6,), (None,), (None,), (8,), (9,)], key=repr)
