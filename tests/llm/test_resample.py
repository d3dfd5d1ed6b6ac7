"""The resampled order against a plain sort, quickselect and ranks on ties, odd texts."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from headway.llm import resample

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    words = _WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    runs = [b" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), runs


def plain(docs, target, longest=1, percent=10, min_words=20, buckets=10_000, seed=2024):
    """(doc_id, n_features, weight, score, rank) of every row."""
    number = lambda run: zlib.crc32(run) % buckets
    s = Counter(number(x) for _, t in docs for x in features(t, longest)[1])
    t = Counter(number(x) for text in target for x in features(text, longest)[1])
    s_all, t_all = float(sum(s.values())), float(sum(t.values()))
    rows = []
    for doc_id, text in docs:
        n_words, runs = features(text, longest)
        gain = [math.floor(1000 * math.log((t[b] + 1.0) * (s_all + buckets) / ((s[b] + 1.0) * (t_all + buckets)))) for b in map(number, runs)]
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(runs), sum(gain), sum(gain) + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


@pytest.mark.parametrize("longest", [1, 3])
def test_equals_plain_version(spark, odd, benchmark, longest):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(80)] + ["Été", "ÅB", "it's", "\U0001f600x"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(700)]
    docs += [(1, docs[1][1])] * 150 + [(None, docs[5][1]), (700, None), (701, ""), (702, "\x00 -- \n")]
    docs += [(r.doc_id, r.text) for r in odd.collect()]
    target = [docs[i][1] for i in range(0, 60, 7)] + [None, ""]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS weight", "3 AS key", "4 AS _row", "5 AS _part", "6 AS n_words")
    found = resample.importance_resample(df, spark.createDataFrame([(x,) for x in target], "text string"), percent=30, longest=longest)
    assert found.dtypes == [("doc_id", "bigint"), ("n_features", "bigint"), ("weight", "bigint"), ("score", "bigint"), ("rank", "bigint")]
    assert sorted(map(tuple, found.collect()), key=repr) == plain(docs, target, longest, percent=30)


def test_no_documents_and_no_target(spark, odd, benchmark):
    assert resample.importance_resample(odd.limit(0), benchmark).count() == 0
    rows = resample.importance_resample(odd, benchmark.limit(0), percent=100).collect()
    assert sorted(r.rank for r in rows if r.rank) == list(range(1, 7))
    assert all(r.rank is None for r in resample.importance_resample(odd, benchmark, percent=10).collect())


@pytest.mark.parametrize("k", [1, 2, 499, 500, 777, 1000])
def test_quickselect_with_ties(spark, k):
    rng = random.Random(k)
    rows = [(rng.choice([0, 0, 0, 1, 2, -7]), None if i % 9 == 0 else i % 13, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a long, b long, c long").select(F.struct("a", "b", "c").alias("key"))
    want = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))[k - 1]
    assert tuple(resample.kth_key(df, k, pivots=7)) == want


def test_ranks_of_ranges(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 5), i) for i in range(500)]
    df = spark.createDataFrame(rows, "a long, i long").repartition(7).select(F.struct("a", "i").alias("key"))
    found = {tuple(r["key"]): r["rank"] for r in resample.ranked(df, "key", "rank").collect()}
    assert [found[r] for r in sorted(rows)] == list(range(1, 501))
