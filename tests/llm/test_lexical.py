"""Ranked search against a plain version: ties, copies, blocks, many buckets, odd texts."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from headway.llm import lexical

from .conftest import prose

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub(rb"[A-Z]", lambda m: m[0].lower(), w) for w in _WORD.findall((text or "").encode())]


def plain(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in counts)
    n_words = sum(sum(c.values()) for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, c in counts:
            n = sum(c.values())
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1000 * c[w] + 8 * (10 + 90 * n * n_docs // n_words)))
                for w in set(terms(text))
                if c[w]
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def corpus(rng, n):
    words = [f"w{i}" for i in range(300)] + ["Été", "ÅB", "\U0001f600x", "7"]
    odds = [1 / (i + 1) for i in range(len(words))]
    return [(i, " ".join(rng.choices(words, odds, k=rng.choice([0, 1, 5, 40, 200])))) for i in range(n)], words


@pytest.mark.parametrize("block_terms", [1 << 16, 150])
def test_equals_plain_version(spark, block_terms):
    rng = random.Random(3)
    docs, words = corpus(rng, 600)
    copy = " ".join(rng.choices(words, k=30))
    docs += [(10_000 - i, copy) for i in range(400)] + [(7, copy), (7, copy), (None, copy), (601, None), (602, " -- "), (None, docs[3][1])]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 30])))) for i in range(25)]
    items += [(50, copy), (50, copy), (51, "nowhere"), (52, None), (53, ""), (None, "w3 W7 w200"), (54, copy.upper())]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS _row", "3 AS n", "4 AS terms", "5 AS length", "6 AS `rank`").repartition(9)
    found = lexical.ranked_search(df, spark.createDataFrame(items, "item_id long, text string"), block_terms=block_terms)
    assert sorted(map(tuple, found.collect()), key=repr) == plain(docs, items)


def test_long_and_odd_documents(spark, odd, benchmark):
    docs, items = [(r.doc_id, r.text) for r in odd.collect()], [(r.item_id, r.text) for r in benchmark.collect()]
    found = lexical.ranked_search(odd, benchmark)
    assert sorted(map(tuple, found.collect()), key=repr) == plain(docs, items)
    long = [(1, prose(1, 20_000)), (2, None)]  # a query of very many terms is a block of its own
    found = lexical.ranked_search(odd, spark.createDataFrame([*long, *items], "item_id long, text string"), block_terms=2000, k=3)
    assert sorted(map(tuple, found.collect()), key=repr) == plain(docs, [*long, *items], 3)


def test_nothing_to_find(spark, odd, benchmark):
    assert lexical.ranked_search(odd.limit(0), benchmark).count() == 0
    assert lexical.ranked_search(odd, benchmark.limit(0)).count() == 0
    assert lexical.ranked_search(odd.where("doc_id <= 3"), benchmark).columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_leave_out_work_but_no_result():
    """Most pairs are pruned before their exact score is taken, and every best one survives."""
    rng = np.random.default_rng(2)
    marks = np.arange(60)
    weights = np.sort(rng.integers(1, 9000, 60))
    query = np.repeat(np.arange(20), 12)
    term = np.concatenate([rng.choice(60, 12, replace=False) for _ in range(20)])
    asked = lexical.Block(np.arange(20), marks, weights, query, term)
    doc = np.repeat(np.arange(3000), 15)
    own = np.concatenate([np.sort(rng.choice(60, 15, replace=False, p=(60 - marks) / 1830)) for _ in range(3000)])
    impact = weights[own] * rng.integers(1, 1_000_000, len(own))
    length = np.sqrt(np.bincount(doc, impact.astype(float) ** 2))
    order = np.argsort(-length)
    number = np.argsort(order)
    by = np.lexsort((own, number[doc]))
    batch = lexical.Batch(number[doc][by], own[by], impact[by], length[order])
    found, pairs = lexical.Found(np.zeros(20, np.int64), 10), 0
    for low in range(0, 3000, 500):
        queries, docs, scores = lexical.search(asked, batch.part(low, low + 500), found)
        pairs += len(scores)
        found.add(queries, scores, np.zeros_like(docs), docs + low, docs + low)
    dense = np.zeros((3000, 60), np.int64)
    dense[batch.doc, batch.term] = batch.impact
    for q in range(20):
        scores = dense[:, term[query == q]].sum(1)
        best = sorted(zip((-scores).tolist(), range(3000), strict=True))[:10]
        mine = found.rows[0] == q
        assert list(zip((-found.rows[1][mine]).tolist(), found.rows[3][mine].tolist(), strict=True)) == best
    assert pairs < 0.5 * 20 * 3000
