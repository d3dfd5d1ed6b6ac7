"""Shared passages of a whole given table, and alignment across long gaps."""

from __future__ import annotations

import os
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from headway.llm import passages
from headway.llm.queries import table

from .conftest import prose

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
def test_every_shared_run_of_a_whole_table(spark):
    """All runs of fifty words that two documents have, word by word: covered words, and pairs that are found or in one component."""
    docs = table(spark, SF, "documents")
    words = {r.doc_id: [w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", r.text or "")] for r in docs.select("doc_id", "text").collect()}
    where = defaultdict(list)
    for i, ws in words.items():
        for at in range(len(ws) - 49):
            where[hash(tuple(ws[at : at + 50]))].append((i, at))
    shared, pairs = defaultdict(set), set()
    for places in where.values():
        owners = {i for i, _ in places}
        if len(owners) > 1:
            pairs |= {(a, b) for a in owners for b in owners if a < b}
            for i, at in places:
                shared[i] |= set(range(at, at + 50))
    covered, component, linked = defaultdict(set), {}, set()
    for r in passages.shared_passages(docs).collect():
        covered[r.doc_id] |= set(range(r.begin, r.end))
        covered[r.kept_id] |= set(range(r.kept_begin, r.kept_end))
        component[r.doc_id] = component[r.kept_id] = r.component_id
        linked.add((min(r.doc_id, r.kept_id), max(r.doc_id, r.kept_id)))
    assert len(pairs) > 100
    found = sum(len(shared[i] & covered[i]) for i in shared) / sum(map(len, shared.values()))
    together = sum(a in component and component.get(a) == component.get(b) for a, b in pairs) / len(pairs)
    print(f"words {found:.4f}, pairs in one component {together:.4f}, pairs themselves {len(pairs & linked) / len(pairs):.4f} of {len(pairs)}")
    assert found >= 0.99 and together >= 0.99


def test_components_join_through_others(spark):
    a, b = prose(1, 80), prose(2, 80)
    rows = [(5, a), (3, f"{a} {b}"), (9, b), (7, prose(3, 200)), (None, f"{prose(4, 70)} tail"), (None, f"{prose(4, 70)} end")]
    found = passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in found} | {(r.kept_id, r.component_id) for r in found} == {(5, 3), (3, 3), (9, 3), (None, None)}


def test_long_gaps_take_no_table(spark):
    """Two long shared runs with twenty thousand other words between them: both are found, without a table of gap by gap words."""
    first, last = prose(1, 6_000), prose(2, 6_000)
    rows = [(i, f"{first} {prose(10 + i, 20_000)} {last}") for i in (1, 2)]
    (x, y) = sorted(passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=lambda r: r.begin)
    assert (x.begin, x.end, x.n_same) == (0, 6_000, 6_000) and (y.begin, y.end, y.n_same) == (26_000, 32_000, 6_000)


def scattered(text: str, fill: int) -> str:
    """All runs of five words of a text, in pieces of eight words in reverse order, with other words between them."""
    words = text.split()
    pieces = [" ".join(words[at : at + 8]) for at in range(0, len(words) - 4, 4)]
    return " ".join(f"{prose(fill * 1000 + i, 12)} {piece}" for i, piece in enumerate(pieces[::-1]))


@pytest.mark.parametrize("others", [12, 40])
def test_seeds_that_other_documents_have_first(spark, others):
    """Two documents share a passage, and a dozen or forty others have its seeds elsewhere, most of them before both."""
    text = prose(1, 60)
    rows = [(i, scattered(text, 10 + i)) for i in range(others)]
    rows += [(100, f"{prose(2, 90)} {text} {prose(3, 30)}"), (101, f"{prose(4, 20)} {text}"), (102, f"{prose(4, 20)} {text}")]
    found = passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert {r.component_id for r in found} == {100} and {i for r in found for i in (r.doc_id, r.kept_id)} == {100, 101, 102}
    spans = {frozenset([(r.doc_id, r.begin, r.end), (r.kept_id, r.kept_begin, r.kept_end)]) for r in found}
    assert frozenset([(101, 0, 80), (102, 0, 80)]) in spans
    assert {frozenset([(100, 90, 150), (i, 20, 80)]) for i in (101, 102)} & spans


def links_of(rng: random.Random) -> list[tuple[int, int]]:
    """Links of two documents: one or a few anywhere, a run on a diagonal near or far apart, or such runs and others."""
    at, to, out = rng.randint(0, 50), rng.randint(0, 50), []
    for _ in range(rng.choice([1, 1, 2, 5, 20])):
        out.append((at, to))
        step = rng.choice([1, 2, 9, 31, 32, 33, 60])
        at, to = at + step, to + step + rng.choice([0, 0, 0, 0, 1, -3, 40])
    return [(x, max(0, y)) for x, y in out + [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(rng.choice([0, 0, 0, 3]))]]


def batch_of(pairs: list, **more: pa.Array) -> pa.RecordBatch:
    links = pa.array([[{"at": x, "to": y} for x, y in p] for p in pairs], pa.list_(passages._LINK))
    numbers = pa.array(range(len(pairs)), pa.int64())
    return pa.RecordBatch.from_pydict({"_doc": numbers, "_hub": numbers, "links": links, **more})


def test_pairs_that_need_no_search_are_not_searched(monkeypatch):
    """All rows' chains are as those of each row alone; single links and runs on one diagonal are never searched for chains."""
    rng = random.Random(3)
    pairs = [links_of(rng) for _ in range(3000)]
    plain, searched = passages.chains, []
    monkeypatch.setattr(passages, "chains", lambda left, right: searched.append(len(left)) or plain(left, right))
    found = [(r["_doc"], [(x["at"], x["to"]) for x in r["links"]]) for b in passages._chained(iter([batch_of([[], *pairs])[1:]])) for r in b.to_pylist()]
    want, bent = [], 0
    for i, p in enumerate(pairs, 1):
        p = sorted(set(p))
        bent += any(c - a != d - b or c - a > 31 for (a, b), (c, d) in zip(p, p[1:], strict=False))
        for chain in plain(*map(list, zip(*p, strict=True))):
            chain = [p[j] for j in chain]
            if min(chain[-1][k] - chain[0][k] for k in (0, 1)) + passages.SEED >= passages.MIN_REACH:
                want.append((i, chain))
    assert sorted(found) == sorted(want) and len(want) > 1000
    assert 0 < len(searched) <= bent < 2500 and min(searched) > 1


def test_chains_on_a_diagonal_are_aligned_together(monkeypatch):
    """Many chains at once give what each of them alone gives: passages to the texts' ends, broken ones, too short ones, no match at all."""
    rng = random.Random(5)
    rows, want = [], []
    for _ in range(600):
        x, y, after, a_after = (rng.choice([0, 3, 40, 90]) for _ in range(4))
        reach, broken = rng.choice([9, 30, 120]), rng.choice([0, 0.05, 0.15, 0.4])
        text = [rng.randint(1, 1 << 30) for _ in range(300)]
        a = np.array(text[100 - x : 100 + reach + after], np.uint32)
        b = np.array([w if rng.random() > broken else 0 for w in text[100 - y : 100 + reach + a_after]], np.uint32)
        inner = sorted({0, reach - passages.SEED, *(rng.randrange(reach - passages.SEED) for _ in range(3))})
        links = [(x + i, y + i) for i in inner]
        for i in inner if broken < 0.4 else []:  # seeds match, but for hashes that collide
            b[y + i : y + i + passages.SEED] = a[x + i : x + i + passages.SEED]
        matches = passages.align(a, b, links)
        want += [(len(rows), *matches[f].tolist(), *(matches[e - 1] + 1).tolist(), e - f) for f, e in passages.alike(matches)]
        rows.append((links, a.tobytes(), b.tobytes()))
    links, a, b = zip(*rows, strict=True)
    low = pa.array([64] * len(rows), pa.int32())
    numbers = pa.array(range(len(rows)), pa.int64())
    moved = [[(x + 64, y + 64) for x, y in p] for p in links]
    block = batch_of(moved, doc_id=numbers, kept_id=numbers, low=low, kept_low=low, words=pa.array(a), kept_words=pa.array(b))
    monkeypatch.setattr(passages, "align", None)
    found = [r for x in passages._aligned(iter([block])) for r in x.to_pylist()]
    assert sorted((r["_doc"], r["begin"] - 64, r["kept_begin"] - 64, r["end"] - 64, r["kept_end"] - 64, r["n_same"]) for r in found) == sorted(want)
    assert len(want) > 200
