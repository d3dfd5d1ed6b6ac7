"""Operators that SQL can't express, against plain versions, round trips and held-out rows."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm import html, jaccard, lm, passages, quality, toxicity
from headway.llm.graph import components
from headway.llm.queries import QUERIES
from headway.llm.words import ALNUM, LOWER, NOT_SPACE, slices, word_hashes, words_of

from .conftest import SF, prose

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBé \t\n\x0b9!\U0001f600"))))
def test_words(values):
    column = pa.array(values, pa.string())
    for letters, pattern in ((NOT_SPACE, "[^\x20\x09-\x0d]+"), (ALNUM, "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")):
        got = []
        for piece in slices(column, 16):
            data = LOWER[piece.data]
            found = words_of(piece, letters, data)
            each = [bytes(data[a:b]).decode() for a, b in zip(found.starts, found.ends, strict=True)]
            got += [each[a:b] for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
            hashes = word_hashes(data, found)
            assert len(set(zip(each, hashes.tolist(), strict=True))) == len(set(each))
        assert got == [re.findall(pattern, (v or "").translate(LOW)) for v in values]


def test_shards_are_even_and_texts_together(spark, texts):
    rows = QUERIES["op1_balanced_label_propagation"](spark, SF).collect()
    sizes, homes = Counter(r.shard for r in rows), defaultdict(set)
    assert len(rows) == len(texts) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))
    for r in rows:
        homes[texts[r.doc_id].text].add(r.shard)
        assert (r["size"], r.text_crc32) == (len(texts[r.doc_id].text.encode()) + 1, zlib.crc32(texts[r.doc_id].text.encode()))
    assert all(len(h) == 1 for h in homes.values())


def test_a_text_of_a_third_of_all_rows_is_spread(spark):
    from headway.llm.sharding import shard

    df = spark.createDataFrame([(i, "same" if i % 3 == 0 else prose(i, 5)) for i in range(600)], "doc_id long, text string")
    rows = shard(df).collect()
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert len({r.shard for r in rows if r.doc_id % 3 == 0}) <= 10


def test_jaccard_with_a_group_of_near_copies(spark):
    """Components of copies of one text with edits of their own, around the limit, against all pairs."""
    rng, base = random.Random(5), prose(9, 120).split()
    docs = {}
    for i in range(300):
        copy = list(base) if i < 200 else prose(i, 15 + i % 9).split()
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(1000)}"
        docs[i] = " ".join(copy)
    for i in range(300, 360):  # small sets, one word apart
        docs[i] = " ".join(prose(i // 4, 14).split()[: 11 + i % 4])
    for n, num in ((3, 90), (5, 80)):
        sets = {i: {tuple(w[j : j + n]) for j in range(max(1, len(w) - n + 1))} for i, w in ((i, t.split()) for i, t in docs.items())}
        least = {i: i for i in docs}

        def root(i, least=least):
            while least[i] != i:
                i = least[i]
            return i

        for i in docs:
            for j in range(i):
                same = len(sets[i] & sets[j])
                if 100 * same >= num * (len(sets[i]) + len(sets[j]) - same):
                    a, b = sorted((root(i), root(j)))
                    least[b] = a
        found = jaccard.jaccard_components(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), n, num, 100)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == {i: (len(sets[i]), root(i)) for i in docs}


def test_subsets_meet():
    for n in range(1, 40):
        for m in range(n, 45):
            for num in (80, 90):
                need = jaccard.overlap(n, m, num, 100)
                if need <= n:
                    assert 100 * need >= num * (n + m - need) and 100 * (need - 1) < num * (n + m - need + 1)
                    assert need in jaccard.subset_sizes(n, num, 100) and need in jaccard.subset_sizes(m, num, 100)


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)] + [(7, 7)]
    rng = random.Random(1)
    rng.shuffle(links)
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def test_toxicity_generalises_to_misspellings():
    rng, bad = random.Random(2), ["horrible", "disgraceful", "contemptible"]
    docs = []
    for i in range(600):
        text = prose(i, 40).split()
        if i % 4 == 0:
            text[rng.randrange(40)] = rng.choice(bad)
        docs.append((" ".join(text), int(i % 4 == 0)))
    bags = toxicity.Bags()
    bags.add(pa.array([t for t, _ in docs[:450]]), np.array([y for _, y in docs[:450]]) == 1)
    table, offset = toxicity.train(bags)
    scores = toxicity.worst_words(pa.array([t for t, _ in docs[450:]]), table, offset)
    truth = np.array([y for _, y in docs[450:]]) == 1
    assert ((scores >= 0.7) == truth).mean() > 0.97
    unseen = toxicity.worst_words(pa.array(["so horribble", "disgracefull stuff", "contemptable"]), table, offset)
    assert (unseen > 0.5).all()


def test_blocks():
    page = """<html><head><title>T</title></head><body class="has-comments"><header><h1>Site</h1></header><nav><a href=x>m</a></nav>
    <div class="cookie-notice">c</div><main><article><header><h1>Head &amp; er</h1></header><p>One<b> two</b><br>three<p>Four &lt;x&gt;
    <a href=q>five</a><div class="ad-box">ad</div><form>f</form><section id="comments"><p>nice</p></section><script>var a="</p>";</script>
    <p>six 5 < 6</p></article></main><footer>f</footer>"""
    assert html.blocks_of(page) == [("Head & er", False), ("One two three", False), ("Four <x> five", False), ("six 5 < 6", False)]
    assert html.blocks_of("<nav><ul><li>x<article><p>body</p></article>") == [("body", False)]
    assert html.blocks_of("<p>Cut &am") == [("Cut &am", True)] and html.blocks_of("<p>a</p><p class='x") == [("a", True)]
    assert html.blocks_of("<div><style>p{}</style><!-- a --><p hidden>no</p>yes</div>") == [("yes", True)]


def test_differencing_by_nearest_url(spark):
    """On pages that mark no article, what the nearest page shares is deleted, in order; other hosts' lines stay."""
    shell = "<div>Menu one</div><div>{}</div><div>Imprint</div>"
    pages = [(i, f"http://h.org/a/{i}?q=1", shell.format(f"own {i}")) for i in range(4)] + [(9, "http://other.org/a/1", shell.format("own 9"))]
    found = {r.page_id: r.text for r in html.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert found == {i: f"own {i}" for i in range(4)} | {9: "Menu one\nown 9\nImprint"}


def test_neighbours_don_t_depend_on_partitions(spark):
    rows = [(f"h{i % 3}", f"/p/{i * 7 % 40:03d}/{i}", i) for i in range(60)]
    df = spark.createDataFrame(rows, "_host string, _path string, _row long")
    got = {r._row: r._partner for r in html.neighbours(df.repartition(7)).collect()}
    ordered = sorted(rows)
    for at, (host, path, row) in enumerate(ordered):
        near = [ordered[j] for j in (at - 1, at + 1) if 0 <= j < len(rows) and ordered[j][0] == host]
        assert got[row] == max(near, key=lambda x: (html._common(path, x[1]), x < (host, path, row)))[2]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=12))
def test_longest_common_lines(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    shared = html.shared_lines(a, b)
    rest = iter(b)
    assert len(shared) == table[-1][-1] and shared == sorted(set(shared)) and all(a[i] in rest for i in shared)


def test_lm_base_and_total(spark, texts):
    rows = {r.doc_id: r for r in QUERIES["op5_lm_scoring"](spark, SF).collect()}
    tokens = {i: words((r.text or "").translate(LOW)) for i, r in texts.items()}
    learnt = [i for i in texts if zlib.crc32(str(i).encode()) % 10]
    counts = Counter(w for i in learnt for w in tokens[i])
    n, v = sum(counts.values()) + len(learnt), len(counts) + 1
    for i, found in rows.items():
        each = [math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens[i]]
        assert math.isclose(found.base_score, sum(each) + math.log10((len(learnt) + 0.1) / (n + 0.1 * (v + 1))), rel_tol=1e-9)
        assert found.n_tokens == len(each) + 1 and found.n_known == sum(counts[w] > 0 for w in tokens[i]) + 1 and found.train_tokens == n
        assert found.held_out == (i not in set(learnt))
    bits = -sum(r.score for r in rows.values() if r.held_out) / math.log10(2)
    assert bits < 4 * sum(len(texts[i].text.encode()) for i, r in rows.items() if r.held_out)


def test_lm_byte_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 5, (1 << lm.SLOT_BITS, 2)).astype(np.float32)
    refined = rng.uniform(0.1, 0.9, 256 * lm.ODDS_BINS)
    weights = rng.uniform(0, 1, (256, lm.ORDERS))
    keys = (np.uint64(0x61626364) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
    assert math.isclose((2.0 ** -lm.byte_costs(keys, counts, weights, refined)).sum(), 1, rel_tol=1e-9)


def test_lm_grams():
    piece = next(slices(pa.array(["Ab", "", "c"])))
    keys, begin = lm._grams(piece)
    assert begin.tolist() == [0, 3, 4, 6]
    assert [f"{k:010x}" for k in keys.tolist()] == ["ffffffff61", "ffffff6162", "ffff6162ff", "ffffffffff", "ffffffff63", "ffffff63ff"]


def test_mix_meets_targets(spark, texts):
    rows = QUERIES["op6_mix_sources"](spark, SF).collect()
    size, taken = Counter(), Counter()
    for r in rows:
        assert r["size"] == len(words(texts[r.doc_id].text)) and r.taken <= 3 * r["size"]
        size[texts[r.doc_id].source] += r["size"]
        taken[texts[r.doc_id].source] += r.taken
    weight = {s: i % 3 + 1 for i, s in enumerate(sorted(size))}
    full: set = set()
    while True:
        left = sum(size.values()) - sum(3 * size[s] for s in full)
        share = {s: 3 * size[s] if s in full else left * weight[s] / sum(w for t, w in weight.items() if t not in full) for s in size}
        more = {s for s in size if s not in full and share[s] > 3 * size[s]}
        if not more:
            break
        full |= more
    for r in rows:
        assert math.isclose(r.target, share[texts[r.doc_id].source]) and r.source_size == size[texts[r.doc_id].source]
    assert all(abs(taken[s] - share[s]) <= 0.05 * share[s] for s in size)
    again = {r.doc_id: r.taken for r in QUERIES["op6_mix_sources"](spark, SF).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_mix_stops_at_three_copies(spark):
    from headway.llm.mixing import mix

    sizes = {"a": 10, "b": 900, "c": 20, None: 300}
    df = spark.createDataFrame([(i, "w " * 10, s) for s, n in sizes.items() for i in range(n // 10)], "doc_id long, text string, source string")
    got = {r.source: (r.target, r.taken) for r in mix(df, keep=["source"]).groupBy("source").agg({"target": "max", "taken": "sum"}).toDF("source", "target", "taken").collect()}
    assert got["a"] == (30, 30) and got["c"] == (60, 60)
    assert math.isclose(got["b"][0], 1140 * 2 / 3) and math.isclose(got[None][0], 1140 / 3)
    assert all(abs(t - k) <= 10 for t, k in got.values())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=12))
def test_best_chain(links):
    left, right = [a for a, _ in links], [b for _, b in links]
    found = passages.chains(left, right)
    assert sorted(i for c in found for i in c) == list(range(len(links)))
    best = {}
    for i in sorted(range(len(links)), key=lambda i: links[i]):
        best[i] = passages.GAIN + max([0] + [best[j] - passages.GAP * (left[i] - left[j] + right[i] - right[j]) for j in best if left[j] < left[i] and right[j] < right[i]])
    chain = found[0]
    score = passages.GAIN * len(chain) - sum(passages.GAP * (left[b] - left[a] + right[b] - right[a]) for a, b in zip(chain, chain[1:], strict=False))
    assert all(left[a] < left[b] and right[a] < right[b] for a, b in zip(chain, chain[1:], strict=False))
    assert math.isclose(score, max(best.values()))


def test_passages_are_found(spark):
    """Exact and edited passages planted in other texts; texts of their own aren't listed."""
    rng, rows, planted = random.Random(4), [], set()
    shared = [prose(1000 + i, 80).split() for i in range(4)]
    for i in range(60):
        text = prose(i, 150).split()
        if i % 3:
            passage = list(shared[i % 4])
            if i % 2:
                for at in range(7, 80, 13):
                    passage[at] = f"edit{i}"
            at = rng.randrange(len(text))
            text[at:at] = passage
            planted.add(i)
        rows.append((i, " ".join(text)))
    found = passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x for r in found for x in (r.doc_id, r.kept_id)} == planted
    text = dict(rows)
    for r in found:
        mine, kept = text[r.doc_id].split()[r.begin : r.end], text[r.kept_id].split()[r.kept_begin : r.kept_end]
        assert 50 <= min(len(mine), len(kept)) <= 90 and r.n_same >= 0.8 * max(len(mine), len(kept))


@pytest.mark.parametrize("size, gap", [(60, 40), (60, 80), (80, 80), (80, 120)])
def test_two_passages_of_a_pair(spark, size, gap):
    """Two verbatim passages in the same order, with other words between them, are both found whole, as by all diagonals."""
    rows, want = [], []
    for i in range(20):
        one, two = prose(50_000 + i, size), prose(60_000 + i, size)
        for side, more in ((0, 0), (1, 7 * (i % 2))):
            rows.append((2 * i + side, f"{prose(70_000 + 2 * i + side, 30)} {one} {prose(80_000 + 2 * i + side, gap + more)} {two} {prose(90_000 + 2 * i + side, 30)}"))
        a, b = (words(rows[-2 + side][1]) for side in (0, 1))
        for shift in range(-len(a) + 1, len(b)):
            run = 0
            for at in range(max(0, -shift), min(len(a), len(b) - shift) + 1):
                if at < min(len(a), len(b) - shift) and a[at] == b[at + shift]:
                    run += 1
                    continue
                if run >= passages.MIN_WORDS:
                    want.append({2 * i: (at - run, at), 2 * i + 1: (at - run + shift, at + shift)})
                run = 0
    found = passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = [({r.doc_id: (r.begin, r.end), r.kept_id: (r.kept_begin, r.kept_end)}, r.n_same) for r in found]
    assert len(got) == len(want) == 40 and all(n >= 0.8 * max(e - b for b, e in g.values()) for g, n in got)
    for w in want:
        assert sum(g.keys() == w.keys() and all(g[k][0] <= w[k][0] and w[k][1] <= g[k][1] for k in w) for g, _ in got) == 1


def test_edited_passages_at_the_limit(spark):
    """Passages with every fifth, sixth or eighth word changed are found wherever word by word comparison says eight tenths."""
    rows, want = [], set()
    for i, (size, every) in enumerate([(50, 6), (50, 8), (80, 5), (80, 6), (80, 8)] * 10):
        one, two = prose(40_000 + i, size).split(), prose(40_000 + i, size).split()
        two[every - 1 :: every] = [f"edit{i}x{j}" for j in range(every - 1, size, every)]
        same = [x == y for x, y in zip(one, two, strict=True)]
        n = max(k + 1 for k in range(size) if same[k])
        if n >= passages.MIN_WORDS and sum(same) >= passages.SIMILAR * n:
            want.add(frozenset((2 * i, 2 * i + 1)))
        rows += [(2 * i + k, f"{prose(41_000 + 2 * i + k, 60)} {' '.join(w)} {prose(42_000 + 2 * i + k, 60)}") for k, w in enumerate((one, two))]
    found = passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {frozenset((r.doc_id, r.kept_id)) for r in found} == want and len(want) == 50


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=8))
def test_longest_alike(runs):
    """The longest range of matches that is a passage is among those found, and they are disjoint passages."""
    pairs, x, y = [], 0, 0
    for n, more, also in runs:
        pairs += [(x + k, y + k) for k in range(n)]
        x, y = x + n + more, y + n + also
    m = np.array(pairs)

    def passage(begin, end):
        size = [pairs[end - 1][k] + 1 - pairs[begin][k] for k in (0, 1)]
        return min(size) >= passages.MIN_WORDS and end - begin >= passages.SIMILAR * max(size)

    every = [(b, e) for b in range(len(pairs)) for e in range(b + 1, len(pairs) + 1) if passage(b, e)]
    found = passages.alike(m)
    assert all(passage(b, e) for b, e in found) and all(p[1] <= q[0] for p, q in zip(found, found[1:], strict=False))
    assert max((e - b for b, e in found), default=0) == max((e - b for b, e in every), default=0)


def test_bins_hold_their_edges(spark):
    from pyspark.sql import functions as F

    df = spark.range(0, 5000).withColumn("bin", quality.bin_of(F.col("id"))).select("id", "bin", quality.bin_edge(F.col("bin"), False).alias("low"), quality.bin_edge(F.col("bin"), True).alias("high"))
    rows = df.collect()
    assert all(r.low <= r.id <= r.high and r.high - r.low <= r.low / 8 for r in rows)
    assert all(a.bin in (b.bin, b.bin - 1) for a, b in zip(rows, rows[1:], strict=False))


def test_pipeline_against_plain_stages(spark, texts):
    """The filters by the queries' own SQL-tested results and all pairs; the mix and the shards by their laws."""
    from headway.llm import stages
    from headway.llm.common import written

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = written(stages.quality_rules(spark, docs, SF), "t")
    verdict = {r.doc_id for r in QUERIES["op10_quality_rules"](spark, SF).collect() if r.kept}
    assert {r.doc_id for r in kept.collect()} == verdict
    unique = written(stages.near_duplicates(spark, kept, SF), "t")
    sets = {}
    for i in verdict:
        w = words(texts[i].text.translate(LOW))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))}
    order, least = sorted(verdict), {}
    for i in order:
        least[i] = {i}
        for j in order:
            same = len(sets[i] & sets[j])
            if j < i and 5 * same >= 4 * (len(sets[i]) + len(sets[j]) - same):
                merged = least[i] | least[j]
                for k in merged:
                    least[k] = merged
    assert {r.doc_id for r in unique.collect()} == {min(g) for g in least.values()}
    clean = written(stages.decontaminate(spark, unique, SF), "t")
    dirty = {r.doc_id for r in QUERIES["op7_benchmark_decontamination"](spark, SF).collect() if r.contaminated}
    assert {r.doc_id for r in clean.collect()} == {min(g) for g in least.values()} - dirty
    mixed = written(stages.mix_sources(spark, clean, SF), "t")
    copies = Counter(r.doc_id for r in mixed.collect())
    assert max(copies.values()) <= 3 and mixed.columns == docs.columns
    placed = stages.shard(spark, mixed, SF).collect()
    sizes = Counter(r.shard for r in placed)
    assert Counter(r.doc_id for r in placed) == copies and max(sizes.values()) - min(sizes.values()) <= 1
