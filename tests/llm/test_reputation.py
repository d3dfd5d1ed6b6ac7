"""Rules and host reputations against a plain version, and odd addresses."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from headway.llm import reputation
from headway.llm.queries import URL_RULES


def plain_reputations(outcomes):
    """host -> (mean, bound) of (host, bad) pairs whose hosts have three labels or two."""
    n, bad = Counter(h for h, b in outcomes if b is not None), Counter(h for h, b in outcomes if b == 1)
    hosts = {h for h, _ in outcomes}
    up = {"host": {h: ".".join(h.split(".")[-2:]) for h in hosts}}
    up["domain"] = {d: d.split(".")[-1] for d in up["host"].values()}
    up["suffix"] = {s: "" for s in up["domain"].values()}
    mean, size = {"": (sum(bad.values()) + 1) / (sum(n.values()) + 2)}, {"": sum(n.values()) + 2}
    out = {}
    for level in ("suffix", "domain", "host"):
        total, worse = defaultdict(int), defaultdict(int)
        for h in hosts:
            node = {"host": h, "domain": up["host"][h], "suffix": up["domain"][up["host"][h]]}[level]
            total[node] += n[h]
            worse[node] += bad[h]
        prior, strength = {x: mean[up[level][x]] for x in total}, {x: size[up[level][x]] for x in total}
        full = [x for x in total if total[x]]
        miss = sum(total[x] * (worse[x] / total[x] - prior[x]) ** 2 / (prior[x] * (1 - prior[x])) for x in full)
        below = sum(total[x] for x in full) - len(full)
        rho = min(max((miss - len(full)) / below if below else 0.0, 0.001), 0.5)
        mean, size = {}, {}
        for x in total:
            worth = min(1 / rho - 1, strength[x])
            a, b = worth * prior[x] + worse[x], worth * (1 - prior[x]) + total[x] - worse[x]
            mean[x], size[x] = a / (a + b), a + b
            out[x] = (mean[x], mean[x] - 19**0.5 * (a * b / ((a + b) ** 2 * (a + b + 1))) ** 0.5)
    return {h: out[h] for h in hosts}


def test_reputations_equal_plain_version(spark):
    rng = random.Random(5)
    outcomes = []
    for suffix in ("aa", "bb"):
        for d in range(5):
            for h in range(4):
                rate = rng.random() ** 2
                rows = rng.choice([0, 1, 5, 60, 400])
                outcomes += [(f"h{h}.d{d}.{suffix}", int(rng.random() < rate)) for _ in range(rows)] + [(f"h{h}.d{d}.{suffix}", None)]
    found = {r.host: (r["mean"], r.bound) for r in reputation.reputations(spark.createDataFrame(outcomes, "host string, bad int")).collect()}
    want = plain_reputations(outcomes)
    assert found.keys() == want.keys()
    for host, (mean, bound) in want.items():
        assert found[host] == pytest.approx((mean, bound))


def test_bad_hosts_are_blocked_and_little_seen_ones_follow_their_domain(spark):
    pages = [(i, f"http://bad.one.xx/de/{i}") for i in range(300)] + [(1000 + i, f"http://good.two.xx/fr/{i}") for i in range(300)]
    pages += [(5000, "http://bad.one.xx/en/1"), (5001, "http://good.two.xx/en/1"), (5002, "http://new.one.xx/"), (5003, "http://www.new.three.yy")]
    labelled = spark.createDataFrame([("http://bad.one.xx/z", 1)] * 5 + [("HTTP://GOOD.TWO.XX", 0), (None, 1)], "url string, bad int")
    rules = [("block", "xx/de/"), ("allow", "xx/fr/")]
    found = {r.page_id: r for r in reputation.url_filter(spark.createDataFrame(pages, "page_id long, url string"), rules, labelled).collect()}
    assert {found[i].verdict for i in range(300)} == {"block"} and {found[1000 + i].verdict for i in range(300)} == {"allow"}
    assert (found[5000].verdict, found[5000].rule) == ("block", None)
    assert found[5001].verdict == "allow" and found[5003].verdict == "allow"
    assert found[5000].bad_rate > found[5002].bad_rate > found[5003].bad_rate > found[5001].bad_rate


def test_odd_addresses_and_longest_rules(spark):
    urls = [
        (1, None), (2, ""), (3, "no scheme/org/"), (4, "://"), (5, "HTTP://Www.Example.ORG/es/x?y#z"), (6, "https://example.org/en/1#a"),
        (7, "https://example.org?en/1"), (8, "x://notexample.org/es/1"), (9, "http://org/"), (10, "http://org"), (11, "a://b://c.com/de/"),
        (12, "http://user@shop.co.uk:80/p"), (13, "http://10.0.0.1/de/"), (14, "http://sub.fr.com/fr/é\U0001f600"), (None, "http://a.com/de/" + "x" * 50_000), (1, None),
    ]
    df = spark.createDataFrame(urls, "page_id long, url string").selectExpr("*", "1 AS host", "2 AS _row", "3 AS blocks", "4 AS bound", "5 AS rule")
    rows = reputation.url_filter(df, URL_RULES).collect()
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert len(rows) == 16 and found[1] == ("", "", None, "allow") == found[2] == found[3]
    assert found[4] == ("", "", None, "allow")
    assert found[5] == ("www.example.org", "/es/x", "example.org/es/", "block")
    assert found[6] == ("example.org", "/en/1", "example.org/en/1", "block")
    assert found[7] == ("example.org", "", None, "allow") and found[8] == ("notexample.org", "/es/1", "org/", "allow")
    assert found[9] == ("org", "/", "org/", "allow") and found[10][:3] == ("org", "", None)
    assert found[11][:2] == ("b:", "//c.com/de/") and found[12][:2] == ("user@shop.co.uk:80", "/p")
    assert found[13][:2] == ("10.0.0.1", "/de/") and found[14] == ("sub.fr.com", "/fr/é\U0001f600", "com/fr/", "allow")
    assert len(found[None][1]) == 50_004 and found[None][2:] == ("com/de/", "block")
    assert reputation.url_filter(df.limit(0), URL_RULES).count() == 0
    assert {r.rule for r in reputation.url_filter(df, []).collect()} == {None}


def test_domains(spark):
    names = [("user@a.shop.co.uk:80",), ("a.b.c",), ("co.uk",), ("localhost",), ("10.0.0.1",), ("[::1]:8080",), ("",)]
    domain, suffix = reputation.domain_suffix("h")
    found = [tuple(r) for r in spark.createDataFrame(names, "h string").select(domain, suffix).collect()]
    assert found == [("shop.co.uk", "co.uk"), ("b.c", "c"), ("co.uk", "co.uk"), ("localhost", "localhost"), ("10.0.0.1", ""), ("[::1]", ""), ("", "")]
