"""Main texts of pages: hints by names, teasers, comments, and whole pages against plain versions."""

import html as entities
import re

import pytest

from headway.llm import html
from headway.llm.queries import QUERIES

from .conftest import SF


def texts_of(page):
    return [text for text, _ in html.blocks_of(page)]


def extracted(spark, pages):
    return {r.page_id: r.text for r in html.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}


def test_a_teaser_is_no_main_text():
    page = "<body><article><p>teaser card</p></article><div>The page's own text, which is longer.</div><div>And more of it.</div></body>"
    assert texts_of(page) == ["teaser card", "The page's own text, which is longer.", "And more of it."]
    assert texts_of(page.replace("teaser card", "an article that is the longer part of the page, whatever stands beside it")) == [
        "an article that is the longer part of the page, whatever stands beside it"
    ]


@pytest.mark.parametrize("mark", ['class="comment"', 'class="comment even depth-1"', "id='comment-17'", 'class="user-comments"'])
def test_comments_in_articles(mark):
    comment = f"<article {mark}><p>first!</p></article>"
    assert texts_of(f"<article><p>body</p></article>{comment}") == ["body"]
    assert texts_of(f"<main><article><p>body</p></article>{comment}</main>") == ["body"]
    assert texts_of(f"<article><p>body</p>{comment}<p>end</p></article>") == ["body", "end"]


def test_lower_case_that_is_longer():
    page = "<article><p>%s</p><SCRIPT>x</p></Script><p>second</p><style>y</STYLE><p>third</p></article>" % ("İ" * 60)
    assert texts_of(page) == ["İ" * 60, "second", "third"]
    assert texts_of("<!--" + "İ" * 40 + "--><nav><li>menu<article><p>body</p></article>") == ["body"]


@pytest.mark.parametrize("name", ['class="social-history"', 'class="tracking-shot"', 'id="search-for-truth"', 'class="shared-values"', 'class="banners-of-war"'])
def test_names_that_only_hold_a_word_of_furniture(name):
    assert texts_of(f"<article><p>one</p><div {name}><p>two</p></div></article>") == ["one", "two"]
    assert texts_of(f"<article {name}><p>one</p></article>") == ["one"]


@pytest.mark.parametrize("name", ["ad", "ad-300x250", "adBox", "cookie-notice", "cookieConsentBar", "nav__item", "related-posts", "newsletter_signup_form", "widget-area", "comment-list"])
def test_names_of_furniture(name):
    assert texts_of(f"<article><p>one</p><div class='x {name}'><p>two</p></div></article>") == ["one"]
    assert texts_of(f"<div>one</div><div id='{name}'>two</div>") == ["one"]


def test_differencing_decides_on_hinted_elements(spark):
    """Inside the article an element with such a name goes if the nearest page has its lines, and stays if not."""
    page = "<article><p>own {0}</p><section class='promo-autumn'><p>Half price until Sunday</p><p>offer {0}</p></section><p>quoted</p></article>"
    pages = [(i, f"http://h.org/a/{i}", page.format(i)) for i in range(3)] + [(9, "http://alone.org/", page.format(9))]
    assert extracted(spark, pages) == {i: f"own {i}\noffer {i}\nquoted" for i in range(3)} | {9: "own 9\nHalf price until Sunday\noffer 9\nquoted"}


def test_whole_pages_without_articles(spark):
    """Given texts in shells of lines: against pairing in a loop and a table of common subsequences."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) BETWEEN 1 AND 6000").orderBy("doc_id").limit(60).collect()
    shells = [f"Menu of {h} {i}" for h in range(4) for i in range(5)]
    pages, lines = [], {}
    for at, r in enumerate(docs):
        host = at % 4
        own = [" ".join(line.split()) for line in re.split("[.\n]", r.text) if line.split()]
        top = [s for i, s in enumerate(shells[5 * host : 5 * host + 5]) if at // 4 % 5 != i]
        lines[at] = top[:2] + own + top[2:]
        path = f"/{'ab'[at % 8 // 4]}/{at * 37 % 60:02d}"
        pages.append((at, f"http://h{host}.org{path}", "".join(f"<div>{entities.escape(x)}</div>" for x in lines[at])))

    def common(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                table[i][j] = table[i + 1][j + 1] + 1 if a[i] == b[j] else max(table[i + 1][j], table[i][j + 1])
        return table[0][0]

    found = extracted(spark, pages)
    for host in range(4):
        order = sorted((url.split(".org")[1], at) for at, url, _ in pages if at % 4 == host)
        for place, (path, at) in enumerate(order):
            near = [order[j] for j in (place - 1, place + 1) if 0 <= j < len(order)]
            _, other = max(near, key=lambda x: (html._common(path, x[0]), x < (path, at)))
            mine, kept = lines[at], found[at].split("\n")
            shared = common(mine, lines[other])
            if shared == len(mine):
                assert kept == mine
            else:
                # What stays, with a longest common subsequence, is the page; lines of one page only all stay, in order.
                assert len(kept) == len(mine) - shared and common(mine, kept) == len(kept)
                assert [x for x in kept if x not in lines[other]] == [x for x in mine if x not in lines[other]]


def test_whole_given_pages(spark):
    """Every given page has one article without furniture in it: its text is what a few replacements make of it."""
    blocks = r"</?(?:p|h\d|ul|li|div|article|section|blockquote)\b[^>]*>"
    given = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op4_html_extraction"](spark, SF).collect()
    assert sorted(r.page_id for r in rows) == sorted(given)
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", given[r.page_id].html, re.S)[1]
        assert not re.search(r"<(?!/?(?:p|b|i|a|br|h\d|em|strong|ul|li)\b)[a-z]", inner)
        pieces = (re.sub(r"<[^>]*>", "", re.sub(r"<br\s*/?>", " ", piece)) for piece in re.split(blocks, inner))
        expected = "\n".join(t for t in (" ".join(entities.unescape(piece).split()) for piece in pieces) if t)
        assert (r.text, r.n_chars, r.url) == (expected, len(expected), given[r.page_id].url)
