"""Main text of web pages by their differences from the page nearest in URL.

A page is cut into blocks of text; blocks inside menus, headers, footers, sidebars, notices,
adverts, forms, comments and code are no text, by the tags and names that enclose them. Pages
of a host are sorted by URL path; each is paired with the neighbour whose path shares the
longest beginning, the earlier of equals. The blocks of a pair are aligned by longest common
subsequence and the shared ones are deleted, being the host's furniture.

Not every shared block is that: copies and quotations lie in articles of one host too. So a
block of prose inside an element that the page itself marks as its article stays; shared
blocks go where the page marks none, where a block is mostly links, and where the name of an
enclosing element only hints at furniture (``promo-autumn``). A page that shares all it has
keeps it. If the marked article holds half of the page's prose or more, what lies outside is
not part of it; with less it is taken for a teaser, and the page for one that marks none.

A name tells furniture if all its parts are such words or words of layout (``nav-bar``,
``cookieNotice``), and hints at it if only some are (``social-history``).

Defined cases: null and empty pages give an empty text; a null url is of the empty host; equal
urls and repeated rows are neighbours and may be paired; a page alone on its host has nothing
deleted; open elements end where a page is cut off; no pages give no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import batches, written

# Elements by role, and words in class, id or role attributes that tell furniture.
RAW = "script style noscript template svg math iframe object embed canvas audio video head textarea".split()
FURNITURE = "nav footer aside form button select datalist dialog menu label input legend fieldset header".split()
BLOCKS = (
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section summary table tbody tfoot thead tr ul"
).split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
TOLD = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner billboard nav navbar navigation menu submenu "
    "breadcrumb breadcrumbs sidebar sidebars widget widgets footer masthead topbar toolbar header cookie cookies consent notice notices gdpr "
    "popup modal overlay subscribe subscription newsletter signup login share sharing social comment comments reply replies respond disqus "
    "related recommended recommendations pagination pager skip search searchbox copyright disclaimer alert tracking".split()
)
LAYOUT = set(
    "area areas author authors bar bars body block blocks bottom box boxes button buttons card cards col collapse column container content "
    "count date desktop entry feed fixed floating form global group header heading icon icons image images info inner inline item items label "
    "large left level line link links list lists main meta mobile module news outer page pages panel post posts primary region right row "
    "secondary section single site slot small stack sticky stories story strip tab tabs tag tags text thread title top unit user users view "
    "wrap wrapper zone active article articles".split()
)
COMMENTING = {"comment", "comments", "reply", "replies", "respond", "disqus"}
STATES = ("has-", "no-", "with-", "is-", "js-")
TOLD_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
MOSTLY_LINKS = 0.5

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(?P<raw>%s)\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|"""
    r"""<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?[a-z][^<]*\Z|[^<]++|<""" % "|".join(RAW),
    re.S | re.I | re.A,
)
_ATTR = re.compile(r"""\b(class|id|role|itemprop|hidden|style|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I | re.A)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_ENDS = {tag: re.compile(rf"</{tag}\b[^>]*>?", re.I | re.A) for tag in RAW}

# What the name of an element says of its being furniture.
NOTHING, HINTED, SURE = 0, 1, 2

_LINE = pa.struct([("text", pa.string()), ("open", pa.bool_())])


def _named(name: str, tag: str, told: set[str]) -> int:
    """What one class name or id says; of an article only whole words and comments are sure."""
    if name.lower().startswith(STATES):
        return NOTHING
    parts = {part.lower() for part in _NAME.findall(name)}
    if not parts & told:
        return NOTHING
    if tag == "article" and len(parts) > 1 and not parts & COMMENTING:
        return HINTED
    return SURE if all(part in told or part in LAYOUT or len(part) == 1 for part in parts) else HINTED


def _told(tag: str, attrs: str, in_article: bool) -> tuple[int, bool]:
    """What says that an element is furniture, and whether it is marked as the page's main text."""
    main, sure = tag in ("article", "main"), tag in FURNITURE and not (tag == "header" and in_article)
    hinted = False
    if attrs:
        for name, value in _ATTR.findall(attrs):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id"):
                if tag not in ("main", "body", "html"):
                    found = max((_named(part, tag, TOLD - {"header"} if in_article else TOLD) for part in value.split()), default=NOTHING)
                    sure |= found == SURE
                    hinted |= found == HINTED
                continue
            value = value.lower()
            if name == "role":
                sure |= value in TOLD_ROLES
                main |= value in ("main", "article")
            elif name == "itemprop":
                main |= value == "articlebody"
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
                sure = True
    return SURE if sure else HINTED if hinted else NOTHING, main and not sure


def blocks_of(page: str) -> list[tuple[str, bool]]:
    """The blocks outside furniture, in order, and whether sharing deletes them (open)."""
    found: list[tuple[str, bool, bool, bool]] = []  # text, marked, of links, hinted
    stack: list[tuple[str, int, bool]] = []  # tag, furniture, main
    parts: list[str] = []
    linked, links, furniture, hinted, main = 0, 0, 0, 0, 0

    def close() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text and not furniture:
            found.append((text, bool(main), linked > MOSTLY_LINKS * len(text), bool(hinted)))
        parts.clear()
        linked = 0

    def pop() -> None:
        nonlocal furniture, hinted, main, links
        tag, told, was_main = stack.pop()
        if tag in BLOCKS:
            close()
        furniture, hinted, main, links = furniture - (told == SURE), hinted - (told == HINTED), main - was_main, links - (tag == "a")

    def ends(tag: str) -> bool:
        return re.compile(rf"</{re.escape(tag)}", re.I | re.A).search(page, at) is not None

    at = 0
    while at < len(page):
        token = _TOKEN.match(page, at)
        at = token.end()
        if token["raw"]:
            tag = token["raw"].lower()
            if not token[0].endswith("/>"):
                end = _ENDS[tag].search(page, at)
                at = end.end() if end else (len(page) if tag != "head" else at)
            parts.append(" ")
        elif token["tag"]:
            tag = token["tag"].lower()
            if token["end"]:
                if any(open_tag == tag for open_tag, _, _ in stack):
                    while stack[-1][0] != tag:
                        pop()
                    pop()
                elif tag in BLOCKS:
                    close()
                continue
            if tag in BLOCKS:
                close()
                if tag in ("article", "main"):  # an element that is never closed ends here
                    while any(told == SURE and not ends(t) for t, told, _ in stack):
                        pop()
                if stack and any(t == "p" for t, _, _ in stack[-4:]) and tag not in ("tr",):
                    while any(t == "p" for t, _, _ in stack[-4:]):
                        pop()
            if tag in CLOSED_BY:
                for depth in range(1, min(4, len(stack)) + 1):
                    if stack[-depth][0] in CLOSED_BY[tag]:
                        for _ in range(depth):
                            pop()
                        break
            if tag in VOID or token["attrs"].endswith("/") and tag not in BLOCKS:
                parts.append(" " if tag in ("br", "hr", "img", "wbr") else "")
                continue
            told, is_main = _told(tag, token["attrs"], main > 0)
            if told == SURE and tag not in BLOCKS and parts and not furniture:
                close()  # what stands before it in the same block isn't part of it
            stack.append((tag, told, is_main))
            furniture, hinted, main, links = furniture + (told == SURE), hinted + (told == HINTED), main + is_main, links + (tag == "a")
            if tag in ("td", "th"):
                parts.append(" ")
        elif token[0][0] != "<" or token[0] == "<":
            if not furniture:
                parts.append(token[0])
                linked += len(token[0]) if links else 0
    close()
    inside = sum(len(text) for text, marked, linky, _ in found if marked and not linky)
    outside = sum(len(text) for text, marked, linky, _ in found if not marked and not linky)
    if inside >= outside and any(marked for _, marked, _, _ in found):
        return [(text, linky or hint) for text, marked, linky, hint in found if marked]
    return [(text, True) for text, _, _, _ in found]


def shared_lines(mine: list[int], other: list[int]) -> list[int]:
    """Indices of my lines in a longest common subsequence, by bits of whole rows at once."""
    both = set(mine) & set(other)
    rows = [i for i, line in enumerate(mine) if line in both]
    columns = [line for line in other if line in both]
    if not rows:
        return []
    masks: dict[int, int] = {}
    for j, line in enumerate(columns):
        masks[line] = masks.get(line, 0) | 1 << j
    full = (1 << len(columns)) - 1
    state, states = full, []
    for i in rows:
        hits = state & masks[mine[i]]
        state = ((state + hits) | (state - hits)) & full
        states.append(state)
    out, row, column = [], len(rows), len(columns)
    while row and column:
        if states[row - 1] >> (column - 1) & 1:
            column -= 1
            continue
        row -= 1
        if row and not states[row - 1] >> (column - 1) & 1:
            continue
        column -= 1
        out.append(rows[row])
    return out[::-1]


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


def neighbours(pages: DataFrame) -> DataFrame:
    """(_row, _partner) for pages with _host, _path and _row: the nearest path on the host.

    Pages are sorted by ranges, so a host may cover many partitions; the few rows at their
    edges are matched with the edge of the next partition.
    """
    order = ["_host", "_path", "_row"]
    ranged = pages.select(*order).repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    placed = written(ranged, "urls")
    here = F.struct(*order)
    inner = Window.partitionBy("_part").orderBy(*order)
    edges = placed.groupBy("_part").agg(F.min(here).alias("first"), F.max(here).alias("last"))
    outer = Window.partitionBy(F.lit(0)).orderBy("_part")  # one row a partition
    edges = edges.select("_part", F.lag("last").over(outer).alias("_left"), F.lead("first").over(outer).alias("_right"))
    near = placed.withColumn("_before", F.lag(here).over(inner)).withColumn("_after", F.lead(here).over(inner)).join(edges, "_part", "left")
    near = near.withColumns({"_before": F.coalesce("_before", "_left"), "_after": F.coalesce("_after", "_right")})
    near = near.withColumns({c: F.when(F.col(f"{c}._host") == F.col("_host"), F.col(c)) for c in ("_before", "_after")})
    near = near.where("_before IS NOT NULL OR _after IS NOT NULL").select("_row", "_path", "_before", "_after")

    def choose(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches(blocks, 10_000):
            partners = []
            for row in block.to_pylist():
                left, right = row["_before"], row["_after"]
                if left is None or right is None:
                    partners.append((left or right)["_row"])
                else:
                    partners.append(left["_row"] if _common(row["_path"], left["_path"]) >= _common(row["_path"], right["_path"]) else right["_row"])
            yield pa.RecordBatch.from_arrays([block.column("_row"), pa.array(partners, pa.int64())], names=["_row", "_partner"])

    return near.mapInArrow(choose, "_row long, _partner long")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row a page: id, url, main text and its length in code points."""
    place = F.coalesce(F.col(url), F.lit(""))
    base = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//"
    picked = pages.select(
        F.struct(F.col(page_id).alias("id"), F.col(url).alias("url")).alias("_key"),
        F.lower(F.regexp_extract(place, base + r"([^/?#]*)", 1)).alias("_host"),
        F.regexp_extract(F.regexp_replace(place, base + r"[^/?#]*", ""), r"^[^?#]*", 0).alias("_path"),
        F.col(page).alias("_page"),
    )

    def parse(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches(blocks, 256):
            lines = [[{"text": t, "open": o} for t, o in blocks_of(p or "")] for p in block.column("_page").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in ("_key", "_host", "_path")), pa.array(lines, pa.list_(_LINE))], names=["_key", "_host", "_path", "lines"])

    kind = picked.schema["_key"].dataType.simpleString()
    parsed = picked.mapInArrow(parse, f"_key {kind}, _host string, _path string, lines array<struct<text: string, open: boolean>>")
    parsed = written(parsed.withColumn("_row", F.monotonically_increasing_id()).withColumn("_open", F.exists("lines", lambda x: x["open"])), "blocks", "zstd")

    # Only pages with blocks that sharing may delete are compared and joined; lines are compared as hashes.
    pairs = neighbours(parsed)
    hashed = parsed.select("_row", F.transform("lines", lambda x: F.xxhash64(x["text"])).alias("marks"))
    mine = parsed.where("_open").select("_row").join(pairs, "_row").join(hashed, "_row")
    both = mine.join(hashed.select(F.col("_row").alias("_partner"), F.col("marks").alias("others")), "_partner").select("_row", "marks", "others")

    def align(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches(blocks):
            found = [shared_lines(a, b) for a, b in zip(block.column("marks").to_pylist(), block.column("others").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([block.column("_row"), pa.array(found, pa.list_(pa.int32()))], names=["_row", "shared"])

    shared = both.mapInArrow(align, "_row long, shared array<int>").where("size(shared) > 0")
    def joined_text(lines):
        return F.array_join(F.transform(lines, lambda x: x["text"]), "\n").alias("text")

    keys = [F.col("_key.id").alias(page_id), F.col("_key.url").alias(url)]
    plain = parsed.where("NOT _open").select(*keys, joined_text(F.col("lines")))
    joined = parsed.where("_open").join(shared, "_row", "left")
    kept = F.when(F.col("shared").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x, i: ~(x["open"] & F.array_contains("shared", i))))
    differing = joined.select(*keys, joined_text(F.when(F.size(kept) > 0, kept).otherwise(F.col("lines"))))
    return plain.unionByName(differing).withColumn("n_chars", F.length("text").cast("long"))
