"""Fuzzy passages shared across documents: seeds, collinear chains, alignment.

Seeds are the grams of four words (A-Z lowered) whose hash is even: a passage of which eight tenths
agree word by word has runs of four and more that do, at worst ten of four words in fifty, and of ten
grams one is a seed but for one time in a thousand. Grams of five words, the least hash of
every sixteen in a row, are seeds too: short grams are common, and a document that has one by
chance may come before the one that shares a passage. Every occurrence of a seed is linked to the least
document that has it, and copies of a text to their least document, place by place; the different texts of
a seed that at most RARE of them have are all linked with each other. Seeds of more texts are common: of those,
each makes pairs with the next NEXT in its document, NEAR to FAR words on, and the pairs are linked as seeds
are, with each other where at most RARE_PAIR texts have one. So links grow with the words, not with the square of
a passage's copies, and two texts whose seeds other documents have first are compared all the same; not compared, but for
their least documents, are two that share only pairs which more than RARE_PAIR texts have, or common seeds with others between them in one
text only. Of a batch, a mark's first texts go on, one more than are rare, as twelve bytes a seed, to the task that has all of a
hash range; its other documents are linked in the batch. The links of a pair of documents are chained in both texts' order, a gap costing in
proportion to its length; the best predecessor comes from a Fenwick tree of prefix maxima. Chains are then
aligned word by word, if their seeds reach over nine words, which those of fifty words with every fifth
changed miss once in a hundred and nearly all others never: along a diagonal between seeds, by edit steps where the diagonal shifts,
and outwards from both ends until mismatches have outweighed matches; between two seeds with too many words
for edit steps only what follows and precedes the seeds is compared. Passages of fifty words and more of
which eight tenths agree are returned; a chain that bridges words that don't agree gives its
longest such passage and those before and after it. Documents that passages join, directly or through
others, are one component, named by its least id.

Defined cases: null, empty and short texts have no seeds; documents are told apart by id and
text, so repeated rows are one document, and null ids may be several; equal texts share all;
no documents give no rows; a component of null ids only is named null. Words are compared by 64-bit
hashes, of which alignment uses 32 and seeds 40; what a seed links is always aligned.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import batches, written
from headway.llm.graph import components
from headway.llm.words import LOWER, NOT_SPACE, gram_hashes, mix, same_doc, slices, word_hashes, words_of

SEED = 4
LONG_SEED = 5
WINDOW = 16
MIN_WORDS = 50
SIMILAR = 0.8
GAIN = 16
GAP = 0.25
MARGIN = 64
ROUND = 32
DROP = 12
MISS = 2
MIN_REACH = 9
# Texts that have a seed, or a pair of seeds: so many are linked with each other.
RARE, RARE_PAIR = 4, 16
NEXT = 2  # pairs that a common seed makes with those after it
NEAR, FAR = MIN_REACH - SEED, MIN_WORDS - SEED  # words from a common seed to those it makes pairs with
EDIT_CELLS = 1 << 18  # of a table of edit steps
PART_BYTES = 12 << 20  # of text, whose seeds one task gathers


def least_of(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the grams that are least in some window within a document, or in a whole short one."""
    grams = gram_hashes(hashes, LONG_SEED)
    inside = np.flatnonzero(same_doc(doc, LONG_SEED))
    if len(inside) == 0:
        return inside, grams[:0]
    owner = doc[inside]
    least, place = grams[inside].copy(), np.arange(len(inside))
    for step in (1, 2, 4, 8):
        # A window stops at its document's end, so documents of few grams have one too.
        later = (least[step:] <= least[:-step]) & (owner[place[step:]] == owner[: len(least) - step])
        reach = np.arange(len(least) - step)
        place[reach] = np.where(later, place[step:], place[reach])
        least[reach] = np.where(later, least[step:], least[reach])
    chosen = np.unique(place)
    return inside[chosen], grams[inside[chosen]]


def seeds_of(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the seeds: the short grams of even hash within a document, and the least long ones."""
    short = np.flatnonzero(same_doc(doc, SEED))
    grams = gram_hashes(hashes, SEED)[short]
    even = grams & np.uint64(1) == 0
    places, least = least_of(hashes, doc)
    return np.concatenate([short[even], places]), np.concatenate([grams[even], least]) >> np.uint64(1)


def chains(left: list[int], right: list[int]) -> list[list[int]]:
    """Disjoint chains of links, each increasing in both places, best first; as lists of link numbers."""
    order = sorted(range(len(left)), key=lambda i: (left[i], right[i]))
    ranks = sorted(set(right))
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (len(ranks) + 1)
    score, before = [0.0] * len(left), [-1] * len(left)
    waiting: list[tuple[int, int]] = []  # links at the current left place, entered when it is passed
    for i in order:
        if waiting and left[waiting[0][1]] != left[i]:
            for rank, j in waiting:
                value = (score[j] + GAP * (left[j] + right[j]), j)
                while rank <= len(ranks):
                    tree[rank] = max(tree[rank], value)
                    rank += rank & -rank
            waiting = []
        rank = bisect_left(ranks, right[i])
        best, at = (-1e18, -1), rank
        while at:
            best = max(best, tree[at])
            at -= at & -at
        joined = best[0] - GAP * (left[i] + right[i])
        score[i], before[i] = (GAIN + joined, best[1]) if joined > 0 else (GAIN, -1)
        waiting.append((rank + 1, i))
    used, out = [False] * len(left), []
    for end in sorted(range(len(left)), key=lambda i: -score[i]):
        chain, i = [], end
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def _outwards(equal: np.ndarray) -> int:
    """How far to go along a diagonal: until the score has fallen too far from its best."""
    score = np.cumsum(np.where(equal, 1, -MISS))
    fallen = np.flatnonzero(np.maximum.accumulate(np.maximum(score, 0)) - score > DROP)
    return int(fallen[0]) if len(fallen) else len(equal)


def _in_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of most words of two short runs that match in order, as rows (in a, in b)."""
    table = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    for i in range(len(a)):
        table[i + 1, 1:] = np.maximum.accumulate(np.maximum(table[i, 1:], table[i, :-1] + (b == a[i])))
    out, i, j = [], len(a), len(b)
    while table[i, j]:
        if table[i - 1, j] == table[i, j]:
            i -= 1
        elif table[i, j - 1] == table[i, j]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append((i, j))
    return np.array(out[::-1], np.int64).reshape(-1, 2)


def align(a: np.ndarray, b: np.ndarray, links: list[tuple[int, int]]) -> np.ndarray:
    """Places of the words that match around a chain's links, as rows (in a, in b) in both texts' order."""

    def along(x: int, y: int, n: int) -> np.ndarray:
        same = np.flatnonzero(a[x : x + n] == b[y : y + n])
        return np.stack([x + same, y + same], 1)

    first = links[0]
    n = min(first)
    back = _outwards((a[first[0] - n : first[0]] == b[first[1] - n : first[1]])[::-1])
    found = [along(first[0] - back, first[1] - back, back)]
    x, y = first
    diagonal = np.array([at - to for at, to in links])
    turns = np.append(np.flatnonzero(np.diff(diagonal)), len(links) - 1)  # the last link of each run on one diagonal
    i = 0
    while i < len(links):
        at, to = links[i]
        if at - x == to - y:  # also seeds that overlap the one before them, on its diagonal
            i = int(turns[np.searchsorted(turns, i)])
            at, to = links[i]
            found.append(along(x, y, at + SEED - x))
        elif at >= x and to >= y:
            if (at - x) * (to - y) <= EDIT_CELLS:
                found.append(_in_order(a[x:at], b[y:to]) + (x, y))
            else:
                n = min(at - x, to - y) // 2
                ahead, back = _outwards(a[x : x + n] == b[y : y + n]), _outwards((a[at - n : at] == b[to - n : to])[::-1])
                found += [along(x, y, ahead), along(at - back, to - back, back)]
            found.append(along(at, to, SEED))
        else:
            i += 1
            continue
        x, y, i = at + SEED, to + SEED, i + 1
    n = min(len(a) - x, len(b) - y)
    ahead = _outwards(a[x : x + n] == b[y : y + n])
    return np.concatenate([*found, along(x, y, ahead)])


def alike(matches: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint ranges [begin, end) of matches that are passages: all, or the longest and those on its both sides."""
    out, left = [], [(0, len(matches))]
    while left:
        low, high = left.pop()
        if high - low < SIMILAR * MIN_WORDS:
            continue
        part = matches[low:high]
        cut = np.flatnonzero((np.diff(part, axis=0) != 1).any(1)) + 1
        # The longest range begins and ends where a run of words does: more of a run only makes it more alike.
        begins, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(part)]])
        best = (0, 0)
        for i, begin in enumerate(begins.tolist()):
            if len(part) - begin <= best[1] - best[0]:
                break
            size = part[ends[i:] - 1] + 1 - part[begin]
            fits = np.flatnonzero((size.min(1) >= MIN_WORDS) & (ends[i:] - begin >= SIMILAR * size.max(1)))
            if len(fits) and ends[i + fits[-1]] - begin > best[1] - best[0]:
                best = (begin, int(ends[i + fits[-1]]))
        if best[1]:
            out.append((low + best[0], low + best[1]))
            left += [(low, low + best[0]), (low + best[1], high)]
    return sorted(out)


_LINK = pa.struct([("at", pa.int32()), ("to", pa.int32())])
_LINK_SQL = "struct<at: int, to: int>"


# A seed that goes on: 40 bits of its hash within its part, its document's number in the row's keys, its
# place, and how many words on its second half begins (0: it has none).
_PACKED = np.dtype([("mark", "u1", 5), ("doc", "<u2"), ("at", "<u4"), ("on", "u1")])
# A link inside a batch; the seed's mark goes with it where the seed is common.
_LOCAL = np.dtype([("doc", "<u2"), ("hub", "<u2"), ("at", "<u4"), ("to", "<u4"), ("mark", "<u4"), ("common", "u1")])


def _planes(rows: np.ndarray) -> bytes:
    """All rows' first bytes, then all second ones ...: high bytes, mostly zero, lie together and are compressed when shuffled."""
    return rows.view(np.uint8).reshape(len(rows), rows.itemsize).T.tobytes()


def _of_planes(data: bytes, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1).T.copy().view(kind).reshape(-1)


class Shared(NamedTuple):
    """Occurrences in order of (mark, document, place), what each goes back to, and which text of its mark it has."""

    order: np.ndarray
    run: np.ndarray  # of each occurrence: its run, which is one document's occurrences of one mark
    first: np.ndarray  # of each run: its first occurrence
    group: np.ndarray  # of each run: its mark's number
    rank: np.ndarray  # of each run: 1, 2, 3 ... in the mark's different texts by their least document, 0 for copies
    back: np.ndarray  # of each run: the run of its text's least document, or of the mark's least document for that one
    texts: np.ndarray  # of each mark: its different texts


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Whether each row differs from the one before it."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def shared(mark: np.ndarray, doc: np.ndarray, text: np.ndarray, at: np.ndarray) -> Shared:
    """The occurrences of each mark, by its documents and their texts."""
    order = np.argsort(mark)
    ordered = mark[order]
    # Only occurrences of marks that come again have an order among them.
    lone = _starts(ordered)
    again = np.flatnonzero(~(lone & np.append(lone[1:], True)[: len(mark)]))
    some = np.sort(order[again])
    order[again] = some[np.lexsort((at[some], doc[some], mark[some]))]
    new = _starts(ordered, doc[order])
    first = np.flatnonzero(new)
    lead = _starts(mark[order][first])
    group = np.cumsum(lead) - 1
    least = np.arange(len(first))
    several = np.flatnonzero(np.bincount(group)[group] > 1)
    texts = text[order[first[several]]]
    by_text = np.lexsort((texts, group[several]))  # stable, so by document where the text is the same
    heads = _starts(group[several][by_text], texts[by_text])
    if len(several):
        least[several[by_text]] = several[by_text[np.flatnonzero(heads)[np.cumsum(heads) - 1]]]
    own = least == np.arange(len(first))
    before = np.cumsum(own) - own
    rank = np.where(own, before + 1 - before[np.flatnonzero(lead)][group], 0) if len(first) else least
    back = np.where(own, np.flatnonzero(lead)[group], least) if len(first) else least
    return Shared(order, np.cumsum(new) - 1, first, group, rank, back, np.bincount(group[own]))


def linked(s: Shared, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows (occurrence, document it links to, place there) of all but the least documents: copies link to their text's
    least document, place by place, the others to the least document of their mark."""
    back = s.back[s.run]
    some = np.flatnonzero(back != s.run)
    hub = s.first[back[some]]
    return s.order[some], s.order[hub], np.where(s.rank[s.run[some]] == 0, at[s.order[some]], at[s.order[hub]])


def met(s: Shared, few: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (occurrence, first occurrence) of the different texts of each mark that has at most ``few``, but for its least document's."""
    own = np.flatnonzero((s.rank > 1) & (s.texts[s.group] <= few)) if len(s.first) else s.first
    size = np.diff(np.append(s.first, len(s.run)))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for step in range(1, few - 1):
        pair = np.flatnonzero(s.group[own[step:]] == s.group[own[: len(own) - step]])
        if len(pair) == 0:
            break
        later, n = own[pair + step], size[own[pair + step]]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        left.append(np.repeat(s.first[later], n) + inside)
        right.append(np.repeat(s.first[own[pair]], n))
    return s.order[np.concatenate(left)], s.order[np.concatenate(right)]


_DEALT = "part int, keys binary, texts binary, seeds binary, links binary"


def _dealt(keys: np.ndarray, texts: np.ndarray, mark: np.ndarray, doc: np.ndarray, at: np.ndarray, on: np.ndarray, parts: int) -> pa.RecordBatch:
    """A batch's seeds by hash range. Of a mark the first texts go on, one more than are rare; the others and copies are linked here."""
    s = shared(mark, doc, texts[doc], at)
    rank, few = s.rank[s.run], RARE_PAIR if on.any() else RARE
    stays = np.zeros(len(mark), bool)
    stays[s.order] = (rank == 0) | (rank > few + 1)
    common = np.zeros(len(mark), bool)
    common[s.order] = rank > few + 1
    own, hub, to = linked(s, at)
    own, hub, to = own[stays[own]], hub[stays[own]], to[stays[own]]
    near = mark // np.uint64(parts)
    local = np.zeros(len(own), _LOCAL)
    local["doc"], local["hub"], local["at"], local["to"] = doc[own], doc[hub], at[own], to
    local["mark"], local["common"] = near[own] & np.uint64(0xFFFFFFFF), common[own]
    goes = np.flatnonzero(~stays)
    halves = on[own] > 0  # a link of two halves is two links
    more = local[halves]
    more["at"] += on[own][halves]
    more["to"] += np.where(common[own], on[hub], on[own])[halves]  # copies have theirs at the same place
    more["common"] = 0
    local = np.concatenate([local, more])
    part = (mark[goes] % np.uint64(parts)).astype(np.int64)
    order = goes[np.argsort(part, kind="stable")]
    cuts = np.searchsorted(np.sort(part), np.arange(parts + 1))
    # Each part takes a share of the batch's own links, so that none gets them all.
    shares = np.arange(parts + 1) * len(local) // parts
    rows: dict[str, list] = {"part": [], "keys": [], "texts": [], "seeds": [], "links": []}
    for p in np.flatnonzero((np.diff(cuts) > 0) | (np.diff(shares) > 0)).tolist():
        some, links = order[cuts[p] : cuts[p + 1]], local[shares[p] : shares[p + 1]].copy()
        named, back = np.unique(np.concatenate([doc[some], links["doc"], links["hub"]]), return_inverse=True)
        seeds = np.zeros(len(some), _PACKED)
        seeds["mark"] = near[some].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
        seeds["doc"], seeds["at"], seeds["on"] = back[: len(some)], at[some], on[some]
        links["doc"], links["hub"] = back[len(some) : len(some) + len(links)], back[len(some) + len(links) :]
        rows["part"].append(p)
        rows["keys"].append(keys[named].astype("<i8").tobytes())
        rows["texts"].append(texts[named].astype("<i8").tobytes())
        rows["seeds"].append(_planes(seeds))
        rows["links"].append(_planes(links))
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(rows[c], t) for c, t in zip(rows, kinds, strict=True)], names=list(rows))


def _keys(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A batch's different documents, their texts, and each row's document."""
    keys, docs = np.unique(np.asarray(block.column("_doc")), return_inverse=True)
    texts = np.zeros(len(keys), np.int64)
    texts[docs] = np.asarray(block.column("_text"))
    return keys, texts, docs


def _seeds(keyed: DataFrame, parts: int) -> DataFrame:
    """A row for each hash range and batch of documents, with the links inside the batch in some of them."""

    def find(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches(blocks):
            keys, texts, docs = _keys(block)
            marks, owners, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for piece in slices(block.column("text")):
                data = LOWER[piece.data]
                words = words_of(piece, NOT_SPACE, data)
                places, found = seeds_of(word_hashes(data, words), words.doc)
                doc = words.doc[places]
                marks.append(found)
                owners.append(docs[piece.first + doc])
                at.append(places - words.first[doc])
            mark, doc, place = np.concatenate(marks), np.concatenate(owners), np.concatenate(at)
            yield _dealt(keys, texts, mark, doc, place, np.zeros(len(mark), np.uint8), parts)

    return keyed.select("_doc", "_text", "text").mapInArrow(find, _DEALT)


def pairs_of(mark: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(mark, doc, at, on) of each seed and the next ones of its document NEAR to FAR words on; of equal pairs the first."""
    order = np.lexsort((mark, at, doc))
    mark, doc, at = mark[order], doc[order], at[order]
    place = doc << 32 | at
    found = [np.zeros((4, 0), np.uint64)]
    for step in range(NEXT):
        to = np.searchsorted(place, place + NEAR) + step
        i = np.flatnonzero(to < len(place))
        i = i[place[to[i]] - place[i] <= FAR]
        to = to[i]
        both = mix(mark[i] * np.uint64(0x9E3779B97F4A7C15) + mark[to]) >> np.uint64(1)
        found.append(np.stack([both, doc[i].astype(np.uint64), at[i].astype(np.uint64), (at[to] - at[i]).astype(np.uint64)]))
    both, doc, at, on = np.concatenate(found, 1)
    order = np.lexsort((on, at, doc, both))
    order = order[_starts(both[order], doc[order])]
    return both[order], doc[order].astype(np.int64), at[order].astype(np.int64), on[order].astype(np.uint8)


def _seed_pairs(common: DataFrame, parts: int) -> DataFrame:
    """Rows as those of seeds, of pairs of common seeds that a document has near each other."""

    def find(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches(blocks):
            keys, texts, docs = _keys(block)
            at, seeds = zip(*(_links(block, i) for i in range(block.num_rows)), strict=True)
            owner = np.repeat(docs, [len(x) for x in at])
            mark, doc, place, on = pairs_of(np.concatenate(seeds).astype(np.int64).view(np.uint64), owner, np.concatenate(at).astype(np.int64))
            yield _dealt(keys, texts, mark, doc, place, on, parts)

    return common.mapInArrow(find, _DEALT)


def _gathered(part: pa.Table) -> pa.Table:
    """Links of a hash range's seeds, and those that batches had made, as one row a pair of documents; and each document's
    common seeds (at, mark), as a row that has its text in place of the other document."""
    marks, docs, texts, at, on, links, common = [], [], [], [], [], [np.zeros((4, 0), np.int64)], [np.zeros((4, 0), np.int64)]
    for keys, names, seeds, own in zip(*(part.column(c).to_pylist() for c in ("keys", "texts", "seeds", "links")), strict=True):
        keys, names, seeds, own = np.frombuffer(keys, "<i8"), np.frombuffer(names, "<i8"), _of_planes(seeds, _PACKED), _of_planes(own, _LOCAL)
        wide = np.zeros((len(seeds), 8), np.uint8)
        wide[:, :5] = seeds["mark"]
        marks.append(wide.reshape(-1).view("<u8"))
        docs.append(keys[seeds["doc"]])
        texts.append(names[seeds["doc"]])
        at.append(seeds["at"].astype(np.int64))
        on.append(seeds["on"].astype(np.int64))
        links.append(np.stack([keys[own["doc"]], keys[own["hub"]], own["at"].astype(np.int64), own["to"].astype(np.int64)]))
        own = own[own["common"] == 1]
        common.append(np.stack([keys[own["doc"]], names[own["doc"]], own["at"].astype(np.int64), own["mark"].astype(np.int64)]))
    mark, doc, text, place, more = (np.concatenate(c) for c in (marks, docs, texts, at, on))
    s = shared(mark, doc, text, place)
    own, hub, to = linked(s, place)
    few = RARE_PAIR if more.any() else RARE
    also, other = met(s, few)
    copy = (text[own] == text[hub]) & (doc[own] != doc[hub])
    second = np.concatenate([np.where(copy, to + more[own], to + more[hub]), place[other] + more[other]])
    own, hub, to = np.concatenate([own, also]), np.concatenate([hub, other]), np.concatenate([to, place[other]])
    links.append(np.stack([doc[own], doc[hub], place[own], to]))
    halves = more[own] > 0
    links.append(np.stack([doc[own], doc[hub], place[own] + more[own], second])[:, halves])
    often = s.order[(s.rank[s.run] > 0) & (s.texts[s.group[s.run]] > few)] if len(mark) else s.order
    common.append(np.stack([doc[often], text[often], place[often], (mark[often] & np.uint64(0xFFFFFFFF)).astype(np.int64)]))
    tables = []
    for rows, flag in ((links, False), (common, True)):
        doc, hub, place, to = np.concatenate(rows, 1)
        order = np.lexsort((to, place, hub, doc))
        order = order[_starts(doc[order], hub[order], place[order], to[order])]
        doc, hub, place, to = doc[order], hub[order], place[order], to[order]
        first = np.flatnonzero(_starts(doc, hub))
        pairs = pa.StructArray.from_arrays([pa.array(place.astype(np.int32)), pa.array(to.astype(np.uint32).view(np.int32))], fields=list(_LINK))
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(doc)).astype(np.int32)), pairs)
        tables.append(pa.table([pa.array(doc[first]), pa.array(hub[first]), lists, pa.array(np.full(len(first), flag))], names=["_doc", "_hub", "links", "common"]))
    return pa.concat_tables(tables)


def _links(block: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Places on both sides of a row's links."""
    links = block.column("links")[i].values
    return np.asarray(links.field("at")), np.asarray(links.field("to"))


def _flat(block: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Row number and places on both sides of all links of a batch."""
    links = block.column("links")
    pairs = links.flatten()
    row = np.repeat(np.arange(block.num_rows), np.asarray(links.value_lengths()))
    return row, np.asarray(pairs.field("at")).astype(np.int64), np.asarray(pairs.field("to")).astype(np.int64)


def _chained(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in batches(blocks):
        row, at, to = _flat(block)
        order = np.lexsort((to, at, row))
        order = order[_starts(row[order], at[order], to[order])]
        row, at, to = row[order], at[order], to[order]
        first = np.flatnonzero(_starts(row))
        last = np.append(first[1:], len(row)) - 1
        # No chain reaches further than all links of its documents do.
        reach = np.minimum(at[last] - at[first], np.maximum.reduceat(to, first) - np.minimum.reduceat(to, first)) + SEED
        step = np.diff(at, prepend=0)
        # Each link on the diagonal of the one before it, and so near that it adds to the score: they are one chain.
        bend = (step != np.diff(to, prepend=0)) | (step >= GAIN / (2 * GAP))
        bend[first] = False
        far, bent = reach >= MIN_REACH, np.logical_or.reduceat(bend, first)
        whole = np.flatnonzero(far & ~bent)
        inside = (far & ~bent)[row]
        rows, sizes, found = whole.tolist(), [0, *(last - first + 1)[whole].tolist()], [np.stack([at[inside], to[inside]])]
        for i in np.flatnonzero(far & bent).tolist():
            x, y = at[first[i] : last[i] + 1], to[first[i] : last[i] + 1]
            for chain in chains(x.tolist(), y.tolist()):
                if min(x[chain[-1]] - x[chain[0]], y[chain[-1]] - y[chain[0]]) + SEED >= MIN_REACH:
                    rows.append(i)
                    sizes.append(len(chain))
                    found.append(np.stack([x[chain], y[chain]]))
        at, to = np.concatenate(found, 1).astype(np.int32)
        pairs = pa.StructArray.from_arrays([pa.array(at), pa.array(to)], fields=list(_LINK))
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), pairs)
        rows = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([block.column("_doc").take(rows), block.column("_hub").take(rows), lists], names=["_doc", "_hub", "links"])


def _segments(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the asked ranges, as 32 bits of each word's hash."""
    for block in batches(blocks, 256):
        rows: dict[str, list] = {"i": [], "low": [], "high": [], "words": []}
        spans = block.column("spans").to_pylist()
        for piece in slices(block.column("text")):
            data = LOWER[piece.data]
            words = words_of(piece, NOT_SPACE, data)
            short = (word_hashes(data, words) >> np.uint64(32)).astype(np.uint32)
            for doc in range(len(piece.offsets) - 1):
                first, size = int(words.first[doc]), int(words.first[doc + 1] - words.first[doc])
                for span in spans[piece.first + doc]:
                    rows["i"].append(piece.first + doc)
                    rows["low"].append(span["low"])
                    rows["high"].append(span["high"])
                    rows["words"].append(short[first + span["low"] : first + min(size, span["high"])].tobytes())
        at = pa.array(rows["i"], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [block.column("_doc").take(at), block.column("doc_id").take(at), pa.array(rows["low"], pa.int32()), pa.array(rows["high"], pa.int32()), pa.array(rows["words"], pa.binary())],
            names=["_doc", "doc_id", "low", "high", "words"],
        )


def _inside(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows that hold so many items: each item's row, and its number in the row."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    return row, np.arange(len(row)) - (np.cumsum(sizes) - sizes)[row]


def _outwards_each(equal: np.ndarray, row: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """As ``_outwards``, for the items of many rows."""
    score = np.cumsum(np.where(equal, 1, -MISS))
    score -= np.append(0, score)[np.cumsum(sizes) - sizes][row]
    lift = row * (len(equal) + 1)  # more than any score, so that a row's maxima begin anew
    fallen = np.flatnonzero(np.maximum.accumulate(np.maximum(score, 0) + lift) - lift - score > DROP)
    fallen = fallen[_starts(row[fallen])]
    out = sizes.copy()
    out[row[fallen]] = at[fallen]
    return out


def aligned_straight(a: np.ndarray, a_first: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_first: np.ndarray, b_size: np.ndarray, x: np.ndarray, y: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, ...]:
    """What ``align`` finds for chains on one diagonal: rows and places (row, in a, in b) of the words that match.

    Each row's words begin at ``first`` of all words and are ``size``; its chain begins at (x, y) and its seeds reach over so many words.
    """
    n = np.minimum(x, y)
    row, at = _inside(n)
    back = _outwards_each(a[(a_first + x)[row] - 1 - at] == b[(b_first + y)[row] - 1 - at], row, at, n)
    n = np.minimum(a_size - x, b_size - y) - reach
    row, at = _inside(n)
    ahead = _outwards_each(a[(a_first + x + reach)[row] + at] == b[(b_first + y + reach)[row] + at], row, at, n)
    row, at = _inside(back + reach + ahead)
    left, right = (x - back)[row] + at, (y - back)[row] + at
    same = a[a_first[row] + left] == b[b_first[row] + right]
    return row[same], left[same], right[same]


def _words(block: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All rows' words, where each row's begin and how many they are."""
    texts = block.column(name).to_pylist()
    sizes = np.array([len(t) for t in texts], np.int64) // 4
    return np.frombuffer(b"".join(texts), np.uint32), np.cumsum(sizes) - sizes, sizes


def _aligned(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["begin", "end", "kept_begin", "kept_end", "n_same"]
    for block in batches(blocks, 512):
        row, at, to = _flat(block)
        low, kept_low = (np.asarray(block.column(c)).astype(np.int64) for c in ("low", "kept_low"))
        at, to = at - low[row], to - kept_low[row]
        first = np.flatnonzero(_starts(row))
        last = np.append(first[1:], len(row)) - 1
        (a, a_first, a_size), (b, b_first, b_size) = _words(block, "words"), _words(block, "kept_words")
        turned = np.logical_or.reduceat(at - to != (at - to)[first][row], first)
        rows: list[tuple] = []

        def passages(i: int, matches: np.ndarray) -> None:
            for begin, end in alike(matches):
                (x, y), (far, kept_far) = matches[begin].tolist(), matches[end - 1].tolist()
                rows.append((i, x, far + 1, y, kept_far + 1, end - begin))  # noqa: B023

        some = np.flatnonzero(~turned)
        x, y, reach = at[first[some]], to[first[some]], (at[last] - at[first])[some] + SEED
        near, left, right = aligned_straight(a, a_first[some], a_size[some], b, b_first[some], b_size[some], x, y, reach)
        ends = np.searchsorted(near, np.arange(len(some) + 1))
        enough = np.flatnonzero(np.diff(ends) >= SIMILAR * MIN_WORDS)
        begin, end = ends[enough], ends[enough + 1]
        size = left[end - 1] + 1 - left[begin]
        whole = (size >= MIN_WORDS) & (end - begin >= SIMILAR * size)  # all matches are one passage
        x, y = begin[whole], end[whole] - 1
        found = np.stack([some[enough[whole]], left[x], left[y] + 1, right[x], right[y] + 1, y + 1 - x], 1)
        for i, f, e in zip(*(c[~whole].tolist() for c in (some[enough], begin, end)), strict=True):
            passages(i, np.stack([left[f:e], right[f:e]], 1))
        for i in np.flatnonzero(turned).tolist():
            links = list(zip(at[first[i] : last[i] + 1].tolist(), to[first[i] : last[i] + 1].tolist(), strict=True))
            passages(i, align(a[a_first[i] :][: a_size[i]], b[b_first[i] :][: b_size[i]], links))
        columns = np.concatenate([found, np.array(rows, np.int64).reshape(-1, 6)]).T
        owner = columns[0]
        places = [columns[1] + low[owner], columns[2] + low[owner], columns[3] + kept_low[owner], columns[4] + kept_low[owner], columns[5]]
        owners = ["_doc", "_hub", "doc_id", "kept_id"]
        picked = [block.column(c).take(pa.array(owner)) for c in owners]
        yield pa.RecordBatch.from_arrays([*picked, *(pa.array(c) for c in places)], names=[*owners, *names])


def shared_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a passage: its document and words [begin, end), the kept document's that it repeats, and their component."""
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text IS NOT NULL").withColumns({"_doc": F.xxhash64("doc_id", "text"), "_text": F.xxhash64("text")})
    size = keyed.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    shape = f"_doc long, _hub long, links array<{_LINK_SQL}>, common boolean"
    links = written(_seeds(keyed, parts).groupBy("part").applyInArrow(_gathered, shape), "links")
    common = links.where("common").groupBy("_doc", F.col("_hub").alias("_text")).agg(F.flatten(F.collect_list("links")).alias("links"))
    further = _seed_pairs(common, parts).groupBy("part").applyInArrow(_gathered, shape)
    # A pair's links are bounded by its texts.
    links = links.unionByName(further).where("NOT common").groupBy("_doc", "_hub").agg(F.flatten(F.collect_list("links")).alias("links"))
    found = links.mapInArrow(_chained, f"_doc long, _hub long, links array<{_LINK_SQL}>")

    def ends(field: str) -> list:
        low = F.greatest(F.lit(0), F.col("links")[0][field] - MARGIN)
        high = F.element_at("links", -1)[field] + SEED + MARGIN
        return [(F.floor(low / ROUND) * ROUND).cast("int"), (F.ceil(high / ROUND) * ROUND).cast("int")]

    (low, high), (kept_low, kept_high) = ends("at"), ends("to")
    found = written(found.select("_doc", "_hub", "links", low.alias("low"), high.alias("high"), kept_low.alias("kept_low"), kept_high.alias("kept_high")), "chains")

    sides = found.select("_doc", "low", "high").unionByName(found.select(F.col("_hub").alias("_doc"), F.col("kept_low").alias("low"), F.col("kept_high").alias("high")))
    asked = sides.distinct().groupBy("_doc").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    kind = keyed.schema["doc_id"].dataType.simpleString()
    parts = keyed.join(asked, "_doc").mapInArrow(_segments, f"_doc long, doc_id {kind}, low int, high int, words binary")
    parts = written(parts.dropDuplicates(["_doc", "low", "high"]), "segments")

    kept = parts.select(*[F.col(c).alias(n) for c, n in (("_doc", "_hub"), ("doc_id", "kept_id"), ("low", "kept_low"), ("high", "kept_high"), ("words", "kept_words"))])
    both = found.join(parts, ["_doc", "low", "high"]).join(kept, ["_hub", "kept_low", "kept_high"])
    picked = both.select("_doc", "_hub", "doc_id", "kept_id", "low", "kept_low", "links", "words", "kept_words")
    fields = f"_doc long, _hub long, doc_id {kind}, kept_id {kind}, begin long, end long, kept_begin long, kept_end long, n_same long"
    passages = written(picked.mapInArrow(_aligned, fields).distinct(), "passages", slim=True)

    joined = components(passages.select(F.col("_doc").alias("a"), F.col("_hub").alias("b")).distinct())
    ends_of = passages.select("_doc", "doc_id").unionByName(passages.select(F.col("_hub").alias("_doc"), F.col("kept_id").alias("doc_id"))).distinct()
    members = written(ends_of.join(joined.withColumnRenamed("node", "_doc"), "_doc"), "members", slim=True)
    least = members.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    # A component that a third of the documents are in is split by the adaptive skew join.
    named = members.select("_doc", "component").distinct().join(least, "component").select("_doc", "component_id")
    return passages.join(named, "_doc").drop("_doc", "_hub")
