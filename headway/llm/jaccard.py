"""Documents whose sets of word n-grams have a Jaccard similarity of at least num / den.

Size-aware heavy-light join. A pair of sizes fixes the overlap c that a link needs. Small sets
are put under each of their subsets of every such c, so linked ones meet under a common
subset. Large sets are put in inverted lists: under their rarest grams, as many as any linked
set must share one of. The size up to which sets count as small is where enumerating subsets
costs less than scanning lists, by the counts of sets of each size; small sets that may link
with large ones are in the lists as well. Rarity is by a table of hashed counts over all
grams, of fixed size; it orders the grams and can't lose a link.

Members of a list aren't all paired. Equal sets are one node. A list first names as its hub
the member with the fewest rarer grams, the one nearest to the others; its members are checked
against the hub, and linked nodes become components. What is left are members of a list in
different components: they are compared within tasks, in blocks, and only the pairs that may
be links leave the task. (While too many are left, hubs are drawn by further hashes first.) So
a group of copies is joined through its hub, and no link between components is lost.

A pair may be a link if the grams before the first they share, and the counts of their grams
in 256 classes, leave the overlap that their sizes need; then whole sets are compared.

Defined cases: null, empty and wordless texts have an empty set and link with nothing, not
even each other; fewer words than n are one gram; repeated rows are in one component; a null
id names no component unless all its ids are null; no documents give no rows. Grams are
compared by 64-bit hashes, sets in a check by 40 bits of each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import batches, bit_table, in_table, salted_join, written
from headway.llm.graph import components
from headway.llm.words import LOWER, NOT_SPACE, Slice, gram_hashes, mix, same_doc, slices, word_hashes, words_of

SKETCH_BITS = 20
BLOCK_BITS = 14
CLASSES = 256
MOST_SMALL = 16
SCAN = 4  # postings read for a key of an inverted list, against one row for a subset
ROUNDS = 3
CROSS = 64  # pairs in different components for each posting, at which no more hubs are drawn
BLOCK = 512  # members of a list that are compared with each other in one go

_TOKEN, _SUBSET = np.uint64(0xA5A5A5A5), np.uint64(0x5B5B5B5B)


def gram_sets(piece: Slice, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner and hash of the distinct grams of each text, by owner and hash, and where each text's begin."""
    data = LOWER[piece.data]
    words = words_of(piece, NOT_SPACE, data)
    hashes = word_hashes(data, words)
    whole = same_doc(words.doc, n)
    marks, owner = [gram_hashes(hashes, n)[whole]], [words.doc[: len(whole)][whole]]
    counts = words.counts()
    for size in range(1, n):
        short = np.flatnonzero(counts == size)
        if len(short):
            marks.append(gram_hashes(hashes, size)[words.first[short]])
            owner.append(short)
    h, doc = np.concatenate(marks), np.concatenate(owner)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return doc, h, np.searchsorted(doc, np.arange(len(piece.offsets)))


def _nodes(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """One hash for each set; equal sets have equal ones."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(0x1234567)), dtype=np.uint64)])
    return mix(total[begin[1:]] - total[begin[:-1]] + np.diff(begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def prefix_size(n, num: int, den: int):
    """Rarest grams of which two linked sets must share one."""
    return n - (num * n + den - 1) // den + 1


def overlap(n, m, num: int, den: int):
    """The grams that linked sets of n and m must share; whole numbers or arrays."""
    return -(-num * (n + m) // (num + den))


def subset_sizes(n: int, num: int, den: int) -> list[int]:
    """The overlaps that a set of n needs with the sizes it may link with."""
    return sorted({overlap(n, m, num, den) for m in range(max(1, -(-num * n // den)), den * n // num + 1)})


def small_sizes(counts: dict[int, int], num: int, den: int) -> int:
    """The size up to which subsets are enumerated: that of the least total cost."""

    def cost(limit: int) -> float:
        total = 0
        for n, sets in counts.items():
            if n <= limit:
                total += sets * sum(math.comb(n, c) for c in subset_sizes(n, num, den))
            if n > limit or den * n // num > limit:
                total += sets * SCAN * int(prefix_size(n, num, den))
        return total

    return min(range(MOST_SMALL + 1), key=cost)


def _sets_and_sketch(n: int, key: str):
    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        kind = None
        for block in batches(blocks):
            kind = block.column(key).type
            sizes, nodes, classes, marks = [], [], [], []
            for piece in slices(block.column("_text")):
                doc, h, begin = gram_sets(piece, n)
                marks.append((h >> np.uint64(64 - SKETCH_BITS)).astype(np.uint32))
                sizes.append(np.diff(begin))
                nodes.append(_nodes(h, begin).view(np.int64))
                docs = len(begin) - 1
                table = np.bincount(doc * CLASSES + (h & np.uint64(CLASSES - 1)).astype(np.int64), minlength=docs * CLASSES)
                classes += [row.tobytes() for row in np.minimum(table, 255).astype(np.uint8).reshape(docs, CLASSES)]
            sketch += np.bincount(np.concatenate(marks), minlength=len(sketch))
            size = np.concatenate(sizes)
            none = pa.nulls(len(size), pa.int32())
            node = pa.array(np.concatenate(nodes), mask=size == 0)
            yield pa.RecordBatch.from_arrays(
                [block.column(key), pa.array(size.astype(np.int64)), node, pa.array(classes, pa.binary()), none, pa.nulls(len(size), pa.binary())],
                names=[key, "n", "node", "classes", "block", "counts"],
            )
        if kind is not None:
            parts = sketch.astype(np.uint32).reshape(-1, 1 << BLOCK_BITS)
            rows = len(parts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(rows, kind),
                    pa.nulls(rows, pa.int64()),
                    pa.nulls(rows, pa.int64()),
                    pa.nulls(rows, pa.binary()),
                    pa.array(np.arange(rows, dtype=np.int32)),
                    pa.array([p.tobytes() for p in parts], pa.binary()),
                ],
                names=[key, "n", "node", "classes", "block", "counts"],
            )

    return run


def _add_blocks(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << BLOCK_BITS, np.int64)
    for part in parts:
        for counts in part.column("counts"):
            total += np.frombuffer(counts.as_py(), np.uint32)
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()], pa.int32()), pa.array([np.minimum(total, (1 << 20) - 1).astype(np.uint32).tobytes()], pa.binary())], names=["block", "counts"]
    )


def _keys(n: int, num: int, den: int, small: int, sketch):
    """(key, node, n, at): subsets of small sets, and rarest grams of the others with how many rarer ones each has."""

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        for block in batches(blocks):
            for piece in slices(block.column("_text")):
                doc, h, begin = gram_sets(piece, n)
                size, node = np.diff(begin), _nodes(h, begin)
                rank = (counts[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20))
                order = np.lexsort((rank, doc))
                place = np.arange(len(h)) - begin[doc]
                listed = (size > small) | (den * size // num > small)
                chosen = (place < prefix_size(size, num, den)[doc]) & listed[doc]
                keys, owner, rarer = [mix(h[order][chosen] ^ _TOKEN)], [doc[chosen]], [place[chosen]]
                for d in np.flatnonzero((size > 0) & (size <= small)):
                    own = mix(h[begin[d] : begin[d + 1]] ^ _SUBSET)
                    for c in subset_sizes(len(own), num, den):
                        members = np.array(list(combinations(range(len(own)), c)))
                        keys.append(mix(mix(own[members].sum(axis=1, dtype=np.uint64)) ^ np.uint64(c)))
                        owner.append(np.full(len(members), d))
                        rarer.append(np.zeros(len(members), np.int64))
                at = np.concatenate(owner).astype(np.int64)
                columns = [np.concatenate(keys).view(np.int64), node[at].view(np.int64), size[at].astype(np.int32), np.concatenate(rarer).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "node", "n", "at"])

    return run


def _whole_sets(n: int, wanted):
    """Sets of the nodes that the bit table has, as 40 bits of each gram."""

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = wanted.value
        for block in batches(blocks):
            nodes, grams = [], []
            for piece in slices(block.column("_text")):
                _, h, begin = gram_sets(piece, n)
                node = _nodes(h, begin)
                for d in np.flatnonzero(in_table(table, node) & (np.diff(begin) > 0)):
                    own = h[begin[d] : begin[d + 1]]
                    nodes.append(node[d].view(np.int64))
                    grams.append((own >> np.uint64(32)).astype(np.uint32).tobytes() + ((own >> np.uint64(24)) & np.uint64(0xFF)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(grams, pa.binary())], names=["node", "grams"])

    return run


def _unpacked(grams: bytes) -> np.ndarray:
    n = len(grams) // 5
    return (np.frombuffer(grams, np.uint32, n).astype(np.uint64) << np.uint64(8)) | np.frombuffer(grams, np.uint8, n, 4 * n)


def _links(num: int, den: int):
    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches(blocks, 512):
            linked = []
            for one, two in zip(block.column("grams_a"), block.column("grams_b"), strict=True):
                x, y = _unpacked(one.as_py()), _unpacked(two.as_py())
                both = np.concatenate([x, y])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                linked.append(den * shared >= num * (len(both) - shared))
            keep = pa.array(np.flatnonzero(linked))
            yield pa.RecordBatch.from_arrays([block.column("a").take(keep), block.column("b").take(keep)], names=["a", "b"])

    return run


def _allow(x: np.ndarray, y: np.ndarray, size: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether class counts allow the overlap that two sets of so many grams together need."""
    least = np.minimum(x, y).sum(1, dtype=np.int64)
    full = (np.minimum(x, y) == 255).any(1)  # a class that counts no further
    return full | (least >= overlap(size, 0, num, den))


def _possible(num: int, den: int):
    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches(blocks, 4096):
            x, y = (np.frombuffer(b"".join(block.column(c).to_pylist()), np.uint8).reshape(-1, CLASSES) for c in ("classes_a", "classes_b"))
            size = np.asarray(block.column("na")).astype(np.int64) + np.asarray(block.column("nb"))
            keep = pa.array(np.flatnonzero(_allow(x, y, size, num, den)))
            yield pa.RecordBatch.from_arrays([block.column("a").take(keep), block.column("b").take(keep)], names=["a", "b"])

    return run


def _compared(num: int, den: int):
    """Pairs of each run of equal (key, i, j) that may be links: in different components, and of both blocks if these differ."""

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        key, node, n, at, group, i, j, own = (np.asarray(rows.column(c)) for c in ("key", "node", "n", "at", "component", "i", "j", "block"))
        classes = np.frombuffer(b"".join(rows.column("classes").to_pylist()), np.uint8).reshape(-1, CLASSES)
        n, first, second = n.astype(np.int64), [], []
        here = np.arange(len(key))
        for step in range(1, len(key)):
            here = here[: np.searchsorted(here, len(key) - step)]
            there = here + step
            same = (key[here] == key[there]) & (i[here] == i[there]) & (j[here] == j[there])
            here = here[same]
            if len(here) == 0:
                break
            there = here + step
            x, y = n[here], n[there]
            total = x + y
            may = (group[here] != group[there]) & ((i[here] == j[here]) | (own[here] != own[there]))
            may &= at[here] + at[there] <= total - 2 * overlap(x, y, num, den)
            may &= den * np.minimum(x, y) >= num * np.maximum(x, y)
            a, b = here[may], there[may]
            may = _allow(classes[a], classes[b], n[a] + n[b], num, den)
            first.append(node[a[may]])
            second.append(node[b[may]])
        a, b = (np.concatenate([np.zeros(0, np.int64), *part]) for part in (first, second))
        both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for block in batches(blocks, 4096):
            held = pa.Table.from_batches([block]) if held is None else pa.concat_tables([held, pa.Table.from_batches([block])])
            marks = [np.asarray(held.column(c)) for c in ("key", "i", "j")]
            new = np.flatnonzero(np.any([m[1:] != m[:-1] for m in marks], axis=0))
            if len(new):  # the last run may go on in the next batch
                yield pairs(held.slice(0, new[-1] + 1))
                held = held.slice(new[-1] + 1)
        if held is not None:
            yield pairs(held)

    return run


class _Join:
    def __init__(self, docs: DataFrame, n: int, num: int, den: int):
        self.docs, self.n, self.num, self.den = docs, n, num, den
        self.spark = docs.sparkSession
        kind = docs.schema["_key"].dataType.simpleString()
        found = docs.mapInArrow(_sets_and_sketch(n, "_key"), f"_key {kind}, n long, node long, classes binary, block int, counts binary")
        found = written(found, "sets")
        self.sets = found.where("block IS NULL").select("_key", "n", "node", "classes")
        self.sketch_rows = found.where("block IS NOT NULL").select("block", "counts")
        self.nodes = written(
            self.sets.where("n > 0").groupBy("node").agg(F.min("_key").alias("least"), F.count("*").alias("rows"), F.first("n").alias("n"), F.first("classes").alias("classes")), "nodes", slim=True
        )

    def postings(self) -> DataFrame:
        sketch = np.zeros((1 << (SKETCH_BITS - BLOCK_BITS), 1 << BLOCK_BITS), np.uint32)
        for block, counts in self.sketch_rows.groupBy("block").applyInArrow(_add_blocks, "block int, counts binary").toLocalIterator():
            sketch[block] = np.frombuffer(counts, np.uint32)
        shared = self.spark.sparkContext.broadcast(sketch.reshape(-1))
        short = self.nodes.where(F.col("n") <= 4 * MOST_SMALL).groupBy("n").count().collect()
        small = small_sizes({r["n"]: r["count"] for r in short}, self.num, self.den)
        keyed = self.docs.select("_text").mapInArrow(_keys(self.n, self.num, self.den, small, shared), "key long, node long, n int, at int")
        lists = keyed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high").select("key")
        # Copies put the same node under a key many times.
        return written(keyed.join(lists, "key").distinct().withColumn("level", F.floor(F.log("n") / math.log(self.den / self.num)).cast("int")), "postings", slim=True)

    def fits(self, a: str, b: str) -> Column:
        return self.den * F.least(a, b) >= self.num * F.greatest(a, b)

    def checked(self, pairs: DataFrame) -> DataFrame:
        """The linked ones of pairs (a, b)."""
        side = self.nodes.select("node", "n", "classes")
        for c in ("a", "b"):
            pairs = pairs.join(side.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("classes").alias(f"classes_{c}")), c)
        hopeful = written(pairs.mapInArrow(_possible(self.num, self.den), "a long, b long"), "hopeful", slim=True)
        wanted = hopeful.select(F.col("a").alias("node")).unionByName(hopeful.select(F.col("b").alias("node"))).distinct()
        grams = self.docs.select("_text").mapInArrow(_whole_sets(self.n, self.spark.sparkContext.broadcast(bit_table(wanted, "node"))), "node long, grams binary")
        grams = written(grams.dropDuplicates(["node"]), "grams", slim=True)
        for c in ("a", "b"):
            hopeful = hopeful.join(grams.select(F.col("node").alias(c), F.col("grams").alias(f"grams_{c}")), c)
        return hopeful.mapInArrow(_links(self.num, self.den), "a long, b long")

    def linked(self) -> tuple[DataFrame, DataFrame]:
        """Links that hold the components together, and each linked node's component."""
        postings = self.postings()
        total = postings.count()
        links = tested = comps = None
        last = False
        for number in range(ROUNDS + 1):
            if comps is None:
                now = postings.withColumn("component", F.col("node"))
            else:
                now = postings.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
                now = written(now, "grouped", slim=True)
                own = now.groupBy("key", "component").count()
                sums = own.groupBy("key").agg(F.sum("count").alias("n"), F.sum(F.col("count") * F.col("count")).alias("squares"))
                mixed = written(sums.where("squares < n * n"), "mixed-lists", slim=True)
                cross = mixed.agg(F.sum((F.col("n") * F.col("n") - F.col("squares")) / 2)).first()[0] or 0
                if cross == 0:
                    break
                last = cross <= CROSS * total or number == ROUNDS
                now = now.join(mixed.select("key", F.col("n").alias("size")), "key")
            pairs = self._cross(now) if last else self._hubs(now, number)
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            pairs = written(pairs, "pairs", slim=True)
            found = written(self.checked(pairs), "links", slim=True)
            links = found if links is None else links.unionByName(found)
            tested = pairs if tested is None else tested.unionByName(pairs)
            comps = components(links)
            if last:
                break
        return links, comps

    def _hubs(self, now: DataFrame, number: int) -> DataFrame:
        """Each member of a list, by level of size, with the hub of this round."""
        draw = F.struct((F.col("at") if number == 0 else F.lit(0)).alias("at"), F.xxhash64(F.lit(number), "node").alias("draw"))
        columns = {"node": "hub", "n": "hub_n", "at": "hub_at", "component": "hub_component"}
        hubs = now.groupBy("key", "level").agg(F.min_by(F.struct(*[F.col(c).alias(h) for c, h in columns.items()]), draw).alias("hub")).select("key", "level", "hub.*")
        met = now.join(hubs, ["key", "level"]).where((F.col("component") != F.col("hub_component")) & self.fits("n", "hub_n"))
        both = F.col("n") + F.col("hub_n")
        spare = both - 2 * F.ceil(self.num * both / (self.num + self.den))
        met = met.where(F.col("at") + F.col("hub_at") <= spare)
        return met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()

    def _cross(self, now: DataFrame) -> DataFrame:
        """Pairs of a list in different components that may be links.

        A list's members are dealt to blocks of about BLOCK; every two blocks meet in one place.
        """
        blocks = F.ceil(F.col("size") / BLOCK).cast("int")
        rows = now.join(self.nodes.select("node", "classes"), "node").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        rows = rows.select("key", "node", "n", "at", "component", "classes", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        return dealt.mapInArrow(_compared(self.num, self.den), "a long, b long").distinct()


def jaccard_components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: doc_id, the size of its set and component_id, the least id of its component."""
    join = _Join(docs.select(F.col(doc_id).alias("_key"), F.col(text).alias("_text")), n, num, den)
    _, comps = join.linked()
    # Only nodes of several rows or with links have another id than their own row's.
    grouped = join.nodes.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("rows").alias("rows")).where("rows > 1")
    known = written(grouped.select("node", "component").join(least.select("component", "component_id"), "component").select("node", "component_id"), "components", slim=True)
    out = salted_join(join.sets.select("_key", "n", "node"), known, ["node"], "_key", salts=8)
    return out.select(F.col("_key").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "_key").alias("component_id"))
