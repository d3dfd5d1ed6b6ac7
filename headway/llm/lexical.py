"""Ranked lexical search: the best documents of every query, by norm buckets of impact vectors.

A document's impact vector has, for each term that queries use, the term's weight times its
saturated frequency in whole numbers; a score is the sum over the query's terms. Vectors are
sorted by length into buckets (ranges of a distributed sort) and searched from the longest on, in
rounds of growing numbers of buckets, so that the k-th best scores found so far are known to the
next round.

By Cauchy-Schwarz no vector of a bucket scores more than its greatest length times the root of the
query's number of terms: queries that ask for more skip the bucket, and where all do, it isn't
read. Inside, each coordinate is bounded by its greatest value there. A query's terms of greatest
bound come first; those after which the rest's bound is under the k-th best score can't make a
result alone, so only vectors that have one of the terms before it are candidates, and
they survive if what these terms give and the bound of the rest reach the k-th best score. Survivors
are rescored exactly in integers over all terms. Tasks keep k rows a query and return them.

Queries are handled in blocks of at most BLOCK_TERMS terms (or one query), so what tasks are sent
is bounded; every block is searched against all documents. A bit table of fixed size keeps
words that no query has out of the written postings.

Defined cases: null and empty texts have no terms, count in nothing and are found by nothing; an
item without terms, or with terms that no document has, has no rows; equal rows of items are one
item, items of one id and different texts are ranked each; repeated document rows are found each;
null ids come after all others of equal score, and equal ids by row; fewer than k documents above 0
are all listed; no documents or no items give no rows. Ids of documents are whole numbers; other columns are
ignored. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm.common import batches, bit_table, in_table, written
from headway.llm.words import ALNUM, LOWER, slices, word_hashes, words_of

BEST = 10
BLOCK_TERMS = 1 << 16
CELLS = 1 << 21  # products of documents and queries that a task holds at a time
SLACK = 1 + 1e-9  # lengths are doubles; bounds by them are widened by more than their error
GROWTH = 4  # each round searches so many times the buckets of the last


def term_counts(column: pa.Array, table: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, where its terms begin, its different terms (hashes, ascending) that the table has, and how often they occur."""
    sizes, starts, marks, often, total = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for piece in slices(column):
        data = LOWER[piece.data]
        words = words_of(piece, ALNUM, data)
        hashes, doc = word_hashes(data, words), words.doc
        if table is not None:
            asked = in_table(table, hashes)
            hashes, doc = hashes[asked], doc[asked]
        hashes = hashes.view(np.int64)
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        sizes.append(words.counts())
        marks.append(hashes[first])
        often.append(np.diff(np.append(first, len(hashes))))
        starts.append(total + np.searchsorted(doc[first], np.arange(1, len(piece.offsets))))
        total += len(first)
    return np.concatenate(sizes), np.concatenate(starts), np.concatenate(marks), np.concatenate(often)


def _with_terms(rows: DataFrame, table) -> DataFrame:
    """(id, _row, n, marks, often) of rows (id, _row, text)."""
    kind = rows.schema["id"].dataType.simpleString()

    def count(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value if table is not None else None
        for block in batches(blocks):
            sizes, starts, marks, often = term_counts(block.column("text"), bits)
            places = pa.array(starts.astype(np.int32))
            lists = [pa.ListArray.from_arrays(places, pa.array(x)) for x in (marks, often.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([block.column("id"), block.column("_row"), pa.array(sizes), *lists], names=["id", "_row", "n", "marks", "often"])

    return rows.mapInArrow(count, f"id {kind}, _row long, n long, marks array<long>, often array<int>")


class Block(NamedTuple):
    """Some queries: their different terms with weights, and each query's terms one after another."""

    names: np.ndarray  # _row of each query
    marks: np.ndarray  # hashes of the terms, ascending
    weights: np.ndarray
    query: np.ndarray  # of each entry
    term: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.bincount(self.query, minlength=len(self.names))


def query_block(rows: list, df: dict[int, int], n_docs: int) -> Block:
    """A block of collected queries (_row, marks); terms that no document has, or all have, weigh nothing and are left out."""
    known = sorted({m for r in rows for m in r["marks"] if m in df})
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[m] + 1))) for m in known], np.int64)
    known = np.array(known, np.int64)[weights > 0] if len(known) else np.zeros(0, np.int64)
    place = {m: i for i, m in enumerate(known.tolist())}
    pairs = [(i, place[m]) for i, r in enumerate(rows) for m in r["marks"] if m in place]
    query, term = np.array(pairs, np.int64).reshape(-1, 2).T
    return Block(np.array([r["_row"] for r in rows], np.int64), known, weights[weights > 0], query, term)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and values of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.asarray(column.offsets, np.int64)
    return offsets - offsets[0], np.asarray(column.flatten())


def _vectors(terms: DataFrame, shared, n_docs: int, n_words: int) -> DataFrame:
    """(id, _row, length, terms, parts) of the documents that have a term of the block; a part times the term's weight is its impact."""

    def weigh(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        for block in batches(blocks):
            offsets, marks = _lists(block.column("marks"))
            often = _lists(block.column("often"))[1].astype(np.int64)
            doc = np.repeat(np.arange(block.num_rows), np.diff(offsets))
            at = np.minimum(np.searchsorted(asked.marks, marks), max(0, len(asked.marks) - 1))
            has = asked.marks[at] == marks if len(asked.marks) else np.zeros(len(marks), bool)
            doc, at, often = doc[has], at[has], often[has]
            spread = 10 + 90 * np.asarray(block.column("n"))[doc] * n_docs // n_words
            parts = 1_000_000_000 * often // (1000 * often + 8 * spread)
            length = np.sqrt(np.bincount(doc, (asked.weights[at] * parts).astype(np.float64) ** 2, block.num_rows))
            picked = np.flatnonzero(length)
            places = pa.array(np.append(0, np.cumsum(np.bincount(doc, minlength=block.num_rows)[picked])).astype(np.int32))
            keep = length[doc] > 0
            lists = [pa.ListArray.from_arrays(places, pa.array(x[keep].astype(np.int32))) for x in (at, parts)]
            rows = pa.array(picked)
            yield pa.RecordBatch.from_arrays([block.column("id").take(rows), block.column("_row").take(rows), pa.array(length[picked]), *lists], names=["id", "_row", "length", "terms", "parts"])

    return terms.where("size(marks) > 0").mapInArrow(weigh, "id long, _row long, length double, terms array<int>, parts array<int>")


class Found:
    """The best rows of each query so far, and the least score with which a row may still enter."""

    def __init__(self, least: np.ndarray, k: int):
        self.least, self.k = least.copy(), k
        self.rows = [np.zeros(0, np.int64) for _ in range(5)]  # query, score, no id, id, row

    def add(self, *rows: np.ndarray) -> None:
        every = [np.concatenate(x) for x in zip(self.rows, rows, strict=True)]
        query, score, nameless, name, row = every
        order = np.lexsort((row, name, nameless, -score, query))
        query = query[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        self.rows = [x[order][place < self.k] for x in every]
        full = order[place == self.k - 1]
        self.least[every[0][full]] = np.maximum(self.least[every[0][full]], score[full])


class Batch(NamedTuple):
    """Impact vectors of some documents, longest first, terms ascending in each."""

    doc: np.ndarray
    term: np.ndarray
    impact: np.ndarray
    length: np.ndarray

    def part(self, low: int, high: int) -> Batch:
        a, b = np.searchsorted(self.doc, [low, high])
        return Batch(self.doc[a:b] - low, self.term[a:b], self.impact[a:b], self.length[low:high])


def essential(asked: Block, batch: Batch, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries without which no vector of the batch can reach its query's least score; what the other entries add at most, and their number."""
    n, sizes = len(asked.names), asked.sizes()
    bound = np.zeros(len(asked.marks), np.int64)
    np.maximum.at(bound, batch.term, batch.impact)
    longest = float(batch.length.max())
    alive = np.sqrt(sizes) * longest * SLACK >= least
    top = bound[asked.term]
    entries = np.flatnonzero(alive[asked.query] & (top > 0))
    entries = entries[np.lexsort((-top[entries], asked.query[entries]))]
    query, top = asked.query[entries], top[entries]
    total = np.bincount(query, top, n)
    before = np.cumsum(top) - top
    first = np.searchsorted(query, np.arange(n))
    inside = before - np.append(before, 0)[np.minimum(first, len(before))][query]
    rest = total[query] - inside  # what this entry and those after it add at most
    left = np.bincount(query, minlength=n)[query] - (np.arange(len(query)) - first[query])
    needed = np.minimum(rest, np.sqrt(left) * longest * SLACK) >= least[query]
    tail, count = np.zeros(n), np.zeros(n, np.int64)
    np.maximum.at(tail, query[~needed], rest[~needed])
    np.maximum.at(count, query[~needed], left[~needed])
    return entries[needed], tail, count


def search(asked: Block, batch: Batch, found: Found) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, document and exact score of the vectors that may be among the best."""
    n, docs = len(asked.names), len(batch.length)
    entries, tail, count = essential(asked, batch, found.least)
    by_term = entries[np.argsort(asked.term[entries], kind="stable")]
    start = np.searchsorted(asked.term[by_term], np.arange(len(asked.marks) + 1))
    fan = np.diff(start)[batch.term]
    has = fan > 0
    doc, term, impact, fan = batch.doc[has], batch.term[has], batch.impact[has], fan[has]
    cost = np.cumsum(np.bincount(doc, fan, docs))
    out, low = [np.zeros((3, 0), np.int64)], 0
    while low < docs:
        spent = cost[low - 1] if low else 0
        high = min(docs, max(low + 1, int(np.searchsorted(cost, spent + CELLS, "right"))), low + max(1, CELLS // n))
        a, b = np.searchsorted(doc, [low, high])
        own = fan[a:b]
        step = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        query = asked.query[by_term[np.repeat(start[term[a:b]], own) + step]]
        cell = np.repeat(doc[a:b] - low, own) * n + query
        partial = np.bincount(cell, np.repeat(impact[a:b], own), (high - low) * n).reshape(high - low, n)  # whole numbers below 2 ** 53
        if high - low > found.k:  # partial sums are scores at least
            kth = np.partition(partial, high - low - found.k, 0)[high - low - found.k].astype(np.int64)
            np.maximum(found.least, kth, out=found.least)
        rest = np.minimum(tail[None, :], np.sqrt(count)[None, :] * (batch.length[low:high, None] * SLACK))
        places, queries = np.nonzero((partial > 0) & (partial + rest >= found.least))
        out.append(np.stack([queries, places + low, exact(asked, batch, places + low, queries)]))
        low = high
    return tuple(np.concatenate(out, 1))


def exact(asked: Block, batch: Batch, docs: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Integer scores of pairs of a document and a query over all the query's terms."""
    size = len(asked.marks)
    keys = batch.doc * size + batch.term  # ascending
    first = np.searchsorted(asked.query, np.arange(len(asked.names) + 1))
    scores = np.zeros(len(docs), np.int64)
    own = np.diff(first)[queries]
    upto = np.cumsum(own)
    low = 0
    while low < len(docs):
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + CELLS, "right")))
        some = own[low:high]
        step = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
        term = asked.term[np.repeat(first[queries[low:high]], some) + step]
        sought = np.repeat(docs[low:high], some) * size + term
        at = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
        hit = np.where(keys[at] == sought, batch.impact[at], 0)
        total = np.append(0, np.cumsum(hit))
        ends = np.cumsum(some)
        scores[low:high] = total[ends] - total[ends - some]
        low = high
    return scores


def _best(vectors: DataFrame, shared, least: np.ndarray, k: int) -> DataFrame:
    """(query, score, id, _row): the best k rows of each query that each task sees."""

    def look(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, found = shared.value, Found(least, k)
        for block in batches(blocks):
            offsets, term = _lists(block.column("terms"))
            term = term.astype(np.int64)
            impact = asked.weights[term] * _lists(block.column("parts"))[1]
            doc = np.repeat(np.arange(block.num_rows), np.diff(offsets))
            whole = Batch(doc, term, impact, np.asarray(block.column("length")))
            names = block.column("id")
            nameless, name = np.asarray(names.is_null()).astype(np.int64), np.asarray(names.fill_null(0))
            row = np.asarray(block.column("_row"))
            queries, docs, scores = search(asked, whole, found)
            found.add(queries, scores, nameless[docs], name[docs], row[docs])
        query, score, nameless, name, row = found.rows
        columns = [pa.array(query), pa.array(score), pa.array(name, pa.int64(), mask=nameless.astype(bool)), pa.array(row)]
        yield pa.RecordBatch.from_arrays(columns, names=["query", "score", "id", "_row"])

    return vectors.mapInArrow(look, "query long, score long, id long, _row long")


def _top(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "_row")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(spark: SparkSession, terms: DataFrame, asked: Block, n_docs: int, n_words: int, k: int) -> DataFrame:
    """(_query, rank, id, score) of a block's queries."""
    shared = spark.sparkContext.broadcast(asked)
    vectors = written(_vectors(terms, shared, n_docs, n_words), "vectors")
    order = [F.desc("length"), F.col("_row")]
    ranged = vectors.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_bucket", F.spark_partition_id())
    ranged = written(ranged, "norm-buckets")
    buckets = ranged.groupBy("_bucket").agg(F.max("length").alias("length")).orderBy("_bucket").collect()  # a row for each range of the sort

    least, reach = np.zeros(len(asked.names), np.int64), np.sqrt(asked.sizes())
    best, low, many = None, 0, 1
    while low < len(buckets):
        # A vector shorter than this is of use to no query.
        enough = float(np.min(np.where(reach > 0, least / np.maximum(reach, 1), np.inf))) / SLACK
        if buckets[low]["length"] < enough:
            break
        some = buckets[low : low + many]
        here = ranged.where(F.col("_bucket").between(some[0]["_bucket"], some[-1]["_bucket"]) & (F.col("length") >= enough))
        found = _best(here, shared, least, k)
        best = written(_top(found if best is None else found.unionByName(best.drop("rank")), k), "best", slim=True)
        for query, score in best.where(F.col("rank") == k).select("query", "score").collect():  # a row a query of the block
            least[query] = score
        low, many = low + many, many * GROWTH
    if best is None:
        return spark.createDataFrame([], "_query long, rank int, id long, score long")
    name = F.get(F.lit(asked.names.tolist()), F.col("query").cast("int"))
    return best.select(name.alias("_query"), "rank", "id", "score")


def query_blocks(items: DataFrame, limit: int) -> tuple[int, list[int]]:
    """A number by which queries (_row, marks) are dealt to blocks of at most ``limit`` terms, or one query, and the blocks that have any."""
    n = max(1, -(-int(items.agg(F.sum(F.size("marks"))).first()[0] or 0) // limit))
    while True:
        dealt = items.groupBy(F.pmod(F.xxhash64("_row"), F.lit(n)).alias("block")).agg(F.sum(F.size("marks")).alias("terms"), F.count("*").alias("queries"))
        if dealt.where((F.col("terms") > limit) & (F.col("queries") > 1)).isEmpty():
            return n, sorted(r[0] for r in dealt.select("block").collect())
        n *= 2


def ranked_search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", k: int = BEST, block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item, best first, scores above 0."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text")).distinct().withColumn("_row", F.monotonically_increasing_id())
    asked = written(_with_terms(asked, None).where("size(marks) > 0"), "queries")
    vocabulary = written(asked.select(F.explode("marks").alias("mark")).distinct(), "vocabulary", slim=True)
    table = spark.sparkContext.broadcast(bit_table(vocabulary, "mark"))

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.monotonically_increasing_id().alias("_row"), F.col(text).alias("text"))
    terms = written(_with_terms(rows, table), "postings")
    n_docs, n_words = terms.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = written(terms.select(F.explode("marks").alias("mark")).groupBy("mark").agg(F.count("*").alias("df")).join(vocabulary, "mark", "left_semi"), "document-counts", slim=True)

    out, (n, blocks) = None, query_blocks(asked, block_terms)
    for block in blocks:
        own = asked.where(F.pmod(F.xxhash64("_row"), F.lit(n)) == block).select("_row", "marks")
        known = df.join(own.select(F.explode("marks").alias("mark")).distinct(), "mark", "left_semi")
        some = query_block(own.collect(), dict(map(tuple, known.collect())), n_docs)
        if len(some.marks):
            found = _search_block(spark, terms, some, n_docs, n_words, k)
            out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], "_query long, rank int, id long, score long")
    names = asked.select(F.col("_row").alias("_query"), F.col("id").alias("item_id"))
    return out.join(names, "_query").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
