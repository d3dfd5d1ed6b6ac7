"""Importance resampling towards a target's word distribution.

Features are runs of words, hashed by crc32 into buckets. How often every bucket occurs in the
documents and in the target gives each bucket a gain, floor(1000 * log ratio) with one added
to every count; a document's weight is the sum of its features' gains, read from one array of
gains. A Gumbel draw from the document's id is added, so the highest scores are a sample
without replacement whose odds are the weights.

The highest scores are found without sorting all: a composite key (score, id, text, row) orders
the candidates strictly; rows drawn at random become pivots, exact counts of the rows before
and at each pivot tell between which two the last winner lies, and the search goes on there.
A round's survivors are a written table of about a PIVOTS-th of the last. Only winners are sorted,
by ranges, and ranked.

Defined cases: null and empty texts have no features, weight 0 and too few words to be drawn;
a null id draws as the empty text and comes after all ids of equal score; of rows equal in
score and id the lesser hash of the text comes first, equal rows are drawn one by one; an empty
target gives every bucket its smoothed gain; no documents give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import batches, written
from headway.llm.words import ALNUM, LOWER, Slice, Words, gram_hashes, same_doc, slices, word_hashes, words_of

BUCKETS = 10_000
LONGEST = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
PIVOTS = 31
SLICE = 1 << 20  # words repeat more in longer slices


def feature_buckets(piece: Slice, buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray, Words]:
    """Bucket and document of every feature of a slice, and its words.

    A run's crc32 is taken once for each different run of the slice.
    """
    data = LOWER[piece.data]
    words = words_of(piece, ALNUM, data)
    hashes = word_hashes(data, words)
    raw = data.tobytes()
    found, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in range(1, longest + 1):
        places = np.flatnonzero(same_doc(words.doc, n))
        _, at, back = np.unique(gram_hashes(hashes, n)[places], return_index=True, return_inverse=True)
        runs = [b" ".join(raw[words.starts[p + i] : words.ends[p + i]] for i in range(n)) for p in places[at].tolist()]
        numbers = np.fromiter((zlib.crc32(run) % buckets for run in runs), np.int64, len(runs))
        found.append(numbers[back])
        owners.append(words.doc[places])
    return np.concatenate(found), np.concatenate(owners), words


def bucket_counts(docs: DataFrame, text: str, buckets: int, longest: int) -> np.ndarray:
    """How often each bucket occurs in all texts; a task sends one row a bucket at most."""

    def count(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for block in batches(blocks):
            for piece in slices(block.column(0), SLICE):
                total += np.bincount(feature_buckets(piece, buckets, longest)[0], minlength=buckets)
        has = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(total[has])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    parts = docs.select(F.col(text)).mapInArrow(count, "bucket long, n long")
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():  # as many rows as buckets
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of each bucket's smoothed share in the target over that in the source."""
    buckets, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    ratios = ((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets)) for s, t in zip(source.tolist(), target.tolist(), strict=True))
    return np.fromiter((math.floor(1000 * math.log(r)) for r in ratios), np.int64, buckets)


def weighed(docs: DataFrame, table: np.ndarray, doc_id: str, text: str, longest: int) -> DataFrame:
    """(doc_id, _text, n_words, n_features, weight) of every row; _text is a hash that settles ties."""
    kind = docs.schema[doc_id].dataType.simpleString()
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("_text"), F.col(text).alias("text"))

    def weigh(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches(blocks):
            parts = [np.zeros((3, 0), np.int64)]
            for piece in slices(block.column("text"), SLICE):
                numbers, owners, words = feature_buckets(piece, len(table), longest)
                size = len(piece.offsets) - 1
                weight = np.bincount(owners, table[numbers], size).astype(np.int64)  # whole numbers far below 2 ** 53
                parts.append(np.stack([words.counts(), np.bincount(owners, minlength=size), weight]))
            n_words, n_features, weight = np.concatenate(parts, 1)
            columns = [block.column("doc_id"), block.column("_text"), pa.array(n_words), pa.array(n_features), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "_text", "n_words", "n_features", "weight"])

    return picked.mapInArrow(weigh, f"doc_id {kind}, _text long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(-1000 * ln(-ln(u))) of a uniform u that the id and the seed decide."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def _literal(key, schema) -> Column:
    return F.struct(*[F.lit(key[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields])


def kth_key(keys: DataFrame, k: int, pivots: int = PIVOTS):
    """The k-th least of a column ``key`` of different structs (k from 1), by distributed quickselect.

    Each round draws pivots by a hash of the key, counts the rows before every pivot in one
    pass and keeps the rows between two of them; a handful of rows and counts reach the driver.
    """
    schema = keys.schema["key"].dataType
    rows, turn = keys, 0
    while True:
        drawn = rows.orderBy(F.xxhash64("key", F.lit(turn)), "key").limit(pivots).collect()
        marks = sorted((r["key"] for r in drawn), key=lambda key: tuple((v is not None, v) for v in key))
        # Before, at and after: a key occurs once, so "at" is one row and "after" is all others.
        counts = rows.agg(*[F.count_if(F.col("key") < _literal(m, schema)).alias(f"c{i}") for i, m in enumerate(marks)]).first()
        below = [counts[i] for i in range(len(marks))]
        for mark, n in zip(marks, below, strict=True):
            if n == k - 1:
                return mark
        low = max((i for i, n in enumerate(below) if n < k), default=None)
        high = min((i for i, n in enumerate(below) if n >= k), default=None)
        if low is not None:
            rows = rows.where(F.col("key") > _literal(marks[low], schema))
            k -= below[low] + 1
        if high is not None:
            rows = rows.where(F.col("key") < _literal(marks[high], schema))
        rows, turn = written(rows, "quickselect", slim=True), turn + 1


def ranked(winners: DataFrame, key: str, name: str) -> DataFrame:
    """Adds ranks from 1 by a column of different structs: rows are sorted by ranges, a range's rank starts after those before it."""
    placed = written(winners.repartitionByRange(key).withColumn("_part", F.spark_partition_id()), "winners")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy(key)
    return placed.withColumn("_nth", F.row_number().over(inside)).join(starts, "_part").withColumn(name, F.col("_start") + F.col("_nth")).drop("_part", "_nth", "_start")


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    seed: int = SEED,
) -> DataFrame:
    """One row a document: doc_id, n_features, weight, score and, if it is drawn, its rank."""
    table = gains(bucket_counts(docs, text, buckets, longest), bucket_counts(target, target_text, buckets, longest))
    rows = weighed(docs, table, doc_id, text, longest).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "weighed")
    key = F.struct((-F.col("score")).alias("worse"), F.col("doc_id").isNull().alias("nameless"), "doc_id", "_text", "_row")

    fits = rows.where(F.col("n_words") >= min_words)
    k = percent * fits.count() // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if k == 0:
        return rows.select(*columns, none)
    keyed = rows.withColumn("key", key)
    last = _literal(kth_key(fits.select(key.alias("key")), k), keyed.schema["key"].dataType)
    drawn = (F.col("n_words") >= min_words) & (F.col("key") <= last)
    winners = ranked(keyed.where(drawn).select(*columns, "key"), "key", "rank")
    return keyed.where(~drawn).select(*columns, none).unionByName(winners.select(*columns, "rank"))
