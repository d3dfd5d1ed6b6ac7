"""Benchmark passages in documents, found by winnowing.

A passage of 13 words holds eight grams of 6 words; the least gram hash of every passage is
kept as its fingerprint, on both sides by the same rule, so any shared 13 words share a
fingerprint. Fingerprints are joined and each hit is extended word by word over the 7 words
to either side, which all passages that the fingerprint stands for lie in. Items of fewer
words are fingerprinted as a whole, and documents at the item lengths that occur.

Document fingerprints are first tested against a bit table of fixed size built from the
benchmark's; it lets some through that the join then drops, and none of the others.

Defined cases: null and empty texts have no words, no hits and are clean; items without
words occur nowhere; equal items count each by id; repeated document rows are judged each;
without documents there are no rows, without items every document is clean. Words are
compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import batches, bit_table, in_table, salted_join, written
from headway.llm.words import ALNUM, LOWER, gram_hashes, mix, same_doc, slices, word_hashes, words_of

PASSAGE = 13
GRAM = 6
STEPS = PASSAGE - GRAM + 1  # grams of a passage: 8, which the doubling in winnowed() needs
REACH = PASSAGE - GRAM

_ANCHOR = pa.struct([("print", pa.int64()), ("length", pa.int32()), ("at", pa.int32()), ("near", pa.list_(pa.int64()))])
_ANCHOR_SQL = "struct<print: long, length: int, at: int, near: array<long>>"


def winnowed(grams: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Places of the grams that are least, the last of equals, in some passage within a document."""
    whole = np.flatnonzero(same_doc(doc, PASSAGE))
    if len(whole) == 0:
        return whole
    least, place = grams.copy(), np.arange(len(grams))
    for step in (1, 2, 4):
        later = least[step:] <= least[:-step]
        place = np.where(later, place[step:], place[:-step])
        least = np.where(later, least[step:], least[:-step])
    chosen = np.zeros(len(grams), bool)
    chosen[place[whole]] = True
    return np.flatnonzero(chosen)


def _anchors(hashes: np.ndarray, doc: np.ndarray, lengths: list[int], table: np.ndarray | None) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, prints) of winnowed grams (length 0) and of whole runs of the given lengths, as far as the table has them."""
    out = []
    for length in [0, *lengths]:
        grams = gram_hashes(hashes, length or GRAM)
        places = winnowed(grams, doc) if length == 0 else np.flatnonzero(same_doc(doc, length))
        prints = mix(grams[places] + np.uint64(length))
        if table is not None:
            known = in_table(table, prints)
            places, prints = places[known], prints[known]
        out.append((length, places, prints))
    return out


def _near(hashes: np.ndarray, doc: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The words from REACH before each place to PASSAGE after it; 0 outside the document."""
    at = places[:, None] + np.arange(-REACH, PASSAGE)[None, :]
    inside = (at >= 0) & (at < len(hashes))
    at = np.where(inside, at, 0)
    return np.where(inside & (doc[at] == doc[places][:, None]), hashes[at] | np.uint64(1), np.uint64(0))


def anchored(column: pa.Array, lengths_of, table: np.ndarray | None) -> tuple[np.ndarray, list[list[dict]]]:
    """Word counts and anchors of every text; lengths_of gives the whole-run lengths for a document's word count, or a list for all."""
    counts, rows = [np.zeros(0, np.int64)], []
    for piece in slices(column):
        data = LOWER[piece.data]
        words = words_of(piece, ALNUM, data)
        hashes = word_hashes(data, words)
        counts.append(words.counts())
        found: list[list[dict]] = [[] for _ in range(len(piece.offsets) - 1)]
        lengths = lengths_of if isinstance(lengths_of, list) else sorted(set(words.counts()) & set(range(1, PASSAGE)))
        for length, places, prints in _anchors(hashes, words.doc, [int(x) for x in lengths], table):
            if not isinstance(lengths_of, list) and length:  # an item: only the run that is all of it
                own = words.counts()[words.doc[places]] == length
                places, prints = places[own], prints[own]
            near = _near(hashes, words.doc, places)
            for place, mark, words_near in zip(places.tolist(), prints.view(np.int64).tolist(), near.view(np.int64).tolist(), strict=True):
                doc = int(words.doc[place])
                found[doc].append({"print": mark, "length": length, "at": place - int(words.first[doc]), "near": words_near})
        rows += found
    return np.concatenate(counts).astype(np.int64), rows


def _with_anchors(df: DataFrame, key: str, kind: str, lengths, table) -> DataFrame:
    def find(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value if table is not None else None
        for block in batches(blocks):
            counts, rows = anchored(block.column("_text"), lengths, bits)
            yield pa.RecordBatch.from_arrays([block.column(key), pa.array(counts), pa.array(rows, pa.list_(_ANCHOR))], names=[key, "n_words", "anchors"])

    return df.mapInArrow(find, f"{key} {kind}, n_words long, anchors array<{_ANCHOR_SQL}>")


def decontamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row a document: words, words hit, items found and whether a twentieth of its words is hit."""
    spark = docs.sparkSession
    keep = keep or [doc_id]

    # Items of equal words are looked for once.
    lowered = F.translate(F.coalesce(F.col(item_text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    wording = F.trim(F.regexp_replace(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    items = written(benchmark.select(F.col(item_id).cast("string").alias("item"), wording.alias("wording")).where("wording != ''"), "items")
    texts = items.groupBy("wording").agg(F.xxhash64("wording").alias("h"), F.min("item").alias("rep"))
    members = items.join(texts.select("wording", "rep"), "wording").select("rep", "item").distinct()
    item_anchors = _with_anchors(texts.select("rep", F.col("wording").alias("_text")), "rep", "string", None, None)
    sought = written(item_anchors.select("rep", F.inline("anchors")).distinct(), "item-anchors")
    lengths = sorted(r[0] for r in sought.where("length > 0").select("length").distinct().collect())
    table = spark.sparkContext.broadcast(bit_table(sought, "print"))

    numbered = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    packed = numbered.select(F.struct(*[c for c in numbered.columns if c != "_text"]).alias("_key"), "_text")
    kind = packed.schema["_key"].dataType.simpleString()
    found = _with_anchors(packed, "_key", kind, lengths, table)
    found = written(found.withColumn("_row", F.monotonically_increasing_id()), "document-anchors")

    mine = found.select("_row", F.inline("anchors"))
    theirs = sought.select("print", F.col("rep"), F.col("length").alias("_length"), F.col("near").alias("_near"))
    hits = salted_join(mine, theirs, ["print"], "_row", "inner").where("length = _length")
    equal = F.zip_with("near", "_near", lambda a, b: (a == b) & (a != 0))

    def run(flags):
        """How many true values a list begins with."""
        stop = F.array_position(flags, F.lit(False)).cast("int")
        return F.when(stop > 0, stop - 1).otherwise(F.size(flags))

    hits = hits.select("_row", "rep", "length", "at", equal.alias("equal"))
    before = run(F.reverse(F.slice("equal", 1, REACH)))
    after = run(F.slice("equal", REACH + 1, PASSAGE))
    spans = hits.select("_row", "rep", "length", "at", before.alias("before"), after.alias("after"))
    passage = (F.col("length") == 0) & (F.col("after") >= GRAM) & (F.col("before") + F.col("after") >= PASSAGE)
    whole = (F.col("length") > 0) & (F.col("after") >= F.col("length"))
    low = F.when(whole, F.col("at")).otherwise(F.col("at") - F.col("before"))
    high = F.when(whole, F.col("at") + F.col("length")).otherwise(F.col("at") + F.col("after"))
    spans = written(spans.where(passage | whole).select("_row", "rep", low.alias("low"), high.alias("high")).distinct(), "hits")

    # Spans of a document are as many as its fingerprints at most; their union is counted in order.
    joined = F.aggregate(
        F.sort_array(F.collect_set(F.struct("low", "high"))),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["high"] - F.greatest(a["upto"], s["low"]))).alias("n"), F.greatest(a["upto"], s["high"]).alias("upto")
        ),
        lambda a: a["n"],
    )
    hit_words = spans.select("_row", "low", "high").groupBy("_row").agg(joined.alias("n_hit"))
    named = salted_join(spans.select("_row", "rep").distinct(), members, ["rep"], "_row", "inner")
    listed = named.groupBy("_row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    out = found.select("_row", "_key.*", "n_words").join(hit_words, "_row", "left").join(listed, "_row", "left")
    n_hit, names = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
        "n_words",
        n_hit.alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
