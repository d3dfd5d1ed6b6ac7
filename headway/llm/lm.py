"""Scores of texts under a context-mixing model of their bytes, and under a unigram base.

The corpus gives counts of words and of byte 5-grams. From the 5-grams every hashed context
(the last 0 to 4 bytes with the bits of the byte known so far) gets counts of its next bit; a
gated mixer, one weight set for each partial byte, adds the predictors' log odds. It learns
online over the 5-grams, each predicted from counts without itself, in all partitions at
once, whose weights are averaged. A table over the last byte and the mixed odds then corrects
the mix by what came true. Bits of a text add up to its log probability, the end included.

A byte's cost depends on its last four bytes and itself, so it is computed once for each
such run that a partition meets.

Defined cases: a null text is empty and has its end only; null ids count as the empty text in
the split; repeated rows score alike and each; without training rows every token is worth
log10 1 under the base and every bit a half; without documents there are no rows. Words are
compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import batches, written
from headway.llm.quality import bin_of
from headway.llm.words import LOWER, NOT_SPACE, Slice, mix, slices, word_hashes, words_of

ORDERS = 5
SLOT_BITS = 22
BLOCK_BITS = 12
ODDS_BINS = 33
COMMON_WORDS = 1 << 20
MEMO_BITS = 21
END = 0xFF  # not a byte of UTF-8
RATE = 0.1
SLICE = 1 << 20  # runs and words repeat more in longer slices

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _grams(piece: Slice) -> tuple[np.ndarray, np.ndarray]:
    """The 5-gram that ends at each byte of each text and at its end, and where each text's begin."""
    docs = len(piece.offsets) - 1
    sizes = np.diff(piece.offsets)
    flat = np.full(len(piece.data) + (ORDERS) * docs, END, np.uint8)
    begin = piece.offsets[:-1] + ORDERS * np.arange(docs) + ORDERS - 1
    shift = np.repeat(begin - piece.offsets[:-1], sizes)
    flat[np.arange(len(piece.data)) + shift] = LOWER[piece.data]
    wide = flat.astype(np.uint64)
    code = wide[ORDERS - 1 :].copy() if docs else np.zeros(0, np.uint64)
    for back in range(1, ORDERS):
        code |= wide[ORDERS - 1 - back : len(wide) - back] << np.uint64(8 * back)
    counted = np.repeat(begin - (ORDERS - 1), sizes + 1) + _within(sizes + 1)
    return code[counted], np.concatenate([[0], np.cumsum(sizes + 1)])


def _within(sizes: np.ndarray) -> np.ndarray:
    """0 .. size-1 for each size in turn."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


class Memo:
    """A table of fixed size from keys to places; keys that meet a taken place stay outside."""

    def __init__(self):
        self.keys = np.full(1 << MEMO_BITS, _NONE, np.uint64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each key's place, whether it is there, and the new keys that were entered."""
        place = (mix(keys) >> np.uint64(64 - MEMO_BITS)).astype(np.int64)
        hit = self.keys[place] == keys
        if hit.all():
            return place, hit, keys[:0]
        new = np.unique(keys[~hit])
        at = (mix(new) >> np.uint64(64 - MEMO_BITS)).astype(np.int64)
        free = self.keys[at] == _NONE
        self.keys[at[free]] = new[free]
        hit = self.keys[place] == keys
        return place, hit, new[free][self.keys[at[free]] == new[free]]


def corpus_counts(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, key, n) of a partition: words by hash (kind 0), byte 5-grams (1) and the number of texts (2)."""
    memo, seen = Memo(), np.zeros(1 << MEMO_BITS, np.int64)
    words: list[tuple[np.ndarray, np.ndarray]] = []
    held, texts = 0, 0
    for block in batches(blocks):
        for piece in slices(block.column(0), SLICE):
            texts += len(piece.offsets) - 1
            keys, _ = _grams(piece)
            place, hit, _ = memo.find(keys)
            seen += np.bincount(place[hit], minlength=len(seen))
            if not hit.all():
                yield _rows(1, *np.unique(keys[~hit], return_counts=True))
            data = LOWER[piece.data]
            words.append(np.unique(word_hashes(data, words_of(piece, NOT_SPACE, data)), return_counts=True))
            held += len(words[-1][0])
            if held > 3_000_000:
                words = [_added(words)]
                held = len(words[0][0])
                if held > 1_500_000:
                    yield _rows(0, *words[0])
                    words, held = [], 0
    if words:
        yield _rows(0, *_added(words))
    used = np.flatnonzero(seen)
    yield _rows(1, memo.keys[used], seen[used])
    yield _rows(2, np.zeros(1, np.uint64), np.array([texts]))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def _rows(kind: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(keys), kind, np.int8)), pa.array(keys.astype(np.uint64).view(np.int64)), pa.array(counts.astype(np.int64))], names=["kind", "key", "n"]
    )


def bit_slots(keys: np.ndarray, bit: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For a bit of the last byte of each 5-gram: a slot for each order, the partial byte, the bit."""
    byte = (keys & np.uint64(0xFF)).astype(np.int64)
    node = (1 << bit) | (byte >> (8 - bit))
    value = (byte >> (7 - bit)) & 1
    out = []
    for order in range(ORDERS):
        known = (keys >> np.uint64(8)) & np.uint64((1 << (8 * order)) - 1)
        code = mix((known << np.uint64(12)) | (node.astype(np.uint64) << np.uint64(3)) | np.uint64(order))
        out.append((code >> np.uint64(64 - SLOT_BITS)).astype(np.int64))
    return out, node, value


def _slot_counts(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Zeros and ones of every slot, in blocks of slots."""
    ones, zeros = np.zeros(1 << SLOT_BITS), np.zeros(1 << SLOT_BITS)
    for block in blocks:
        keys, n = np.asarray(block.column("key")).view(np.uint64), np.asarray(block.column("n")).astype(float)
        for bit in range(8):
            places, _, value = bit_slots(keys, bit)
            for place in places:
                ones += np.bincount(place, n * value, len(ones))
                zeros += np.bincount(place, n * (1 - value), len(zeros))
    pair = np.stack([zeros, ones], 1).reshape(-1, 2 << BLOCK_BITS)
    used = np.flatnonzero(pair.any(1))
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([pair[i].astype(np.float64).tobytes() for i in used], pa.binary())], names=["block", "counts"])


def _add_blocks(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(2 << BLOCK_BITS)
    for part in parts:
        for counts in part.column("counts"):
            total += np.frombuffer(counts.as_py())
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["block", "counts"])


def _stretched(counts: np.ndarray, place: np.ndarray, less: np.ndarray | None = None) -> np.ndarray:
    """Log odds of a one; less: the bit of an example that the counts hold, to be left out."""
    zeros, ones = counts[place, 0].astype(float), counts[place, 1].astype(float)
    if less is not None:
        zeros, ones = np.maximum(0, zeros - (1 - less)), np.maximum(0, ones - less)
    return np.log((ones + 0.3) / (zeros + 0.3))


def _mixer(counts, blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights after one online pass over a partition's 5-grams, and how many bytes they saw."""
    weights = np.full((256, ORDERS), 1 / ORDERS)
    drift = np.full((256, 1), 1e-6)
    total = 0.0
    for block in batches(blocks, 256):
        keys, n = np.asarray(block.column("key")).view(np.uint64), np.asarray(block.column("n")).astype(float)
        total += n.sum()
        for bit in range(8):
            places, node, value = bit_slots(keys, bit)
            inputs = np.stack([_stretched(counts.value, p, value) for p in places], 1)
            wrong = (value - 1 / (1 + np.exp(-np.clip((weights[node] * inputs).sum(1), -30, 30)))) * n
            push = np.stack([np.bincount(node, wrong * inputs[:, o], 256) for o in range(ORDERS)], 1)
            mass = np.maximum(1.0, np.bincount(node, n, 256))[:, None]
            push /= mass
            drift += (push**2).sum(1, keepdims=True)
            weights += RATE * push / np.sqrt(drift) * (push != 0)
    yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([weights.tobytes()], pa.binary())], names=["total", "weights"])


def _corrections(counts, weights: np.ndarray, blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ones and all by last byte and bin of the mixed odds."""
    ones, every = np.zeros(256 * ODDS_BINS), np.zeros(256 * ODDS_BINS)
    for block in batches(blocks, 65536):
        keys, n = np.asarray(block.column("key")).view(np.uint64), np.asarray(block.column("n")).astype(float)
        before = ((keys >> np.uint64(8)) & np.uint64(0xFF)).astype(np.int64)
        for bit in range(8):
            places, node, value = bit_slots(keys, bit)
            odds = sum(weights[node, o] * _stretched(counts.value, p, value) for o, p in enumerate(places))
            at = before * ODDS_BINS + _bin(odds)
            ones += np.bincount(at, n * value, len(ones))
            every += np.bincount(at, n, len(every))
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(ones))), pa.array(ones), pa.array(every)], names=["at", "ones", "every"])


def _bin(odds: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(odds * 2) + ODDS_BINS // 2, 0, ODDS_BINS - 1).astype(np.int64)


def byte_costs(keys: np.ndarray, counts: np.ndarray, weights: np.ndarray, refined: np.ndarray) -> np.ndarray:
    """Bits of the last byte of each 5-gram."""
    cost = np.zeros(len(keys))
    before = ((keys >> np.uint64(8)) & np.uint64(0xFF)).astype(np.int64)
    for bit in range(8):
        places, node, value = bit_slots(keys, bit)
        odds = sum(weights[node, o] * _stretched(counts, p) for o, p in enumerate(places))
        p = (1 / (1 + np.exp(-np.clip(odds, -30, 30))) + refined[before * ODDS_BINS + _bin(odds)]) / 2
        cost -= np.log2(np.where(value == 1, p, 1 - p))
    return cost


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 10 == 0


class Model:
    """What scoring needs of the corpus: fixed-size bit tables, the commonest words, totals; all word counts stay a table."""

    def __init__(self, docs: DataFrame):
        spark = docs.sparkSession
        learnt = docs.where(~held_out(F.col("doc_id"))).select(F.coalesce("text", F.lit("")).alias("text"))
        counted = learnt.mapInArrow(corpus_counts, "kind byte, key long, n long")
        found = written(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "corpus-counts", slim=True)
        self.words = found.where("kind = 0").select("key", "n")
        tokens, distinct = self.words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        ends = found.where("kind = 2").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        self.ends, self.tokens, self.distinct = ends, tokens + ends, distinct + (ends > 0)

        grams = found.where("kind = 1").select("key", "n")
        blocks = grams.mapInArrow(_slot_counts, "block int, counts binary").groupBy("block").applyInArrow(_add_blocks, "block int, counts binary")
        counts = np.zeros((1 << (SLOT_BITS - BLOCK_BITS), 2 << BLOCK_BITS), np.float32)
        for block, blob in blocks.toLocalIterator():
            counts[block] = np.frombuffer(blob, np.float32)
        self.counts = spark.sparkContext.broadcast(counts.reshape(-1, 2))

        shared = self.counts
        taught = grams.mapInArrow(lambda b: _mixer(shared, b), "total double, weights binary").where("total > 0").collect()
        weights, total = np.full((256, ORDERS), 1 / ORDERS), sum(r["total"] for r in taught)
        if taught:
            weights = sum(np.frombuffer(r["weights"]).reshape(256, ORDERS) * (r["total"] / total) for r in taught)
        self.weights = weights
        seen = grams.mapInArrow(lambda b: _corrections(shared, weights, b), "at long, ones double, every double")
        odds = (np.tile(np.arange(ODDS_BINS), 256) - ODDS_BINS // 2) / 2
        prior = 1 / (1 + np.exp(-odds))
        self.refined = prior.copy()
        for at, ones, every in seen.groupBy("at").agg(F.sum("ones"), F.sum("every")).collect():
            self.refined[at] = (ones + 4 * prior[at]) / (every + 4)
        self.refined = np.clip(self.refined, 1e-6, 1 - 1e-6)

        # Words from the least bin of counts on that leaves at most COMMON_WORDS; none if one bin has more.
        sized = self.words.withColumn("bin", bin_of(F.col("n")))
        least, total = 1 << 30, 0
        for row in sorted(sized.groupBy("bin").count().collect(), key=lambda r: -r["bin"]):
            total += row["count"]
            if total > COMMON_WORDS:
                break
            least = row["bin"]
        common = sized.where(F.col("bin") >= least).select("key", "n").toArrow()
        keys = common.column("key").to_numpy()
        order = np.argsort(keys)
        self.common = spark.sparkContext.broadcast((keys[order], common.column("n").to_numpy()[order]))


def lm_scores(docs: DataFrame) -> DataFrame:
    """One row a document: tokens, known tokens, the base's and the model's log10 probability."""
    model = Model(docs)
    shared, weights, refined, common = model.counts, model.weights, model.refined, model.common
    below = model.tokens + 0.1 * (model.distinct + 1)
    end_known, end_score = int(model.ends > 0), math.log10((model.ends + 0.1) / below)

    def score(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, cost = Memo(), np.zeros(1 << MEMO_BITS)
        keys, counts = common.value
        worth = np.log10((counts + 0.1) / below)
        for block in batches(blocks):
            out: dict[str, list] = {c: [np.zeros(0)] for c in ("n", "known", "base", "score")}
            rest: list[np.ndarray] = []
            for piece in slices(block.column("text"), SLICE):
                grams, begin = _grams(piece)
                place, hit, new = memo.find(grams)
                if len(new):
                    cost[(mix(new) >> np.uint64(64 - MEMO_BITS)).astype(np.int64)] = byte_costs(new, shared.value, weights, refined)
                bits = cost[place]
                if not hit.all():
                    odd, back = np.unique(grams[~hit], return_inverse=True)
                    bits[~hit] = byte_costs(odd, shared.value, weights, refined)[back]
                out["score"].append(_sums(bits, begin) * -math.log10(2))
                data = LOWER[piece.data]
                words = words_of(piece, NOT_SPACE, data)
                hashes = word_hashes(data, words).view(np.int64)
                at = np.minimum(np.searchsorted(keys, hashes), max(0, len(keys) - 1))
                met = keys[at] == hashes if len(keys) else np.zeros(len(hashes), bool)
                value = worth[at] * met if len(keys) else np.zeros(len(hashes))
                out["n"].append(words.counts() + 1)
                out["known"].append(_sums(met, words.first) + end_known)
                out["base"].append(_sums(value, words.first) + end_score)
                left, owner = hashes[~met], words.doc[~met]
                rest += np.split(left, np.searchsorted(owner, np.arange(1, len(piece.offsets) - 1))) if len(piece.offsets) > 1 else []
            whole = {c: np.concatenate(x) for c, x in out.items()}
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    pa.array(whole["n"].astype(np.int64)),
                    pa.array(whole["known"].astype(np.int64)),
                    pa.array(whole["base"].astype(float)),
                    pa.array(whole["score"].astype(float)),
                    pa.array(rest, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score", "rest"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double, rest array<long>"
    scored = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(score, fields)
    scored = written(scored.withColumn("_row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("_row", F.explode("rest").alias("key")).groupBy("_row", "key").agg(F.count("*").alias("times"))
    seen = F.coalesce("n", F.lit(0))
    each = rare.join(model.words, "key", "left")
    tail = each.groupBy("_row").agg(
        F.sum(F.col("times") * F.log10((seen + 0.1) / F.lit(below))).alias("more"), F.sum(F.when(seen > 0, F.col("times")).otherwise(0)).alias("also")
    )
    joined = scored.drop("rest").join(tail, "_row", "left")
    return joined.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(int(model.tokens)).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        "score",
    )


def _sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums of the values from each beginning to the next; 0 where these are equal."""
    out = np.zeros(len(begin) - 1)
    some = begin[1:] > begin[:-1]
    if some.any():
        out[some] = np.add.reduceat(values.astype(np.float64), begin[:-1][some])
    return out
