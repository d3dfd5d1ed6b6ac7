"""Toxicity from subword bags: character n-gram vectors, averaged, in a linear softmax.

A word is the bag of its byte n-grams with the word's edges marked; the bag's mean vector
goes through a two-class softmax, and a document is as toxic as its worst word. Labels are
for documents, so training alternates: words of a toxic document share its label by how well
each explains it (noisy or), and vectors and softmax are fitted together to these shares,
every word of a clean document being clean. A misspelling never seen has most n-grams of the
word it distorts.

Training reads a sample of labelled rows, ``sample_rows`` expected (fewer if there are
fewer), in one task; scoring reads everything. Scores use a table of fixed size.

Defined cases: null and empty texts score 0; null ids count as the empty text in the split;
rows labelled null are not learnt from and of repeated labels the greatest counts; without
toxic labels all scores are 0; repeated rows score alike; no documents give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import batches, written
from headway.llm.words import ALNUM, LOWER, slices, word_hashes, words_of

SAMPLE_ROWS = 12_000
TABLE_BITS = 18
SIZE = 8
GRAMS = (3, 4, 5, 6)
ROUNDS = 4
STEPS = 40
RATE = 0.08
DECAY = 1e-7
THRESHOLD = 0.7
SLICE = 2 << 20  # words repeat more in longer slices

_EDGES = (np.uint8(0x3C), np.uint8(0x3E))


def gram_slots(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table slots of all n-grams of the words, word after word, and where each word's begin."""
    sizes = ends - starts + 2
    begin = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.empty(begin[-1], np.uint8)
    word = np.repeat(np.arange(len(sizes)), sizes)
    inner = np.arange(begin[-1]) - begin[word]
    edge = (inner == 0) | (inner == sizes[word] - 1)
    flat[~edge] = data[(starts[word] + inner - 1)[~edge]]
    flat[begin[:-1]], flat[begin[1:] - 1] = _EDGES
    left = sizes[word] - inner
    parts, owners = [], []
    code = np.zeros(len(flat), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        letters = np.zeros(len(flat), np.uint64)
        letters[: len(flat) - n + 1] = flat[n - 1 :]
        code = (code ^ letters) * np.uint64(0x100000001B3) + np.uint64(n)
        if n in GRAMS:
            fits = left >= n
            parts.append(((code[fits] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int32))
            owners.append(word[fits].astype(np.int32))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(parts)[order], np.searchsorted(owner[order], np.arange(len(sizes) + 1))


def _means(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return (total[begin[1:]] - total[begin[:-1]]) / np.maximum(1, np.diff(begin))


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Bags:
    """Distinct words of the sample, and which documents have them."""

    def __init__(self):
        self.number: dict[int, int] = {}
        self.texts: list[bytes] = []
        self.clean: dict[int, int] = {}
        self.toxic: list[np.ndarray] = []
        self.n_clean = 0

    def add(self, column: pa.Array, toxic: np.ndarray) -> None:
        for piece in slices(column):
            data = LOWER[piece.data]
            words = words_of(piece, ALNUM, data)
            hashes = word_hashes(data, words)
            for doc in range(len(piece.offsets) - 1):
                low, high = words.first[doc], words.first[doc + 1]
                found, at = np.unique(hashes[low:high], return_index=True)
                ids = np.empty(len(found), np.int64)
                for i, (h, place) in enumerate(zip(found.tolist(), (at + low).tolist(), strict=True)):
                    number = self.number.setdefault(h, len(self.texts))
                    if number == len(self.texts):
                        self.texts.append(data[words.starts[place] : words.ends[place]].tobytes())
                    ids[i] = number
                if toxic[piece.first + doc]:
                    self.toxic.append(ids)
                else:
                    self.n_clean += 1
                    for number in ids.tolist():
                        self.clean[number] = self.clean.get(number, 0) + 1


def train(bags: Bags, seed: int = 3) -> tuple[np.ndarray, float]:
    """The score of each n-gram slot under the softmax, and the offset; fitted jointly."""
    words = len(bags.texts)
    if not bags.toxic or words == 0:
        return np.zeros(1 << TABLE_BITS, np.float32), -40.0
    sizes = np.array([len(t) for t in bags.texts])
    ends = np.cumsum(sizes)
    slots, begin = gram_slots(np.frombuffer(b"".join(bags.texts), np.uint8), ends - sizes, ends)
    share = np.repeat(1 / np.diff(begin), np.diff(begin))
    clean = np.zeros(words)
    clean[list(bags.clean)] = list(bags.clean.values())
    pair_word = np.concatenate(bags.toxic)
    pair_doc = np.repeat(np.arange(len(bags.toxic)), [len(x) for x in bags.toxic])
    in_toxic = np.bincount(pair_word, minlength=words)

    # Words of toxic documents only, the more of these the better, explain first.
    p = np.clip(in_toxic / (in_toxic + clean * max(1.0, len(bags.toxic) / max(1, bags.n_clean)) + 3.0), 1e-6, 0.999)
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (1 << TABLE_BITS, SIZE))
    softmax = rng.normal(0, 0.5, (2, SIZE))
    offset = -4.0
    state = [np.zeros_like(vectors), np.zeros_like(vectors), np.zeros_like(softmax), np.zeros_like(softmax), 0.0, 0.0]
    step = 0
    for _ in range(ROUNDS):
        none = np.bincount(pair_doc, np.log1p(-np.minimum(p[pair_word], 0.999)), len(bags.toxic))
        blame = np.minimum(1.0, p[pair_word] / np.maximum(1e-9, 1 - np.exp(none))[pair_doc])
        blame = blame / np.maximum(1.0, np.bincount(pair_doc, blame, len(bags.toxic)))[pair_doc]
        # A toxic document spreads at most one unit over its words.
        guilty = np.bincount(pair_word, blame, words)
        weight = clean + in_toxic
        target = np.clip(guilty / np.maximum(weight, 1e-9), 0, 1)
        target = np.where(in_toxic > 0, np.where(guilty >= 0.5, np.maximum(target, in_toxic / (in_toxic + 3 * clean)), target), 0)
        total = weight.sum()
        for _ in range(STEPS):
            step += 1
            along = softmax[1] - softmax[0]
            z = _means((vectors @ along)[slots], begin) + offset
            wrong = weight * (_logistic(z) - target) / total * 1000
            pull = np.bincount(slots, np.repeat(wrong, np.diff(begin)) * share, 1 << TABLE_BITS)
            lean = pull @ vectors
            grads = [pull[:, None] * along[None, :] + DECAY * vectors, np.stack([-lean, lean]), wrong.sum()]
            fix1, fix2 = 1 - 0.9**step, 1 - 0.99**step
            moves = []
            for k, grad in enumerate(grads):
                state[2 * k] = 0.9 * state[2 * k] + 0.1 * grad
                state[2 * k + 1] = 0.99 * state[2 * k + 1] + 0.01 * grad * grad
                moves.append(RATE * (state[2 * k] / fix1) / (np.sqrt(state[2 * k + 1] / fix2) + 1e-8))
            vectors, softmax, offset = vectors - moves[0], softmax - moves[1], offset - moves[2]
        p = np.clip(_logistic(_means((vectors @ (softmax[1] - softmax[0]))[slots], begin) + offset), 1e-6, 0.999)
    return (vectors @ (softmax[1] - softmax[0])).astype(np.float32), float(offset)


def worst_words(column: pa.Array, table: np.ndarray, offset: float) -> np.ndarray:
    """The score of the worst word of every text; 0 without words."""
    out = [np.zeros(0)]
    for piece in slices(column, SLICE):
        data = LOWER[piece.data]
        words = words_of(piece, ALNUM, data)
        scores = np.zeros(len(piece.offsets) - 1)
        if len(words.doc):
            _, at, back = np.unique(word_hashes(data, words), return_index=True, return_inverse=True)
            slots, begin = gram_slots(data, words.starts[at], words.ends[at])
            z = _means(table[slots], begin) + offset
            has = words.counts() > 0
            scores[has] = _logistic(np.maximum.reduceat(z[back], words.first[:-1][has]))
        out.append(scores)
    return np.concatenate(out)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The model as a written table of parts: one task, given a bounded sample, makes it."""
    marks = labels.where("toxic IS NOT NULL").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = marks.count()
    share = int(min(1.0, sample_rows / max(1, n)) * (1 << 30))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share
    texts = docs.select("doc_id", "text").where(drawn & F.col("text").isNotNull())
    sample = texts.join(marks.where(drawn), "doc_id").select("doc_id", "text", "toxic")

    def learn(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags = Bags()
        for block in batches(blocks):
            bags.add(block.column("text"), np.asarray(block.column("toxic")) == 1)
        table, offset = train(bags)
        yield pa.RecordBatch.from_arrays([pa.array([table.tobytes()], pa.binary()), pa.array([offset])], names=["grams", "bias"])

    ordered = sample.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    return written(ordered.mapInArrow(learn, "grams binary, bias double"), "toxicity-model")


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row a document: whether its label may not be learnt from, score and prediction."""
    spark = docs.sparkSession
    model = fit(docs, labels, sample_rows).first()
    # Without a row to learn from there may be no task and so no model: as without toxic labels.
    known = (np.frombuffer(model["grams"], np.float32), model["bias"]) if model else train(Bags())
    shared = spark.sparkContext.broadcast(known)

    def rate(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, offset = shared.value
        for block in batches(blocks):
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(worst_words(block.column("text"), table, offset))], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(rate, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
