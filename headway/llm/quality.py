"""Quality rules whose limits come from the corpus: quantile sketches per language and source.

Each document gets counts from its whole text (n_echo_words: words equal to the one before).
Five ratios of them go into histograms with
eight bins an octave, which merge by addition, so a sketch of any group is a sum. A limit is
a quartile moved by three interquartile ranges, at least by a fixed slack; groups of few
documents take the sketch of their language, or of everything.

Defined cases: null and empty texts have no words and fail the base rule; null languages and
sources are groups of their own; equal rows are judged alike; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import batches, salted_join, written
from headway.llm.words import NOT_SPACE, gram_hashes, mix, same_doc, slices, word_hashes, words_of

WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Ratio, numerator, denominator, scale, least move of the lower and upper limit (None: no limit).
RATIOS = [
    ("mean_length", "word_chars", "n_words", 100, 200, 400),
    ("symbols", "n_symbols", "n_words", 1000, None, 150),
    ("dup_lines", "n_dup_lines", "n_lines", 1000, None, 400),
    ("repeats", "n_repeat_words", "n_words", 1000, None, 300),
    ("echoes", "n_echo_words", "n_words", 1000, None, 150),
]
MIN_GROUP = 200
SPREAD = 3

COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_echo_words"]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_NOT_NEWLINE = np.ones(256, bool)
_NOT_NEWLINE[0x0A] = False


def text_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of every text of a column."""
    parts: dict[str, list[np.ndarray]] = {name: [np.zeros(0, np.int64)] for name in COUNTS}
    for piece in slices(column):
        data, offsets = piece.data, piece.offsets
        words = words_of(piece, NOT_SPACE)

        def per_doc(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0], np.cumsum(flags)])[at])

        inside = NOT_SPACE[data]
        parts["n_words"].append(words.counts())
        parts["word_chars"].append(per_doc(inside & ((data & 0xC0) != 0x80), offsets))
        parts["n_symbols"].append(per_doc(_SYMBOL[data], offsets))
        hashes = word_hashes(data, words)
        parts["n_repeat_words"].append(per_doc(_repeated(hashes, words.doc), words.first))
        echo = np.zeros(len(hashes), bool)
        if len(hashes):
            echo[1:] = (hashes[1:] == hashes[:-1]) & same_doc(words.doc, 2)
        parts["n_echo_words"].append(per_doc(echo, words.first))

        lines = words_of(piece, _NOT_NEWLINE)
        seen = np.concatenate([[0], np.cumsum(inside)])
        worded = seen[lines.ends] > seen[lines.starts]
        key = mix(word_hashes(data, lines) + mix(lines.doc.astype(np.uint64)))[worded]
        doc = lines.doc[worded]
        _, first = np.unique(key, return_index=True)
        n_lines = np.bincount(doc, minlength=len(offsets) - 1)
        parts["n_lines"].append(n_lines)
        parts["n_dup_lines"].append(n_lines - np.bincount(doc[first], minlength=len(offsets) - 1))
    return {name: np.concatenate(found).astype(np.int64) for name, found in parts.items()}


def _repeated(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Words inside a window that its document has twice or more."""
    covered = np.zeros(len(hashes), bool)
    whole = same_doc(doc, WINDOW_WORDS)
    if not whole.any():
        return covered
    places = np.flatnonzero(whole)
    key = mix(gram_hashes(hashes, WINDOW_WORDS)[places] + mix(doc[places].astype(np.uint64)))
    order = np.argsort(key)
    ranked = key[order]
    again = np.zeros(len(key), bool)
    again[order[1:]] |= ranked[1:] == ranked[:-1]
    again[order[:-1]] |= ranked[1:] == ranked[:-1]
    for i in range(WINDOW_WORDS):
        covered[places[again] + i] = True
    return covered


def counted(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns and the counts of the whole text."""
    names = [f"_k{i}" for i in range(len(keep))]
    picked = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], F.col(text).alias("_text"))
    fields = [f"`{n}` {picked.schema[n].dataType.simpleString()}" for n in names] + [f"{c} long" for c in COUNTS]

    def count(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches(blocks):
            found = text_counts(block.column("_text"))
            yield pa.RecordBatch.from_arrays([*(block.column(n) for n in names), *(pa.array(found[c]) for c in COUNTS)], names=[*names, *COUNTS])

    out = picked.mapInArrow(count, ", ".join(fields))
    return out.withColumnsRenamed(dict(zip(names, keep, strict=True)))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def bin_of(value: Column) -> Column:
    """Bin of a whole number from 0: itself below 16, then eight bins an octave."""
    octave = (F.length(F.bin(value)) - 4).cast("int")
    return F.when(value < 16, value).otherwise(octave * 8 + F.call_function("shiftright", value, octave))


def bin_edge(number: Column, upper: bool) -> Column:
    """Least or greatest value of a bin."""
    octave = F.floor(number / 8) - 1
    least = (8 + number % 8) * F.pow(F.lit(2), octave).cast("long")
    width = F.pow(F.lit(2), octave).cast("long")
    return F.when(number < 16, number).otherwise(least + width - 1 if upper else least)


def ratio(numerator: str, denominator: str, scale: int) -> Column:
    return F.when(F.col(denominator) > 0, F.expr(f"{numerator} * {scale} DIV {denominator}"))


def sketches(found: DataFrame) -> DataFrame:
    """Bin counts of each ratio for (lang, source), (lang) and all documents that pass the base rule."""
    values = F.array(*[F.struct(F.lit(name).alias("ratio"), ratio(top, below, scale).alias("value")) for name, top, below, scale, _, _ in RATIOS])
    each = found.where(~base_failed()).select("lang", "source", F.inline(values)).where("value IS NOT NULL")
    fine = each.withColumn("bin", bin_of(F.col("value"))).groupBy("lang", "source", "ratio", "bin").agg(F.count("*").alias("n"))
    fine = fine.withColumn("level", F.lit(0))
    by_lang = fine.groupBy("lang", F.lit(None).cast("string").alias("source"), "ratio", "bin").agg(F.sum("n").alias("n")).withColumn("level", F.lit(1))
    total = by_lang.groupBy(F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"), "ratio", "bin").agg(F.sum("n").alias("n")).withColumn("level", F.lit(2))
    return fine.unionByName(by_lang).unionByName(total)


def limits(sketch: DataFrame) -> DataFrame:
    """One row a group and level: its documents, and the limits of each ratio."""
    group = ["level", "lang", "source", "ratio"]
    running = Window.partitionBy(*group).orderBy("bin")
    ranked = sketch.withColumn("upto", F.sum("n").over(running)).withColumn("total", F.sum("n").over(Window.partitionBy(*group)))

    def quartile(k: int) -> Column:
        return F.min(F.when(4 * F.col("upto") >= k * F.col("total"), F.col("bin")))

    quartiles = ranked.groupBy(*group).agg(F.max("total").alias("total"), quartile(1).alias("b1"), quartile(3).alias("b3"))
    quartiles = quartiles.withColumns({"low": bin_edge(F.col("b1"), False), "high": bin_edge(F.col("b3"), True)})
    spread = SPREAD * (F.col("high") - F.col("low"))
    columns = []
    for name, _, _, _, down, up in RATIOS:
        own = F.col("ratio") == name
        if down is not None:
            columns.append(F.max(F.when(own, F.col("low") - F.greatest(spread, F.lit(down)))).alias(f"least_{name}"))
        columns.append(F.max(F.when(own, F.col("high") + F.greatest(spread, F.lit(up)))).alias(f"most_{name}"))
    return quartiles.groupBy("level", "lang", "source").agg(F.max("total").alias("total"), *columns)


def group_limits(found: DataFrame) -> DataFrame:
    """Limits of each (lang, source): its own, or its language's or everything's where it has few documents."""
    table = written(limits(sketches(found)), "limits", slim=True)
    names = [c for c in table.columns if c.startswith(("least_", "most_"))]
    own = table.where("level = 0").select("lang", "source", F.struct("total", *names).alias("own"))
    lang = table.where("level = 1").select(F.col("lang").alias("l"), F.struct("total", *names).alias("wide"))
    joined = own.join(lang, own["lang"].eqNullSafe(lang["l"]), "left")
    over_all = table.where("level = 2").select("total", *names).first()  # one row, or none without documents
    types = dict(table.dtypes)
    every = F.struct(*[F.lit(over_all[c] if over_all else None).cast(types[c]).alias(c) for c in ("total", *names)])
    chosen = F.when(F.col("own.total") >= MIN_GROUP, F.col("own")).when(F.col("wide.total") >= MIN_GROUP, F.col("wide")).otherwise(every)
    return joined.select("lang", "source", chosen.alias("c")).select("lang", "source", *[F.col(f"c.{n}").alias(n) for n in names])


def judged(found: DataFrame, spread_by: str) -> DataFrame:
    """Adds base_failed and kept to counted rows with lang and source.

    ``found`` is read twice, so it should be a written table.
    """
    joined = salted_join(found, group_limits(found), ["lang", "source"], spread_by)
    fine = F.lit(True)
    for name, top, below, scale, down, _ in RATIOS:
        value = ratio(top, below, scale)
        fine &= F.coalesce(value <= F.col(f"most_{name}"), F.lit(True))
        if down is not None:
            fine &= F.coalesce(value >= F.col(f"least_{name}"), F.lit(True))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & fine)


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row a document: its counts, whether the base rule fails it, and the verdict."""
    renamed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    found = written(counted(renamed, ["doc_id", "lang", "source"]), "quality")
    return judged(found, "doc_id").select("doc_id", *COUNTS, "base_failed", "kept")
