"""Contains-search of many texts in many names by an index of letter groups.

Names are indexed by their runs of one, two and three letters. A text of three letters or more looks up
the rarest of its three-letter runs and is verified on the few names that have it; a shorter text is a
run of the index itself. Searches are thereby joins on equality, and no name meets a text it shares nothing with.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.text import name_key

RUN = 3


def runs(key: str, sizes: Sequence[int]) -> Column:
    """The different runs of the given numbers of letters of a text."""

    def of_size(n: int) -> Column:
        # Of a text that is too short a sequence would count down.
        starts = F.when(F.length(key) >= n, F.sequence(F.lit(1), F.length(key) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda at: F.substring(F.col(key), at, F.lit(n)))

    return F.array_distinct(F.concat(*[of_size(n) for n in sizes]))


def name_index(names: DataFrame, key: str, *columns: str) -> DataFrame:
    """Postings (run, key, name): every run of every different name in the columns, without case and outer blanks.

    This is the table to store: names change seldom and are searched often.
    """
    each = names.select(key, F.explode(F.array(*[name_key(c) for c in columns])).alias("name"))
    known = each.where("name IS NOT NULL AND name != ''").distinct()
    return known.select(F.explode(runs("name", range(1, RUN + 1))).alias("run"), key, "name")


def contains_search(asked: DataFrame, text: str, index: DataFrame, key: str) -> DataFrame:
    """(text, key) for each asked text and each key with a name that contains it, without case and outer blanks.

    Blank and null texts find nothing. Each text looks up one run, the one that the fewest names have.
    """
    texts = asked.select(text).distinct().withColumn("_text", name_key(text)).where("_text != ''")
    wanted = texts.withColumn("run", F.explode(F.when(F.length("_text") <= RUN, F.array("_text")).otherwise(runs("_text", [RUN]))))
    # A run that no name has is counted too: its text is found nowhere.
    often = index.join(wanted.select("run").distinct(), "run", "left_semi").groupBy("run").agg(F.count("*").alias("_names"))
    counted = wanted.join(often, "run", "left").withColumn("_names", F.coalesce("_names", F.lit(0)))
    rarest = counted.groupBy(text, "_text").agg(F.min(F.struct("_names", "run")).alias("least")).where("least._names > 0")
    found = rarest.select(text, "_text", "least.run").join(index, "run").where(F.contains("name", F.col("_text")))
    return found.select(text, key).distinct()
