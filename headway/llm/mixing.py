"""Mixing sources to target weights by entropy balancing.

The least tilt (in relative entropy) of the documents' rates that meets a token total for
each source is rate = exp(tilt of its source), and the tilts minimise a convex dual. A
document belongs to one source, so the Hessian is diagonal and both it and the gradient need
one distributed aggregate, the source's tokens; Newton steps then run for all sources at once.

Rates become whole copies. Documents of a source are dealt to cells of like size and every
cell is rounded systematically, so a cell is off by less than one of its documents; a few
rounds then change the copies of the one document of a source that mends its total best.

Defined cases: a null text has size 0 and costs nothing; a null source is a source of its
own, the last; equal rows are rounded each; without documents there are no rows, and with no
words at all every target is 0. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import salted_join, written

MOST_COPIES = 3
WEIGHTS = [1, 2, 3]
NEWTON_STEPS = 40
CELL_ROWS = 20_000
MENDS = 5
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, rows) -> with target: weights in code point order share all tokens, at most MOST_COPIES times a source.

    Sources that would exceed their limit keep it; the rest is shared by weight. In the order of
    limit a weight, the first k sources are the full ones for the least k whose share fits the next.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int"))
    most = F.col("source_size") * MOST_COPIES
    weighed = sizes.withColumn("weight", weight).withColumn("fill", most / F.col("weight"))
    upto = Window.orderBy("fill", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(most).over(upto), F.lit(0))
    weights = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0))
    share = weighed.withColumn("share", left / weights)
    # The share is the one of the first source, in that order, that isn't full under it.
    final = F.min(F.when(F.col("share") <= F.col("fill"), F.struct("fill", "share"))).over(every)["share"]
    target = F.least(most.cast("double"), F.coalesce(final * F.col("weight"), most.cast("double")))
    return share.select("source", "source_size", "rows", target.alias("target"))


def tilt(size: Column, target: Column) -> Column:
    """Newton's minimiser of size * exp(t) - target * t; null where no tokens are wanted."""
    steps = F.sequence(F.lit(1), F.lit(NEWTON_STEPS))

    def step(t: Column, _: Column) -> Column:
        now = size * F.exp(t)
        return t - (now - target) / now

    return F.when((size > 0) & (target > 0), F.aggregate(steps, F.lit(0.0), step))


def _cell(of: Column) -> Column:
    return F.length(F.bin(of))


def mix(docs: DataFrame, text: str = "text", source: str = "source", keep: list[str] | None = None) -> DataFrame:
    """The kept columns with size, source_size, target, copies and taken of every document."""
    keep = keep or ["doc_id"]
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    kept = F.struct(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]).alias("_key")
    # Draws come from what a row says, so a rerun on other partitions differs among equal rows only.
    picked = docs.select(kept, F.col(source).alias("source"), size.alias("size"), F.xxhash64(*keep, source, text).alias("_draw"))
    rows = written(picked.withColumn("_row", F.monotonically_increasing_id()), "sizes")

    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    targets = source_targets(sizes)
    rate = F.least(F.lit(float(MOST_COPIES)), F.coalesce(F.exp(tilt(F.col("source_size"), F.col("target"))), F.lit(0.0)))
    # A source that its limit binds gets exactly that many copies.
    rate = F.when(F.col("target") >= MOST_COPIES * F.col("source_size"), F.lit(float(MOST_COPIES))).otherwise(rate)
    plan = written(targets.withColumn("rate", rate).withColumn("blocks", 1 + F.floor(F.col("rows") / CELL_ROWS)), "sources")

    rated = salted_join(rows, plan, ["source"], "_row")
    dealt = rated.withColumn("_cell", _cell(F.col("size"))).withColumn("_block", F.pmod("_draw", F.col("blocks")))
    cell = ["source", "_cell", "_block"]
    place = F.row_number().over(Window.partitionBy(*cell).orderBy(F.xxhash64("_draw"), "_row"))
    part = F.col("rate") - F.floor("rate")
    start = F.pmod(F.xxhash64(*cell), F.lit(1 << 20)) / (1 << 20)
    more = F.floor(place * part + start) - F.floor((place - 1) * part + start)
    copies = F.least(F.lit(MOST_COPIES), F.floor("rate") + more).cast("long")
    rounded = written(dealt.withColumn("copies", copies).select("_row", "_draw", "_key", "source", "size", "source_size", "target", "copies"), "copies")

    changed = None
    for _ in range(MENDS):
        now = rounded if changed is None else _apply(rounded, changed)
        off = now.groupBy("source").agg((F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("off"))
        near = salted_join(now, off, ["source"], "_row")
        up = F.col("off") > 0
        can = F.when(up, F.col("copies") < MOST_COPIES).otherwise(F.col("copies") > 0)
        miss = F.abs(F.abs("off") - F.col("size"))
        best = near.where(can & (miss < F.abs("off"))).groupBy("source").agg(F.min(F.struct(miss.alias("miss"), "_draw", "_row", F.when(up, 1).otherwise(-1).alias("more"))).alias("best"))
        step = best.select("best._row", F.col("best.more").cast("long").alias("more"))
        step = step if changed is None else changed.unionByName(step).groupBy("_row").agg(F.sum("more").alias("more"))
        changed = written(step, "mends")
    final = _apply(rounded, changed)
    names = [F.col(f"_key._k{i}").alias(c) for i, c in enumerate(keep)]
    return final.select(*names, "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def _apply(rows: DataFrame, changed: DataFrame) -> DataFrame:
    """Copies after the changes, of which there are few for each source."""
    return rows.join(changed, "_row", "left").withColumn("copies", F.col("copies") + F.coalesce("more", F.lit(0))).drop("more")
