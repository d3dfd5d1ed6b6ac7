"""Balanced label propagation: equal texts drift to one shard while shards stay even.

Documents start in hashed shards. In each round a document wants the shard that most of its
neighbours (the rows of its text) are in, of those that aren't full; wishes from shard s to t
are granted up to the wishes from t to s plus a share of t's room. Room is what the rows with neighbours leave of an
even shard, for the others can make way at no cut: at last full shards give rows away, those
without neighbours first, so counts are at most one apart (law ``rows``). A text of more rows
than a shard holds is spread over several.

Defined cases: a null text has one byte of size, the checksum of an empty text and other null
texts as neighbours; null and repeated ids are placed row by row; fewer rows than shards leave
the last shards empty; no rows give none. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import numbered, salted_join, written

SHARDS = 16
ROUNDS = 10


def _pick(values: list[int], by: Column) -> Column:
    """values[by], for a list as long as there are shards."""
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), by + 1)


def _granted(wishes: dict[tuple[int, int], int], counts: list[int], capacity: int) -> list[list[int]]:
    """How many of the wishes from s to t may be met: swaps, and what room allows."""
    shards = range(len(counts))
    granted = [[0] * len(counts) for _ in shards]
    for t in shards:
        room = max(0, capacity - counts[t])
        extra = {s: wishes.get((s, t), 0) - min(wishes.get((s, t), 0), wishes.get((t, s), 0)) for s in shards}
        total = sum(extra.values())
        share = {s: extra[s] if total <= room else extra[s] * room // total for s in shards}
        for s in sorted(shards, key=lambda s: -extra[s]):
            if share[s] < extra[s] and sum(share.values()) < room:
                share[s] += 1
            granted[s][t] = share[s] + min(wishes.get((s, t), 0), wishes.get((t, s), 0))
    return granted


def shard(docs: DataFrame, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """The kept columns with size, text_crc32, law, shard, slot and grown_shard of every row."""
    keep = keep or [doc_id]
    utf8 = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    base = docs.select(
        F.struct(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]).alias("_key"),
        (F.octet_length(utf8) + 1).cast("long").alias("size"),
        F.crc32(utf8).alias("text_crc32"),
        F.xxhash64(text, F.col(text).isNull()).alias("_text"),
        F.xxhash64(doc_id, text).alias("_draw"),
    )
    state = written(base.withColumn("_row", F.monotonically_increasing_id()), "rows")
    state = state.withColumn("shard", F.pmod("_draw", F.lit(shards)).cast("int"))
    texts = state.groupBy("_text").agg(F.count("*").alias("rows")).where("rows > 1").select("_text", F.lit(True).alias("tied"))
    tied = salted_join(state.select("_row", "_draw", "_text", "shard"), texts, ["_text"], "_row")
    places = written(tied.withColumn("tied", F.coalesce("tied", F.lit(False))), "shards")
    capacity = -(-places.count() // shards)

    for _ in range(ROUNDS):
        counts = _counts(places.where("tied"), shards)
        near = places.where("tied").groupBy("_text", "shard").agg(F.count("*").alias("n"))
        full = F.array(*[F.lit(c >= capacity) for c in counts])
        order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), full[F.col("shard")].alias("full"), F.xxhash64("_text", "shard").alias("tie"), "shard")))
        best = near.groupBy("_text").agg(order.alias("order")).where(F.size("order") > 1).select("_text", F.transform("order", lambda x: x["shard"]).alias("order"))
        open_to = F.get(F.filter("order", lambda s: ~full[s]), F.lit(0))
        wish = F.when(F.array_position("order", open_to) < F.array_position("order", F.col("shard")), open_to)
        wishing = salted_join(places.where("tied"), best, ["_text"], "_row", "inner").withColumn("wish", wish).drop("order")
        wishing = written(wishing.where("wish IS NOT NULL"), "wishes")
        wishes = {(r["shard"], r["wish"]): r["count"] for r in wishing.groupBy("shard", "wish").count().collect()}
        if not wishes:
            break
        grant = F.element_at(F.array(*[F.array(*[F.lit(n) for n in row]) for row in _granted(wishes, counts, capacity)]), F.col("shard") + 1)
        ranked = numbered(wishing, ["shard", "wish"], "_draw", ["_text", "_draw", "_row"], "_nth")
        moved = ranked.where(F.col("_nth") < F.element_at(grant, F.col("wish") + 1)).select("_row", "wish")
        places = written(places.join(moved, "_row", "left").withColumn("shard", F.coalesce("wish", "shard")).drop("wish"), "shards")

    places = _evened(places, shards)
    slots = numbered(places.select("_row", "_draw", "shard"), ["shard"], "_draw", ["_draw", "_row"], "slot").drop("_draw")
    out = state.drop("shard").join(slots, "_row")
    names = [F.col(f"_key._k{i}").alias(c) for i, c in enumerate(keep)]
    return out.select(*names, "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))


def _counts(places: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["count"] for r in places.groupBy("shard").count().collect()}
    return [found.get(s, 0) for s in range(shards)]


def _evened(places: DataFrame, shards: int) -> DataFrame:
    """Counts at most one apart; rows without neighbours in their shard leave first."""
    counts = _counts(places, shards)
    total = sum(counts)
    even = [total // shards + (s < total % shards) for s in range(shards)]
    spare = [max(0, c - e) for c, e in zip(counts, even, strict=True)]
    if not any(spare):
        return places
    together = places.where("tied").groupBy("_text", "shard").agg(F.count("*").alias("n")).where("n > 1").select("_text", F.col("shard").alias("_home"), F.lit(True).alias("bound"))
    over = places.where(_pick(spare, F.col("shard")) > 0)
    # The shard of a kept-together text is compared after the join, which is on the text alone.
    marked = salted_join(over, together.groupBy("_text").agg(F.collect_set("_home").alias("homes")), ["_text"], "_row")
    marked = marked.withColumn("bound", F.coalesce(F.array_contains("homes", F.col("shard")), F.lit(False))).drop("homes")
    marked = written(marked, "spare")
    loose = {r["shard"]: r["count"] for r in marked.where("NOT bound").groupBy("shard").count().collect()}
    ranked = numbered(marked, ["shard", "bound"], "_draw", ["_draw", "_row"], "_nth")
    nth = F.col("_nth") + F.when(F.col("bound"), _pick([loose.get(s, 0) for s in range(shards)], F.col("shard"))).otherwise(0)
    leaving = written(ranked.where(nth < _pick(spare, F.col("shard"))).select("_row", "_draw"), "leaving")
    upto, to = 0, F.lit(None).cast("int")
    for s in reversed(range(shards)):
        upto = sum(max(0, even[t] - counts[t]) for t in range(s + 1))
        to = F.when(F.col("_nth") < upto, F.lit(s)).otherwise(to)
    settled = numbered(leaving, [], "_draw", ["_draw", "_row"], "_nth").select("_row", to.alias("to"))
    return written(places.join(settled, "_row", "left").withColumn("shard", F.coalesce("to", "shard")).drop("to"), "shards")
