"""State of streams by key: the version that stands for each key, and counts that take back what no longer does.

A stream of versioned rows becomes a stream of changes: a row that now stands has sign 1, the row whose place
it takes has sign -1. Late and repeated rows change nothing. Whatever is counted from changes follows a
row that moves from one group to another, and reads no table again. State lies in the state store of the
query, which its checkpoint makes exact across restarts; changes go to plain folders of appended files.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from headway.operators.ranking import latest_per_key

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "dateFormat": "yyyy-MM-dd"}
KEPT = "30 days"


def use_state_store(spark: SparkSession) -> None:
    """Streams with state of several variables need the store that can hold them."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


class LatestVersion(StatefulProcessor):
    """Keeps a key's newest row; a batch gives at most one change a key.

    Within a batch the greatest (version, order) wins, of equals the least row as text; against the
    kept row only a newer version does. The kept row goes when the watermark passes its version: from then
    on older rows are dropped as late before they come here, and the row counts as closed.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", "version long, payload string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for some in rows:
            for version, order, payload in zip(some["micros"], some["ties"], some["payload"], strict=True):
                rank = (int(version), tuple(order))
                if best is None or rank > best[0] or (rank == best[0] and payload < best[1]):
                    best = (rank, payload)
        (version, _), payload = best
        held = self.latest.get()
        if held is not None and version <= held[0]:
            return
        self.latest.update((version, payload))
        self.handle.registerTimer(version // 1000)
        before = [] if held is None else [(-1, held[1])]
        yield pd.DataFrame([*before, (1, payload)], columns=["sign", "payload"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.latest.get()
        if held is not None and held[0] // 1000 <= expiredTimerInfo.getExpiryTimeInMs():
            self.latest.clear()
        return iter(())

    def close(self) -> None:
        pass


def changes(rows: DataFrame, keys: Sequence[str], version: str, newest_first: Sequence[str] = (), kept: str = KEPT) -> DataFrame:
    """(sign, columns of rows): what the newest row of each key takes the place of, and that row.

    ``version`` is a timestamp; of equal ones in a batch the greatest ``newest_first`` timestamps decide, null
    least. Rows older than the newest by more than ``kept`` are too late, and so is what state is kept for.
    """
    use_state_store(rows.sparkSession)
    order = [F.coalesce(F.unix_micros(c), F.lit(-(1 << 62))) for c in newest_first]
    names = [f"key{i}" for i in range(len(keys))]
    packed = rows.withWatermark(version, kept).select(  # no leading underscores: frames would rename them
        *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)],
        F.col(version).alias("event_time"),
        F.unix_micros(version).alias("micros"),
        (F.array(*order) if order else F.array().cast("array<long>")).alias("ties"),
        F.to_json(F.struct(*rows.columns), JSON).alias("payload"),
    )
    out = packed.groupBy(*names).transformWithStateInPandas(LatestVersion(), "sign int, payload string", "Append", "EventTime")
    return out.select("sign", F.from_json("payload", rows.schema, JSON).alias("row")).select("sign", "row.*")


def standing(log: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The rows that stand, from a folder of changes: versions of a key only grow."""
    return latest_per_key(log.where("sign = 1").drop("sign"), keys, [F.desc(version)])


def last_revision(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last word on each key, from a folder of revisions."""
    return latest_per_key(log, keys, [F.desc("revision")]).drop("revision")


def _net(rows: Iterator[pd.DataFrame], column: str) -> dict:
    """Sum of the signs of each known value of a column."""
    total: dict = {}
    for some in rows:
        for value, sign in some.groupby(column)["sign"].sum().items():
            total[value] = total.get(value, 0) + int(sign)
    return {v: n for v, n in total.items() if n}


def _add(counts, value, n: int) -> tuple[int, int]:
    """Changes a count of a map; returns it before and after. Values without a count aren't kept."""
    before = counts.getValue((value,))[0] if counts.containsKey((value,)) else 0
    if before + n:
        counts.updateValue((value,), (before + n,))
    else:
        counts.removeKey((value,))
    return before, before + n


class DelayCounts(StatefulProcessor):
    """Counts of a group's delays by second, from which all its statistics follow, the greatest delay too."""

    def __init__(self, threshold: int):
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "delay long", "n long")
        self.totals = handle.getValueState("totals", "n long, late long, seconds long, most long, revision long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, late, seconds, most, revision = self.totals.get() or (0, 0, 0, None, 0)
        net = {int(delay): change for delay, change in _net(rows, "delay").items()}
        if not net:
            return
        lost = False
        for delay, change in net.items():
            _, left = _add(self.counts, delay, change)
            n, seconds = n + change, seconds + change * delay
            late += change if delay >= self.threshold else 0
            if left and (most is None or delay > most):
                most = delay
            lost = lost or (not left and delay == most)
        if lost:
            most = max((k[0] for k in self.counts.keys()), default=None)
        self.totals.update((n, late, seconds, most, revision + 1))
        yield pd.DataFrame([[*key, n, late, seconds, most, revision + 1]], columns=[*[f"k{i}" for i in range(len(key))], "n", "late", "seconds", "most", "revision"])

    def close(self) -> None:
        pass


def delay_counts(signed: DataFrame, keys: Sequence[str], delay: str, threshold: int) -> DataFrame:
    """(keys, n, late, seconds, most, revision) of every group that a batch of changes touches."""
    use_state_store(signed.sparkSession)
    fields = [signed.schema[k] for k in keys]
    out = ", ".join(f"k{i} {f.dataType.simpleString()}" for i, f in enumerate(fields)) + ", n long, late long, seconds long, most long, revision long"
    known = signed.where(F.col(delay).isNotNull()).select(*keys, F.col(delay).cast("long").alias("delay"), "sign")
    found = known.groupBy(*keys).transformWithStateInPandas(DelayCounts(threshold), out, "Append", "None")
    return found.withColumnsRenamed({f"k{i}": k for i, k in enumerate(keys)})


class SetCounts(StatefulProcessor):
    """How often each value of some columns occurs in a group: their numbers, or the values themselves."""

    def __init__(self, columns: list[str], keep_ms: int):
        self.columns, self.keep_ms = columns, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.maps = [handle.getMapState(f"of_{c}", "value string", "n long", self.keep_ms) for c in self.columns]
        self.revision = handle.getValueState("revision", "n long", self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        some = list(rows)
        for column, counts in zip(self.columns, self.maps, strict=True):
            for value, change in _net(iter(some), column).items():
                _add(counts, value, change)
        revision = (self.revision.get() or (0,))[0] + 1
        self.revision.update((revision,))
        values = [sorted(k[0] for k in counts.keys()) for counts in self.maps]
        yield pd.DataFrame([[*key, *values, revision]], columns=[*[f"k{i}" for i in range(len(key))], *self.columns, "revision"])

    def close(self) -> None:
        pass


def value_sets(signed: DataFrame, keys: Sequence[str], columns: Sequence[str], keep_ms: int) -> DataFrame:
    """(keys, each column's values that stand as a sorted list, revision) of every group that a batch of changes touches.

    A group that nothing touches for ``keep_ms`` is closed and its state dropped.
    """
    use_state_store(signed.sparkSession)
    fields = [signed.schema[k] for k in keys]
    out = ", ".join([*[f"k{i} {f.dataType.simpleString()}" for i, f in enumerate(fields)], *[f"{c} array<string>" for c in columns], "revision long"])
    texts = signed.select(*keys, *[F.col(c).cast("string").alias(c) for c in columns], "sign")
    found = texts.groupBy(*keys).transformWithStateInPandas(SetCounts(list(columns), keep_ms), out, "Append", "ProcessingTime")
    return found.withColumnsRenamed({f"k{i}": k for i, k in enumerate(keys)})
