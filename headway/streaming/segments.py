"""A stream source with offsets over a folder of numbered segment files, in the place of a broker's topic.

A segment is a text file named by the offset of its first record, one record a line; a record's offset is
that number plus its line. Old segments may be removed. The stream starts at the earliest, the
latest or a given offset, reads on from its checkpoint, and either stops where offsets it needs are gone
or goes on from the first there is.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "offset long, value binary"


class Slice(InputPartition):
    """Records [low, high) of one segment."""

    def __init__(self, path: str, base: int, low: int, high: int):
        self.path, self.base, self.low, self.high = path, base, low, high


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


class SegmentReader(DataSourceStreamReader):
    def __init__(self, options):
        self.folder = options["path"].rstrip("/")
        self.begin = options.get("startingOffsets", "latest")
        self.strict = options.get("failOnDataLoss", "true").lower() != "false"
        if self.begin not in ("earliest", "latest") and not self.begin.isdigit():
            raise ValueError(f"startingOffsets is earliest, latest or a number, not {self.begin}")

    def _segments(self) -> list[tuple[int, str]]:
        """(first offset, path) of the segments there are, in order."""
        from pyarrow import fs

        system, place = _filesystem(self.folder)
        found = system.get_file_info(fs.FileSelector(place, allow_not_found=True))
        named = [(f.base_name.removesuffix(".log"), f.path) for f in found if f.is_file and f.base_name.endswith(".log")]
        return sorted((int(name), path) for name, path in named if name.isdigit())

    def _lines(self, path: str) -> Iterator[bytes]:
        """Whole lines of a segment: one that is still being written has no line break yet."""
        system, _ = _filesystem(self.folder)
        rest = b""
        with system.open_input_stream(path) as stream:
            while block := stream.read(1 << 20):
                *lines, rest = (rest + block).split(b"\n")
                yield from lines

    def initialOffset(self) -> dict:
        if self.begin == "latest":
            return self.latestOffset()
        segments = self._segments()
        return {"offset": int(self.begin) if self.begin.isdigit() else segments[0][0] if segments else 0}

    def latestOffset(self) -> dict:
        """The offset after the last record; only the last segment is counted, earlier ones end where the next begins."""
        segments = self._segments()
        if not segments:
            return {"offset": int(self.begin) if self.begin.isdigit() else 0}
        base, path = segments[-1]
        end = base + sum(1 for _ in self._lines(path))
        return {"offset": max(end, int(self.begin)) if self.begin.isdigit() else end}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        low, high = start["offset"], end["offset"]
        segments = self._segments()
        ends = [base for base, _ in segments[1:]] + [high]
        parts = [Slice(path, base, max(low, base), min(high, upto)) for (base, path), upto in zip(segments, ends, strict=True)]
        parts = [p for p in parts if p.low < p.high]
        reached = low
        for part in parts:
            self._lost(reached, part.low)
            reached = part.high
        self._lost(reached, high)
        return parts

    def _lost(self, low: int, high: int) -> None:
        if low < high and self.strict:
            raise ValueError(f"records {low} to {high - 1} of {self.folder} are gone; failOnDataLoss=false goes on without them")

    def read(self, partition: Slice) -> Iterator[tuple[int, bytes]]:
        offset = partition.base
        try:
            for line in self._lines(partition.path):
                if offset >= partition.high:
                    return
                if offset >= partition.low:
                    yield offset, line
                offset += 1
        except FileNotFoundError:  # removed since the batch was planned
            if self.strict:
                raise
        if offset < partition.high:
            self._lost(max(offset, partition.low), partition.high)

    def commit(self, end: dict) -> None:
        pass


class SegmentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "segments"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> SegmentReader:
        return SegmentReader(self.options)


def segment_source(spark: SparkSession, folder: str, offsets: str = "latest", fail_on_data_loss: bool = False) -> DataFrame:
    """Records of a folder of segments, as the broker's topic would give them. Offsets lost to retention do not stop the stream."""
    spark.dataSource.register(SegmentSource)
    reader = spark.readStream.format("segments").option("startingOffsets", offsets).option("failOnDataLoss", str(fail_on_data_loss).lower())
    return reader.load(folder)
