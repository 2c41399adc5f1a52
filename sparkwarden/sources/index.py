"""A time-ordered index of events as a Spark data source: scans take a pushed range, streams go on from segment to segment.

An index is a folder of segments (Parquet files of a stretch of time) and, for each append, one entry that names its
segments with their first and last time.  ``spark.read.format("segments")`` plans one partition for each segment that
the pushed range touches; others are not opened.  The stream's offset is the number of appends, so rows that come late
belong to the append that brought them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from sparkwarden.storage import files_of

_PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def append_segments(df: DataFrame, root: str, time: str, segments: int = 8) -> None:
    """Add rows as up to ``segments`` stretches of time (``time`` is a whole number); readers see all of them or none."""
    spark, files = df.sparkSession, files_of(df.sparkSession, root)
    folder = f"data-{uuid.uuid4().hex}"
    df.repartitionByRange(segments, time).sortWithinPartitions(time).write.parquet(f"{root}/{folder}")
    name = F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file")
    stats = spark.read.parquet(f"{root}/{folder}").select(name, time).groupBy("file").agg(F.min(time).alias("lo"), F.max(time).alias("hi"), F.count(F.lit(1)).alias("n"), F.count(time).alias("timed"))
    # One row for each file that was written.
    entry = [{"file": f"{folder}/{r.file}", "lo": r.lo, "hi": r.hi, "rows": r.n, "untimed": r.n - r.timed} for r in stats.orderBy("lo", "file").collect()]
    number = len(files.names(f"{root}/_segments"))
    files.create(f"{root}/_segments/{number:08d}.json", json.dumps(entry))


@dataclass
class Segment(InputPartition):
    file: str
    lo: int | None
    hi: int | None


def _appends(root: str) -> list[list[dict]]:
    """The entries of all appends, in order."""
    system, path = fs.FileSystem.from_uri(root)
    found = system.get_file_info(fs.FileSelector(f"{path}/_segments", allow_not_found=True))
    out = []
    for info in sorted(found, key=lambda i: i.base_name):
        if info.base_name.endswith(".json"):
            with system.open_input_stream(info.path) as stream:
                out.append(json.loads(stream.read()))
    return out


def _rows(root: str, time: str, names: list[str], part: Segment) -> Iterator[pa.RecordBatch]:
    system, path = fs.FileSystem.from_uri(root)
    bounds = [(time, ">=", part.lo)] * (part.lo is not None) + [(time, "<=", part.hi)] * (part.hi is not None)
    table = pq.read_table(f"{path}/{part.file}", columns=names, filters=bounds or None, filesystem=system)
    yield from table.to_batches()


class SegmentSource(DataSource):
    """Options: ``path`` (a URI) and ``time`` (the column that segments are ordered by). The schema must be given."""

    @classmethod
    def name(cls) -> str:
        return "segments"

    def reader(self, schema) -> DataSourceReader:
        return SegmentReader(self.options["path"], self.options["time"], schema.names)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return SegmentStream(self.options["path"], self.options["time"], schema.names)


class SegmentReader(DataSourceReader):
    def __init__(self, root: str, time: str, names: list[str]):
        self.root, self.time, self.names = root, time, names
        self.lo: int | None = None
        self.hi: int | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of the time with whole numbers become the range; others are left to Spark."""
        for f in filters:
            step = {GreaterThanOrEqual: (0, None), GreaterThan: (1, None), LessThanOrEqual: (None, 0), LessThan: (None, -1), EqualTo: (0, 0)}.get(type(f))
            if step is None or f.attribute != (self.time,) or not isinstance(f.value, int):
                yield f
                continue
            low, high = step
            if low is not None:
                self.lo = f.value + low if self.lo is None else max(self.lo, f.value + low)
            if high is not None:
                self.hi = f.value + high if self.hi is None else min(self.hi, f.value + high)

    def _touched(self, s: dict) -> bool:
        if self.lo is None and self.hi is None:
            return True
        return s["lo"] is not None and (self.hi is None or s["lo"] <= self.hi) and (self.lo is None or s["hi"] >= self.lo)

    def partitions(self) -> list[Segment]:
        return [Segment(s["file"], self.lo, self.hi) for a in _appends(self.root) for s in a if self._touched(s)] or [Segment("", None, None)]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        if partition.file:
            yield from _rows(self.root, self.time, self.names, partition)


class SegmentStream(DataSourceStreamReader):
    def __init__(self, root: str, time: str, names: list[str]):
        self.root, self.time, self.names = root, time, names

    def initialOffset(self) -> dict:
        return {"appends": 0}

    def latestOffset(self) -> dict:
        return {"appends": len(_appends(self.root))}

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        return [Segment(s["file"], None, None) for a in _appends(self.root)[start["appends"] : end["appends"]] for s in a]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        yield from _rows(self.root, self.time, self.names, partition)


def read_segments(spark: SparkSession, root: str, time: str, schema) -> DataFrame:
    """An index as a table; conditions on ``time`` choose segments, and rows in them, before anything is read."""
    spark.dataSource.register(SegmentSource)
    spark.conf.set(_PUSHDOWN, "true")
    return spark.read.format("segments").schema(schema).option("path", root).option("time", time).load()


def stream_segments(spark: SparkSession, root: str, time: str, schema) -> DataFrame:
    spark.dataSource.register(SegmentSource)
    return spark.readStream.format("segments").schema(schema).option("path", root).option("time", time).load()
