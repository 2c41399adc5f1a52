"""Where intermediate tables go: the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of narrow tables (ids, hashes) that are broadcast at most; larger ones are shuffled.
BROADCAST_ROWS = 500_000
_PATH = "_sparkwarden_path"
_OPEN: ContextVar[list[DataFrame] | None] = ContextVar("open", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, a temporary one, in local mode only (tests)."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="sparkwarden-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once as Parquet to the shared folder and read back.

    Later plans start from files, so a lost executor costs the reading of a file and not the work before it.
    """
    path = f"{shared_dir(df.sparkSession)}/sparkwarden/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    setattr(out, _PATH, path)
    made = _OPEN.get()
    if made is not None:
        made.append(out)
    return out


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that ``written`` makes within are deleted at the end, but for those that were passed to what this yields.

    For callers of operators whose result still reads such tables: write the result within and keep it.
    """
    made: list[DataFrame] = []
    kept: list[DataFrame] = []
    outer = _OPEN.get()
    before = _OPEN.set(made)

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table)
        return table

    try:
        yield keep
    finally:
        _OPEN.reset(before)
        discard(*(t for t in made if not any(t is k for k in kept)))
        if outer is not None:
            outer.extend(kept)


def path_of(table: DataFrame) -> str:
    """Where a table that ``written`` returned lies."""
    return vars(table)[_PATH]


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``written`` returned; what was made of them must have been written by now.

    Other frames are left alone.
    """
    for table in tables:
        path = vars(table).pop(_PATH, None)
        if path:
            sc = table.sparkSession.sparkContext
            place = sc._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, marked so that its joins merge and neither side is broadcast.

    Spark takes a table's size from its files, where equal values are stored once and compressed, and does not count the
    rows that an explode adds: left alone, it sends tables of a gigabyte through the driver as if they had a few MB.
    """
    return df.hint("merge")


def small_or_shuffled(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast if it was counted to have ``most`` rows or fewer, else to be ``shuffled``.

    For tables that are files or cheap to count: the count stops at ``most`` rows.
    """
    return F.broadcast(df) if df.limit(most + 1).count() <= most else shuffled(df)


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of finished plans that nothing refers to any more.

    Spark does so once the driver has collected its garbage, which a driver with little to do puts off; operators whose
    phases shuffle as much as they read call this between phases.
    """
    gc.collect()  # Python's handles go first
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.3)


class Files:
    """Small files and folders of a file system that Spark knows."""

    def __init__(self, spark: SparkSession, root: str):
        sc = spark.sparkContext
        self.jvm = sc._jvm
        self.system = self._path(root).getFileSystem(sc._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        """What lies in a folder; nothing where there is none."""
        place = self._path(folder)
        return sorted(s.getPath().getName() for s in self.system.listStatus(place)) if self.system.exists(place) else []

    def read(self, path: str) -> str:
        stream = self.system.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """Write a file that must not be there yet."""
        stream = self.system.create(self._path(path), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        self.system.delete(self._path(path), True)


def files_of(spark: SparkSession, root: str) -> Files:
    return Files(spark, root)
