"""Features of raw files, computed once a file."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkwarden.operators.aggregates import latest
from sparkwarden.sources.versions import Batches

_FILE = StructType().add("path", "string").add("length", "long").add("modified", "timestamp")


def listed_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, length and time of the files of a folder. Their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


class FeatureCache:
    """A table of file features under ``root``: path, length, time, and what ``features`` says of the content as latin-1 text.

    ``update`` reads the content of files alone that the table lacks as they are now (path, length and time).  What it
    adds is a batch named after these files, so that a run that failed and is repeated replaces its own rows.
    """

    def __init__(self, spark: SparkSession, root: str, features: dict[str, Column]):
        self.spark, self.features = spark, features
        kinds = spark.range(0).select(F.lit("").alias("text")).select(*(c.alias(n) for n, c in features.items())).schema
        self.table = Batches(spark, root, StructType([*_FILE.fields, *kinds.fields]))

    def update(self, path: str, pattern: str = "*", magic: bytes = b"") -> int:
        """Add the files of a folder that are new or changed; how many. Files that do not begin with ``magic`` are left out."""
        known = self.table.read().select(*_FILE.names)
        # The driver lists the folder anyway; what it takes here are the names of new files.
        fresh = listed_files(self.spark, path, pattern).join(known, _FILE.names, "left_anti").orderBy("path").collect()
        if not fresh:
            return 0
        name = hashlib.sha256("\n".join(f"{r.path} {r.length} {r.modified}" for r in fresh).encode()).hexdigest()[:32]
        content = self.spark.read.format("binaryFile").load([r.path for r in fresh])
        text = F.decode("content", "ISO-8859-1").alias("text")
        rows = content.where(F.substring("content", 1, len(magic)) == F.lit(bytearray(magic))) if magic else content
        rows = rows.select("path", "length", F.col("modificationTime").alias("modified"), text)
        self.table.write(rows.select(*_FILE.names, *(c.alias(n) for n, c in self.features.items())), name)
        return len(fresh)

    def read(self) -> DataFrame:
        """The newest row of each file."""
        return latest(self.table.read().drop("batch"), ["path"], "modified", "length")
