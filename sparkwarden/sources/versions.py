"""Tables kept as whole versions, each published by one small file, and tables of batches that replace themselves."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sparkwarden.storage import files_of


class Versions:
    """A table as a row of whole versions under ``root``; readers see a version only when it is published.

    A version is written to a folder of its own and then named by one entry in ``_published``, which is created once and
    never changed: a writer that fails before leaves nothing that anyone reads, and of two writers of the same version
    one fails.  An entry also says which batch of each source the version holds.  ``merge`` uses that to apply a batch
    once, and ``as_of`` to give a batch that runs again the version which it had seen the first time.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType | str):
        self.spark, self.root = spark, root.rstrip("/")
        self.schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        self.files = files_of(spark, self.root)

    def _entries(self) -> list[tuple[int, dict]]:
        """Published versions, the oldest first; an entry that was not written to its end is none."""
        found = []
        for name in self.files.names(f"{self.root}/_published"):
            try:
                found.append((int(name), json.loads(self.files.read(f"{self.root}/_published/{name}"))))
            except ValueError:
                continue
        return sorted(found, key=lambda x: x[0])

    def _table(self, entry: dict | None) -> DataFrame:
        if entry is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/{entry['folder']}")

    def latest(self) -> int | None:
        entries = self._entries()
        return entries[-1][0] if entries else None

    def read(self, version: int | None = None) -> DataFrame:
        """A version, by default the latest; without any the table is empty."""
        entries = dict(self._entries())
        if version is None:
            return self._table(entries[max(entries)] if entries else None)
        return self._table(entries[version])

    def as_of(self, source: str, batch: int) -> DataFrame:
        """The newest version that holds no batch of ``source`` from ``batch`` on."""
        before = [e for _, e in self._entries() if e["applied"].get(source, -1) < batch]
        return self._table(before[-1] if before else None)

    def publish(self, rows: DataFrame, source: str | None = None, batch: int | None = None) -> int:
        """Write ``rows`` as the next version; ``batch`` of ``source`` is in it from now on."""
        entries = self._entries()
        version = 1 + max([0, *(int(n) for n in self.files.names(f"{self.root}/_published") if n.isdigit())])
        applied = dict(entries[-1][1]["applied"]) if entries else {}
        if source is not None:
            applied[source] = batch
        folder = f"v{version:08d}-{uuid.uuid4().hex}"
        rows.select(*self.schema.names).write.parquet(f"{self.root}/{folder}")
        self.files.create(f"{self.root}/_published/{version:08d}", json.dumps({"folder": folder, "applied": applied}))
        return version

    def merge(self, source: str, batch: int, step: Callable[[DataFrame], DataFrame]) -> int | None:
        """Publish ``step`` of the latest version, unless it holds this batch of ``source`` or a later one."""
        entries = self._entries()
        if entries and entries[-1][1]["applied"].get(source, -1) >= batch:
            return entries[-1][0]
        return self.publish(step(self.read()), source, batch)

    def prune(self, keep: int = 3) -> None:
        """Delete all but the last ``keep`` versions; whoever still reads an older one fails."""
        for version, entry in self._entries()[:-keep]:
            self.files.delete(f"{self.root}/_published/{version:08d}")
            self.files.delete(f"{self.root}/{entry['folder']}")


class Batches:
    """A table of batches under ``root``: a batch that is written again replaces itself and nothing else."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType | str, by: list[str] | None = None):
        self.spark, self.root, self.by = spark, root.rstrip("/"), by or []
        self.schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)

    def write(self, rows: DataFrame, batch: str) -> None:
        """``by`` columns become folders below the batch; their rows are brought together first, large ones in several files."""
        out = rows.select(*self.schema.names)
        if self.by:
            out = out.hint("rebalance", *self.by)
        out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*self.by).parquet(f"{self.root}/batch={batch}")

    def read(self) -> DataFrame:
        """All batches, with the ``batch`` of each row; conditions on it and on the ``by`` columns choose folders."""
        files = files_of(self.spark, self.root)
        if not files.names(self.root):
            return self.spark.createDataFrame([], StructType([*self.schema.fields]).add("batch", "string"))
        kinds = StructType([*self.schema.fields]).add("batch", "string")
        return self.spark.read.schema(kinds).option("basePath", self.root).parquet(self.root).select(*self.schema.names, "batch")
