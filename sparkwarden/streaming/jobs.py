"""Structured Streaming forms of the five-minute jobs. Each runs until its source is read and is restarted from its checkpoint."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwarden.sources.versions import Batches, Versions
from sparkwarden.storage import shared_dir


def new_files(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    """A stream of the Parquet files that match ``path``, each of them once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def drained(stream: DataFrame, mode: str = "append", folder: str | None = None, each: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Run a stream over what is there now; the rows that it wrote, with the number of their ``batch``.

    With the same ``folder``, a later run goes on where the last one ended.  A batch that is written again after a
    failure replaces itself.
    """
    spark = stream.sparkSession
    folder = folder or f"{shared_dir(spark)}/sparkwarden/stream-{uuid.uuid4().hex}"
    schema = (each(stream) if each else stream).schema

    def put(batch: DataFrame, number: int) -> None:
        (each(batch) if each else batch).write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).foreachBatch(put).start().awaitTermination()
    return spark.read.schema(schema.add("batch", "long")).parquet(f"{folder}/rows")


def learning(stream: DataFrame, baselines: Versions, source: str, detect: Callable[[DataFrame, DataFrame], DataFrame], learn: Callable[[DataFrame, DataFrame], DataFrame], folder: str) -> None:
    """Run a stream over what is there now: each batch is judged by the baseline as it was before, and then trains it.

    ``detect(batch, baseline)`` gives the alerts, which go to ``folder/alerts`` by batch; ``learn(batch, baseline)`` the
    next version of the baseline.  A batch that runs again after a failure sees the version that it saw before, replaces
    its alerts and does not train twice.
    """

    def put(batch: DataFrame, number: int) -> None:
        before = baselines.as_of(source, number)
        alerts = detect(batch, before)
        Batches(stream.sparkSession, f"{folder}/alerts", alerts.schema).write(alerts, str(number))
        baselines.merge(source, number, lambda latest: learn(batch, latest))

    stream.writeStream.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).foreachBatch(put).start().awaitTermination()


def slot_volumes(flows: DataFrame, minutes: int = 5, late: str = "10 minutes") -> DataFrame:
    """Bytes of each host and tumbling window (``slot``: number of windows since the month began), with a watermark."""
    ends = flows.withWatermark("ts", late).select("ts", F.floor(F.col("sec") / (60 * minutes)).alias("slot"), F.explode(F.array(F.struct(F.col("srcip").alias("ip"), F.col("upbytesize").alias("n")), F.struct(F.col("dstip").alias("ip"), F.col("downbytesize").alias("n")))).alias("e"))
    return ends.groupBy(F.window("ts", f"{minutes} minutes"), "slot", F.col("e.ip").alias("ip")).agg(F.sum("e.n").alias("bytes")).select("slot", "ip", "bytes")


def last_updates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows written in update mode, the last of each key."""
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max(F.struct("batch", *rest)).alias("last")).select(*keys, *(F.col(f"last.{c}").alias(c) for c in rest))


def without_repeats(flows: DataFrame, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """The first of the flows that repeat their keys within the horizon."""
    return flows.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)
