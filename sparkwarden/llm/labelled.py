"""Labelled samples for the classifiers: bounded, never from the held-out fifth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Rows whose crc32(id as text) leaves 0 modulo 5. Null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, label)`` of at most ``per_class[c]`` rows for each class, chosen by a hash of the id.

    The ids that are broadcast are at most the sum of the bounds.  Null labels and ids are left out.  An id that is
    labelled twice has its highest label; of rows that repeat an id, the one with the smallest text is taken.
    """
    rows = labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = None
    for value, bound in per_class.items():
        part = rows.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = chosen.withColumnRenamed("doc_id", "__id")
    found = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
