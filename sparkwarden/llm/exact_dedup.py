"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

DataFrame functions only.  Copies agree after each run of ``[\\x20\\x09-\\x0D]`` is replaced by one space; a null
text is the empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwarden.storage import scratch, small_or_shuffled, written

#: Characters of a text that the second level hashes.
PREFIX_CHARS = 256


def normalised(text: Column) -> Column:
    """The text that counts as equal: null is empty, a run of blanks is one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def surviving_groups(sketch: DataFrame) -> DataFrame:
    """``(size, prefix)`` of the groups that may hold copies, of a table with these columns.

    Lengths that one row has go first; only the others' prefixes are grouped, and those that one row has go.
    """
    lengths = sketch.groupBy("size").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("size").alias("of_size"))
    again = sketch.join(small_or_shuffled(lengths), F.col("size") == F.col("of_size"), "left_semi")
    return again.groupBy("size", "prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("size", "prefix")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS, digest_all: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Only rows of groups that survive length and prefix hash have their whole text hashed, unless ``digest_all``
    asks for everyone's digest (else ``text_sha256`` is null for the rest).  The full hash is SHA-256 beside the
    length.  Counts and minima combine before each shuffle, and the joins that bring them back are plain equi joins
    on freshly shuffled keys, which adaptive execution splits where one group holds a large share of the rows.

    Null texts are copies of the empty text.  Rows that repeat an id and its text are one group and are marked alike,
    so with repeated ids more than one row can be kept; rows without an id keep the group's smallest id, or null.
    An empty table gives an empty result; other columns are not looked at.
    """
    clean = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), clean.alias("clean"))
    rows = rows.select("doc_id", "clean", F.length("clean").alias("size"), F.xxhash64(F.substring("clean", 1, prefix_chars)).alias("prefix"))
    digest = F.sha2(F.encode("clean", "UTF-8"), 256)
    # Each text is read and normalised once for lengths and prefixes (and its digest, where everyone's is wanted).
    sketch = written(rows.select("doc_id", "size", "prefix", *([digest.alias("text_sha256")] if digest_all else [])), "sketch")
    survivors = small_or_shuffled(written(surviving_groups(sketch).withColumn("survives", F.lit(True)), "survivors"))
    if digest_all:
        marked = sketch.join(survivors, ["size", "prefix"], "left")
    else:
        marked = rows.join(survivors, ["size", "prefix"]).select("doc_id", "size", "survives", digest.alias("text_sha256"))
        others = sketch.join(survivors, ["size", "prefix"], "left_anti").select("doc_id", "size", F.lit(None).cast("boolean").alias("survives"), F.lit(None).cast("string").alias("text_sha256"))
        marked = marked.unionByName(others)
    # A single row's key is its own, so that only survivors meet in groups.
    marked = marked.select("doc_id", "text_sha256", "survives", F.when(F.col("survives"), F.concat_ws(":", "size", "text_sha256")).alias("content"))
    groups = marked.where("content is not null").groupBy("content").agg(F.min("doc_id").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Another key than the grouping's, so that both sides are shuffled for the join and hot groups can be split.
    groups = groups.select(F.concat(F.col("content"), F.lit("=")).alias("of"), "keep", "n")
    joined = marked.withColumn("of", F.concat(F.col("content"), F.lit("="))).join(groups, "of", "left")
    keep = F.when(F.col("n").isNotNull(), F.col("keep")).otherwise(F.col("doc_id"))
    return joined.select(
        F.col("doc_id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("doc_id") == keep, F.col("n").isNull() | F.col("keep").isNull()).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text another row of smaller id has; all columns stay.

    Rows without an id stay.  Rows that repeat an id and its text stay together.
    """
    with scratch() as keep:
        gone = exact_groups(docs, id_col, text_col).where(~F.col("kept")).select(F.col(id_col).alias("__gone")).distinct()
        gone = keep(written(gone, "gone"))
    return docs.join(small_or_shuffled(gone), docs[id_col] == gone["__gone"], "left_anti")
