"""Joins that detections share, and the merge of many indicators per host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwarden.operators.enrich import bounded


def merge_indicators(tables: dict[str, DataFrame], key: str = "ip") -> DataFrame:
    """One row per entity with a 0/1 column for each table that has it: a union and one grouping, not a chain of joins."""
    parts = [t.select(F.col(key), F.lit(name).alias("__kind")) for name, t in tables.items()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy(key).agg(*(F.max(F.when(F.col("__kind") == n, 1).otherwise(0)).alias(n) for n in tables))


def events_of_hosts(events: DataFrame, hosts: DataFrame, ends: tuple[str, str] = ("srcip", "dstip"), host: str = "ip") -> DataFrame:
    """Events with a listed host at either end, once for each such host (an OR join as an equi join)."""
    spread = events.withColumn(host, F.explode(F.array_distinct(F.array(*ends))))
    return spread.join(bounded(hosts.select(host).distinct()), host, "left_semi")


def membership(df: DataFrame, column: str, threats: DataFrame, suspicious: DataFrame) -> Column | DataFrame:
    """``tag``: 0 in no list, 1 in the threat list, 2 in the suspicious list, 3 in both. Lists have one column each."""
    a = bounded(threats.toDF("__k").distinct()).select(F.col("__k").alias("__a"))
    b = bounded(suspicious.toDF("__k").distinct()).select(F.col("__k").alias("__b"))
    joined = df.join(a, F.col(column) == F.col("__a"), "left").join(b, F.col(column) == F.col("__b"), "left")
    return joined.withColumn("tag", F.col("__a").isNotNull().cast("int") + 2 * F.col("__b").isNotNull().cast("int")).drop("__a", "__b")


def with_pattern_scores(vectors: DataFrame, patterns: DataFrame, indicators: list[str]) -> DataFrame:
    """The rule score of each exact indicator vector, null where no rule has it."""
    return vectors.join(bounded(patterns.select(*indicators, "pattern_score")), indicators, "left")


def whitelisted_by_feedback(verdicts: DataFrame, feedback: DataFrame, indicators: list[str], key: str = "ip") -> DataFrame:
    """Verdicts whose indicator vector feedback has with a flag other than 2, one row per host."""
    allowed = feedback.where("flag <> 2").select(*indicators).distinct()
    return verdicts.join(bounded(allowed), indicators, "left_semi").dropDuplicates([key])


def upsert(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Old rows with the new value where there is one, and the new rows."""
    return old.join(new.withColumnRenamed(value, "__new"), keys, "full").select(*keys, F.coalesce("__new", value).alias(value))


def update_insert_sets(found: DataFrame, present: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """What to update (the key is present) and what to insert (it is not)."""
    keys = present.select(key).distinct()
    return found.join(keys, key, "left_semi"), found.join(keys, key, "left_anti")
