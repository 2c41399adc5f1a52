"""Feature tables: profiles, scaling, vectors, neighbours, metrics of models."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkwarden.operators.enrich import bounded


def long_features(df: DataFrame, keep: list[str], column: str = "embedding") -> DataFrame:
    """``(keep, feature, x)``: one row for each element of the feature array, numbered from 1."""
    return df.select(*keep, F.posexplode(column).alias("k", "x")).select(*keep, (F.col("k") + 1).alias("feature"), F.col("x").cast("double").alias("x"))


def class_profile(df: DataFrame, label: str = "label") -> DataFrame:
    """Mean and population standard deviation of every feature in each class."""
    return long_features(df, [label]).groupBy(label, "feature").agg(F.round(F.avg("x"), 6).alias("mean"), F.round(F.stddev_pop("x"), 6).alias("std"))


def standardised(train: DataFrame, other: DataFrame, key: str = "vec_id") -> DataFrame:
    """Features of ``other`` minus the mean and over the deviation of ``train`` (constant features: 0)."""
    fitted = long_features(train, []).groupBy("feature").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"))
    return long_features(other, [key]).join(bounded(fitted), "feature").select(key, "feature", F.round(F.when(F.col("s") > 0, (F.col("x") - F.col("m")) / F.col("s")).otherwise(0.0), 5).alias("z"))


def min_max(df: DataFrame, key: str = "vec_id") -> DataFrame:
    rows = long_features(df, [key])
    ends = rows.groupBy("feature").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    return rows.join(bounded(ends), "feature").select(key, "feature", F.round(F.when(F.col("hi") > F.col("lo"), (F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(0.0), 5).alias("scaled"))


def vectors(df: DataFrame, column: str = "embedding") -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(column).cast("array<double>")))


#: Query vectors that one pass over the base compares with it.
QUERY_BLOCK = 50_000


def nearest_votes(queries: DataFrame, base: DataFrame, k: int = 5, key: str = "vec_id", label: str = "label", block: int = QUERY_BLOCK) -> DataFrame:
    """The majority label of each query's ``k`` nearest base vectors (squared distance to 4 places, ties by key, then label).

    A stated query set meets all rows: blocks of about ``block`` queries are broadcast, one after the other, the base is
    read where it lies, and every batch of it keeps only its ``k`` nearest rows for each query.
    """
    wanted = queries.select(F.col(key).cast("long").alias("q"), F.col("embedding").cast("array<double>").alias("v"))
    blocks = max(1, -(-wanted.count() // block))
    parts = [_nearest(wanted.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == n), base, k, key, label) for n in range(blocks)]
    found = reduce(DataFrame.unionByName, parts)
    # The best of all batches: distances are ranked together with their rows, a row for each query in the end.
    best = found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("d", "b"))).where(F.col("rank") <= k)
    votes = best.groupBy("q", "y").agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy("q").agg(F.max(F.struct("n", (-F.col("y")).alias("m"))).alias("top")).select(F.col("q").alias(key), (-F.col("top.m")).alias("prediction"))


def _nearest(wanted: DataFrame, base: DataFrame, k: int, key: str, label: str) -> DataFrame:
    """``(q, b, y, d)``: of each batch of the base, the ``k`` nearest rows of each of the wanted vectors."""
    rows = wanted.orderBy("q").collect()
    held = wanted.sparkSession.sparkContext.broadcast((np.array([r["q"] for r in rows], np.int64), np.array([r["v"] for r in rows], np.float64)))

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q, v = held.value
        for batch in batches:
            b, y = batch["b"].to_numpy(np.int64), batch["y"].to_numpy(np.int64)
            for lo in range(0, len(batch) if len(q) else 0, 1024):
                ids, labels, x = b[lo : lo + 1024], y[lo : lo + 1024], np.stack(batch["v"].to_numpy()[lo : lo + 1024]).astype(np.float64)
                for at in range(0, len(q), 256):
                    d = np.round(((v[at : at + 256, None, :] - x[None]) ** 2).sum(axis=2), 4)
                    d[q[at : at + 256, None] == ids[None]] = np.inf  # a row is not its own neighbour
                    order = np.lexsort((np.broadcast_to(ids, d.shape), d), axis=1)[:, :k]
                    rows = np.arange(len(d))[:, None]
                    found = pd.DataFrame({"q": np.repeat(q[at : at + 256], order.shape[1]), "b": ids[order].ravel(), "y": labels[order].ravel(), "d": d[rows, order].ravel()})
                    yield found[np.isfinite(found["d"])]

    others = base.select(F.col(key).cast("long").alias("b"), F.col(label).cast("long").alias("y"), F.col("embedding").alias("v"))
    return others.mapInPandas(near, "q long, b long, y long, d double")
