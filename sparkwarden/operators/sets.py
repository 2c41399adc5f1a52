"""Sorting, top-k, distinct rows, set operations and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group; Spark keeps only k rows a group before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def balance_classes(df: DataFrame, label: str, key: str) -> DataFrame:
    """As many rows of each class as the rarest has, chosen by a scrambled key; rows without a class or key are left out."""
    rows = df.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    least = counts.agg(F.min("n")).first()[0]
    wanted = counts.select(label, F.lit(least or 0).cast("long").alias("wanted"))
    return first_of_classes(rows, label, wanted, (F.col(key) * 7919) % 10007, F.col(key))


def first_of_classes(df: DataFrame, label: str, wanted: DataFrame, order: Column, tie: Column, pieces: int = 4096) -> DataFrame:
    """The first ``wanted`` (label, wanted) rows of each class by ``order`` (a whole number of few values), then ``tie`` (a whole number).

    Counts by value tell the value at which a class is complete: rows before it are taken as they are.  Of that one value
    the ties are counted in ``pieces`` ranges, and only the range in which the class is complete is ranked.  So no class
    is sorted in one task; what is ranked together are the rows of a class with one value and one range of ties.
    """
    rows = df.withColumns({"__o": order.cast("long"), "__t": tie.cast("long")})
    by_value = _boundary(rows, [label], "__o", wanted.select(label, F.col("wanted").alias("__left")))
    cut = by_value.select(F.col(label).alias("__l"), F.col("__at").alias("__cut"), "__left")
    placed = rows.join(F.broadcast(cut), F.col(label) == F.col("__l"))
    before = placed.where(F.col("__o") < F.col("__cut"))
    at = placed.where(F.col("__o") == F.col("__cut"))
    ends = at.groupBy(label).agg(F.min("__t").alias("__lo"), F.max("__t").alias("__hi")).withColumnRenamed(label, "__l2")
    width = F.floor((F.col("__hi") - F.col("__lo")) / pieces) + 1
    pieced = at.join(F.broadcast(ends), F.col(label) == F.col("__l2")).withColumn("__p", F.floor((F.col("__t") - F.col("__lo")) / width))
    last = _boundary(pieced, [label], "__p", cut.select(F.col("__l").alias(label), "__left")).select(F.col(label).alias("__l3"), F.col("__at").alias("__pcut"), F.col("__left").alias("__rest"))
    pieced = pieced.join(F.broadcast(last), F.col(label) == F.col("__l3"))
    ranked = pieced.where(F.col("__p") == F.col("__pcut")).withColumn("__k", F.row_number().over(Window.partitionBy(label, "__p").orderBy("__t"))).where("__k <= __rest")
    out = before.select(*df.columns).unionByName(pieced.where(F.col("__p") < F.col("__pcut")).select(*df.columns))
    return out.unionByName(ranked.select(*df.columns))


def _boundary(df: DataFrame, keys: list[str], value: str, wanted: DataFrame) -> DataFrame:
    """Of each key the value (``__at``) at which ``__left`` rows are complete, and how many of its rows belong to them.

    One row per key and value is summed up in order: as many as there are values, not rows.
    """
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    running = F.sum("__n").over(Window.partitionBy(*keys).orderBy(value))
    summed = counts.withColumn("__upto", running).join(F.broadcast(wanted), keys)
    hit = summed.where((F.col("__upto") >= F.col("__left")) & (F.col("__upto") - F.col("__n") < F.col("__left")))
    return hit.select(*keys, F.col(value).alias("__at"), (F.col("__left") - (F.col("__upto") - F.col("__n"))).alias("__left"))


def new_keys(found: DataFrame, baseline: DataFrame) -> DataFrame:
    """Set difference: distinct rows that the baseline does not have."""
    return found.select(*baseline.columns).subtract(baseline)


def common_members(df: DataFrame, group: str, unit: str, member: str) -> DataFrame:
    """Members that every unit of a group has: those counted as often as the group has units."""
    sizes = df.groupBy(group).agg(F.countDistinct(unit).alias("__units"))
    seen = df.groupBy(group, member).agg(F.countDistinct(unit).alias("__seen"))
    return seen.join(sizes, group).where("__seen = __units").select(group, member)


def split_by_key(key: Column, train_share: int = 70) -> Column:
    """``train`` or ``test`` by a scrambled key, the same in every run."""
    return F.when((key * 7919) % 100 < train_share, "train").otherwise("test")
