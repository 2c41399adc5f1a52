"""Aggregations over flows, events and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwarden.operators.sets import top_k


def two_way_volume(flows: DataFrame, by: list[str], up: str = "upbytesize", down: str = "downbytesize") -> DataFrame:
    """Bytes of each host: sent where it is the source, received where it is the destination; one shuffle."""
    ends = flows.select(*by, F.explode(F.array(F.struct(F.col("srcip").alias("ip"), F.col(up).alias("n")), F.struct(F.col("dstip").alias("ip"), F.col(down).alias("n")))).alias("e"))
    return ends.groupBy(F.col("e.ip").alias("ip"), *by).agg(F.sum("e.n").alias("bytes"))


def set_text(column: str | Column, sep: str = "#") -> Column:
    """The distinct values of a group, sorted and joined; for groups of few values."""
    return F.concat_ws(sep, F.array_sort(F.collect_set(column)))


def first_texts(df: DataFrame, key: str, column: str, k: int, sep: str = "#") -> DataFrame:
    """The first ``k`` distinct values of each group, sorted and joined; no group is gathered, however many values it has."""
    values = df.select(key, column).where(F.col(column).isNotNull()).distinct()
    firsts = top_k(values, [key], [F.col(column)], k).groupBy(key).agg(F.concat_ws(sep, F.array_sort(F.collect_list(column))).alias(column))
    return df.select(key).distinct().join(firsts, key, "left").fillna("", [column])


def latest(df: DataFrame, keys: list[str], at: str, tie: str) -> DataFrame:
    """The latest row of each key, of equal times that with the largest ``tie``. Combined before the shuffle."""
    rest = [c for c in df.columns if c not in (*keys, at, tie)]
    top = F.max(F.struct(at, tie, *rest)).alias("__top")
    return df.groupBy(*keys).agg(top).select(*keys, *(F.col(f"__top.{c}").alias(c) for c in (at, tie, *rest)))


def mode(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The most frequent value of each key, of equally frequent ones the smallest."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*keys).agg(F.max(F.struct("n", (-F.col(value)).alias("__minus"))).alias("top")).select(*keys, (-F.col("top.__minus")).alias(value), F.col("top.n").alias("n"))


def shared_by(df: DataFrame, key: str, entity: str, least: int) -> DataFrame:
    """Keys that at least ``least`` distinct entities have, with the number of them."""
    return df.groupBy(key).agg(F.countDistinct(entity).alias("n")).where(F.col("n") >= least)


def upper_limit(column: str, k: float = 3.0) -> Column:
    """Mean and ``k`` population standard deviations; ``k`` times the value where there is only one."""
    c = F.col(column)
    return F.when(F.count(c) == 1, k * F.max(c)).otherwise(F.avg(c) + k * F.stddev_pop(c))


def fill_with_mean(df: DataFrame, key: str | list[str], value: str) -> Column:
    """The value, or the mean of the key's other values where it is missing."""
    keys = [key] if isinstance(key, str) else key
    return F.coalesce(F.col(value), F.avg(value).over(Window.partitionBy(*keys)))


def term_weights(terms: DataFrame, doc: str = "doc_id", term: str = "term") -> DataFrame:
    """Of each term its frequency, document frequency and ``ln(tf) / df``."""
    per_doc = terms.groupBy(term, doc).agg(F.count(F.lit(1)).alias("n"))
    return per_doc.groupBy(term).agg(F.sum("n").alias("tf"), F.count(F.lit(1)).alias("df")).withColumn("weight", F.round(F.log("tf") / F.col("df"), 6))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction", by: list[str] | None = None) -> DataFrame:
    """tp, fp, fn, tn of 0/1 columns, with precision, recall, accuracy and F1 (null where undefined)."""
    cell = lambda a, b, n: F.sum(F.when((F.col(label) == a) & (F.col(prediction) == b), 1).otherwise(0)).alias(n)
    counts = df.groupBy(*(by or [])).agg(cell(1, 1, "tp"), cell(0, 1, "fp"), cell(1, 0, "fn"), cell(0, 0, "tn"))
    ratio = lambda a, b: F.round(F.when(b > 0, a / b), 6)
    tp, fp, fn, tn = map(F.col, ("tp", "fp", "fn", "tn"))
    return counts.select(*(by or []), "tp", "fp", "fn", "tn", ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def per_label_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Of each label its rows, precision, recall, false positive rate and F-measure, from one confusion table."""
    cells = df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(F.explode(F.array(F.struct(F.col(label).alias("k"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("said")), F.struct(F.col(prediction).alias("k"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("said")))).alias("s"), F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0).alias("hit"))
    per = sides.groupBy(F.col("s.k").alias("label")).agg(F.sum("s.actual").alias("actual"), F.sum("s.said").alias("said"), (F.sum("hit") / 2).alias("tp"))
    total = cells.agg(F.sum("n").alias("total"))
    r = lambda c: F.round(c, 6)
    out = per.join(F.broadcast(total), how="cross")
    precision, recall = F.when(F.col("said") > 0, F.col("tp") / F.col("said")).otherwise(0.0), F.when(F.col("actual") > 0, F.col("tp") / F.col("actual")).otherwise(0.0)
    fpr = F.when(F.col("total") > F.col("actual"), (F.col("said") - F.col("tp")) / (F.col("total") - F.col("actual"))).otherwise(0.0)
    f = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return out.select("label", "actual", r(precision).alias("precision"), r(recall).alias("recall"), r(fpr).alias("fpr"), r(f).alias("f_measure"))


def length_and_classes(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Of each key the least and greatest length of its values and the character classes that occur in them."""
    from sparkwarden.functions.strings import shape

    kinds = df.select(*keys, F.explode(F.split(shape(F.col(value)), ",")).alias("c")).groupBy(*keys).agg(set_text("c", ",").alias("classes"))
    return df.groupBy(*keys).agg(F.min(F.length(value)).alias("low"), F.max(F.length(value)).alias("high")).join(kinds, keys)
