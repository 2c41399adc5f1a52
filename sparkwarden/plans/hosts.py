"""Fusion of indicators into a host verdict and its score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwarden.operators.aggregates import latest
from sparkwarden.operators.enrich import bounded, level
from sparkwarden.operators.merge import with_pattern_scores


def fused_indicators(events: DataFrame, kinds: list[str], conditions: dict[str, str] | None = None) -> DataFrame:
    """One row per host: a flag for each kind of event, evidence (kind and id of the latest events) and the time range.

    ``conditions`` are SQL conditions that events of a kind must meet to count.  Only the latest event of each host and
    kind is looked at.
    """
    last = latest(events.where(F.col("modeltype").isin(kinds)), ["ip", "modeltype"], "sec", "id")
    ok = F.lit(True)
    for kind, condition in (conditions or {}).items():
        ok = ok & ((F.col("modeltype") != kind) | F.expr(condition))
    last = last.where(ok)
    flags = [F.max(F.when(F.col("modeltype") == k, 1).otherwise(0)).alias(k) for k in kinds]
    evidence = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "modeltype", F.col("id").cast("string")))), "#").alias("evidence")
    return last.groupBy("ip").agg(*flags, evidence, F.min("sec").alias("first_at"), F.max("sec").alias("last_at"))


def compromise_scores(indicators: DataFrame, weights: dict[str, float], patterns: DataFrame, threat: str, floor: int = 60, cut_off: int = 0) -> DataFrame:
    """The rule score of the exact indicator vector, else the integer part of 100 times the weighted flags.

    A set ``threat`` flag lifts the score to ``floor``; hosts at or below ``cut_off`` go.
    """
    kinds = list(weights)
    weighted = sum((F.col(k) * F.lit(float(w)) for k, w in weights.items()), F.lit(0.0))
    scored = with_pattern_scores(indicators, patterns, kinds)
    raw = F.coalesce("pattern_score", F.floor(weighted * 100 + 1e-9).cast("double"))
    score = F.when((F.col(threat) == 1) & (raw < floor), float(floor)).otherwise(raw)
    out = scored.select("ip", *kinds, score.alias("score"), F.when(F.col("pattern_score").isNotNull(), 1).otherwise(2).alias("score_type"))
    return out.where(F.col("score") > cut_off).withColumn("level", level(F.col("score")))


def resolved_labels(samples: DataFrame) -> DataFrame:
    """Labels after feedback: flag 1 is positive, 2 negative, 0 keeps the label."""
    return samples.withColumn("label", F.when(F.col("flag") == 1, 1).when(F.col("flag") == 2, 0).otherwise(F.col("label")))


def normalised_weights(coefficients: DataFrame) -> DataFrame:
    """``(indicator, weight)`` from ``(indicator, coefficient)``: negatives become a quarter of the least positive one, and
    the sum becomes 1; with one positive or none, every weight is 0.1. There are as many rows as indicators."""
    c = F.col("coefficient")
    stats = coefficients.agg(F.min(F.when(c > 0, c)).alias("least"), F.count(F.when(c > 0, 1)).alias("positive"))
    lifted = coefficients.join(bounded(stats), how="cross").withColumn("w", F.when(c < 0, F.col("least") / 4).otherwise(c))
    total = lifted.agg(F.sum("w").alias("total"))
    return lifted.join(bounded(total), how="cross").select("indicator", F.round(F.when(F.col("positive") <= 1, 0.1).otherwise(F.col("w") / F.col("total")), 6).alias("weight"))
