"""Weights and rules of the host score, fitted by day and read as they were before the scored day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwarden.ml import models
from sparkwarden.plans import events as E
from sparkwarden.plans.hosts import normalised_weights
from sparkwarden.sources.versions import Versions
from sparkwarden.storage import discard, written


class ScoreRegistry:
    """Versions of weights (indicator, weight) and of rules (the ten flags, pattern_score) under ``root``.

    A version is published for the day whose labels it has learned from; ``for_day`` gives the newest one of an earlier
    day, so that scores of a day never rest on labels of that day or later ones, whatever was published since.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.weights = Versions(spark, f"{root}/weights", "indicator string, weight double")
        self.rules = Versions(spark, f"{root}/rules", ", ".join(f"{k} int" for k in E.KINDS) + ", pattern_score double")

    def learn(self, samples: DataFrame, day: int, support: float = 0.2, confidence: float = 0.8) -> None:
        """Fit on ``samples`` (the ten flags and ``label``) of days up to ``day``; a day that was learned is not learned again.

        Weights are normalised coefficients of a logistic regression; where all labels are alike all weights are 0.1.
        Rules are frequent patterns that imply the positive label; a rule holds for exactly its vector.
        """
        rows = written(samples.select(*E.KINDS, F.col("label").cast("int").alias("label")).where("label is not null"), "samples")
        labels = rows.agg(F.countDistinct("label")).first()[0]
        flat = rows.sparkSession.createDataFrame([(k, 0.1) for k in E.KINDS], "indicator string, weight double")
        weights = normalised_weights(models.indicator_coefficients(rows, E.KINDS)) if labels > 1 else flat
        names = [F.when(F.col(k) == 1, F.lit(k)) for k in E.KINDS] + [F.when(F.col("label") == 1, F.lit("bad"))]
        baskets = rows.select(F.array_compact(F.array(*names)).alias("items")).where(F.size("items") > 0)
        found = models.class_rules(baskets, "bad", support, confidence)
        has = F.split("antecedent", ",")
        rules = found.where(F.col("antecedent") != "").select(*(F.array_contains(has, k).cast("int").alias(k) for k in E.KINDS), F.col("score").cast("double").alias("pattern_score"))
        self.weights.merge("labels", day, lambda _: weights)
        self.rules.merge("labels", day, lambda _: rules)
        discard(rows)

    def for_day(self, day: int) -> tuple[dict[str, float], DataFrame]:
        """Weights (ten numbers) and rules for scoring a day; all weights 0.1 and no rules where nothing was learned before."""
        known = {r.indicator: r.weight for r in self.weights.as_of("labels", day).collect()}
        return {k: known.get(k, 0.1) for k in E.KINDS}, self.rules.as_of("labels", day)


def scored_day(events: DataFrame, registry: ScoreRegistry, day: int, most_up: float = 70, feedback: DataFrame | None = None, cut_off: int = 0) -> DataFrame:
    """Verdicts on the events of one day, by what was learned before it."""
    weights, rules = registry.for_day(day)
    return E.verdicts(E.fused(events.where(F.col("day") == day), most_up), weights, rules, feedback, cut_off)
