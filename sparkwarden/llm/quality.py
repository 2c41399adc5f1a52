"""Text quality by a sparse ensemble of rules.

Small trees are fitted on text statistics; every path from a root to a node is a rule, a conjunction of thresholds.
A lasso logistic regression weighs the rules and sets most weights to zero.  What is left is compiled into one Spark
column expression, so scoring is a projection over the scan.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwarden.llm.labelled import held_out, training_sample
from sparkwarden.storage import written

#: Labelled rows of each class that the fit uses at most.
ROWS_PER_CLASS = 5000
TREES, DEPTH, LASSO = 24, 3, 0.002
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÇÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜ"


def _share(text: Column, characters: str, of: Column) -> Column:
    """Characters of a set in the text, per ``of``."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))) / of


NAMES = ["chars", "words", "word_length", "distinct_words", "upper", "digits", "exclamations", "bars", "symbols", "stops", "lines"]


def with_statistics(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the statistics of each text (null: the empty text); all are finite for any text.

    The text is cut into words once: the array is a column of its own, which Spark does not compute again for each use.
    """
    cut = df.select(*keep, F.btrim(F.coalesce(F.col(text_col), F.lit("")), F.lit(" \t\n\x0b\x0c\r")).alias("__t"))
    cut = cut.select(*keep, "__t", F.split("__t", r"[\x20\x09-\x0D]+").alias("__w"))
    cut = cut.select(*keep, "__t", F.greatest(F.length("__t"), F.lit(1)).cast("double").alias("__size"), F.size("__w").cast("double").alias("__n"), F.size(F.array_distinct("__w")).cast("double").alias("__kinds"))
    t, size, n = F.col("__t"), F.col("__size"), F.col("__n")
    stats = [
        size, n, size / n, F.col("__kinds") / n, _share(t, _UPPER, size), _share(t, "0123456789", size), _share(t, "!", n), _share(t, "|", n),
        _share(t, "#$%&*@^~_=+<>{}[]\\/", size), _share(t, ".,;:?", n), _share(t, "\n", n),
    ]
    return cut.select(*keep, *(c.alias(f"__{k}") for k, c in zip(NAMES, stats, strict=True)))


Rule = tuple[tuple[str, bool, float], ...]  # (statistic, at most?, threshold), all of which must hold


@dataclass
class RuleModel:
    rules: list[tuple[Rule, float]]
    intercept: float

    def score(self, columns: dict[str, Column]) -> Column:
        """The probability of label 1, from columns that hold the statistics."""
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            total = total + F.when(holds(rule, columns), F.lit(float(weight))).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def holds(rule: Rule, columns: dict[str, Column]) -> Column:
    out = F.lit(True)
    for name, below, threshold in rule:
        out = out & ((columns[name] <= threshold) if below else (columns[name] > threshold))
    return out


def _paths(node, names: list[str], path: Rule = ()) -> list[Rule]:
    """The rules of a fitted tree: one for every node but the root."""
    found = [path] if path else []
    if node.getClass().getSimpleName() == "InternalNode":
        name, threshold = names[node.split().featureIndex()], round(node.split().threshold(), 6)
        found += _paths(node.leftChild(), names, (*path, (name, True, threshold)))
        found += _paths(node.rightChild(), names, (*path, (name, False, threshold)))
    return found


def fit_rules(sample: DataFrame, label: str = "label", trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO, seed: int = 7) -> RuleModel:
    """Fit on a frame of ``text`` and a 0/1 ``label``. One class only (or no rows) gives a constant model."""
    names = NAMES
    rows = with_statistics(sample.select("text", F.col(label).cast("double").alias("label")), "text", ["label"])
    rows = written(rows.select("label", *(F.col(f"__{n}").alias(n) for n in names)), "statistics")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return RuleModel([], 20.0 if 0.0 not in counts and counts else -20.0 if counts else 0.0)
    data = VectorAssembler(inputCols=names, outputCol="features").transform(rows.coalesce(2)).select("label", "features", *names).cache()
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird", subsamplingRate=0.8).fit(data.select("label", "features"))
    rules = sorted({tuple(dict.fromkeys(r)) for tree in forest.trees for r in _paths(tree._java_obj.rootNode(), names)})
    columns = {n: F.col(n) for n in names}
    marked = data.select("label", *(F.when(holds(r, columns), 1.0).otherwise(0.0).alias(f"r{k}") for k, r in enumerate(rules)))
    marked = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="rules").transform(marked).select("label", "rules").cache()
    model = LogisticRegression(featuresCol="rules", regParam=lasso, elasticNetParam=1.0, maxIter=60, standardization=False).fit(marked)
    weights = model.coefficients.toArray().tolist()
    marked.unpersist()
    data.unpersist()
    kept = [(r, w) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6]
    # The classes were bounded one by one; the intercept is moved back to their true odds by the caller if it knows them.
    return RuleModel(kept, float(model.intercept))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", threshold: float = 0.3, rows_per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``score`` (0 to 1, higher: label 1 likelier), ``predicted``.

    Rules are learned from at most ``rows_per_class`` labelled rows of each class outside the held-out fifth; the odds
    of the classes are those of all labels outside it.  Scores see the text only.  Null and empty texts are scored like
    any other; without labels every score is one half.  Repeated rows and rows without an id each get a row.
    """
    sample = training_sample(docs, labels, label, {0: rows_per_class, 1: rows_per_class}, id_col, text_col)
    model = fit_rules(sample)
    known = labels.where(F.col(label).isNotNull() & ~held_out(F.col(id_col)))
    n = {int(r[label]): r["count"] for r in known.groupBy(label).count().collect()}
    if model.rules and n.get(0) and n.get(1):
        model.intercept += math.log(n[1] / n[0]) - math.log(min(n[1], rows_per_class) / min(n[0], rows_per_class))
    named = with_statistics(docs.select(F.col(id_col), F.col(text_col)), text_col, [id_col])
    score = model.score({k: F.col(f"__{k}") for k in NAMES})
    out = named.select(id_col, held_out(F.col(id_col)).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
