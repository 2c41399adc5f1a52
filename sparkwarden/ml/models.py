"""Models on feature tables, texts and records: fitted by Spark, applied by Spark."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, NaiveBayes, OneVsRest, RandomForestClassifier
from pyspark.ml.clustering import LDA, KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, PCA, CountVectorizer, HashingTF, MinMaxScaler, RegexTokenizer, VectorAssembler, Word2Vec
from pyspark.ml.fpm import FPGrowth
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from sparkwarden.operators.aggregates import per_label_metrics
from sparkwarden.storage import discard, path_of, written


#: The features of a DNS record that the covert-channel classifier reads (see ``plans.dns.covert_features``).
COVERT_FEATURES = ["labels", "name_length", "max_ttl", "sum_length", "bits", "digits", "size"]


def save(model, path: str) -> None:
    """Write a fitted model or pipeline to a folder that all executors share."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    """A pipeline that ``save`` wrote."""
    return PipelineModel.load(path)


def boosted_pipeline(train: DataFrame, columns: list[str], iterations: int = 10, seed: int = 1) -> PipelineModel:
    """Boosted trees on numeric columns, with a 0/1 ``label``; null features leave a row out."""
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip"), GBTClassifier(maxIter=iterations, maxDepth=3, seed=seed)]).fit(train)


def forest_pipeline(train: DataFrame, columns: list[str], seed: int = 21) -> PipelineModel:
    """A forest of 4 trees of depth 4 with 10 bins on numeric columns."""
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip"), RandomForestClassifier(numTrees=4, maxDepth=4, maxBins=10, seed=seed)]).fit(train)


def assembled(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as one vector ``features``; rows with a null in them go."""
    return VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip").transform(df)


def boosted_scores(train: DataFrame, other: DataFrame, iterations: int = 10, seed: int = 1) -> DataFrame:
    """``other`` with the prediction of boosted trees fitted on ``train`` (label, features)."""
    return GBTClassifier(maxIter=iterations, maxDepth=3, seed=seed).fit(train).transform(other).withColumn("probability", vector_to_array("probability")[1])


def cross_validated_forest(train: DataFrame, folds: int = 5, seed: int = 21):
    """A small forest (4 trees, depth 4, 10 bins), its depth chosen by F1 over folds."""
    forest = RandomForestClassifier(numTrees=4, maxDepth=4, maxBins=10, seed=seed)
    grid = ParamGridBuilder().addGrid(forest.maxDepth, [3, 4]).build()
    return CrossValidator(estimator=forest, estimatorParamMaps=grid, evaluator=MulticlassClassificationEvaluator(metricName="f1"), numFolds=folds, seed=seed).fit(train)


def text_classifier(train: DataFrame, features: int = 20_000) -> PipelineModel:
    """Tokens, hashed frequencies, inverse document frequency, naive Bayes (``text``, ``label``)."""
    stages = [RegexTokenizer(inputCol="text", outputCol="tokens", pattern=r"\s+"), HashingTF(inputCol="tokens", outputCol="tf", numFeatures=features), IDF(inputCol="tf", outputCol="features"), NaiveBayes()]
    return Pipeline(stages=stages).fit(train)


def indicator_coefficients(samples: DataFrame, indicators: list[str], reg: float = 0.01) -> DataFrame:
    """``(indicator, coefficient)`` of a logistic regression of the label on the indicator flags."""
    model = LogisticRegression(regParam=reg).fit(assembled(samples, indicators).select("label", "features"))
    return samples.sparkSession.createDataFrame(list(zip(indicators, map(float, model.coefficients), strict=True)), "indicator string, coefficient double")


def class_rules(items: DataFrame, consequent: str, support: float = 0.2, confidence: float = 0.8) -> DataFrame:
    """Rules ``antecedent -> consequent`` of frequent patterns in ``items`` (array), scored 100 times their confidence."""
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(items)
    rules = model.associationRules.where(F.array_contains("consequent", consequent))
    return rules.select(F.array_join(F.array_sort("antecedent"), ",").alias("antecedent"), F.round(F.col("confidence") * 100, 4).alias("score"), F.round("support", 6).alias("support"))


def pair_rules(items: DataFrame, key: str, item: str, support: float, confidence: float) -> DataFrame:
    """Support and confidence of every rule from one item to another, by joining each basket with itself.

    Baskets hold few distinct items: as many as there are kinds of events.
    """
    rows = items.select(key, item).distinct()
    total = rows.agg(F.countDistinct(key).alias("total"))
    ones = rows.groupBy(item).agg(F.count(F.lit(1)).alias("n_a")).withColumnRenamed(item, "a")
    pairs = rows.withColumnRenamed(item, "a").join(rows.withColumnRenamed(item, "b"), key).where("a <> b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    out = pairs.join(ones, "a").join(F.broadcast(total), how="cross")
    return out.select("a", "b", F.round(F.col("n") / F.col("total"), 6).alias("support"), F.round(F.col("n") / F.col("n_a"), 6).alias("confidence")).where((F.col("support") >= support) & (F.col("confidence") >= confidence))


def count_vectors(df: DataFrame, entity: str, item: str, vocabulary: int = 1 << 18, min_df: float = 1.0) -> DataFrame:
    """One sparse count vector per entity: the ``vocabulary`` most frequent items, numbered by falling frequency, then by item.

    Items of fewer than ``min_df`` entities are left out; entities whose items all are have an empty vector.  Records are
    counted before the first shuffle, so a row holds an entity's distinct items only, of which there are ``vocabulary``
    at most, however many records it has.  The vectors are written once to the shared folder and read back as vectors.
    """
    counted = written(df.select(entity, item).where(F.col(entity).isNotNull()).groupBy(entity, item).agg(F.count(F.lit(1)).alias("n")), "counts")
    items = counted.where(F.col(item).isNotNull()).groupBy(item).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("df")).where(F.col("df") >= min_df)
    kept = written(items.orderBy(F.desc("total"), item).limit(vocabulary), "vocabulary")
    # As many rows as the vocabulary is allowed to have.
    numbered = kept.select(F.col(item).alias("__item"), (F.row_number().over(Window.orderBy(F.desc("total"), item)) - 1).alias("__k"))
    size = kept.count()
    pairs = counted.join(F.broadcast(numbered), F.col(item) == F.col("__item"), "left")
    lists = pairs.groupBy(entity).agg(F.array_sort(F.collect_list(F.when(F.col("__k").isNotNull(), F.struct("__k", "n")))).alias("v"))
    vector = F.struct(
        F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"),
        F.transform("v", lambda x: x["__k"].cast("int")).alias("indices"), F.transform("v", lambda x: x["n"].cast("double")).alias("values"),
    )
    plain = written(lists.select(entity, vector.alias("features")), "vectors")
    schema = StructType([plain.schema[entity], StructField("features", VectorUDT())])
    discard(counted, kept)
    return df.sparkSession.read.schema(schema).parquet(path_of(plain))


def term_statistics(tokens: DataFrame, min_df: int, vocabulary: int) -> DataFrame:
    """The vocabulary of ``(doc_id, word)`` rows: words in at least ``min_df`` documents, the most frequent ones."""
    per = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("tf"), F.countDistinct("doc_id").alias("df")).where(F.col("df") >= min_df)
    return per.orderBy(F.desc("tf"), "word").limit(vocabulary)


def clusters(vectors: DataFrame, entity: str, k: int = 3, scaled: bool = True, seed: int = 1) -> DataFrame:
    """k-means clusters of the entities' (min-max scaled) vectors."""
    if scaled:
        vectors = MinMaxScaler(inputCol="features", outputCol="scaled").fit(vectors).transform(vectors).drop("features").withColumnRenamed("scaled", "features")
    return KMeans(k=k, seed=seed).fit(vectors).transform(vectors).select(entity, F.col("prediction").alias("cluster"))


def topic_model(tokens: DataFrame, topics: int, seeds: dict[str, int] | None = None, boost: int = 5, iterations: int = 5, seed: int = 1, vocabulary: int = 1 << 18, words: int | None = None) -> DataFrame:
    """``(topic, word, p)`` of a topic model; seed words count ``boost`` times.

    The ``vocabulary`` most frequent words of two or more documents take part; each topic lists its first ``words``
    (all, if not given).
    """
    weight = F.when(F.col("word").isin(list(seeds or {})), boost).otherwise(1)
    bags = tokens.groupBy("doc_id").agg(F.flatten(F.collect_list(F.array_repeat(F.col("word"), weight))).alias("items"))
    bags = written(bags, "bags")  # the vocabulary and the vectors are made of them
    counted = CountVectorizer(inputCol="items", outputCol="features", vocabSize=vocabulary, minDF=2.0).fit(bags)
    vectors = written(counted.transform(bags).select("features"), "vectors")  # each iteration reads them
    model = LDA(k=topics, maxIter=iterations, seed=seed).fit(vectors)
    discard(bags, vectors)
    names = tokens.sparkSession.createDataFrame(list(enumerate(counted.vocabulary)), "k int, word string")
    top = model.describeTopics(words or len(counted.vocabulary)).select("topic", F.explode(F.arrays_zip("termIndices", "termWeights")).alias("t"))
    return top.select("topic", F.col("t.termIndices").alias("k"), F.col("t.termWeights").alias("p")).join(names, "k").select("topic", "word", "p")


def topic_ranking(counts: DataFrame, topics: int) -> DataFrame:
    """Words of each topic ranked by ``(1/K + n_kv / n_v) * log10(n_kv)`` from ``(topic, word, n)``."""
    totals = counts.groupBy("word").agg(F.sum("n").alias("total"))
    score = (F.lit(1.0 / topics) + F.col("n") / F.col("total")) * F.log10("n")
    return counts.join(totals, "word").select("topic", "word", F.round(score, 6).alias("score"))


def table_cosine(a: DataFrame, b: DataFrame) -> DataFrame:
    """How alike two word-topic tables ``(word, topic, n)`` are, as one row: the cosine of each word's topics, weighted by its count.

    The weight of a word is its count in both tables; words that one table lacks count as 0 alike.  Counts are multiplied
    as doubles: products of sums of squares do not fit a long.
    """
    as_double = lambda t, name: t.select("word", "topic", F.col("n").cast("double").alias(name))
    joined = as_double(a, "x").join(as_double(b, "y"), ["word", "topic"], "full").fillna(0.0, ["x", "y"])
    norm = F.sqrt(F.sum(F.col("x") * F.col("x")) * F.sum(F.col("y") * F.col("y")))
    words = joined.groupBy("word").agg(F.sum(F.col("x") + F.col("y")).alias("n"), F.when(norm > 0, F.sum(F.col("x") * F.col("y")) / norm).otherwise(0.0).alias("cosine"))
    return words.agg(F.round(F.sum(F.col("n") * F.col("cosine")) / F.sum("n"), 6).alias("cosine"))


def compared_classifiers(train: DataFrame, test: DataFrame, inputs: int, trees: int = 200, seed: int = 1) -> DataFrame:
    """Metrics of four classifiers on a test set (label, features): forest, linear SVM, neural network, naive Bayes."""
    labels = int(train.agg(F.max("label")).first()[0]) + 1
    known = {"forest": RandomForestClassifier(numTrees=trees, seed=seed), "svm": OneVsRest(classifier=LinearSVC(maxIter=20)), "network": MultilayerPerceptronClassifier(layers=[inputs, 8, labels], maxIter=20, seed=seed), "bayes": NaiveBayes(modelType="gaussian")}
    out = []
    for name, model in known.items():
        scored = model.fit(train).transform(test)
        out.append(per_label_metrics(scored.select(F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))).withColumn("model", F.lit(name)))
    return reduce(DataFrame.unionByName, out)


def importances(train: DataFrame, top: int = 30, trees: int = 20, seed: int = 1) -> DataFrame:
    """The most important features of a forest, numbered from 1."""
    model = RandomForestClassifier(numTrees=trees, seed=seed).fit(train)
    rows = [(k + 1, float(v)) for k, v in enumerate(model.featureImportances.toArray())]
    return train.sparkSession.createDataFrame(rows, "feature int, importance double").orderBy(F.desc("importance"), "feature").limit(top)


def principal_components(df: DataFrame, key: str, k: int = 2) -> DataFrame:
    out = PCA(k=k, inputCol="features", outputCol="pc").fit(df).transform(df)
    return out.select(key, *(vector_to_array("pc")[i].alias(f"pc{i + 1}") for i in range(k)))


#: Tokens that one task of ``word_vectors`` trains on, about.
TASK_TOKENS = 500_000


def word_vectors(docs: DataFrame, size: int = 8, seed: int = 1, task_tokens: int = TASK_TOKENS) -> DataFrame:
    """Word embeddings of tokenised texts (``tokens``); texts without any (null) are left out.

    Texts are dealt into parts of about ``task_tokens``: Spark trains each part in one task and takes the mean of their
    vectors, so the longest task does not grow with the input.
    """
    docs = docs.where("tokens is not null")
    total = docs.agg(F.sum(F.size("tokens")).alias("n")).first()["n"] or 0
    parts = max(1, -(-total // task_tokens))
    return Word2Vec(vectorSize=size, minCount=5, inputCol="tokens", outputCol="v", seed=seed, maxIter=1, numPartitions=parts).fit(docs).getVectors().select("word", vector_to_array("vector").alias("vector"))
