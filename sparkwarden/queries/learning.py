"""Models and feature tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkwarden.adapters import view
from sparkwarden.functions.strings import structure_counts
from sparkwarden.ml import features, models
from sparkwarden.operators.merge import merge_indicators
from sparkwarden.plans import dns, hosts, leak
from sparkwarden.queries import query, table
from sparkwarden.queries.relational import _FLAGS, _HOST_DAYS, KINDS, host_days
from sparkwarden.sources.cache import FeatureCache
from sparkwarden.storage import shared_dir, written

XY = ("v_xy",)
_LONG = "x AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, CAST(unnest(range(1, len(embedding) + 1)) AS INTEGER) AS feature FROM v_xy)"


def covert_label():
    """What counts as a covert channel here: long names with long answers, or answers that live long; one record in 50 is mislabelled."""
    rule = ((F.col("name_length") >= 15) & (F.col("sum_length") > 50)) | (F.col("max_ttl") > 240)
    return F.when(F.col("flow_id") % 50 == 7, ~rule).otherwise(rule).cast("double")


def _dns_samples(spark, d):
    rows = dns.covert_features(view(spark, d, "v_dns")).withColumn("label", covert_label())
    return models.assembled(written(rows, "dns-features"), models.COVERT_FEATURES)  # fits read them many times


def _vectors(spark, d):
    return features.vectors(view(spark, d, "v_xy")).select("vec_id", F.col("label").cast("double").alias("label"), "features")


@query("ml1_boosted_scores")
def ml1(spark, d):
    rows = _dns_samples(spark, d)
    return models.boosted_scores(rows.where("flow_id % 10 < 7").select("label", "features"), rows).select("flow_id", "label", "prediction", F.round("probability", 6).alias("probability"))


@query("ml2_cross_validated_forest")
def ml2(spark, d):
    rows = _dns_samples(spark, d)
    return models.cross_validated_forest(rows.where("flow_id % 10 < 7").select("label", "features")).transform(rows.where("flow_id % 10 >= 7")).select("flow_id", "label", "prediction")


@query("ml3_text_classifier")
def ml3(spark, d):
    rows = table(spark, d, "labels").select("doc_id", F.col("quality").cast("double").alias("label")).join(table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    return models.text_classifier(rows.where("doc_id % 10 < 7")).transform(rows.where("doc_id % 10 >= 7")).select("doc_id", "label", "prediction")


def _samples(spark, d):
    events = host_days(spark, d)
    hosts_of = merge_indicators({k: events.where(F.col("modeltype") == k) for k in KINDS})
    return hosts_of.withColumn("label", (F.length("ip") % 2).cast("int")).withColumn("flag", F.col("click") + F.col("error"))


@query("ml4_indicator_weights")
def ml4(spark, d):
    return hosts.normalised_weights(models.indicator_coefficients(_samples(spark, d), list(KINDS)))


_COEF = "c AS (SELECT modeltype AS indicator, CAST(sum(CASE WHEN id % 3 = 0 THEN -3 ELSE 1 END) AS DOUBLE) / 100 AS c FROM v_evt GROUP BY modeltype), s AS (SELECT min(c) FILTER (c > 0) AS least, count(*) FILTER (c > 0) AS positive FROM c), w AS (SELECT indicator, positive, CASE WHEN c < 0 THEN least / 4 ELSE c END AS w FROM c, s)"


@query("ml4_weight_normalisation", f"WITH {_COEF} SELECT indicator, round(CASE WHEN positive <= 1 THEN 0.1 ELSE w / (SELECT sum(w) FROM w) END, 6) AS weight FROM w", ("v_evt",))
def ml4_normalised(spark, d):
    coefficients = view(spark, d, "v_evt").groupBy(F.col("modeltype").alias("indicator")).agg((F.sum(F.when(F.col("id") % 3 == 0, -3).otherwise(1)) / 100.0).alias("coefficient"))
    return hosts.normalised_weights(coefficients)


def _baskets(spark, d):
    return host_days(spark, d).select("ip", F.col("modeltype").alias("item"))


@query("ml5_class_rules")
def ml5(spark, d):
    items = _baskets(spark, d).groupBy("ip").agg(F.collect_set("item").alias("items"))
    return models.class_rules(items, "click", 0.02, 0.2)


@query("ml5_pair_rules", f"WITH {_HOST_DAYS}, b AS (SELECT DISTINCT ip, modeltype AS item FROM h), p AS (SELECT x.item AS a, y.item AS b, count(*) AS n FROM b x JOIN b y ON x.ip = y.ip AND x.item <> y.item GROUP BY ALL), o AS (SELECT item, count(*) AS n FROM b GROUP BY item), r AS (SELECT a, b, round(p.n / (SELECT count(DISTINCT ip) FROM b), 6) AS support, round(p.n / o.n, 6) AS confidence FROM p JOIN o ON o.item = a) SELECT * FROM r WHERE support >= 0.05 AND confidence >= 0.2", ("v_evt",))
def ml5_pairs(spark, d):
    return models.pair_rules(_baskets(spark, d), "ip", "item", 0.05, 0.2)


@query("ml6_resolved_labels", f"WITH {_HOST_DAYS}, v AS (SELECT ip, {_FLAGS} FROM h GROUP BY ip), s AS (SELECT *, CAST(length(ip) % 2 AS INTEGER) AS label, click + error AS flag FROM v) SELECT ip, CASE flag WHEN 1 THEN 1 WHEN 2 THEN 0 ELSE label END AS label FROM s", ("v_evt",))
def ml6(spark, d):
    return hosts.resolved_labels(_samples(spark, d)).select("ip", "label")


@query("ml7_clusters")
def ml7(spark, d):
    return models.clusters(models.count_vectors(view(spark, d, "v_dns"), "srcip", "queries_name"), "srcip")


@query("ml8_vocabulary", "WITH t AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^a-z]+')) AS word FROM documents) SELECT word, count(*) AS tf, count(DISTINCT doc_id) AS df FROM t WHERE length(word) > 2 GROUP BY word HAVING count(DISTINCT doc_id) >= 5 ORDER BY tf DESC, word LIMIT 500")
def ml8(spark, d):
    return models.term_statistics(leak.word_tokens(table(spark, d, "documents")), 5, 500)


@query("ml9_topics")
def ml9(spark, d):
    return models.topic_model(leak.word_tokens(table(spark, d, "documents")), 4, {"the": 0, "der": 1})


_TOPIC_COUNTS = "t AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^a-z]+')) AS word FROM documents), n AS (SELECT CAST(doc_id % 4 AS INTEGER) AS topic, word, count(*) AS n FROM t WHERE length(word) > 2 GROUP BY ALL)"


def _topic_counts(spark, d, by):
    return leak.word_tokens(table(spark, d, "documents")).groupBy((F.col("doc_id") % by).cast("int").alias("topic"), "word").agg(F.count(F.lit(1)).alias("n"))


@query("ml9_topic_ranking", f"WITH {_TOPIC_COUNTS} SELECT topic, word, round((0.25 + n / sum(n) OVER (PARTITION BY word)) * log10(n), 6) AS score FROM n")
def ml9_ranking(spark, d):
    return models.topic_ranking(_topic_counts(spark, d, 4), 4)


@query("ml10_stability", f"WITH {_TOPIC_COUNTS}, a AS (SELECT word, topic, n FROM n WHERE topic < 2), b AS (SELECT word, topic - 2 AS topic, n FROM n WHERE topic >= 2), j AS (SELECT coalesce(a.word, b.word) AS word, sum(coalesce(a.n, 0) + coalesce(b.n, 0)) AS n, sum(coalesce(a.n, 0) * coalesce(b.n, 0)) / nullif(sqrt(sum(coalesce(a.n, 0) ** 2) * sum(coalesce(b.n, 0) ** 2)), 0) AS c FROM a FULL JOIN b ON a.word = b.word AND a.topic = b.topic GROUP BY 1) SELECT round(sum(n * coalesce(c, 0)) / sum(n), 6) AS cosine FROM j")
def ml10(spark, d):
    counts = _topic_counts(spark, d, 4)
    return models.table_cosine(counts.where("topic < 2"), counts.where("topic >= 2").withColumn("topic", F.col("topic") - 2))


@query("ml11_compared_classifiers")
def ml11(spark, d):
    rows = _vectors(spark, d)
    return models.compared_classifiers(rows.where("vec_id % 10 < 7"), rows.where("vec_id % 10 >= 7"), 64)


@query("ml12_nearest_votes", """
    WITH q AS (SELECT * FROM v_xy WHERE vec_id % 20 = 0), d AS (SELECT q.vec_id AS q, b.vec_id AS b, b.label AS y, round(list_sum(list_transform(list_zip(q.embedding, b.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) ** 2)), 4) AS d FROM q JOIN v_xy b ON b.vec_id <> q.vec_id),
         r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d, b) AS k FROM d), v AS (SELECT q, y, count(*) AS n FROM r WHERE k <= 5 GROUP BY q, y)
    SELECT q AS vec_id, CAST(y AS BIGINT) AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY n DESC, y) AS k FROM v) WHERE k = 1""", XY)
def ml12(spark, d):
    rows = view(spark, d, "v_xy")
    return features.nearest_votes(rows.where("vec_id % 20 = 0"), rows)


@query("ml13_importances")
def ml13(spark, d):
    return models.importances(_vectors(spark, d))


@query("ml14_principal_components")
def ml14(spark, d):
    return models.principal_components(_vectors(spark, d), "vec_id", 3)


@query("ml14_min_max", f"WITH {_LONG}, e AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM x GROUP BY feature) SELECT vec_id, x.feature, round(CASE WHEN hi > lo THEN (x - lo) / (hi - lo) ELSE 0 END, 5) AS scaled FROM x JOIN e ON e.feature = x.feature", XY)
def ml14_scaled(spark, d):
    return features.min_max(view(spark, d, "v_xy"))


@query("ml15_standardised", f"WITH {_LONG}, e AS (SELECT feature, avg(x) AS m, stddev_pop(x) AS s FROM x WHERE vec_id % 10 < 7 GROUP BY feature) SELECT vec_id, x.feature, round(CASE WHEN s > 0 THEN (x - m) / s ELSE 0 END, 5) AS z FROM x JOIN e ON e.feature = x.feature WHERE vec_id % 10 >= 7", XY)
def ml15(spark, d):
    rows = view(spark, d, "v_xy")
    return features.standardised(rows.where("vec_id % 10 < 7"), rows.where("vec_id % 10 >= 7"))


@query("ml16_normalised_labels", "SELECT doc_id, CASE upper(CASE WHEN toxic = 1 THEN 'TRUE' WHEN doc_id % 2 = 0 THEN 'False' ELSE 'n/a' END) WHEN 'TRUE' THEN 1 WHEN 'FALSE' THEN 0 END AS label FROM labels")
def ml16(spark, d):
    raw = table(spark, d, "labels").withColumn("class", F.when(F.col("toxic") == 1, "TRUE").when(F.col("doc_id") % 2 == 0, "False").otherwise("n/a"))
    return raw.select("doc_id", F.when(F.upper("class") == "TRUE", 1).when(F.upper("class") == "FALSE", 0).alias("label"))


@query("ml17_uncached_files", "SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def ml17(spark, d):
    return table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")


_COUNTED = {"forms": "<p>", "links": "<a ", "heads": "<h[1-6]"}


@query("ml17_feature_cache", "SELECT CAST(page_id % 6 AS INTEGER) AS part, " + ", ".join(f"CAST(sum(len(regexp_extract_all(html, '{p}'))) AS INTEGER) AS {n}" for n, p in _COUNTED.items()) + " FROM v_page GROUP BY page_id % 6", ("v_page",))
def ml17_cache(spark, d):
    """Four files, then two more; the second run reads these two alone."""
    root = f"{shared_dir(spark)}/sparkwarden/files-{uuid.uuid4().hex}"
    cache = FeatureCache(spark, f"{root}-features", structure_counts(F.col("text"), _COUNTED))
    part = F.col("page_id") % 6
    for some in (part < 4, part >= 4):
        view(spark, d, "v_page").where(some).select("html", part.cast("int").alias("part")).hint("rebalance", "part").write.mode("append").partitionBy("part").text(root)
        cache.update(f"{root}/part=*", "part-*")
    counted = cache.read().withColumn("part", F.regexp_extract("path", "part=([0-9]+)", 1).cast("int"))
    return counted.groupBy("part").agg(*(F.sum(n).cast("int").alias(n) for n in _COUNTED))


@query("ml18_misclassified", "SELECT l.doc_id, toxic AS label, CASE WHEN n_chars % 7 < 2 THEN 1 ELSE 0 END AS prediction FROM labels l JOIN documents d ON d.doc_id = l.doc_id WHERE toxic <> CASE WHEN n_chars % 7 < 2 THEN 1 ELSE 0 END")
def ml18(spark, d):
    from sparkwarden.queries.relational import _predictions

    return _predictions(spark, d).where("label <> prediction").select("doc_id", "label", "prediction")


@query("ml19_word_vectors")
def ml19(spark, d):
    docs = table(spark, d, "documents").select(F.split(F.lower("text"), "[^a-z]+").alias("tokens"))
    return models.word_vectors(docs)
