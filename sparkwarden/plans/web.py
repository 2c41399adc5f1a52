"""Web requests: injection texts, parameter baselines, response baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwarden.functions import strings as S
from sparkwarden.operators import aggregates as A


def injection_texts(requests: DataFrame, words: list[str], more: list[str] | None = None) -> DataFrame:
    """Requests as spaced lower-case tokens after decoding, and whether a confirming keyword occurs; ``more`` names columns that stay."""
    text = S.spaced_tokens(S.percent_decoded(F.col("uri")))
    return requests.select("flow_id", "srcip", "host", *(more or []), text.alias("text")).withColumn("keyword", S.has_word(F.col("text"), words))


def injections(requests: DataFrame, words: list[str], model) -> DataFrame:
    """Requests that the text classifier takes for attacks and in which a confirming keyword occurs."""
    scored = model.transform(injection_texts(requests, words)).where("prediction = 1 and keyword")
    return scored.select("flow_id", "srcip", "host", "text")


def used_requests(requests: DataFrame, least_sources: int = 3) -> DataFrame:
    """Requests with their ``path``, of paths that at least ``least_sources`` sources requested."""
    paths = requests.withColumn("path", S.request_path(F.col("uri")))
    return paths.join(A.shared_by(paths, "path", "srcip", least_sources).select("path"), "path", "left_semi")


def functions(requests: DataFrame, least_sources: int = 3) -> DataFrame:
    """Of each used path its ``function`` (the path and the ``key=value`` pairs that all its requests have) and these ``pairs``.

    A request without a query string has no pairs, so the path's function has none either.  There are as many pairs as
    one request has, at most.
    """
    used = used_requests(requests, least_sources)
    n = used.groupBy("path").agg(F.countDistinct("flow_id").alias("n"))
    pair = F.concat_ws("=", "param", "value").alias("pair")
    seen = S.query_pairs(used, "uri", ["path", "flow_id"]).select("path", "flow_id", pair).groupBy("path", "pair").agg(F.countDistinct("flow_id").alias("seen"))
    common = seen.join(n, "path").where("seen = n").groupBy("path").agg(F.array_sort(F.collect_list("pair")).alias("pairs"))
    out = n.select("path").join(common, "path", "left").withColumn("pairs", F.coalesce("pairs", F.array().cast("array<string>")))
    return out.select("path", F.concat("path", F.lit("?"), F.array_join("pairs", "&")).alias("function"), "pairs")


def parameter_baseline(requests: DataFrame, least_sources: int = 3) -> DataFrame:
    """Per path and parameter: the function, and length range and character classes of the values that do not belong to it."""
    named = functions(requests, least_sources)
    pairs = S.query_pairs(used_requests(requests, least_sources), "uri", ["path", "flow_id"]).join(named, "path").where(~F.array_contains("pairs", F.concat_ws("=", "param", "value")))
    ranges = A.length_and_classes(pairs, ["path", "param"], "value")
    return ranges.join(named.select("path", "function"), "path").select("path", "function", "param", "low", "high", "classes")


def parameter_anomalies(requests: DataFrame, baseline: DataFrame) -> DataFrame:
    """Parameters whose value is longer, shorter or of other characters than the baseline saw; pairs of the function are not judged."""
    pairs = S.query_pairs(requests.withColumn("path", S.request_path(F.col("uri"))), "uri", ["path", "flow_id"])
    joined = pairs.join(baseline, ["path", "param"])
    own = F.array_contains(F.split(F.substring_index("function", "?", -1), "&"), F.concat_ws("=", "param", "value"))
    return joined.where(~own & S.outside_range(F.col("value"), F.col("low"), F.col("high"), S.shape(F.col("value")), F.col("classes"))).select("path", "param", "flow_id", "value")


def response_baseline(requests: DataFrame) -> DataFrame:
    """Upper limits of response time and size for each path."""
    timed = requests.select(S.request_path(F.col("uri")).alias("path"), (F.col("response_date") - F.col("request_date")).cast("double").alias("seconds"), "content_length")
    return timed.groupBy("path").agg(A.upper_limit("seconds").alias("time_limit"), A.upper_limit("content_length").alias("size_limit"))


def response_labels(requests: DataFrame, baseline: DataFrame) -> DataFrame:
    """Requests labelled abnormal where time or size is over the path's limit; unknown paths go."""
    joined = requests.withColumn("path", S.request_path(F.col("uri"))).join(baseline, "path")
    over = ((F.col("response_date") - F.col("request_date")) > F.col("time_limit")) | (F.col("content_length") > F.col("size_limit"))
    return joined.select("flow_id", "path", F.when(over, "abnormal").otherwise("normal").alias("label"))
