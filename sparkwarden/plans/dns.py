"""DNS: algorithmic names, covert channels, failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwarden.functions import strings as S
from sparkwarden.ml import models
from sparkwarden.operators.aggregates import first_texts
from sparkwarden.operators.enrich import bounded
from sparkwarden.storage import written


def request_response_summary(dns: DataFrame) -> DataFrame:
    """Requests, responses and their bytes for each source that has both."""
    is_response = F.col("flags_response") == 1
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    size = lambda c: F.sum(F.when(c, F.col("size")).otherwise(0))
    out = dns.groupBy("srcip").agg(count(~is_response).alias("requests"), count(is_response).alias("responses"), size(~is_response).alias("request_bytes"), size(is_response).alias("response_bytes"))
    return out.where("requests > 0 and responses > 0")


def failure_rate(dns: DataFrame) -> DataFrame:
    """Share of a host's distinct (name, failed) pairs that failed."""
    pairs = dns.select("srcip", "queries_name", F.when(F.col("flags_reply_code") == 3, 1.0).otherwise(0.0).alias("f")).distinct()
    return pairs.groupBy("srcip").agg(F.round(F.avg("f"), 6).alias("failure_rate"))


def list_features() -> dict[str, Column]:
    """Label count, length without dots, largest time to live, answer bytes."""
    name = F.col("queries_name")
    return {"labels": F.size(F.split(name, r"\.")), "name_length": F.length(F.replace(name, F.lit("."), F.lit(""))), "max_ttl": F.array_max(S.numbers(F.col("answers_ttl"))), "sum_length": F.aggregate(S.numbers(F.col("answers_data_length")), F.lit(0.0), lambda a, x: a + x)}


def gram_ranks(names: DataFrame, name: str, n: int, least: int = 1) -> DataFrame:
    """Rank of each n-gram by frequency (1 is the most frequent). The dictionary is as small as the alphabet's n-grams."""
    counts = names.select(F.explode(S.ngrams(F.col(name), n)).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return counts.select("gram", F.dense_rank().over(Window.orderBy(F.desc("n"), "gram")).alias("rank"))


def transition_table(names: DataFrame, name: str, least: int = 1) -> DataFrame:
    """``(pair, p)``: probability of the second character after the first, from pairs seen ``least`` times."""
    x = F.col(name)
    pairs = names.where(F.length(x) >= 2).select(F.explode(F.transform(F.sequence(F.lit(1), F.length(x) - 1), lambda i: F.substr(x, i, F.lit(2)))).alias("pair"))
    counts = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return counts.select("pair", (F.col("n") / F.sum("n").over(Window.partitionBy(F.substring("pair", 1, 1)))).alias("p"))


def domain_features(names: DataFrame, name: str, ranks: DataFrame, transitions: DataFrame, shorter: dict[int, DataFrame] | None = None) -> DataFrame:
    """The features of algorithmic names: length, entropy, shares, runs, n-gram ranks, transitions.

    ``ranks`` are those of 3-grams; ``shorter`` has those of other n-grams, each a feature ``avg_rank_<n>``.
    """
    x = F.col(name)
    own = names.select(
        name, F.length(x).alias("length"), F.round(S.entropy(x), 6).alias("entropy"), F.round(S.share(x, S.VOWELS), 6).alias("vowels"), F.round(S.share(x, S.DIGITS), 6).alias("digits"),
        F.round(S.repeated_share(x), 6).alias("repeated"), F.round(S.run_share(x, S.CONSONANTS), 6).alias("consonant_runs"), F.round(S.run_share(x, S.DIGITS), 6).alias("digit_runs"),
    )
    ranked = S.average_rank(names, name, ranks, 3).select(name, F.round("avg_rank", 6).alias("avg_rank"))
    chained = S.transition_score(names, name, transitions).select(name, F.round("transition", 6).alias("transition"))
    for n, table in (shorter or {}).items():
        ranked = ranked.join(S.average_rank(names, name, table, n).select(name, F.round("avg_rank", 6).alias(f"avg_rank_{n}")), name)
    return own.join(ranked, name).join(chained, name)


#: What the boosted trees read of a name.
NAME_FEATURES = ["length", "entropy", "vowels", "digits", "repeated", "consonant_runs", "digit_runs", "avg_rank", "avg_rank_1", "avg_rank_2", "transition"]


def name_features(names: DataFrame, name: str, known: DataFrame) -> DataFrame:
    """All eleven features of names, with the ranks and transitions of the ``known`` ones."""
    return domain_features(names, name, gram_ranks(known, name, 3), transition_table(known, name), {n: gram_ranks(known, name, n) for n in (1, 2)})


def detected_names(candidates: DataFrame, listed: DataFrame, known: DataFrame) -> DataFrame:
    """Records of ``candidates`` whose name boosted trees take for algorithmic.

    ``listed`` has malicious names (``queries_name``), ``known`` all names with which ranks, transitions and the trees
    are learned.
    """
    known = known.select("queries_name").distinct()
    features = written(name_features(known, "queries_name", known), "name-features")
    bad = bounded(listed.select("queries_name").distinct()).withColumn("label", F.lit(1.0))
    train = features.join(bad, "queries_name", "left").fillna(0.0, ["label"])
    model = models.boosted_pipeline(train, NAME_FEATURES)
    names = name_features(candidates.select("queries_name").distinct(), "queries_name", known)
    positive = model.transform(names).where("prediction = 1").select("queries_name")
    return candidates.join(positive, "queries_name", "left_semi")


def covert_hosts(dns: DataFrame, model) -> DataFrame:
    """Per host with records that the classifier takes for covert: their number and the host's summary."""
    scored = model.transform(covert_features(dns)).where("prediction = 1")
    return scored.groupBy("srcip").agg(F.count(F.lit(1)).alias("covert")).join(covert_summary(dns), "srcip")


def candidate_names(dns: DataFrame, suffixes: DataFrame, whitelist: DataFrame, least: int = 4, labels: int = 2) -> DataFrame:
    """Queries worth scoring: a listed suffix, at most ``labels`` subdomain labels, a long enough domain, not whitelisted."""
    parts = S.split_host(dns.select("queries_name").distinct(), "queries_name", suffixes)
    depth = F.when(F.col("subdomain") == "", 0).otherwise(F.size(F.split("subdomain", r"\.")))
    good = parts.where((F.col("suffix") != "No-Parse") & (depth <= labels) & (F.length("domain") >= least))
    return dns.join(good, "queries_name").join(bounded(whitelist.select("queries_name").distinct()), "queries_name", "left_anti")


def algorithmic_hosts(scored: DataFrame, flows_least: int, domains_least: int) -> DataFrame:
    """Hosts with enough domains that each were asked often enough (``scored``: positives with srcip, domain, flow_id)."""
    often = scored.groupBy("srcip", "domain").agg(F.countDistinct("flow_id").alias("n")).where(F.col("n") >= flows_least)
    return often.groupBy("srcip").agg(F.count(F.lit(1)).alias("domains"), F.sum("n").alias("flows")).where(F.col("domains") >= domains_least)


def new_domains(found: DataFrame, known: DataFrame) -> DataFrame:
    return found.select("domain").distinct().join(known.select("domain").distinct(), "domain", "left_anti")


def covert_features(dns: DataFrame) -> DataFrame:
    """Numeric features of a DNS record for the covert-channel classifier."""
    name = F.replace("queries_name", F.lit("."), F.lit(""))
    return dns.select("flow_id", "srcip", *(c.alias(k) for k, c in list_features().items()), F.round(S.entropy(name, 2.0), 6).alias("bits"), F.round(S.share(F.col("queries_name"), S.DIGITS), 6).alias("digits"), "size")


def covert_summary(dns: DataFrame) -> DataFrame:
    """Per host: requests and responses, the latest time and the names asked for."""
    last = dns.groupBy("srcip").agg(F.max("sec").alias("last_at"))
    names = first_texts(dns, "srcip", "queries_name", 10).withColumnRenamed("queries_name", "names")
    return request_response_summary(dns).join(last, "srcip").join(names, "srcip")
