"""Documents in transit: topics, baselines of users, fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkwarden.operators import sets as S
from sparkwarden.storage import written


def word_tokens(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(doc_id, word)`` for every word of lower-case Latin letters with more than two of them."""
    return docs.select("doc_id", F.explode(F.split(F.lower(text), "[^a-z]+")).alias("word")).where(F.length("word") > 2)


#: A word is frequent if it is one token in so many or more; there are at most as many such words.
FREQUENT = 200_000


def word_counts(tokens: DataFrame) -> DataFrame:
    """``(word, n)``, as a written table."""
    return written(tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word-counts")


def topic_tags(docs: DataFrame, topics: DataFrame, counts: DataFrame | None = None, least: float = 0.3, words: int = 3, frequent: int = FREQUENT) -> DataFrame:
    """Topics whose mean over a document's known words is above ``least``, with the words that contribute most.

    ``topics``: word, topic, p (normalised per word); words that it lacks are unknown and do not count.  ``counts`` are
    the ``word_counts`` of ``docs``, made here if they are not given.

    Texts are dealt by document once, and frequent words, of which there are at most ``frequent``, find their topics by
    broadcast: what a document has of them is summed up where it is.  Only tokens of other words are shuffled to theirs.
    A word is of one kind, so the sums of both add up, and the best words are among the best of both.
    """
    counts = word_counts(word_tokens(docs)) if counts is None else counts
    tokens = (counts.agg(F.sum("n")).first()[0] or 0) / frequent
    of_word = topics.groupBy("word", "topic").agg(F.sum("p").alias("p")).groupBy("word").agg(F.collect_list(F.struct("topic", "p")).alias("of"))
    of_word = written(of_word.join(counts, "word").select("word", "of", (F.col("n") >= tokens).alias("often")), "topics-of-words")
    often, seldom = of_word.where("often").select("word", "of"), of_word.where("not often").select("word", "of")
    dealt = word_tokens(docs.select("doc_id", "text").repartition("doc_id")).groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(often), "word")
    # Merged, not broadcast where it is small, so that small inputs say what large ones will shuffle.
    sought = word_tokens(docs).join(F.broadcast(often.select("word")), "word", "left_anti").join(seldom.hint("merge"), "word").repartition("doc_id")
    sought = sought.groupBy("doc_id", "word", "of").agg(F.count(F.lit(1)).alias("n"))
    found = written(_best_parts(dealt, words).unionByName(_best_parts(sought, words)), "topic-parts")
    sums = found.where("rank = 1").groupBy("doc_id", "topic").agg(F.sum("total").alias("total"), F.sum("led").alias("led"))
    known = sums.groupBy("doc_id").agg(F.sum("led").alias("n_known"))
    means = sums.join(known, "doc_id")
    means = means.withColumn("share", F.col("total") / F.col("n_known")).where(F.col("share") > least)
    best = S.top_k(found.drop("rank"), ["doc_id", "topic"], [F.desc(F.round("part", 9)), F.col("word")], words).groupBy("doc_id", "topic").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda x: x["word"]), ",").alias("words"))
    return means.select("doc_id", "topic", F.round("share", 6).alias("share")).join(best, ["doc_id", "topic"])


def _best_parts(tokens: DataFrame, words: int) -> DataFrame:
    """The best words of each document and topic, with the topic's ``total`` and the tokens that it is the first topic of (``led``).

    ``tokens`` (doc_id, word, n, of) are dealt by document, so nothing is shuffled here; one sort serves ranks and sums.
    """
    parts = tokens.select("doc_id", "word", "n", F.posexplode("of").alias("place", "of"))
    parts = parts.select("doc_id", F.col("of.topic").alias("topic"), "word", (F.col("n") * F.col("of.p")).alias("part"), F.when(F.col("place") == 0, F.col("n")).otherwise(0).alias("lead"))
    w = Window.partitionBy("doc_id", "topic").orderBy(F.desc(F.round("part", 9)), "word")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return parts.select("doc_id", "topic", "word", "part", F.row_number().over(w).alias("rank"), F.sum("part").over(whole).alias("total"), F.sum("lead").over(whole).alias("led")).where(F.col("rank") <= words)


def inner_ends(records: DataFrame, inner: str = r"^10\.") -> DataFrame:
    """Records by ``user``: one for each end (``owner``, ``peer``) that is inside, one where both ends are the same."""
    ends = F.filter(F.array_distinct(F.array("owner", "peer")), lambda e: e.rlike(inner))
    return records.withColumn("user", F.explode(ends)).drop("owner", "peer")


def period_bytes(records: DataFrame) -> DataFrame:
    """Bytes of each user, tag, day and hour, and the first document in them."""
    return records.groupBy("user", "tag", "dd", "hh").agg(F.sum("bytes").alias("bytes"), F.min("doc_id").alias("doc_id"))


def user_baseline(records: DataFrame) -> DataFrame:
    """Per user, tag and hour of the day: the most bytes of one day, the tag's documents and the user's documents."""
    per_tag = records.groupBy("user", "tag").agg(F.count(F.lit(1)).alias("n_tag"))
    per_user = records.groupBy("user").agg(F.count(F.lit(1)).alias("n_user"))
    most = period_bytes(records).groupBy("user", "tag", "hh").agg(F.max("bytes").alias("most_bytes"))
    return most.join(per_tag, ["user", "tag"]).join(per_user, "user")


def leak_alerts(records: DataFrame, baseline: DataFrame, share: float = 0.003) -> DataFrame:
    """Documents of a tag that is rare (or new) for a user, and periods in which a user moved more of a tag than ever.

    A period is an hour of a day; its bytes are those of all its documents, named by the first one.
    """
    tags = baseline.groupBy("user", "tag").agg((F.max("n_tag") / F.max("n_user")).alias("share"))
    rare = records.join(tags, ["user", "tag"], "left").where(F.col("share").isNull() | (F.col("share") <= share)).select("user", "tag", "dd", "hh", F.col("bytes").cast("long").alias("bytes"), "doc_id", F.lit("rare tag").alias("reason"))
    large = period_bytes(records).join(baseline.select("user", "tag", "hh", "most_bytes"), ["user", "tag", "hh"]).where(F.col("bytes") > F.col("most_bytes"))
    return rare.unionByName(large.select("user", "tag", "dd", "hh", "bytes", "doc_id", F.lit("volume").alias("reason")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """The fingerprint of each document's lower-case words, how many share it, and the first of them."""
    marked = docs.select("doc_id", F.md5(F.array_join(F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+"), "")).alias("fingerprint"))
    groups = marked.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id"))
    return marked.join(groups, "fingerprint")
