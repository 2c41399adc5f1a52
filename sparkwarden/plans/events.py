"""The event table that all detectors write, and what is made of it: flags per host, scores, verdicts.

Detectors return tables of their own.  ``detected`` brings each to one shape (``EVENT``): one row per kind, host, peer
and day, with named fields for what later stages ask of it.  Events are stored by batch, day and kind; a batch that is
detected again replaces itself.  Fusion and scoring read nothing but that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkwarden.operators.aggregates import latest
from sparkwarden.operators.merge import whitelisted_by_feedback
from sparkwarden.plans.hosts import compromise_scores
from sparkwarden.sources.versions import Batches

#: ``tag``: 0 to 3, in which lists the peer is (1 threats, 2 suspicious); for up_down 1 if the host asked for a suspicious
#: name that day.  ``mean_up``: mean upload of a conversation.  ``threat``: 1 if a security log calls it a threat.
EVENT = (
    StructType().add("event_id", "string").add("ip", "string").add("peer", "string").add("at", "long").add("n", "long").add("first_id", "long").add("score", "double")
    .add("tag", "integer").add("mean_up", "double").add("threat", "integer").add("evidence", "string").add("day", "integer").add("kind", "string")
)
VERDICT = (
    StructType().add("verdict_id", "string").add("ip", "string").add("score", "double").add("score_type", "integer").add("level", "string")
    .add("indicators", "string").add("evidence", "string").add("first_at", "long").add("last_at", "long")
)
# The ten indicators; the first seven come from detectors, the others count for hosts that these report.
DETECTORS = ["abnormal_ports", "covert_channel", "heartbeat", "up_down", "algorithmic_domain", "external_connection", "traffic_anomaly"]
KINDS = [*DETECTORS, "threat", "security_event", "botnet"]
#: What an event must meet to set its flag. The limit of the mean upload is a parameter of ``fused``.
CONDITIONS = {"heartbeat": "tag = 2 AND mean_up < {most_up}", "up_down": "tag = 1", "threat": "threat = 1"}


def event_log(spark: SparkSession, root: str) -> Batches:
    return Batches(spark, root, EVENT, by=["day", "kind"])


def detected(kind: str, found: DataFrame, ip: str, at: str = "sec", day: str = "dd", key: str = "flow_id", peer: str | None = None, **fields: Column) -> DataFrame:
    """What a detector found as events: one for each host, peer and day, combined before one shuffle.

    ``fields`` are aggregates for ``score``, ``tag``, ``mean_up`` and ``threat``; those not given are null.  Rows without
    a host or a day are left out.
    """
    rows = found.where(F.col(ip).isNotNull() & F.col(day).isNotNull())
    by = [F.col(ip).alias("ip"), (F.coalesce(F.col(peer).cast("string"), F.lit("")) if peer else F.lit("")).alias("peer"), F.col(day).cast("int").alias("day")]
    known = {f.name: f.dataType for f in EVENT.fields}
    given = [c.cast(known[name]).alias(name) for name, c in fields.items()]
    out = rows.groupBy(*by).agg(F.max(at).cast("long").alias("at"), F.count(F.lit(1)).alias("n"), F.min(key).cast("long").alias("first_id"), *given)
    for name in ("score", "tag", "mean_up", "threat"):
        if name not in fields:
            out = out.withColumn(name, F.lit(None).cast(known[name]))
    out = out.withColumn("kind", F.lit(kind))
    evidence = F.concat_ws(" ", "kind", F.concat(F.lit("x"), F.col("n").cast("string")), F.concat(F.lit("#"), F.col("first_id").cast("string")))
    return out.withColumn("evidence", evidence).withColumn("event_id", F.sha2(F.concat_ws("|", "kind", "ip", "peer", F.col("day").cast("string")), 256)).select(*EVENT.names)


def all_events(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def security_events(log: DataFrame, threats: Column) -> DataFrame:
    """Events of a security log at both of its ends (``ip``, ``dstip``), as the two kinds; ``threats`` says which are threats."""
    ends = log.withColumn("threat", threats.cast("int")).withColumn("host", F.explode(F.array_distinct(F.array("ip", "dstip")))).drop("ip")
    marked = detected("security_event", ends, "host", key="id", threat=F.max("threat"))
    return marked.unionByName(detected("threat", ends.where("threat = 1"), "host", key="id", threat=F.max("threat")))


def fused(events: DataFrame, most_up: float = 70, kinds: list[str] | None = None) -> DataFrame:
    """One row per host with a flag for each kind, the evidence and the time range of the events that count.

    Of each host and kind the latest event is looked at (of equal times that with the larger id), and counts if it meets
    the kind's condition.  Only hosts that a detector reported are listed; events of security logs and of bots count for
    them alone, as flags of the latest event too.
    """
    kinds = kinds or KINDS
    reported = events.where(F.col("kind").isin(DETECTORS)).select("ip").distinct()
    last = latest(events.where(F.col("kind").isin(kinds)), ["ip", "kind"], "at", "event_id").join(reported, "ip", "left_semi")
    ok = F.lit(True)
    for kind, condition in CONDITIONS.items():
        ok = ok & ((F.col("kind") != kind) | F.coalesce(F.expr(condition.format(most_up=most_up)), F.lit(False)))
    flags = [F.max(F.when(F.col("kind") == k, 1).otherwise(0)).alias(k) for k in kinds]
    # At most one event of each kind: ten strings.
    evidence = F.array_join(F.array_sort(F.collect_list("evidence")), "@").alias("evidence")
    return last.where(ok).groupBy("ip").agg(*flags, evidence, F.min("at").alias("first_at"), F.max("at").alias("last_at"))


def verdicts(indicators: DataFrame, weights: dict[str, float], patterns: DataFrame, feedback: DataFrame | None = None, cut_off: int = 0, floor: int = 60) -> DataFrame:
    """``VERDICT`` rows of fused indicators: scored, cut off, and kept where feedback allows the indicator vector (JN12).

    ``feedback`` has the ten flags and ``flag``; without it all vectors are allowed.
    """
    scored = compromise_scores(indicators, weights, patterns, threat="threat", floor=floor, cut_off=cut_off)
    if feedback is not None:
        scored = whitelisted_by_feedback(scored, feedback, KINDS)
    rest = indicators.select(F.col("ip").alias("__ip"), "evidence", "first_at", "last_at")
    named = F.concat_ws(",", *(F.when(F.col(k) == 1, F.lit(k)) for k in KINDS)).alias("indicators")
    out = scored.join(rest, F.col("ip") == F.col("__ip")).select("ip", "score", "score_type", "level", named, "evidence", "first_at", "last_at")
    return out.withColumn("verdict_id", F.sha2(F.concat_ws("|", "ip", F.col("last_at").cast("string")), 256)).select(*VERDICT.names)
