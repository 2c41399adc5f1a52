"""Detections over flows: ports, periods, ratios, new hosts, volumes, sessions, assets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwarden.functions.strings import safe_ratio
from sparkwarden.operators import aggregates as A
from sparkwarden.operators import sequences as Q
from sparkwarden.operators.enrich import day_period, in_segments, outbound_bulk, well_known_port
from sparkwarden.operators.merge import membership
from sparkwarden.operators.runs import longest_slot_run


def candidate_ports(flows: DataFrame) -> DataFrame:
    return flows.where(well_known_port(F.col("srcport"), F.col("dstport"), F.col("protocol")))


def abnormal_ports(flows: DataFrame, baseline: DataFrame, as_of: int | None = None, min_history_days: int = 7, pairwise: bool = False) -> DataFrame:
    """Flows to a known host over a port or a protocol that its baseline (ip, dstport, protocol, trained_day) lacks.

    Hosts without a baseline are normal, and so are those whose baseline is younger than ``min_history_days`` on day
    ``as_of``.  ``pairwise`` tests port and protocol together instead of each by itself.
    """
    hosts = baseline.groupBy("ip").agg(F.min("trained_day").alias("since")).withColumnRenamed("ip", "dstip")
    if as_of is not None:
        hosts = hosts.where(F.lit(as_of) - F.col("since") >= min_history_days)
    found = candidate_ports(flows).join(hosts.select("dstip"), "dstip")
    if pairwise:
        return found.join(baseline.select(F.col("ip").alias("dstip"), "dstport", "protocol").distinct(), ["dstip", "dstport", "protocol"], "left_anti")
    known = lambda c: baseline.select(F.col("ip").alias("dstip"), c).distinct().withColumn(f"__{c}", F.lit(True))
    marked = found.join(known("dstport"), ["dstip", "dstport"], "left").join(known("protocol"), ["dstip", "protocol"], "left")
    return marked.where("__dstport is null or __protocol is null").drop("__dstport", "__protocol")


def learned_ports(flows: DataFrame, baseline: DataFrame, feedback: DataFrame) -> DataFrame:
    """Port baseline rows to add: seen or confirmed by feedback, and not yet there."""
    seen = candidate_ports(flows).select(F.col("dstip").alias("ip"), "dstport", "protocol")
    return seen.union(feedback.select("ip", "dstport", "protocol")).distinct().subtract(baseline.select("ip", "dstport", "protocol"))


def unusual_flows(flows: DataFrame, baseline: DataFrame, least: int = 1 << 20) -> DataFrame:
    """Bulk traffic in a period that the source's baseline (ip, period) lacks; hosts without a baseline are usual."""
    hosts = baseline.select("ip").distinct()
    seen = baseline.select("ip", "period").distinct()
    return bulk_periods(flows, least).join(hosts, "ip", "left_semi").join(seen, ["ip", "period"], "left_anti")


def unusual_periods(flows: DataFrame, baseline: DataFrame, least: int = 1 << 20) -> DataFrame:
    """One row for each source, destination and period of ``unusual_flows``."""
    odd = unusual_flows(flows, baseline, least)
    return odd.groupBy("srcip", "dstip", "period").agg(F.min("flow_id").alias("flow_id"), F.sum("upbytesize").alias("bytes"))


def bulk_periods(flows: DataFrame, least: int = 1 << 20) -> DataFrame:
    """Flows of bulk traffic with ``ip`` and ``period``."""
    bulk = flows.where(outbound_bulk(F.col("srcport"), F.col("dstport"), F.col("upbytesize"), least))
    return bulk.withColumn("ip", F.col("srcip")).withColumn("period", day_period(F.col("hh")))


def learned_periods(baseline: DataFrame, flows: DataFrame, confirmed: DataFrame, least: int = 1 << 20) -> DataFrame:
    """The baseline (ip, period) after a batch of flows.

    Added are the pairs of hosts that had no baseline, and pairs that feedback confirmed as usual (``ip, period``).
    Pairs that were reported and not confirmed stay unusual.
    """
    seen = bulk_periods(flows, least).select("ip", "period").distinct()
    fresh = seen.join(baseline.select("ip").distinct(), "ip", "left_anti")
    return baseline.select("ip", "period").union(fresh).union(confirmed.select("ip", "period")).distinct()


def raised_ratios(baseline: DataFrame, normal: DataFrame) -> DataFrame:
    """The baseline (ip, period, max_ratio) raised by ratios that count as normal (ip, period, ratio).

    Missing and infinite ratios do not count.  Both sides are combined before one shuffle.
    """
    sound = normal.where(F.col("ratio").isNotNull() & ~F.isnan("ratio") & (F.col("ratio") < float("inf")))
    both = baseline.select("ip", "period", "max_ratio").unionByName(sound.select("ip", "period", F.col("ratio").alias("max_ratio")))
    return both.groupBy("ip", "period").agg(F.max("max_ratio").alias("max_ratio"))


def normal_ratios(flows: DataFrame, baseline: DataFrame, rejected: DataFrame) -> DataFrame:
    """Ratios that train: of hosts and periods without a baseline, within it, or reported and ``rejected`` (flow_id) by an analyst."""
    judged = ratios(flows).join(baseline, ["ip", "period"], "left")
    within = judged.where("max_ratio is null or ratio <= max_ratio")
    wrong = judged.where("ratio > max_ratio").join(rejected.select("flow_id").distinct(), "flow_id", "left_semi")
    return within.select("ip", "period", "ratio").union(wrong.select("ip", "period", "ratio"))


def ratios(flows: DataFrame) -> DataFrame:
    return flows.withColumn("ip", F.col("srcip")).withColumn("period", day_period(F.col("hh"))).withColumn("ratio", safe_ratio(F.col("upbytesize"), F.col("downbytesize")))


def ratio_baseline(flows: DataFrame) -> DataFrame:
    """The largest upload/download ratio of each host and period."""
    return ratios(flows).groupBy("ip", "period").agg(F.max("ratio").alias("max_ratio"))


def ratio_anomalies(flows: DataFrame, baseline: DataFrame) -> DataFrame:
    """Flows whose ratio exceeds the host's largest of that period; hosts and periods without a baseline are normal."""
    return ratios(flows).join(baseline, ["ip", "period"]).where(F.col("ratio") > F.col("max_ratio"))


def discovered_assets(flows: DataFrame, assets: DataFrame, segments: DataFrame) -> DataFrame:
    """Hosts of the segments that are no asset: sources of anything but icmp, targets of tcp with more than two packets."""
    side = lambda c, n: in_segments(flows, segments, c).select(F.col(c).alias("ip"), "flow_id", "sec", "protocol", "uppkts", F.lit(n).alias("side"))
    seen = side("srcip", "source").where("protocol <> 'icmp'").unionByName(side("dstip", "target").where("protocol = 'tcp' and uppkts > 2"))
    fresh = seen.join(assets.select("ip").distinct(), "ip", "left_anti")
    return Q.first_of_each(fresh, "ip", ["sec", "flow_id", "side"]).select("ip", "sec", "flow_id", "side", "protocol")


def volume_exceedances(volumes: DataFrame, keys: list[str], day: str, slot: str, value: str = "bytes", days: int = 7, k: float = 3.0) -> DataFrame:
    """Every slot with its upper limit and ``exceeds``.

    The limit comes from the same slot of the days before; where that slot has none, it is the mean limit of the other
    slots of the entity's day.  Without any limit nothing exceeds.
    """
    based = Q.slot_baseline(volumes, keys, day, slot, value, days, k)
    filled = based.withColumn("limit", A.fill_with_mean(based, [*keys, day], "upper"))
    return filled.withColumn("exceeds", F.when(F.col(value) > F.col("limit"), 1).otherwise(0))


def volume_anomalies(volumes: DataFrame, keys: list[str], day: str, slot: str, first_day: int, consecutive: int = 2, **options) -> DataFrame:
    """Entities and days (from ``first_day``) with at least ``consecutive`` exceeding slots in a row: longest run, its first slot, slots present.

    Slots without traffic end a run; a day with ``consecutive`` slots of traffic or fewer is not judged.
    """
    judged = volume_exceedances(volumes, keys, day, slot, **options).where(F.col(day) >= first_day)
    found = longest_slot_run(judged, [*keys, day], slot, "exceeds").where(F.col("longest") >= consecutive)
    present = judged.groupBy(*keys, day).agg(F.count("bytes" if "value" not in options else options["value"]).alias("present")).where(F.col("present") > consecutive)
    return found.join(present, [*keys, day])


def masked_history(volumes: DataFrame, anomalies: DataFrame, keys: list[str]) -> DataFrame:
    """Volumes without the slots that were anomalous, so that these do not train."""
    return volumes.join(anomalies.select(*keys).distinct(), keys, "left_anti")


def heartbeats(flows: DataFrame, keys: list[str], threats: DataFrame, suspicious: DataFrame, least: float = 0.8) -> DataFrame:
    """Conversations with a strided autocorrelation over ``least``, their mean upload and the membership tag of their target."""
    score = Q.periodicity(flows, keys, "sec", "flow_id")
    means = flows.groupBy(*keys).agg(F.round(F.avg("upbytesize"), 4).alias("mean_up"))
    found = score.where(F.col("score") > least).join(means, keys)
    return membership(found, keys[-1], threats, suspicious)


def idle_assets(assets: DataFrame, volumes: DataFrame, least: int) -> DataFrame:
    """Assets whose slots are all missing or below ``least`` bytes."""
    busy = volumes.groupBy("ip").agg(F.max("bytes").alias("top")).where(F.col("top") >= least)
    return assets.join(busy, "ip", "left_anti")


def retired_assets(last_seen: DataFrame, today: Column, days: int) -> DataFrame:
    return Q.idle_days(last_seen, today, "day", days, days).select("ip", "day", "gap_days", "flag")


def changed_assets(events: DataFrame, kinds: int) -> DataFrame:
    """Hosts with more than ``kinds`` distinct kinds of events."""
    return events.groupBy("ip").agg(F.countDistinct("modeltype").alias("kinds")).where(F.col("kinds") > kinds)


def recovered_slots(masked: DataFrame, rejected: DataFrame, keys: list[str]) -> DataFrame:
    """Masked volumes (null bytes) restored from rejected events, which carry lists of slots and of values."""
    lists = rejected.select(*keys[:-1], F.explode(F.arrays_zip("slots", "values")).alias("z")).select(*keys[:-1], F.col("z.slots").alias(keys[-1]), F.col("z.values").alias("__value"))
    restored = lists.groupBy(*keys).agg(F.max("__value").alias("__value"))
    return masked.join(restored, keys, "left").withColumn("bytes", F.coalesce("bytes", "__value")).drop("__value")


