"""Bots from DNS behaviour, from shared domains and from netflow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwarden.operators import aggregates as A
from sparkwarden.operators import sequences as Q
from sparkwarden.operators import sets as S
from sparkwarden.operators.enrich import bounded
from sparkwarden.operators.graph import cosine_components
from sparkwarden.storage import discard, written


def bot_rate(members: DataFrame, bots: DataFrame, group: str, host: str = "ip") -> DataFrame:
    """Hosts, bots and the share of bots of each group."""
    marked = members.join(bots.select(host).distinct().withColumn("__bot", F.lit(1)), host, "left")
    out = marked.groupBy(group).agg(F.countDistinct(host).alias("hosts"), F.countDistinct(F.when(F.col("__bot") == 1, F.col(host))).alias("bots"))
    return out.withColumn("bot_rate", F.round(F.col("bots") / F.col("hosts"), 6))


def domain_scores(dns: DataFrame, clusters: DataFrame, least_hosts: int = 3) -> DataFrame:
    """Share of a cluster's hosts that ask for a domain, for clusters of at least ``least_hosts`` hosts."""
    sizes = clusters.groupBy("cluster").agg(F.countDistinct("srcip").alias("hosts")).where(F.col("hosts") >= least_hosts)
    seen = dns.select("srcip", "queries_name").distinct().join(clusters, "srcip").groupBy("cluster", "queries_name").agg(F.count(F.lit(1)).alias("n"))
    return seen.join(bounded(sizes), "cluster").select("cluster", "queries_name", (F.col("n") / F.col("hosts")).alias("share"))


def dns_bots(dns: DataFrame, clusters: DataFrame, slot: str, k1: float, k2: float, k3: float, k4: int) -> DataFrame:
    """Hosts scored ``k1 * share + k2 * periodicity`` per domain; clusters with more than ``k4`` pairs at ``k3`` or more."""
    ak = Q.presence_autocorrelation(dns, ["srcip", "queries_name"], slot)
    scored = ak.join(clusters, "srcip").join(domain_scores(dns, clusters), ["cluster", "queries_name"])
    high = scored.withColumn("score", F.round(k1 * F.col("share") + k2 * F.col("ak"), 6)).where(F.col("score") >= k3)
    busy = high.groupBy("cluster").agg(F.count(F.lit(1)).alias("pairs")).where(F.col("pairs") > k4)
    return high.join(bounded(busy), "cluster").select("cluster", "srcip", "queries_name", "score", "pairs")


def bot_networks(dns: DataFrame, malicious: DataFrame, similarity: float, k: int = 10, failing: float = 0.5) -> DataFrame:
    """Sub-networks of hosts that ask for similar malicious domains: hosts, mean failure rate, bots, their share, top domains.

    Hosts whose failure rate is ``failing`` or more count as bots.
    """
    from sparkwarden.plans.dns import failure_rate

    bad = dns.join(bounded(malicious.select("queries_name").distinct()), "queries_name", "left_semi")
    # Written, as the failures are, since they are read several times.
    visits = written(bad.select("srcip", "queries_name").distinct(), "visits")
    members = cosine_components(visits, "srcip", "queries_name", similarity).withColumnRenamed("component", "subnet").withColumnRenamed("node", "srcip")
    failures = written(failure_rate(dns), "failures")
    rates = members.join(failures, "srcip").groupBy("subnet").agg(F.round(F.avg("failure_rate"), 6).alias("mean_failures"))
    bots = bot_rate(members.select("subnet", "srcip"), failures.where(F.col("failure_rate") >= failing), "subnet", "srcip")
    domains = visits.join(members, "srcip").groupBy("subnet", "queries_name").agg(F.count(F.lit(1)).alias("n"))
    top = S.top_k(domains, ["subnet"], [F.desc("n"), F.col("queries_name")], k).groupBy("subnet").agg(A.set_text("queries_name").alias("domains"))
    return bots.join(rates, "subnet").join(top, "subnet")


def netflow_bots(dns: DataFrame, flows: DataFrame, malicious: DataFrame, heartbeat_hosts: DataFrame, compromised: DataFrame, most_bytes: int, width: int, least_hosts: int = 3) -> DataFrame:
    """Hosts of domains that are reached as bots do, with their state.

    Of records of malicious domains (``dns``: ``answer_length`` beside the usual columns) that have a tcp or udp flow,
    these stay, one step after the other: those below ``most_bytes`` both ways; from hosts with heartbeats (``srcip``);
    of domains active at both ends and in the middle of their span; with the domain's most frequent answer length; of
    domains that at least ``least_hosts`` hosts still reach.  One row per domain and host: length, hosts of the domain,
    bytes, records, whether the host is among the ``compromised`` (``ip``), and the share of compromised records of all.
    """
    keys = ["flow_id", "srcip", "srcport", "dstport"]
    # Each step is read by several later ones, so it is written: else the joins before it were made again for each of them.
    names = written(malicious.select("queries_name").distinct(), "names")
    hosts = written(heartbeat_hosts.select("srcip").distinct(), "beating-hosts")
    bad = dns.select(*keys, "queries_name", "sec", "answer_length").join(bounded(names), "queries_name", "left_semi").join(bounded(hosts), "srcip", "left_semi")
    both = bad.join(flows.where(F.col("protocol").isin("tcp", "udp")).select(*keys, (F.col("upbytesize") + F.col("downbytesize")).alias("bytes")), keys).where(F.col("bytes") < most_bytes)
    beating = written(both.select("queries_name", "srcip", "sec", "answer_length", "bytes"), "beating")
    steady = written(Q.three_window_presence(beating, "queries_name", "sec", width), "steady")
    kept = beating.join(bounded(steady), "queries_name", "left_semi")
    usual = written(A.mode(kept, ["queries_name"], "answer_length").select("queries_name", "answer_length"), "usual")
    alike = written(kept.join(bounded(usual), ["queries_name", "answer_length"], "left_semi"), "alike")
    shared = written(A.shared_by(alike, "queries_name", "srcip", least_hosts).withColumnRenamed("n", "hosts"), "shared")
    known = written(compromised.select(F.col("ip").alias("srcip")).distinct().withColumn("compromised", F.lit(1)), "compromised")
    found = alike.join(bounded(shared), "queries_name").join(bounded(known), "srcip", "left").withColumn("compromised", F.coalesce("compromised", F.lit(0)))
    rows = written(found.groupBy("queries_name", "srcip", "answer_length", "hosts", "compromised").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("records")), "rows")
    discard(names, hosts, beating, steady, usual, alike, shared, known)
    total = rows.agg(F.round(F.sum(F.col("compromised") * F.col("records")) / F.sum("records"), 6).alias("bot_probability"))
    return rows.join(F.broadcast(total), how="cross")  # one row
