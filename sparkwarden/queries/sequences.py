"""Sequence operators over flows and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwarden.adapters import view
from sparkwarden.operators import graph as G
from sparkwarden.operators import sequences as Q
from sparkwarden.operators.runs import longest_slot_run
from sparkwarden.queries import query

FLOW = ("v_flow_ts",)
_GAPS = "g AS (SELECT srcip, protocol, sec, flow_id, sec - lag(sec) OVER w AS gap, row_number() OVER w AS k, count(*) OVER (PARTITION BY srcip, protocol) AS n FROM v_flow_ts WINDOW w AS (PARTITION BY srcip, protocol ORDER BY sec, flow_id))"


@query("wn1_gaps", f"WITH {_GAPS} SELECT srcip, protocol, sec, flow_id, gap, CAST(k AS INTEGER) AS k FROM g WHERE n >= 4 AND gap IS NOT NULL", FLOW)
def wn1(spark, d):
    return Q.gaps(view(spark, d, "v_flow_ts"), ["srcip", "protocol"], "sec", "flow_id")


@query("wn2_periodicity", f"""
    WITH {_GAPS}, x AS (SELECT srcip, protocol, list(CAST(gap AS DOUBLE) ORDER BY k) AS x FROM g WHERE n >= 4 AND gap IS NOT NULL GROUP BY ALL),
         t AS (SELECT srcip, protocol, len(x) AS n, x, list_sum(list_transform(x, lambda v: v * v)) AS total FROM x),
         j AS (SELECT srcip, protocol, n, total, coalesce(list_sum(list_transform(range(1, CAST(ceil(len(x) / j) AS BIGINT)), lambda i: x[i * j + 1] * x[(i - 1) * j + 1])), 0) / nullif(total, 0) AS s
               FROM t, unnest(range(1, greatest(len(x), 2))) u(j) WHERE len(x) >= 2)
    SELECT srcip, protocol, CAST(n AS INTEGER) AS n_gaps, round(max(s), 6) AS score FROM j GROUP BY srcip, protocol, n""", FLOW)
def wn2(spark, d):
    return Q.periodicity(view(spark, d, "v_flow_ts"), ["srcip", "protocol"], "sec", "flow_id")


@query("wn3_presence", """
    WITH p AS (SELECT DISTINCT srcip, protocol, dd * 24 + hh AS slot FROM v_flow_ts), f AS (SELECT srcip, protocol, CASE WHEN lead(slot) OVER (PARTITION BY srcip, protocol ORDER BY slot) = slot + 1 THEN 1 ELSE 0 END AS pair FROM p)
    SELECT srcip, protocol, count(*) AS slots, round(sum(pair) / count(*), 6) AS ak FROM f GROUP BY srcip, protocol""", FLOW)
def wn3(spark, d):
    return Q.presence_autocorrelation(view(spark, d, "v_flow_ts").withColumn("slot", F.col("dd") * 24 + F.col("hh")), ["srcip", "protocol"], "slot")


_FLAGGED = "x AS (SELECT srcip, dd * 24 + hh AS slot, CASE WHEN sum(upbytesize) > 5000 THEN 1 ELSE 0 END AS flag FROM v_flow_ts GROUP BY ALL), i AS (SELECT *, slot - row_number() OVER (PARTITION BY srcip, flag ORDER BY slot) AS island FROM x)"


def _flagged(spark, d):
    """Hours with traffic, and whether it was much; hours without traffic are absent and end a run."""
    hours = view(spark, d, "v_flow_ts").groupBy("srcip", (F.col("dd") * 24 + F.col("hh")).alias("slot"))
    return hours.agg(F.when(F.sum("upbytesize") > 5000, 1).otherwise(0).alias("flag"))


@query("wn4_runs", f"WITH {_FLAGGED} SELECT srcip, flag, min(slot) AS first, max(slot) AS last, count(*) AS length FROM i GROUP BY srcip, flag, island", FLOW)
def wn4(spark, d):
    return Q.runs(_flagged(spark, d), ["srcip"], "slot", "flag")


@query("wn4_longest_run", f"""
    WITH {_FLAGGED}, r AS (SELECT srcip, count(*) AS length, min(slot) AS first_slot FROM i WHERE flag = 1 GROUP BY srcip, island)
    SELECT srcip, max(length) AS longest, min(first_slot) FILTER (length = m) AS first_slot FROM (SELECT *, max(length) OVER (PARTITION BY srcip) AS m FROM r) GROUP BY srcip""", FLOW)
def wn4_longest(spark, d):
    return longest_slot_run(_flagged(spark, d), ["srcip"], "slot", "flag")


_VOLUME = "v AS (SELECT regexp_extract(srcip, '^([0-9]+[.][0-9]+[.][0-9]+)', 1) AS segment, dd, hh, CAST(sum(upbytesize) AS DOUBLE) AS bytes FROM v_flow_ts GROUP BY ALL)"
_BASE = "b AS (SELECT *, count(bytes) OVER w AS n_base, avg(bytes) OVER w AS base_mean, stddev_pop(bytes) OVER w AS s FROM v WINDOW w AS (PARTITION BY segment, hh ORDER BY dd RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING))"


def volumes(spark, d):
    flows = view(spark, d, "v_flow_ts").withColumn("segment", F.substring_index("srcip", ".", 3))
    return flows.groupBy("segment", "dd", "hh").agg(F.sum("upbytesize").cast("double").alias("bytes"))


@query("wn5_slot_baseline", f"WITH {_VOLUME}, {_BASE} SELECT segment, dd, hh, bytes, n_base, round(base_mean, 4) AS base_mean, round(CASE WHEN n_base = 1 THEN 3 * base_mean WHEN n_base > 1 THEN base_mean + 3 * s END, 4) AS upper FROM b", FLOW)
def wn5(spark, d):
    out = Q.slot_baseline(volumes(spark, d), ["segment"], "dd", "hh", "bytes")
    return out.withColumn("base_mean", F.round("base_mean", 4)).withColumn("upper", F.round("upper", 4))


@query("wn6_complete_grid", f"WITH {_VOLUME}, g AS (SELECT segment, dd, CAST(h AS INTEGER) AS hh FROM (SELECT DISTINCT segment, dd FROM v), unnest(range(0, 24)) t(h)) SELECT g.segment, g.dd, g.hh, v.bytes FROM g LEFT JOIN v ON v.segment = g.segment AND v.dd = g.dd AND v.hh = g.hh", FLOW)
def wn6(spark, d):
    return Q.complete_grid(volumes(spark, d), ["segment", "dd"], "hh", 0, 23, "bytes")


@query("wn7_three_windows", """
    WITH s AS (SELECT queries_name, min(sec) AS lo, max(sec) AS hi FROM v_dns GROUP BY queries_name HAVING max(sec) - min(sec) >= 3 * 86400),
         p AS (SELECT queries_name, CASE WHEN sec < lo + 86400 THEN 0 WHEN sec > hi - 86400 THEN 2 WHEN abs(sec - (lo + hi) / 2) <= 43200 THEN 1 END AS part FROM v_dns JOIN s USING (queries_name))
    SELECT queries_name FROM p GROUP BY queries_name HAVING count(DISTINCT part) = 3""", ("v_dns",))
def wn7(spark, d):
    return Q.three_window_presence(view(spark, d, "v_dns"), "queries_name", "sec", 86_400)


@query("wn8_first_record", "SELECT dstip, sec, flow_id, srcip FROM (SELECT *, row_number() OVER (PARTITION BY dstip ORDER BY sec, flow_id) AS k FROM v_flow_ts) WHERE k = 1", FLOW)
def wn8(spark, d):
    return Q.first_of_each(view(spark, d, "v_flow_ts").select("dstip", "sec", "flow_id", "srcip"), "dstip", ["sec", "flow_id"])


@query("wn9_idle_days", "WITH l AS (SELECT srcip, max(dt) AS day FROM v_flow_ts GROUP BY srcip), g AS (SELECT srcip, CAST(date_diff('day', CAST(day AS DATE), DATE '2024-01-31') AS INTEGER) AS gap_days FROM l) SELECT srcip, gap_days, CASE WHEN gap_days >= 3 THEN 5 ELSE 4 END AS flag FROM g WHERE gap_days >= 2", FLOW)
def wn9(spark, d):
    last = view(spark, d, "v_flow_ts").groupBy("srcip").agg(F.max("dt").alias("day"))
    return Q.idle_days(last, F.lit("2024-01-31").cast("date"), "day", 2, 3).select("srcip", "gap_days", "flag")


_VISITS = "x AS (SELECT DISTINCT srcip, queries_name FROM v_dns), n AS (SELECT srcip, count(*) AS n FROM x GROUP BY srcip), l AS (SELECT a.srcip AS a, b.srcip AS b, round(count(*) / sqrt(any_value(na.n) * any_value(nb.n)), 6) AS similarity FROM x a JOIN x b ON a.queries_name = b.queries_name AND a.srcip < b.srcip JOIN n na ON na.srcip = a.srcip JOIN n nb ON nb.srcip = b.srcip GROUP BY a.srcip, b.srcip HAVING round(count(*) / sqrt(any_value(na.n) * any_value(nb.n)), 6) >= 0.6)"


@query("gr1_cosine_links", f"WITH {_VISITS} SELECT a, b, similarity FROM l", ("v_dns",))
def gr1(spark, d):
    return G.cosine_links(view(spark, d, "v_dns"), "srcip", "queries_name", 0.6)


@query("gr2_components", f"""
    WITH RECURSIVE {_VISITS}, e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), r AS (SELECT a AS node, a AS seen FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen)
    SELECT node, min(seen) AS component FROM r GROUP BY node""", ("v_dns",))
def gr2(spark, d):
    return G.cosine_components(view(spark, d, "v_dns"), "srcip", "queries_name", 0.6)


@query("gr3_frequency_index", "SELECT srcip, n, CAST(row_number() OVER (ORDER BY n DESC, srcip) - 1 AS INTEGER) AS index FROM (SELECT srcip, count(*) AS n FROM v_dns GROUP BY srcip)", ("v_dns",))
def gr3(spark, d):
    return G.frequency_index(view(spark, d, "v_dns"), "srcip")
