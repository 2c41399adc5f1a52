"""From flows, DNS and requests through ten detectors and the event table to host verdicts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkwarden.adapters import view
from sparkwarden.functions import strings as S
from sparkwarden.operators import aggregates as A
from sparkwarden.operators import sequences as Q
from sparkwarden.operators.enrich import bounded
from sparkwarden.operators.merge import membership
from sparkwarden.plans import events as E
from sparkwarden.plans import flows, web
from sparkwarden.plans.scoring import ScoreRegistry, scored_day
from sparkwarden.queries import query
from sparkwarden.queries.detections import _PORTS, _old_new, _port_baseline
from sparkwarden.queries.relational import _PERIOD, _RATIO
from sparkwarden.storage import scratch, shared_dir, written

VIEWS = ("v_flow_ts", "v_dns", "v_http", "v_evt")
#: Words that confirm an injection here, and what such a request must hold.
WORDS = ["select", "union", "script", "ref"]
#: Limits of the chain on the given tables.
MOST_UP, PERIODIC, VOWELS, LONG_NAME, THREAT_VALUE = 5_000, 0.3, 0.25, 17, 60
WEIGHTS = dict(zip(E.KINDS, (0.1, 0.05, 0.2, 0.1, 0.15, 0.05, 0.1, 0.1, 0.05, 0.1), strict=True))


def _traffic(spark, d):
    """Hourly bytes of each host; the month's first 20 days are the baseline of the last ten."""
    flow = view(spark, d, "v_flow_ts")
    return flow.groupBy(F.col("srcip").alias("ip"), "dd", "hh").agg(F.sum("upbytesize").cast("double").alias("bytes"), F.max("sec").alias("sec"), F.min("flow_id").alias("flow_id"))


def detector_events(spark, d):
    """All ten detectors over days 21 to 30, as events.

    What several detectors read, or one several times, is written once; the caller writes the events within
    ``storage.scratch``, which deletes these tables.
    """
    old, new = _old_new(spark, d)
    _, dns = _old_new(spark, d, "v_dns")
    dns = written(dns.select("flow_id", "srcip", "queries_name", "flags_response", "size", "sec", "dd", "page_id"), "dns")
    _, log = _old_new(spark, d, "v_evt")
    # Names with few vowels; a host is reported for a day with two of them.
    name = F.element_at(F.split("queries_name", r"\."), -3)
    odd = dns.withColumn("domain", name).where((F.length("domain") > 0) & (S.share(F.col("domain"), S.VOWELS) < VOWELS))
    algorithmic = written(E.detected("algorithmic_domain", odd, "srcip", score=F.countDistinct("domain")).where("score >= 2"), "algorithmic")
    ports = E.detected("abnormal_ports", flows.abnormal_ports(new, written(_port_baseline(old), "port-baseline"), as_of=21), "dstip")
    long = dns.where(F.length(F.replace("queries_name", F.lit("."), F.lit(""))) >= LONG_NAME)
    covert = E.detected("covert_channel", long, "srcip", score=F.sum(F.col("flags_response")), mean_up=F.avg("size")).where("score > 0 AND score < n")
    talks = written(dns.join(new.select("flow_id", "upbytesize"), "flow_id").select("srcip", "queries_name", "sec", "dd", "flow_id", "upbytesize", "page_id"), "talks")
    beats = Q.periodicity(talks, ["srcip", "queries_name"], "sec", "flow_id").where(F.col("score") > PERIODIC)
    threats = written(talks.where("page_id % 10 = 0").select("queries_name").distinct(), "threats")
    suspicious = written(talks.where("page_id % 3 = 0").select("queries_name").distinct(), "suspicious")
    tagged = membership(talks.join(beats, ["srcip", "queries_name"]), "queries_name", threats, suspicious)
    # A conversation is one event, on its last day.
    conversation = tagged.groupBy("srcip", "queries_name").agg(F.max("dd").alias("dd"), F.max("sec").alias("sec"), F.min("flow_id").alias("flow_id"), F.max("score").alias("score"), F.max("tag").alias("tag"), F.avg("upbytesize").alias("mean_up"))
    heartbeat = E.detected("heartbeat", conversation, "srcip", peer="queries_name", score=F.max("score"), tag=F.max("tag"), mean_up=F.max("mean_up"))
    ratios = flows.ratio_anomalies(new, flows.ratio_baseline(old))
    asked = bounded(algorithmic.select("ip", F.col("day").alias("dd")).withColumn("asked", F.lit(1)))
    up_down = E.detected("up_down", ratios.join(asked, ["ip", "dd"], "left"), "ip", score=F.max("ratio"), tag=F.max(F.coalesce("asked", F.lit(0))))
    pairs = written(flows.bulk_periods(old, 1000).where("dd <= 3").select("ip", "period").distinct(), "periods")
    external = E.detected("external_connection", flows.unusual_flows(new, pairs, 1000), "srcip")
    traffic = flows.volume_exceedances(_traffic(spark, d), ["ip"], "dd", "hh", k=1.0, days=20)
    exceeding = written(traffic.where("dd > 20 AND exceeds = 1").select("ip", "dd", "hh", "sec", "flow_id", "exceeds"), "exceeding")
    runs = flows.longest_slot_run(exceeding, ["ip", "dd"], "hh", "exceeds").where("longest >= 1").select("ip", "dd", "longest")
    volume = E.detected("traffic_anomaly", exceeding.join(runs, ["ip", "dd"]), "ip", score=F.max("longest"))
    botted = written(A.shared_by(dns.where("page_id % 10 = 0"), "queries_name", "srcip", 3).select("queries_name"), "botted")
    bots = E.detected("botnet", dns.join(bounded(botted), "queries_name", "left_semi"), "srcip", score=F.countDistinct("queries_name"))
    requests = view(spark, d, "v_http").where("dd > 20")
    # The rest of the request stays beside its text, so that it is not joined again.
    attacks = web.injection_texts(requests, WORDS, ["dstip", "request_date", "dd"]).where("keyword").select(F.col("flow_id").alias("id"), F.col("srcip").alias("ip"), "dstip", F.col("request_date").alias("sec"), "dd")
    log = log.where(F.col("value") >= THREAT_VALUE).select("id", "ip", "dstip", "sec", "dd", (F.col("modeltype") == "error").alias("bad"))
    security = E.security_events(written(log.unionByName(attacks.withColumn("bad", F.lit(False)).select(*log.columns)), "security"), F.col("bad"))
    return E.all_events([ports, covert, heartbeat, up_down, algorithmic, external, volume, security, bots])


def event_table(spark, d, root=None):
    """Events of the run as they come back from the table; detected again, they replace themselves."""
    log = E.event_log(spark, root or f"{shared_dir(spark)}/sparkwarden/events-{uuid.uuid4().hex}")
    with scratch():
        log.write(detector_events(spark, d), "days-21-30")
    return log.read()


def _event(kind, source, ip, key="flow_id", peer="''", at="sec", day="dd", score="NULL", tag="NULL", mean_up="NULL", threat="NULL", having=""):
    return (
        f"SELECT '{kind}' AS kind, {ip} AS ip, {peer} AS peer, CAST({day} AS INTEGER) AS day, CAST(max({at}) AS BIGINT) AS at_sec, count(*) AS n, CAST(min({key}) AS BIGINT) AS first_id, "
        f"CAST({score} AS DOUBLE) AS score, CAST({tag} AS INTEGER) AS tag, CAST({mean_up} AS DOUBLE) AS mean_up, CAST({threat} AS INTEGER) AS threat FROM {source} GROUP BY {ip}, {peer}, {day} {having}"
    )


_SPACED = r"trim(regexp_replace(regexp_replace(regexp_replace(lower(url_decode(replace(uri, '+', ' '))), '(%[0-9a-f]{2})', ' \1 ', 'g'), '([()<>=,;''" + '"' + r"/&?+*|-])', ' \1 ', 'g'), '\s+', ' ', 'g'))"
_EVENTS = f"""{_PORTS},
    ports AS (SELECT * FROM c WHERE dd > 20 AND dstip IN (SELECT dstip FROM b GROUP BY dstip HAVING 21 - min(since) >= 7)
              AND NOT (EXISTS (SELECT 1 FROM b WHERE b.dstip = c.dstip AND b.dstport = c.dstport) AND EXISTS (SELECT 1 FROM b WHERE b.dstip = c.dstip AND b.protocol = c.protocol))),
    dns AS (SELECT * FROM v_dns WHERE dd > 20), named AS (SELECT *, string_split(queries_name, '.')[-3] AS domain FROM dns),
    odd AS (SELECT * FROM named WHERE length(domain) > 0 AND length(regexp_replace(domain, '[^aeiou]', '', 'g')) / length(domain) < {VOWELS}),
    algo AS ({_event("algorithmic_domain", "odd", "srcip", score="count(DISTINCT domain)", having="HAVING count(DISTINCT domain) >= 2")}),
    lengthy AS (SELECT * FROM dns WHERE length(replace(queries_name, '.', '')) >= {LONG_NAME}),
    talks AS (SELECT dns.*, f.upbytesize FROM dns JOIN v_flow_ts f ON f.flow_id = dns.flow_id AND f.dd > 20),
    gaps AS (SELECT srcip, queries_name, sec - lag(sec) OVER w AS gap, row_number() OVER w AS k, count(*) OVER (PARTITION BY srcip, queries_name) AS n FROM talks WINDOW w AS (PARTITION BY srcip, queries_name ORDER BY sec, flow_id)),
    lists AS (SELECT srcip, queries_name, list(CAST(gap AS DOUBLE) ORDER BY k) AS x FROM gaps WHERE n >= 4 AND gap IS NOT NULL GROUP BY ALL),
    strides AS (SELECT srcip, queries_name, coalesce(list_sum(list_transform(range(1, CAST(ceil(len(x) / j) AS BIGINT)), lambda i: x[i * j + 1] * x[(i - 1) * j + 1])), 0) / nullif(list_sum(list_transform(x, lambda v: v * v)), 0) AS s FROM lists, unnest(range(1, greatest(len(x), 2))) u(j)),
    beats AS (SELECT srcip, queries_name, round(max(s), 6) AS score FROM strides GROUP BY ALL HAVING round(max(s), 6) > {PERIODIC}),
    talked AS (SELECT t.srcip, t.queries_name, max(dd) AS dd, max(sec) AS sec, min(flow_id) AS flow_id, max(beats.score) AS score, avg(upbytesize) AS mean_up FROM talks t JOIN beats ON beats.srcip = t.srcip AND beats.queries_name = t.queries_name GROUP BY ALL),
    tagged AS (SELECT *, (CASE WHEN queries_name IN (SELECT queries_name FROM talks WHERE page_id % 10 = 0) THEN 1 ELSE 0 END) + (CASE WHEN queries_name IN (SELECT queries_name FROM talks WHERE page_id % 3 = 0) THEN 2 ELSE 0 END) AS tag FROM talked),
    r AS (SELECT flow_id, srcip AS ip, sec, dd, {_PERIOD} AS period, {_RATIO} AS ratio FROM v_flow_ts), rb AS (SELECT ip, period, max(ratio) AS max_ratio FROM r WHERE dd <= 20 GROUP BY ip, period),
    ratios AS (SELECT r.*, CASE WHEN EXISTS (SELECT 1 FROM algo WHERE algo.ip = r.ip AND algo.day = r.dd) THEN 1 ELSE 0 END AS asked FROM r JOIN rb ON rb.ip = r.ip AND rb.period = r.period WHERE dd > 20 AND ratio > max_ratio),
    p AS (SELECT *, {_PERIOD} AS period FROM v_flow_ts WHERE srcport > 1024 AND dstport < 1024 AND upbytesize > 1000), pb AS (SELECT DISTINCT srcip, period FROM p WHERE dd <= 3),
    external AS (SELECT * FROM p WHERE dd > 20 AND srcip IN (SELECT srcip FROM pb) AND (srcip, period) NOT IN (SELECT srcip, period FROM pb)),
    t AS (SELECT srcip AS ip, dd, hh, CAST(sum(upbytesize) AS DOUBLE) AS bytes, max(sec) AS sec, min(flow_id) AS flow_id FROM v_flow_ts GROUP BY ALL),
    tb AS (SELECT *, count(bytes) OVER w AS nb, avg(bytes) OVER w AS mean, stddev_pop(bytes) OVER w AS s FROM t WINDOW w AS (PARTITION BY ip, hh ORDER BY dd RANGE BETWEEN 20 PRECEDING AND 1 PRECEDING)),
    tu AS (SELECT *, CASE WHEN nb = 1 THEN mean WHEN nb > 1 THEN mean + s END AS upper FROM tb), tj AS (SELECT *, bytes > coalesce(upper, avg(upper) OVER (PARTITION BY ip, dd)) + 1e-6 AS exceeds FROM tu),
    ti AS (SELECT *, hh - row_number() OVER (PARTITION BY ip, dd ORDER BY hh) AS island FROM tj WHERE exceeds AND dd > 20), tl AS (SELECT ip, dd, max(k) AS longest FROM (SELECT ip, dd, island, count(*) AS k FROM ti GROUP BY ALL) GROUP BY ip, dd),
    volume AS (SELECT ti.*, longest FROM ti JOIN tl ON tl.ip = ti.ip AND tl.dd = ti.dd),
    botted AS (SELECT queries_name FROM dns WHERE page_id % 10 = 0 GROUP BY queries_name HAVING count(DISTINCT srcip) >= 3), bots AS (SELECT * FROM dns WHERE queries_name IN (SELECT queries_name FROM botted)),
    raw AS (SELECT id, ip, dstip, sec, dd, modeltype = 'error' AS bad FROM v_evt WHERE dd > 20 AND value >= {THREAT_VALUE}
            UNION ALL SELECT flow_id, srcip, dstip, request_date, dd, false FROM v_http WHERE dd > 20 AND regexp_matches({_SPACED}, '{"|".join(WORDS)}')),
    ends AS (SELECT id, ip AS host, sec, dd, CAST(bad AS INTEGER) AS threat FROM raw UNION ALL SELECT id, dstip, sec, dd, CAST(bad AS INTEGER) FROM raw WHERE dstip <> ip),
    e0 AS ({_event("abnormal_ports", "ports", "dstip")} UNION ALL {_event("covert_channel", "lengthy", "srcip", score="sum(flags_response)", mean_up="avg(size)", having="HAVING sum(flags_response) > 0 AND sum(flags_response) < count(*)")}
           UNION ALL {_event("heartbeat", "tagged", "srcip", peer="queries_name", score="max(score)", tag="max(tag)", mean_up="max(mean_up)")} UNION ALL {_event("up_down", "ratios", "ip", score="max(ratio)", tag="max(asked)")}
           UNION ALL SELECT * FROM algo UNION ALL {_event("external_connection", "external", "srcip")} UNION ALL {_event("traffic_anomaly", "volume", "ip", score="max(longest)")}
           UNION ALL {_event("security_event", "ends", "host", key="id", threat="max(threat)")} UNION ALL {_event("threat", "(SELECT * FROM ends WHERE threat = 1)", "host", key="id", threat="max(threat)")}
           UNION ALL {_event("botnet", "bots", "srcip", score="count(DISTINCT queries_name)")}),
    ev AS (SELECT sha256(concat_ws('|', kind, ip, peer, CAST(day AS VARCHAR))) AS event_id, ip, peer, at_sec, n, first_id, score, tag, mean_up, threat, kind || ' x' || n || ' #' || first_id AS evidence, day, kind FROM e0)"""


@query("dt13_detector_events", f"WITH {_EVENTS} SELECT event_id, ip, peer, at_sec AS \"at\", n, first_id, round(score, 6) AS score, tag, round(mean_up, 6) AS mean_up, threat, evidence, day, kind, 'days-21-30' AS batch FROM ev", VIEWS)
def dt13_events(spark, d):
    return event_table(spark, d).withColumn("score", F.round("score", 6)).withColumn("mean_up", F.round("mean_up", 6))


_FUSED = f"""{_EVENTS},
    last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ip, kind ORDER BY at_sec DESC, event_id DESC) AS k FROM ev) WHERE k = 1
             AND ip IN (SELECT ip FROM ev WHERE kind IN ({", ".join(f"'{k}'" for k in E.DETECTORS)}))),
    ok AS (SELECT * FROM last WHERE NOT (kind = 'heartbeat' AND NOT (tag = 2 AND mean_up < {MOST_UP})) AND NOT (kind = 'up_down' AND tag <> 1) AND NOT (kind = 'threat' AND threat <> 1)),
    fused AS (SELECT ip, {", ".join(f"CAST(max(CASE WHEN kind = '{k}' THEN 1 ELSE 0 END) AS INTEGER) AS {k}" for k in E.KINDS)},
              string_agg(evidence, '@' ORDER BY evidence) AS evidence, min(at_sec) AS first_at, max(at_sec) AS last_at FROM ok GROUP BY ip)"""


@query("dt13_fused_detections", f"WITH {_FUSED} SELECT * FROM fused", VIEWS)
def dt13_fused(spark, d):
    return E.fused(event_table(spark, d), MOST_UP)


_VECTOR = ", ".join(E.KINDS)


@query("dt14_host_verdicts", f"""
    WITH {_FUSED}, patterns AS (SELECT {_VECTOR}, 90.0 AS s FROM fused GROUP BY ALL HAVING count(*) BETWEEN 3 AND 12),
         q AS (SELECT fused.*, s, coalesce(s, floor(({" + ".join(f"{k} * {w}" for k, w in WEIGHTS.items())}) * 100 + 1e-9)) AS raw FROM fused LEFT JOIN patterns USING ({_VECTOR})),
         z AS (SELECT *, CASE WHEN threat = 1 AND raw < 60 THEN 60.0 ELSE raw END AS score FROM q),
         allowed AS (SELECT DISTINCT {_VECTOR} FROM fused WHERE first_at % 3 <> 2)
    SELECT sha256(ip || '|' || last_at) AS verdict_id, ip, CAST(score AS DOUBLE) AS score, CASE WHEN s IS NOT NULL THEN 1 ELSE 2 END AS score_type, CASE WHEN score >= 80 THEN 'high' WHEN score >= 70 THEN 'medium' WHEN score >= 60 THEN 'low' ELSE 'none' END AS level,
           concat_ws(',', {", ".join(f"CASE WHEN {k} = 1 THEN '{k}' END" for k in E.KINDS)}) AS indicators, evidence, first_at, last_at
    FROM z SEMI JOIN allowed USING ({_VECTOR}) WHERE score > 20""", VIEWS)
def dt14_verdicts(spark, d):
    """Vectors of three to twelve hosts are rules; an analyst has seen every host and rejected a third of them."""
    found = written(E.fused(event_table(spark, d), MOST_UP), "fused")  # read as patterns, feedback and verdicts
    patterns = found.groupBy(*E.KINDS).agg(F.count(F.lit(1)).alias("n")).where("n BETWEEN 3 AND 12").withColumn("pattern_score", F.lit(90.0))
    feedback = found.withColumn("flag", F.when(F.col("first_at") % 3 == 2, 2).otherwise(1))
    return E.verdicts(found, WEIGHTS, patterns, feedback, cut_off=20)


@query("dt14_fitted_verdicts")
def dt14_fitted(spark, d):
    """Weights and rules learned after day 25 and again after day 28; day 27 is scored by the first, day 29 by the second."""
    events = event_table(spark, d)
    registry = ScoreRegistry(spark, f"{shared_dir(spark)}/sparkwarden/scores-{uuid.uuid4().hex}")
    for day in (25, 28):
        known = E.fused(events.where(F.col("day") <= day), MOST_UP)
        registry.learn(known.withColumn("label", F.col("threat")), day)
    one = lambda day: scored_day(events, registry, day, MOST_UP).withColumn("day", F.lit(day))
    return one(27).unionByName(one(29))
