"""Detection pipelines: baselines from days 1 to 20, detections in days 21 to 30."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkwarden.adapters import view
from sparkwarden.functions import strings as S
from sparkwarden.ml import models
from sparkwarden.operators import sequences as Q
from sparkwarden.plans import botnets, dns, flows, hosts, leak, web
from sparkwarden.queries import query, table
from sparkwarden.queries.learning import covert_label
from sparkwarden.queries.relational import _PERIOD, _RATIO, ASSET, FLOW, KINDS
from sparkwarden.queries.sequences import _BASE, _GAPS, _VISITS, _VOLUME, volumes
from sparkwarden.sources.versions import Versions
from sparkwarden.storage import shared_dir, written

_WELL = "dstport <= srcport AND dstport < 1024 AND dstport NOT IN (22, 23, 80, 81, 139, 443) AND protocol IN ('tcp', 'udp')"
_PORTS = f"c AS (SELECT * FROM v_flow_ts WHERE {_WELL}), b AS (SELECT dstip, dstport, protocol, min(dd) AS since FROM c WHERE dd BETWEEN 14 AND 20 GROUP BY ALL)"


def _old_new(spark, d, name="v_flow_ts"):
    df = view(spark, d, name)
    return df.where("dd <= 20"), df.where("dd > 20")


def _port_baseline(old):
    return flows.candidate_ports(old.where("dd >= 14")).groupBy(F.col("dstip").alias("ip"), "dstport", "protocol").agg(F.min("dd").alias("trained_day"))


@query("dt1_abnormal_ports", f"""
    WITH {_PORTS} SELECT flow_id, dstip, dstport, protocol FROM c WHERE dd > 20 AND dstip IN (SELECT dstip FROM b GROUP BY dstip HAVING 21 - min(since) >= 7)
      AND NOT EXISTS (SELECT 1 FROM b WHERE b.dstip = c.dstip AND b.dstport = c.dstport AND b.protocol = c.protocol)""", FLOW)
def dt1(spark, d):
    old, new = _old_new(spark, d)
    return flows.abnormal_ports(new, _port_baseline(old), as_of=21, pairwise=True).select("flow_id", "dstip", "dstport", "protocol")


@query("dt1_learned_ports", f"WITH {_PORTS} (SELECT dstip AS ip, dstport, protocol FROM c WHERE dd > 20 UNION SELECT dstip, dstport, protocol FROM v_flow_ts WHERE flow_id % 97 = 0) EXCEPT SELECT dstip, dstport, protocol FROM b", FLOW)
def dt1_learn(spark, d):
    old, new = _old_new(spark, d)
    feedback = view(spark, d, "v_flow_ts").where("flow_id % 97 = 0").select(F.col("dstip").alias("ip"), "dstport", "protocol")
    return flows.learned_ports(new, _port_baseline(old), feedback)


@query("dt2_unusual_periods", f"""
    WITH p AS (SELECT *, {_PERIOD} AS period FROM v_flow_ts WHERE srcport > 1024 AND dstport < 1024), b AS (SELECT DISTINCT srcip, period FROM p WHERE dd <= 20)
    SELECT srcip, dstip, period, min(flow_id) AS flow_id, CAST(sum(upbytesize) AS BIGINT) AS bytes FROM p WHERE dd > 20 AND upbytesize > 1000 AND srcip IN (SELECT srcip FROM b) AND (srcip, period) NOT IN (SELECT srcip, period FROM b) GROUP BY srcip, dstip, period""", FLOW)
def dt2(spark, d):
    old, new = _old_new(spark, d)
    from sparkwarden.operators.enrich import day_period

    base = old.where("srcport > 1024 AND dstport < 1024").select(F.col("srcip").alias("ip"), day_period(F.col("hh")).alias("period")).distinct()
    return flows.unusual_periods(new, base, least=1000)


@query("dt2_learned_periods", f"""
    WITH p AS (SELECT flow_id, srcip AS ip, dd, {_PERIOD} AS period FROM v_flow_ts WHERE srcport > 1024 AND dstport < 1024 AND upbytesize > 1000), b0 AS (SELECT DISTINCT ip, period FROM p WHERE dd <= 3),
         b1 AS (SELECT ip, period FROM b0 UNION SELECT ip, period FROM p WHERE dd BETWEEN 4 AND 15 AND (ip NOT IN (SELECT ip FROM b0) OR flow_id % 7 = 0))
    SELECT ip, period FROM b1 UNION SELECT ip, period FROM p WHERE dd > 15 AND (ip NOT IN (SELECT ip FROM b1) OR flow_id % 7 = 0)""", FLOW)
def dt2_learn(spark, d):
    """Two batches after the first three days; an analyst confirms every seventh flow's pair. The last batch comes twice."""
    flow = view(spark, d, "v_flow_ts")
    baselines = Versions(spark, f"{shared_dir(spark)}/sparkwarden/periods-{uuid.uuid4().hex}", "ip string, period string")
    nobody = spark.createDataFrame([], "ip string, period string")
    for batch, days, confirmed in ((0, "dd <= 3", nobody), (1, "dd BETWEEN 4 AND 15", None), (2, "dd > 15", None), (2, "dd > 15", None)):
        part = flow.where(days)
        pairs = flows.bulk_periods(part.where("flow_id % 7 = 0"), 1000).select("ip", "period") if confirmed is None else confirmed
        baselines.merge("flows", batch, lambda base: flows.learned_periods(base, part, pairs, 1000))  # noqa: B023
    return baselines.read()


@query("dt3_ratio_anomaly", f"""
    WITH r AS (SELECT flow_id, srcip AS ip, dd, {_PERIOD} AS period, {_RATIO} AS ratio FROM v_flow_ts), b AS (SELECT ip, period, max(ratio) AS max_ratio FROM r WHERE dd <= 20 GROUP BY ip, period)
    SELECT flow_id, r.ip, r.period, round(ratio, 6) AS ratio, round(max_ratio, 6) AS max_ratio FROM r JOIN b ON b.ip = r.ip AND b.period = r.period WHERE dd > 20 AND ratio > max_ratio""", FLOW)
def dt3(spark, d):
    old, new = _old_new(spark, d)
    return flows.ratio_anomalies(new, flows.ratio_baseline(old)).select("flow_id", "ip", "period", F.round("ratio", 6).alias("ratio"), F.round("max_ratio", 6).alias("max_ratio"))


@query("dt4_discovered_assets", """
    WITH s AS (SELECT srcip AS ip, sec, flow_id, 'source' AS side, protocol FROM v_flow_ts WHERE protocol <> 'icmp' AND regexp_extract(srcip, '^([0-9]+[.][0-9]+[.][0-9]+)', 1) IN ('10.0.1', '172.16.0')
               UNION ALL SELECT dstip, sec, flow_id, 'target', protocol FROM v_flow_ts WHERE protocol = 'tcp' AND uppkts > 2 AND regexp_extract(dstip, '^([0-9]+[.][0-9]+[.][0-9]+)', 1) IN ('10.0.1', '172.16.0')),
         k AS (SELECT *, row_number() OVER (PARTITION BY ip ORDER BY sec, flow_id, side) AS k FROM s WHERE ip NOT IN (SELECT ip FROM v_asset WHERE status = 1))
    SELECT ip, sec, flow_id, side, protocol FROM k WHERE k = 1""", ASSET)
def dt4(spark, d):
    segments = spark.createDataFrame([("10.0.1",), ("172.16.0",)], "segment string")
    return flows.discovered_assets(view(spark, d, "v_flow_ts"), view(spark, d, "v_asset").where("status = 1"), segments)


_LIMITS = f"{_VOLUME}, {_BASE}, u AS (SELECT *, CASE WHEN n_base = 1 THEN 3 * base_mean WHEN n_base > 1 THEN base_mean + 3 * s END AS upper FROM b), j AS (SELECT *, CASE WHEN bytes > coalesce(upper, avg(upper) OVER (PARTITION BY segment, dd)) + 1e-6 THEN 1 ELSE 0 END AS exceeds FROM u)"


#: DT5 with a lower limit than three deviations, so that the given tables have runs.
_NARROW = _LIMITS.replace("base_mean + 3 * s", "base_mean + s").replace("3 * base_mean", "base_mean")


@query("dt5_volume_anomaly", f"""
    WITH {_NARROW}, i AS (SELECT *, hh - row_number() OVER (PARTITION BY segment, dd ORDER BY hh) AS island FROM j WHERE dd >= 8 AND exceeds = 1),
         r AS (SELECT segment, dd, count(*) AS length, min(hh) AS first_slot FROM i GROUP BY segment, dd, island), p AS (SELECT segment, dd, count(*) AS present FROM j WHERE dd >= 8 GROUP BY segment, dd HAVING count(*) > 2)
    SELECT segment, dd, max(length) AS longest, CAST(arg_min(first_slot, first_slot - 1000 * length) AS BIGINT) AS first_slot, any_value(present) AS present FROM r JOIN p USING (segment, dd) GROUP BY segment, dd HAVING max(length) >= 2""", FLOW)
def dt5(spark, d):
    return flows.volume_anomalies(volumes(spark, d), ["segment"], "dd", "hh", first_day=8, consecutive=2, k=1.0)


@query("dt6_masked_history", f"WITH {_LIMITS} SELECT segment, dd, hh, bytes FROM j WHERE exceeds = 0", FLOW)
def dt6(spark, d):
    base = volumes(spark, d)
    odd = flows.volume_exceedances(base, ["segment"], "dd", "hh").where("exceeds = 1")
    return flows.masked_history(base, odd, ["segment", "dd", "hh"])


@query("dt7_heartbeats", f"""
    WITH {_GAPS}, x AS (SELECT srcip, protocol, list(CAST(gap AS DOUBLE) ORDER BY k) AS x FROM g WHERE n >= 4 AND gap IS NOT NULL GROUP BY ALL),
         t AS (SELECT srcip, protocol, x, list_sum(list_transform(x, lambda v: v * v)) AS total FROM x),
         j AS (SELECT srcip, protocol, len(x) AS n, coalesce(list_sum(list_transform(range(1, CAST(ceil(len(x) / j) AS BIGINT)), lambda i: x[i * j + 1] * x[(i - 1) * j + 1])), 0) / nullif(total, 0) AS s FROM t, unnest(range(1, greatest(len(x), 2))) u(j)),
         m AS (SELECT srcip, protocol, CAST(any_value(n) AS INTEGER) AS n_gaps, round(max(s), 6) AS score FROM j GROUP BY ALL), a AS (SELECT srcip, protocol, round(avg(upbytesize), 4) AS mean_up FROM v_flow_ts GROUP BY ALL)
    SELECT m.srcip, m.protocol, n_gaps, score, mean_up, CAST((CASE WHEN m.protocol IN ('tcp', 'icmp') THEN 1 ELSE 0 END) + (CASE WHEN m.protocol = 'tcp' THEN 2 ELSE 0 END) AS INTEGER) AS tag FROM m JOIN a ON a.srcip = m.srcip AND a.protocol = m.protocol WHERE score > 0.4""", FLOW)
def dt7(spark, d):
    lists = [spark.createDataFrame([(x,) for x in names], "protocol string") for names in (("tcp", "icmp"), ("tcp",))]
    return flows.heartbeats(view(spark, d, "v_flow_ts"), ["srcip", "protocol"], *lists, least=0.4)


@query("dt8_domain_features", """
    WITH h AS (SELECT DISTINCT host FROM v_page WHERE host <> ''), c AS (SELECT host, unnest(string_split(host, '')) AS ch, length(host) AS n FROM h), q AS (SELECT host, ch, n, count(*) AS k FROM c GROUP BY ALL),
         e AS (SELECT host, round(-sum(k / n * ln(k / n)), 6) AS entropy, round(coalesce(sum(k) FILTER (k > 1 AND ch BETWEEN 'a' AND 'z'), 0) / any_value(n), 6) AS repeated FROM q GROUP BY host),
         g AS (SELECT host, substr('^' || host || '$', CAST(i AS BIGINT), 3) AS gram FROM h, unnest(range(1, length(host) + 1)) t(i)), r AS (SELECT gram, dense_rank() OVER (ORDER BY n DESC, gram) AS rank FROM (SELECT gram, count(*) AS n FROM g GROUP BY gram)),
         a AS (SELECT host, round(avg(coalesce(rank, 0)), 6) AS avg_rank FROM g LEFT JOIN r USING (gram) GROUP BY host),
         p AS (SELECT host, substr(host, CAST(i AS BIGINT), 2) AS pair FROM h, unnest(range(1, length(host))) t(i)),
         t AS (SELECT pair, n / sum(n) OVER (PARTITION BY substr(pair, 1, 1)) AS p FROM (SELECT pair, count(*) AS n FROM p GROUP BY pair)),
         z AS (SELECT host, round(coalesce(sum(ln(t.p)), 0), 6) AS transition FROM h LEFT JOIN p USING (host) LEFT JOIN t USING (pair) GROUP BY host)
    SELECT h.host, CAST(length(h.host) AS INTEGER) AS length, entropy, round(length(regexp_replace(h.host, '[^aeiou]', '', 'g')) / length(h.host), 6) AS vowels, round(length(regexp_replace(h.host, '[^0-9]', '', 'g')) / length(h.host), 6) AS digits, repeated,
           round((length(h.host) - length(regexp_replace(h.host, '[bcdfghjklmnpqrstvwxyz]{2,}', '', 'g'))) / length(h.host), 6) AS consonant_runs, round((length(h.host) - length(regexp_replace(h.host, '[0-9]{2,}', '', 'g'))) / length(h.host), 6) AS digit_runs, avg_rank, transition
    FROM h JOIN e USING (host) JOIN a USING (host) JOIN z USING (host)""", ("v_page",))
def dt8(spark, d):
    names = view(spark, d, "v_page").where("host <> ''").select("host").distinct()
    return dns.domain_features(names, "host", dns.gram_ranks(names, "host", 3), dns.transition_table(names, "host"))


_SPLIT = """s(suffix) AS (VALUES ('com'), ('net'), ('org'), ('example.com'), ('example.net'), ('example.org')), n AS (SELECT DISTINCT queries_name FROM v_dns),
         m AS (SELECT queries_name, suffix, row_number() OVER (PARTITION BY queries_name ORDER BY length(suffix) DESC) AS k FROM n JOIN s ON ends_with(queries_name, '.' || suffix)),
         r AS (SELECT queries_name, suffix, string_split(substr(queries_name, 1, length(queries_name) - length(suffix) - 1), '.') AS l FROM m WHERE k = 1),
         c AS (SELECT v.*, l[-1] AS domain FROM v_dns v JOIN r USING (queries_name) WHERE len(l) - 1 <= 2 AND length(l[-1]) >= 4 AND queries_name NOT IN (SELECT queries_name FROM v_dns WHERE page_id % 10 = 1))"""


def _named(spark, d):
    records = view(spark, d, "v_dns")
    suffixes = spark.createDataFrame([(x,) for x in ("com", "net", "org", "example.com", "example.net", "example.org")], "suffix string")
    return dns.candidate_names(records, suffixes, records.where("page_id % 10 = 1"))


@query("dt8_algorithmic_hosts", f"WITH {_SPLIT}, o AS (SELECT srcip, domain, count(DISTINCT flow_id) AS n FROM c WHERE size % 3 = 0 GROUP BY srcip, domain HAVING count(DISTINCT flow_id) >= 1) SELECT srcip, count(*) AS domains, CAST(sum(n) AS BIGINT) AS flows FROM o GROUP BY srcip HAVING count(*) >= 2", ("v_dns",))
def dt8_hosts(spark, d):
    return dns.algorithmic_hosts(_named(spark, d).where("size % 3 = 0"), 1, 2)


@query("dt8_detected_hosts")
def dt8_detected(spark, d):
    """From records to hosts, with boosted trees learned from names that are listed for having few vowels."""
    return dns.algorithmic_hosts(dns.detected_names(_named(spark, d), *listed_names(spark, d)), 1, 2)


def listed_names(spark, d):
    """Listed and all names of pages: listed are those with few vowels before the suffix."""
    pages = view(spark, d, "v_page").where("host <> ''").withColumn("queries_name", F.col("host"))
    return pages.where(S.share(F.element_at(F.split("host", r"\."), -3), S.VOWELS) < 0.25), pages


@query("dt9_new_domains", f"WITH {_SPLIT} SELECT DISTINCT domain FROM c WHERE domain NOT IN (SELECT domain FROM c WHERE ends_with(queries_name, '.com'))", ("v_dns",))
def dt9(spark, d):
    named = _named(spark, d)
    return dns.new_domains(named, named.where(F.endswith("queries_name", F.lit(".com"))))


@query("dt10_covert_features", """
    WITH f AS (SELECT flow_id, srcip, queries_name, answers_ttl, answers_data_length, size FROM v_dns), h AS (SELECT DISTINCT replace(queries_name, '.', '') AS host FROM v_dns), c AS (SELECT host, unnest(string_split(host, '')) AS ch, length(host) AS n FROM h), g AS (SELECT host, ch, n, count(*) AS k FROM c GROUP BY ALL), e AS (SELECT host, round(-sum(k / n * log2(k / n)), 6) AS bits FROM g GROUP BY host)
    SELECT flow_id, srcip, CAST(len(string_split(queries_name, '.')) AS INTEGER) AS labels, CAST(length(replace(queries_name, '.', '')) AS INTEGER) AS name_length, list_max(list_transform(string_split(answers_ttl, '#'), lambda x: x::DOUBLE)) AS max_ttl,
           list_sum(list_transform(string_split(answers_data_length, '#'), lambda x: x::DOUBLE)) AS sum_length, bits, round(length(regexp_replace(queries_name, '[^0-9]', '', 'g')) / length(queries_name), 6) AS digits, size
    FROM f LEFT JOIN e ON e.host = replace(queries_name, '.', '')""", ("v_dns",))
def dt10(spark, d):
    return dns.covert_features(view(spark, d, "v_dns"))


@query("dt10_covert_hosts")
def dt10_hosts(spark, d):
    """A forest learned from days 1 to 20, saved, loaded and applied to the days after."""
    old, new = _old_new(spark, d, "v_dns")
    train = written(dns.covert_features(old).withColumn("label", covert_label()), "dns-features")
    return dns.covert_hosts(new, _kept(spark, models.forest_pipeline(train, models.COVERT_FEATURES), "covert-forest"))


@query("dt10_covert_summary", """
    SELECT srcip, count(*) FILTER (flags_response = 0) AS requests, count(*) FILTER (flags_response = 1) AS responses, CAST(coalesce(sum(size) FILTER (flags_response = 0), 0) AS BIGINT) AS request_bytes, CAST(coalesce(sum(size) FILTER (flags_response = 1), 0) AS BIGINT) AS response_bytes,
           max(sec) AS last_at, array_to_string(list_sort(list(DISTINCT queries_name))[1:10], '#') AS names
    FROM v_dns GROUP BY srcip HAVING count(*) FILTER (flags_response = 0) > 0 AND count(*) FILTER (flags_response = 1) > 0""", ("v_dns",))
def dt10_summary(spark, d):
    return dns.covert_summary(view(spark, d, "v_dns"))


def _injection_sql(words):
    spaced = r"trim(regexp_replace(regexp_replace(regexp_replace(lower(url_decode(replace(uri, '+', ' '))), '(%[0-9a-f]{2})', ' \1 ', 'g'), '([()<>=,;''" + '"' + r"/&?+*|-])', ' \1 ', 'g'), '\s+', ' ', 'g'))"
    return f"WITH x AS (SELECT flow_id, srcip, host, {spaced} AS text FROM v_http) SELECT *, regexp_matches(text, '{words}') AS keyword FROM x"


@query("dt11_sql_injection_texts", _injection_sql("select|union|insert|update|delete|drop"), ("v_http",))
def dt11(spark, d):
    from sparkwarden.functions.strings import SQL_WORDS

    return web.injection_texts(view(spark, d, "v_http"), SQL_WORDS)


@query("dt12_script_injection_texts", _injection_sql("script|alert|onerror|onload|javascript|iframe"), ("v_http",))
def dt12(spark, d):
    from sparkwarden.functions.strings import SCRIPT_WORDS

    return web.injection_texts(view(spark, d, "v_http"), SCRIPT_WORDS)


def _kept(spark, model, name):
    """The model as it comes back from the shared folder."""
    path = f"{shared_dir(spark)}/sparkwarden/{name}-{uuid.uuid4().hex}"
    models.save(model, path)
    return models.load(path)


#: Attacks that are planted in every 23rd request, and what others say with the same words.
_ATTACKS = {"sql": ["&q=1%27+union+select+name+from+users--", "&id=7;drop+table+x"], "script": ["&c=%3Cscript%3Ealert(1)%3C/script%3E", "&c=%22onerror=alert(2)"]}
_INNOCENT = {"sql": "&q=please+select+one+from+here", "script": "&q=the+script+of+the+play"}


def planted_requests(spark, d, kind):
    """Requests with ``label`` 1 where an attack was planted; others, as many, only use its words."""
    some = F.element_at(F.array(*[F.lit(x) for x in _ATTACKS[kind]]), (F.floor(F.col("flow_id") / 23) % 2 + 1).cast("int"))
    bad, talk = F.col("flow_id") % 23 == 3, F.col("flow_id") % 23 == 11
    requests = view(spark, d, "v_http").withColumn("label", bad.cast("double"))
    return requests.withColumn("uri", F.concat("uri", F.when(F.contains("uri", F.lit("?")), "").otherwise("?a=1"), F.when(bad, some).when(talk, F.lit(_INNOCENT[kind])).otherwise("")))


def _injections(spark, d, words, kind):
    """A text classifier learned from requests with planted attacks, saved, loaded and applied to the requests held back."""
    requests = planted_requests(spark, d, kind)
    old = requests.where("flow_id % 10 < 7")
    texts = web.injection_texts(old, words).join(old.select("flow_id", "label"), "flow_id")
    model = _kept(spark, models.text_classifier(written(texts.select("text", "label"), "request-texts")), f"{kind}-texts")
    return web.injections(requests.where("flow_id % 10 >= 7"), words, model)


@query("dt11_sql_injections")
def dt11_detected(spark, d):
    return _injections(spark, d, S.SQL_WORDS, "sql")


@query("dt12_script_injections")
def dt12_detected(spark, d):
    return _injections(spark, d, S.SCRIPT_WORDS, "script")


_LAST = "l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ip, modeltype ORDER BY sec DESC, id DESC) AS k FROM v_evt) WHERE k = 1 AND NOT (modeltype = 'view' AND value >= 20))"
_FUSED = "f AS (SELECT ip, " + ", ".join(f"CAST(max(CASE WHEN modeltype = '{k}' THEN 1 ELSE 0 END) AS INTEGER) AS {k}" for k in KINDS) + ", string_agg(concat(modeltype, ':', CAST(id AS VARCHAR)), '#' ORDER BY concat(modeltype, ':', CAST(id AS VARCHAR))) AS evidence, min(sec) AS first_at, max(sec) AS last_at FROM l GROUP BY ip)"


def _fused(spark, d):
    return hosts.fused_indicators(view(spark, d, "v_evt"), list(KINDS), {"view": "value < 20"})


@query("dt13_fused_indicators", f"WITH {_LAST}, {_FUSED} SELECT * FROM f", ("v_evt",))
def dt13(spark, d):
    return _fused(spark, d)


@query("dt14_compromise_scores", f"""
    WITH {_LAST}, {_FUSED}, p(a, b, c, e, g, s) AS (VALUES (1, 1, 1, 1, 1, 65.0::DOUBLE), (1, 0, 1, 1, 1, 92.0)),
         q AS (SELECT f.*, s, coalesce(s, floor((click * 0.1 + "view" * 0.15 + purchase * 0.2 + signup * 0.25 + error * 0.3) * 100 + 1e-9)) AS raw FROM f LEFT JOIN p ON click = a AND "view" = b AND purchase = c AND signup = e AND error = g),
         z AS (SELECT *, CASE WHEN signup = 1 AND raw < 60 THEN 60.0 ELSE raw END AS score FROM q)
    SELECT ip, click, "view", purchase, signup, error, CAST(score AS DOUBLE) AS score, CASE WHEN s IS NOT NULL THEN 1 ELSE 2 END AS score_type, CASE WHEN score >= 80 THEN 'high' WHEN score >= 70 THEN 'medium' WHEN score >= 60 THEN 'low' ELSE 'none' END AS level FROM z WHERE score > 30""", ("v_evt",))
def dt14(spark, d):
    patterns = spark.createDataFrame([(1, 1, 1, 1, 1, 65.0), (1, 0, 1, 1, 1, 92.0)], ", ".join(f"{k} int" for k in KINDS) + ", pattern_score double")
    return hosts.compromise_scores(_fused(spark, d), dict(zip(KINDS, (0.1, 0.15, 0.2, 0.25, 0.3), strict=True)), patterns, threat="signup", cut_off=30)


@query("dt15_dns_bots", """
    WITH c AS (SELECT DISTINCT srcip, substr(srcip, 6, 1) AS cluster FROM v_dns), z AS (SELECT cluster, count(*) AS hosts FROM c GROUP BY cluster HAVING count(*) >= 3),
         d AS (SELECT cluster, queries_name, count(*) AS n FROM (SELECT DISTINCT srcip, queries_name FROM v_dns) JOIN c USING (srcip) GROUP BY ALL), s AS (SELECT cluster, queries_name, n / hosts AS share FROM d JOIN z USING (cluster)),
         p AS (SELECT DISTINCT srcip, queries_name, dd AS slot FROM v_dns), f AS (SELECT srcip, queries_name, CASE WHEN lead(slot) OVER (PARTITION BY srcip, queries_name ORDER BY slot) = slot + 1 THEN 1 ELSE 0 END AS pair FROM p),
         a AS (SELECT srcip, queries_name, round(sum(pair) / count(*), 6) AS ak FROM f GROUP BY ALL), h AS (SELECT cluster, srcip, queries_name, round(0.6 * share + 0.4 * ak, 6) AS score FROM a JOIN c USING (srcip) JOIN s USING (cluster, queries_name))
    SELECT cluster, srcip, queries_name, score, count(*) OVER (PARTITION BY cluster) AS pairs FROM h WHERE score >= 0.1 QUALIFY count(*) OVER (PARTITION BY cluster) > 3""", ("v_dns",))
def dt15(spark, d):
    records = view(spark, d, "v_dns")
    clusters = records.select("srcip", F.substring("srcip", 6, 1).alias("cluster")).distinct()
    return botnets.dns_bots(records, clusters, "dd", 0.6, 0.4, 0.1, 3)


@query("dt15_clustered_bots")
def dt15_clustered(spark, d):
    """The same with clusters from k-means over the hosts' counts of names."""
    records = view(spark, d, "v_dns")
    vectors = written(models.count_vectors(records, "srcip", "queries_name"), "host-vectors")
    return botnets.dns_bots(records, written(models.clusters(vectors, "srcip"), "clusters"), "dd", 0.6, 0.4, 0.1, 3)


@query("dt16_bot_networks", f"""
    WITH RECURSIVE {_VISITS.replace('FROM v_dns)', 'FROM v_dns WHERE queries_name IN (SELECT queries_name FROM v_dns WHERE page_id % 10 = 0))', 1)}, e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), r AS (SELECT a AS node, a AS seen FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen),
         m AS (SELECT node AS srcip, min(seen) AS subnet FROM r GROUP BY node), q AS (SELECT srcip, round(avg(f), 6) AS failure_rate FROM (SELECT DISTINCT srcip, queries_name, CASE WHEN flags_reply_code = 3 THEN 1.0 ELSE 0.0 END AS f FROM v_dns) GROUP BY srcip),
         t AS (SELECT subnet, queries_name, row_number() OVER (PARTITION BY subnet ORDER BY count(*) DESC, queries_name) AS k FROM x JOIN m USING (srcip) GROUP BY subnet, queries_name)
    SELECT g.subnet, hosts, mean_failures, bots, round(bots / hosts, 6) AS bot_rate, domains FROM (SELECT subnet, count(*) AS hosts, round(avg(failure_rate), 6) AS mean_failures, count(*) FILTER (failure_rate >= 0.2) AS bots FROM m JOIN q USING (srcip) GROUP BY subnet) g JOIN (SELECT subnet, array_to_string(list_sort(list(queries_name)), '#') AS domains FROM t WHERE k <= 10 GROUP BY subnet) USING (subnet)""", ("v_dns",))
def dt16(spark, d):
    records = view(spark, d, "v_dns")
    return botnets.bot_networks(records, records.where("page_id % 10 = 0"), 0.6, failing=0.2)


_BEATS = f"""{_GAPS}, x AS (SELECT srcip, protocol, list(CAST(gap AS DOUBLE) ORDER BY k) AS x FROM g WHERE n >= 4 AND gap IS NOT NULL GROUP BY ALL),
         j AS (SELECT srcip, coalesce(list_sum(list_transform(range(1, CAST(ceil(len(x) / j) AS BIGINT)), lambda i: x[i * j + 1] * x[(i - 1) * j + 1])), 0) / nullif(list_sum(list_transform(x, lambda v: v * v)), 0) AS s FROM x, unnest(range(1, greatest(len(x), 2))) u(j)), beating AS (SELECT DISTINCT srcip FROM j WHERE round(s, 6) > 0.4)"""


@query("dt17_netflow_bots", f"""
    WITH {_BEATS}, b AS (SELECT n.*, floor(n.size / 40) * 40 AS answer_length, f.upbytesize + f.downbytesize AS bytes FROM v_dns n JOIN v_flow_ts f ON f.flow_id = n.flow_id AND f.srcip = n.srcip AND f.srcport = n.srcport AND f.dstport = n.dstport
                         WHERE n.queries_name IN (SELECT queries_name FROM v_dns WHERE page_id % 2 = 0) AND f.protocol IN ('tcp', 'udp') AND f.upbytesize + f.downbytesize < 20000 AND n.srcip IN (SELECT srcip FROM beating)),
         s AS (SELECT queries_name, min(sec) AS lo, max(sec) AS hi FROM b GROUP BY queries_name HAVING max(sec) - min(sec) >= 3 * 172800), p AS (SELECT queries_name, CASE WHEN sec < lo + 172800 THEN 0 WHEN sec > hi - 172800 THEN 2 WHEN abs(sec - (lo + hi) / 2) <= 86400 THEN 1 END AS part FROM b JOIN s USING (queries_name)),
         k AS (SELECT b.* FROM b WHERE queries_name IN (SELECT queries_name FROM p GROUP BY queries_name HAVING count(DISTINCT part) = 3)), o AS (SELECT queries_name, answer_length, row_number() OVER (PARTITION BY queries_name ORDER BY count(*) DESC, answer_length) AS r FROM k GROUP BY queries_name, answer_length),
         a AS (SELECT k.* FROM k JOIN o ON o.queries_name = k.queries_name AND o.answer_length = k.answer_length AND r = 1), h AS (SELECT queries_name, count(DISTINCT srcip) AS hosts FROM a GROUP BY queries_name HAVING count(DISTINCT srcip) >= 3),
         z AS (SELECT a.queries_name, a.srcip, CAST(answer_length AS BIGINT) AS answer_length, hosts, CASE WHEN a.srcip IN (SELECT ip FROM v_asset WHERE status = 2) THEN 1 ELSE 0 END AS compromised, CAST(sum(bytes) AS BIGINT) AS bytes, count(*) AS records FROM a JOIN h ON h.queries_name = a.queries_name GROUP BY ALL)
    SELECT z.*, round(sum(compromised * records) OVER () / sum(records) OVER (), 6) AS bot_probability FROM z""", ("v_dns", "v_flow_ts", "v_asset"))
def dt17(spark, d):
    records, flow = view(spark, d, "v_dns"), view(spark, d, "v_flow_ts")
    named = records.withColumn("answer_length", F.floor(F.col("size") / 40) * 40)
    beating = Q.periodicity(flow, ["srcip", "protocol"], "sec", "flow_id").where("score > 0.4").select("srcip")
    return botnets.netflow_bots(named, flow, records.where("page_id % 2 = 0"), beating, view(spark, d, "v_asset").where("status = 2"), 20_000, 172_800)


@query("dt18_idle_assets", "SELECT ip, status FROM v_asset WHERE ip NOT IN (SELECT srcip FROM v_flow_ts WHERE dd > 28 GROUP BY srcip, dd, hh HAVING sum(upbytesize) >= 2000)", ASSET)
def dt18(spark, d):
    recent = view(spark, d, "v_flow_ts").where("dd > 28").groupBy(F.col("srcip").alias("ip"), "dd", "hh").agg(F.sum("upbytesize").alias("bytes"))
    return flows.idle_assets(view(spark, d, "v_asset"), recent, 2000)


@query("dt19_retired_assets", "WITH l AS (SELECT srcip AS ip, CAST(max(dt) AS DATE) AS day FROM v_flow_ts GROUP BY srcip) SELECT ip, CAST(date_diff('day', day, DATE '2024-01-31') AS INTEGER) AS gap_days, 5 AS flag FROM l WHERE date_diff('day', day, DATE '2024-01-31') >= 2", FLOW)
def dt19(spark, d):
    last = view(spark, d, "v_flow_ts").groupBy(F.col("srcip").alias("ip")).agg(F.max("dt").alias("day"))
    return flows.retired_assets(last, F.lit("2024-01-31").cast("date"), 2).select("ip", "gap_days", "flag")


@query("dt20_changed_assets", "SELECT ip, count(DISTINCT modeltype) AS kinds FROM v_evt WHERE dd > 28 GROUP BY ip HAVING count(DISTINCT modeltype) > 2", ("v_evt",))
def dt20(spark, d):
    return flows.changed_assets(view(spark, d, "v_evt").where("dd > 28"), 2)


@query("dt21_recovered_slots", f"WITH {_VOLUME} SELECT segment, dd, hh, CASE WHEN hh % 4 = 0 AND dd % 2 = 1 THEN NULL ELSE bytes END AS bytes FROM v", FLOW)
def dt21(spark, d):
    base = volumes(spark, d)
    masked = base.withColumn("bytes", F.when(F.col("hh") % 4 != 0, F.col("bytes")))
    lost = base.where("hh % 4 = 0 AND dd % 2 = 0").groupBy("segment", "dd").agg(F.array_sort(F.collect_list(F.struct("hh", "bytes"))).alias("s"))
    rejected = lost.select("segment", "dd", F.transform("s", lambda x: x["hh"]).alias("slots"), F.transform("s", lambda x: x["bytes"]).alias("values"))
    return flows.recovered_slots(masked, rejected, ["segment", "dd", "hh"])


@query("dt21_recovered_ratios", f"""
    WITH r AS (SELECT flow_id, srcip AS ip, dd, {_PERIOD} AS period, {_RATIO} AS ratio FROM v_flow_ts), b AS (SELECT ip, period, max(ratio) AS max_ratio FROM r WHERE dd <= 20 GROUP BY ip, period),
         w AS (SELECT r.ip, r.period, max(ratio) AS ratio FROM r JOIN b ON b.ip = r.ip AND b.period = r.period WHERE dd > 20 AND ratio > max_ratio AND flow_id % 3 = 0 GROUP BY ALL)
    SELECT b.ip, b.period, round(greatest(max_ratio, coalesce(ratio, 0)), 6) AS max_ratio FROM b LEFT JOIN w ON w.ip = b.ip AND w.period = b.period""", FLOW)
def dt21_ratios(spark, d):
    """Ratio events that an analyst rejected raise the baseline that had reported them."""
    old, new = _old_new(spark, d)
    base = flows.ratio_baseline(old)
    rejected = flows.ratio_anomalies(new, base).where("flow_id % 3 = 0").select("ip", "period", "ratio")
    return flows.raised_ratios(base, rejected).withColumn("max_ratio", F.round("max_ratio", 6))


_CLASS = "CASE WHEN regexp_matches(ch, '[A-Z]') THEN 'U' WHEN regexp_matches(ch, '[a-z]') THEN 'D' WHEN regexp_matches(ch, '[0-9]') THEN 'N' WHEN unicode(ch) BETWEEN 33 AND 126 THEN 'P' ELSE '#' END"
_PAIRS = rf"""q AS (SELECT *, string_split(uri, '?')[1] AS path FROM v_http), w AS (SELECT path, flow_id, dd, unnest(string_split(regexp_extract(uri, '[?](.*)$', 1), '&')) AS pair FROM q),
         v AS (SELECT path, flow_id, dd, pair, string_split(pair, '=')[1] AS param, regexp_extract(pair, '=(.*)$', 1) AS value FROM w WHERE contains(pair, '=') AND regexp_extract(pair, '=(.*)$', 1) <> ''),
         u AS (SELECT path, count(DISTINCT flow_id) AS n FROM q WHERE dd <= 20 GROUP BY path HAVING count(DISTINCT srcip) >= 3), o AS (SELECT v.* FROM v JOIN u USING (path) WHERE dd <= 20),
         f AS (SELECT path, pair FROM o JOIN u USING (path) GROUP BY path, pair HAVING count(DISTINCT flow_id) = any_value(n)), m AS (SELECT u.path, u.path || '?' || coalesce(string_agg(pair, '&' ORDER BY pair), '') AS function FROM u LEFT JOIN f USING (path) GROUP BY u.path),
         r AS (SELECT o.* FROM o ANTI JOIN f USING (path, pair)), k AS (SELECT DISTINCT path, param, {_CLASS} AS class FROM (SELECT path, param, unnest(string_split(value, '')) AS ch FROM r)),
         b AS (SELECT path, param, min(length(value)) AS low, max(length(value)) AS high FROM r GROUP BY path, param)"""


@query("dt22_parameter_baseline", f"WITH {_PAIRS} SELECT path, function, param, CAST(low AS INTEGER) AS low, CAST(high AS INTEGER) AS high, classes FROM b JOIN m USING (path) JOIN (SELECT path, param, array_to_string(list_sort(list(class)), ',') AS classes FROM k GROUP BY ALL) USING (path, param)", ("v_http",))
def dt22(spark, d):
    return web.parameter_baseline(view(spark, d, "v_http").where("dd <= 20"))


@query("dt22_functions", f"WITH {_PAIRS} SELECT path, function FROM m", ("v_http",))
def dt22_functions(spark, d):
    return web.functions(view(spark, d, "v_http").where("dd <= 20")).select("path", "function")


@query("dt23_parameter_anomalies", f"""
    WITH {_PAIRS}, n AS (SELECT * FROM v WHERE dd > 20), c AS (SELECT n.*, low, high FROM n ANTI JOIN f ON f.path = n.path AND f.pair = n.pair JOIN b USING (path, param)),
         z AS (SELECT DISTINCT path, param, flow_id, value, {_CLASS} AS class FROM (SELECT *, unnest(string_split(value, '')) AS ch FROM c)),
         odd AS (SELECT DISTINCT path, param, flow_id, value FROM z WHERE (path, param, class) NOT IN (SELECT path, param, class FROM k))
    SELECT path, param, flow_id, value FROM c WHERE NOT length(value) BETWEEN low AND high OR (path, param, flow_id, value) IN (SELECT path, param, flow_id, value FROM odd)""", ("v_http",))
def dt23(spark, d):
    old, new = _old_new(spark, d, "v_http")
    return web.parameter_anomalies(new, web.parameter_baseline(old))


_RESP = "r AS (SELECT *, string_split(uri, '?')[1] AS path, CAST(response_date - request_date AS DOUBLE) AS seconds FROM v_http), b AS (SELECT path, " + ", ".join(f"CASE WHEN count(*) = 1 THEN 3 * max({c}) ELSE avg({c}) + 3 * stddev_pop({c}) END AS {n}" for c, n in (("seconds", "time_limit"), ("content_length", "size_limit"))) + " FROM r WHERE dd <= 20 GROUP BY path)"


@query("dt24_response_baseline", f"WITH {_RESP} SELECT path, round(time_limit, 4) AS time_limit, round(size_limit, 4) AS size_limit FROM b", ("v_http",))
def dt24(spark, d):
    return web.response_baseline(view(spark, d, "v_http").where("dd <= 20")).select("path", F.round("time_limit", 4).alias("time_limit"), F.round("size_limit", 4).alias("size_limit"))


@query("dt24_response_labels", f"WITH {_RESP} SELECT flow_id, r.path, CASE WHEN seconds > time_limit OR content_length > size_limit THEN 'abnormal' ELSE 'normal' END AS label FROM r JOIN b ON b.path = r.path WHERE dd > 20", ("v_http",))
def dt24_labels(spark, d):
    old, new = _old_new(spark, d, "v_http")
    return web.response_labels(new, web.response_baseline(old))


_TOPICS = "t AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^a-z]+')) AS word FROM documents), w AS (SELECT * FROM t WHERE length(word) > 2), o AS (SELECT word, CAST(length(word) % 3 AS INTEGER) AS topic, 0.75::DOUBLE AS p FROM (SELECT DISTINCT word FROM w) UNION ALL SELECT word, CAST((length(word) + 1) % 3 AS INTEGER), 0.25 FROM (SELECT DISTINCT word FROM w))"


@query("dt25_topic_tags", f"""
    WITH {_TOPICS}, n AS (SELECT doc_id, count(*) AS n FROM w GROUP BY doc_id), p AS (SELECT doc_id, topic, word, sum(p) AS part FROM w JOIN o USING (word) GROUP BY ALL), m AS (SELECT doc_id, topic, sum(part) / any_value(n) AS share FROM p JOIN n USING (doc_id) GROUP BY ALL),
         b AS (SELECT doc_id, topic, word, row_number() OVER (PARTITION BY doc_id, topic ORDER BY round(part, 9) DESC, word) AS k FROM p)
    SELECT doc_id, topic, round(share, 6) AS share, words FROM m JOIN (SELECT doc_id, topic, string_agg(word, ',' ORDER BY k) AS words FROM b WHERE k <= 3 GROUP BY ALL) USING (doc_id, topic) WHERE share > 0.3""")
def dt25(spark, d):
    docs = table(spark, d, "documents")
    counts = leak.word_counts(leak.word_tokens(docs))
    topic = lambda k, p: counts.select("word", ((F.length("word") + k) % 3).alias("topic"), F.lit(p).alias("p"))
    return leak.topic_tags(docs, topic(0, 0.75).unionByName(topic(1, 0.25)), counts)


_ENDS = "d AS (SELECT *, doc_id % 10 AS dd FROM v_doc), x AS (SELECT doc_id, owner AS user, tag, dd, hh, bytes FROM d UNION ALL SELECT doc_id, peer, tag, dd, hh, bytes FROM d WHERE peer <> owner AND starts_with(peer, '10.'))"


@query("dt26_leak_alerts", f"""
    WITH {_ENDS}, h AS (SELECT * FROM x WHERE dd < 8), t AS (SELECT user, tag, count(*) AS n FROM h GROUP BY ALL), o AS (SELECT user, count(*) AS n FROM h GROUP BY ALL),
         m AS (SELECT user, tag, hh, max(total) AS most FROM (SELECT user, tag, dd, hh, sum(bytes) AS total FROM h GROUP BY ALL) GROUP BY ALL), r AS (SELECT * FROM x WHERE dd >= 8)
    SELECT r.user, r.tag, r.dd, r.hh, CAST(r.bytes AS BIGINT) AS bytes, r.doc_id, 'rare tag' AS reason FROM r LEFT JOIN t ON t.user = r.user AND t.tag = r.tag LEFT JOIN o ON o.user = r.user WHERE t.n IS NULL OR t.n / o.n <= 0.05
    UNION ALL SELECT user, tag, dd, hh, CAST(sum(bytes) AS BIGINT), min(doc_id), 'volume' FROM r JOIN m USING (user, tag, hh) GROUP BY user, tag, dd, hh HAVING sum(bytes) > any_value(most)""", ("v_doc",))
def dt26(spark, d):
    ends = leak.inner_ends(view(spark, d, "v_doc").withColumn("dd", F.col("doc_id") % 10))
    return leak.leak_alerts(ends.where("dd >= 8"), leak.user_baseline(ends.where("dd < 8")), 0.05)


@query("dt27_fingerprints", r"WITH f AS (SELECT doc_id, md5(regexp_replace(lower(coalesce(text, '')), '\s+', '', 'g')) AS fingerprint FROM documents) SELECT doc_id, fingerprint, count(*) OVER (PARTITION BY fingerprint) AS copies, min(doc_id) OVER (PARTITION BY fingerprint) AS first_id FROM f")
def dt27(spark, d):
    return leak.fingerprints(table(spark, d, "documents"))
