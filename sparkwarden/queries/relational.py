"""Projections, joins, aggregations, sorting and set operations over the log views."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwarden.adapters import view
from sparkwarden.functions.strings import query_pairs, request_path
from sparkwarden.operators import aggregates as A
from sparkwarden.operators import enrich as E
from sparkwarden.operators import merge as M
from sparkwarden.operators import sets as S
from sparkwarden.queries import query, table

FLOW, ASSET = ("v_flow_ts",), ("v_flow_ts", "v_asset")


# Projection, filter, enrichment


@query("prj1_projection", "SELECT flow_id, srcip, dstip, dstport, protocol FROM v_flow", ("v_flow",))
def prj1(spark, d):
    return view(spark, d, "v_flow").select("flow_id", "srcip", "dstip", "dstport", "protocol")


@query("prj2_direction_flag", """
    SELECT flow_id, srcip, dstip, CASE WHEN s.ip IS NOT NULL THEN 1 ELSE 2 END AS flag_ip
    FROM v_flow_ts LEFT JOIN (SELECT ip FROM v_asset WHERE status <> 2) s ON s.ip = srcip LEFT JOIN (SELECT ip FROM v_asset WHERE status <> 2) t ON t.ip = dstip
    WHERE s.ip IS NOT NULL OR t.ip IS NOT NULL""", ASSET)
def prj2(spark, d):
    return E.flag_direction(view(spark, d, "v_flow_ts"), view(spark, d, "v_asset").where("status <> 2")).select("flow_id", "srcip", "dstip", "flag_ip")


@query("prj3_day_period", """
    SELECT flow_id, CASE WHEN hh >= 9 AND hh < 12 THEN 'morning' WHEN hh >= 12 AND hh < 14 THEN 'noon' WHEN hh >= 14 AND hh < 18 THEN 'afternoon' WHEN hh >= 18 THEN 'evening' ELSE 'night' END AS period,
           round(upbytesize / 1024.0, 6) AS up_kb FROM v_flow_ts""", FLOW)
def prj3(spark, d):
    return view(spark, d, "v_flow_ts").select("flow_id", E.day_period(F.col("hh")).alias("period"), F.round(F.col("upbytesize") / 1024.0, 6).alias("up_kb"))


@query("prj4_display_bucket", "SELECT flow_id, concat(CAST(dt AS VARCHAR), ' ', CAST(CAST(floor(hh / 4) * 4 AS BIGINT) AS VARCHAR)) AS bucket FROM v_flow_ts", FLOW)
def prj4(spark, d):
    return view(spark, d, "v_flow_ts").select("flow_id", E.display_bucket(F.col("dt"), F.col("hh")).alias("bucket"))


@query("prj5_window_label", """
    WITH s AS (SELECT flow_id, CAST(floor((hh * 3600 + mi * 60) / 300) * 300 AS BIGINT) AS e FROM v_flow_ts), t AS (SELECT flow_id, (e + 86100) % 86400 AS a, e % 86400 AS b FROM s)
    SELECT flow_id, concat(lpad(CAST(a // 3600 AS VARCHAR), 2, '0'), ':', lpad(CAST(a % 3600 // 60 AS VARCHAR), 2, '0'), '-', lpad(CAST(b // 3600 AS VARCHAR), 2, '0'), ':', lpad(CAST(b % 3600 // 60 AS VARCHAR), 2, '0')) AS label FROM t""", FLOW)
def prj5(spark, d):
    return view(spark, d, "v_flow_ts").select("flow_id", E.window_label(F.col("hh") * 3600 + F.col("mi") * 60).alias("label"))


@query("prj6_ten_minute_slot", "SELECT flow_id, concat(lpad(CAST(hh AS VARCHAR), 2, '0'), ':', CAST(mi // 10 AS VARCHAR), '0') AS slot FROM v_flow_ts", FLOW)
def prj6(spark, d):
    return view(spark, d, "v_flow_ts").select("flow_id", E.ten_minute_slot(F.col("hh"), F.col("mi")).alias("slot"))


@query("prj7_trace", "SELECT flow_id, concat_ws('#', srcip, CAST(srcport AS VARCHAR), dstip, CAST(dstport AS VARCHAR), coalesce(protocol, '')) AS trace FROM v_flow_ts", FLOW)
def prj7(spark, d):
    return view(spark, d, "v_flow_ts").select("flow_id", E.trace("srcip", "srcport", "dstip", "dstport", "protocol").alias("trace"))


@query("prj8_encrypted", "SELECT flow_id, CASE WHEN lower(proto7) = 'tls' THEN 'encrypted' ELSE 'plain' END AS encrypted FROM v_flow", ("v_flow",))
def prj8(spark, d):
    return view(spark, d, "v_flow").select("flow_id", E.encrypted_label(F.col("proto7")).alias("encrypted"))


@query("prj9_well_known_ports", "SELECT flow_id, dstport, protocol FROM v_flow_ts WHERE dstport <= srcport AND dstport < 1024 AND dstport NOT IN (22, 23, 80, 81, 139, 443) AND protocol IN ('tcp', 'udp')", FLOW)
def prj9(spark, d):
    return view(spark, d, "v_flow_ts").where(E.well_known_port(F.col("srcport"), F.col("dstport"), F.col("protocol"))).select("flow_id", "dstport", "protocol")


@query("prj10_segments", "SELECT flow_id, srcip FROM v_flow_ts WHERE regexp_extract(srcip, '^([0-9]+[.][0-9]+[.][0-9]+)', 1) IN ('10.0.1', '10.0.3')", FLOW)
def prj10(spark, d):
    return E.in_segments(view(spark, d, "v_flow_ts"), spark.createDataFrame([("10.0.1",), ("10.0.3",)], "segment string")).select("flow_id", "srcip")


@query("prj11_private", "SELECT flow_id, srcip LIKE '172.%' OR srcip LIKE '10.%' AS src_private, dstip LIKE '172.%' OR dstip LIKE '10.%' AS dst_private FROM v_flow_ts", FLOW)
def prj11(spark, d):
    return view(spark, d, "v_flow_ts").select("flow_id", E.private_address(F.col("srcip")).alias("src_private"), E.private_address(F.col("dstip")).alias("dst_private"))


@query("prj12_outbound_bulk", "SELECT flow_id, upbytesize FROM v_flow WHERE srcport > 1024 AND dstport < 1024 AND upbytesize > 30000", ("v_flow",))
def prj12(spark, d):
    return view(spark, d, "v_flow").where(E.outbound_bulk(F.col("srcport"), F.col("dstport"), F.col("upbytesize"), 30_000)).select("flow_id", "upbytesize")


@query("prj13_evidence", """
    SELECT flow_id, concat('host ', srcip, ' sent ', CAST(upbytesize AS VARCHAR), ' bytes to ', dstip, ':', CAST(dstport AS VARCHAR)) AS evidence,
           concat('{"srcip":"', srcip, '","dstport":', CAST(dstport AS VARCHAR), ',"bytes":', CAST(upbytesize AS VARCHAR), '}') AS original FROM v_flow_ts""", FLOW)
def prj13(spark, d):
    return view(spark, d, "v_flow_ts").select("flow_id", F.format_string("host %s sent %d bytes to %s:%d", "srcip", "upbytesize", "dstip", "dstport").alias("evidence"), F.to_json(F.struct("srcip", "dstport", F.col("upbytesize").alias("bytes"))).alias("original"))


@query("prj14_null_defaults", """
    WITH x AS (SELECT flow_id, CASE WHEN flow_id % 3 = 0 THEN NULL ELSE uppkts END AS uppkts, CASE WHEN flow_id % 4 = 0 THEN NULL ELSE protocol END AS protocol, CASE WHEN flow_id % 10 = 0 THEN NULL ELSE srcip END AS srcip FROM v_flow_ts)
    SELECT flow_id, coalesce(uppkts, 7) AS uppkts, coalesce(protocol, 'unknown') AS protocol, srcip FROM x WHERE srcip IS NOT NULL""", FLOW)
def prj14(spark, d):
    holes = view(spark, d, "v_flow_ts").selectExpr("flow_id", "IF(flow_id % 3 = 0, NULL, uppkts) AS uppkts", "IF(flow_id % 4 = 0, NULL, protocol) AS protocol", "IF(flow_id % 10 = 0, NULL, srcip) AS srcip")
    return E.fill_from_defaults(holes.dropna(subset=["srcip"]), spark.createDataFrame([(7, "unknown")], "uppkts long, protocol string"))


@query("prj15_content_filter", "SELECT flow_id, host, uri FROM v_http WHERE (content_type LIKE '%html%' OR content_type LIKE '%json%' OR content_type LIKE '%form%') AND host LIKE '%example.org'", ("v_http",))
def prj15(spark, d):
    kind = F.col("content_type")
    return view(spark, d, "v_http").where((kind.contains("html") | kind.contains("json") | kind.contains("form")) & F.col("host").endswith("example.org")).select("flow_id", "host", "uri")


@query("prj16_unpack", """
    WITH x AS (SELECT flow_id, string_split(concat_ws('#', srcip, dstip, CAST(dstport AS VARCHAR)), '#') AS p FROM v_flow_ts)
    SELECT flow_id, p[1] AS source, p[2] AS target, p[3] AS port, p[4] AS missing FROM x""", FLOW)
def prj16(spark, d):
    packed = view(spark, d, "v_flow_ts").select("flow_id", F.concat_ws("#", "srcip", "dstip", "dstport").alias("packed"))
    return E.unpack(packed, "packed", ["source", "target", "port", "missing"]).drop("packed")


@query("prj17_file_record", "SELECT flow_id, sec, srcip, dstip, CAST(srcport AS INTEGER) AS srcport, CAST(dstport AS INTEGER) AS dstport, 'doc' AS kind, protocol, upbytesize AS size FROM v_flow_ts", FLOW)
def prj17(spark, d):
    named = view(spark, d, "v_flow_ts").select("flow_id", F.concat_ws("_", "sec", "srcip", "dstip", "srcport", "dstport", F.lit("doc"), "protocol", "upbytesize").alias("name"))
    return named.select("flow_id", *(c.alias(k) for k, c in E.file_record(F.col("name")).items()))


# Joins


def _period(hh="hh"):
    return E.day_period(F.col(hh))


@query("jn1_baseline_inner", """
    WITH b AS (SELECT srcip, hh, max(upbytesize) AS top FROM v_flow_ts WHERE dd <= 20 GROUP BY srcip, hh)
    SELECT flow_id, f.srcip, f.hh, upbytesize, top FROM v_flow_ts f JOIN b ON b.srcip = f.srcip AND b.hh = f.hh WHERE dd > 20""", FLOW)
def jn1(spark, d):
    flows = view(spark, d, "v_flow_ts")
    base = flows.where("dd <= 20").groupBy("srcip", "hh").agg(F.max("upbytesize").alias("top"))
    return flows.where("dd > 20").join(base, ["srcip", "hh"]).select("flow_id", "srcip", "hh", "upbytesize", "top")


@query("jn2_left_enrichment", "SELECT flow_id, dstip, a.status FROM v_flow_ts LEFT JOIN v_asset a ON a.ip = dstip AND a.status = 2", ASSET)
def jn2(spark, d):
    retired = view(spark, d, "v_asset").where("status = 2").select(F.col("ip").alias("dstip"), "status")
    return view(spark, d, "v_flow_ts").join(E.bounded(retired), "dstip", "left").select("flow_id", "dstip", "status")


@query("jn3_right_as_inner", "SELECT a.ip, a.status, count(*) AS n FROM v_flow_ts RIGHT JOIN v_asset a ON a.ip = srcip WHERE srcip IS NOT NULL GROUP BY a.ip, a.status", ASSET)
def jn3(spark, d):
    assets = view(spark, d, "v_asset")
    per_host = view(spark, d, "v_flow_ts").groupBy(F.col("srcip").alias("ip")).agg(F.count(F.lit(1)).alias("n"))
    return per_host.join(assets, "ip").select("ip", "status", "n")


@query("jn4_observed_or_baseline", """
    WITH b AS (SELECT dstip, dstport, count(*) AS before FROM v_flow_ts WHERE dd <= 20 GROUP BY ALL), o AS (SELECT dstip, dstport, count(*) AS now FROM v_flow_ts WHERE dd > 20 GROUP BY ALL)
    SELECT coalesce(b.dstip, o.dstip) AS dstip, coalesce(b.dstport, o.dstport) AS dstport, before, now FROM b FULL JOIN o ON b.dstip = o.dstip AND b.dstport = o.dstport""", FLOW)
def jn4(spark, d):
    flows = view(spark, d, "v_flow_ts")
    count = lambda where, n: flows.where(where).groupBy("dstip", "dstport").agg(F.count(F.lit(1)).alias(n))
    return count("dd <= 20", "before").join(count("dd > 20", "now"), ["dstip", "dstport"], "full")


KINDS = ("click", "view", "purchase", "signup", "error")


#: Hosts by the day: the entity of the indicator queries, since few hosts lack a kind of event over all days.
_HOST_DAYS = "h AS (SELECT concat(ip, '/', CAST(dd AS STRING)) AS ip, modeltype, id, value, dd FROM v_evt)"
_FLAGS = ", ".join(f"CAST(max(CASE WHEN modeltype = '{k}' THEN 1 ELSE 0 END) AS INTEGER) AS {k}" for k in KINDS)


def host_days(spark, d):
    return view(spark, d, "v_evt").withColumn("ip", F.concat("ip", F.lit("/"), F.col("dd").cast("string")))


def _vectors(spark, d, where="true"):
    events = host_days(spark, d).where(where)
    return M.merge_indicators({k: events.where(F.col("modeltype") == k) for k in KINDS})


@query("jn5_merge_indicators", f"WITH {_HOST_DAYS} SELECT ip, {_FLAGS} FROM h GROUP BY ip", ("v_evt",))
def jn5(spark, d):
    return _vectors(spark, d)


@query("jn6_either_end", "SELECT flow_id, ip FROM v_flow_ts JOIN (SELECT ip FROM v_asset WHERE status = 2) a ON a.ip = srcip OR a.ip = dstip", ASSET)
def jn6(spark, d):
    return M.events_of_hosts(view(spark, d, "v_flow_ts"), view(spark, d, "v_asset").where("status = 2")).select("flow_id", "ip")


@query("jn7_flow_identity", "SELECT f.flow_id, f.srcip, f.srcport, queries_name, f.upbytesize FROM v_flow_ts f JOIN v_dns n ON f.flow_id = n.flow_id AND f.srcip = n.srcip AND f.srcport = n.srcport AND f.dstport = n.dstport", ("v_flow_ts", "v_dns"))
def jn7(spark, d):
    keys = ["flow_id", "srcip", "srcport", "dstport"]
    return view(spark, d, "v_flow_ts").join(view(spark, d, "v_dns").select(*keys, "queries_name"), keys).select("flow_id", "srcip", "srcport", "queries_name", "upbytesize")


@query("jn8_pattern_join", f"""
    WITH {_HOST_DAYS}, v AS (SELECT ip, {_FLAGS} FROM h GROUP BY ip)
    SELECT v.*, p.score AS pattern_score FROM v LEFT JOIN (VALUES (1, 1, 0, 0, 0, 90.0), (1, 1, 1, 0, 0, 75.5), (1, 0, 0, 0, 1, 60.0)) AS p(a, b, c, e, f, score) ON click = a AND "view" = b AND purchase = c AND signup = e AND error = f""", ("v_evt",))
def jn8(spark, d):
    patterns = spark.createDataFrame([(1, 1, 0, 0, 0, 90.0), (1, 1, 1, 0, 0, 75.5), (1, 0, 0, 0, 1, 60.0)], ", ".join(f"{k} int" for k in KINDS) + ", pattern_score double")
    return M.with_pattern_scores(_vectors(spark, d), patterns, list(KINDS)).select("ip", *KINDS, "pattern_score")


@query("jn9_semi", "SELECT flow_id, queries_name FROM v_dns WHERE queries_name IN (SELECT host FROM v_page WHERE page_id % 10 = 0)", ("v_dns", "v_page"))
def jn9(spark, d):
    listed = view(spark, d, "v_page").where("page_id % 10 = 0").select(F.col("host").alias("queries_name")).distinct()
    return view(spark, d, "v_dns").join(E.bounded(listed), "queries_name", "left_semi").select("flow_id", "queries_name")


@query("jn10_anti", "SELECT flow_id, queries_name FROM v_dns WHERE queries_name NOT IN (SELECT host FROM v_page WHERE page_id % 10 = 1)", ("v_dns", "v_page"))
def jn10(spark, d):
    listed = view(spark, d, "v_page").where("page_id % 10 = 1").select(F.col("host").alias("queries_name")).distinct()
    return view(spark, d, "v_dns").join(E.bounded(listed), "queries_name", "left_anti").select("flow_id", "queries_name")


@query("jn11_membership", """
    SELECT flow_id, dstip, CAST((CASE WHEN dstip IN (SELECT dstip FROM v_flow_ts WHERE flow_id % 50 < 9) THEN 1 ELSE 0 END) + (CASE WHEN dstip IN (SELECT dstip FROM v_flow_ts WHERE flow_id % 50 BETWEEN 5 AND 20) THEN 2 ELSE 0 END) AS INTEGER) AS tag FROM v_flow_ts""", FLOW)
def jn11(spark, d):
    flows = view(spark, d, "v_flow_ts")
    return M.membership(flows, "dstip", flows.where("flow_id % 50 < 9").select("dstip"), flows.where("flow_id % 50 BETWEEN 5 AND 20").select("dstip")).select("flow_id", "dstip", "tag")


@query("jn12_feedback_whitelist", f"""
    WITH {_HOST_DAYS}, v AS (SELECT ip, {_FLAGS} FROM h WHERE dd > 15 GROUP BY ip), o AS (SELECT ip, {_FLAGS}, min(id) % 3 AS flag FROM h WHERE dd <= 15 GROUP BY ip),
         w AS (SELECT DISTINCT click, "view", purchase, signup, error FROM o WHERE flag <> 2)
    SELECT v.* FROM v SEMI JOIN w USING (click, "view", purchase, signup, error)""", ("v_evt",))
def jn12(spark, d):
    flag = host_days(spark, d).where("dd <= 15").groupBy("ip").agg((F.min("id") % 3).alias("flag"))
    return M.whitelisted_by_feedback(_vectors(spark, d, "dd > 15"), _vectors(spark, d, "dd <= 15").join(flag, "ip"), list(KINDS)).select("ip", *KINDS)


# Aggregations


@query("ag1_two_way_volume", """
    WITH e AS (SELECT srcip AS ip, protocol, dt, upbytesize AS n FROM v_flow UNION ALL SELECT dstip, protocol, dt, downbytesize FROM v_flow)
    SELECT ip, protocol, year(dt) AS yr, CAST(sum(n) AS BIGINT) AS bytes FROM e WHERE ip IN (SELECT srcip FROM v_flow WHERE flow_id % 4 = 1) GROUP BY ip, protocol, year(dt)""", ("v_flow",))
def ag1(spark, d):
    flows = view(spark, d, "v_flow")
    assets = flows.where("flow_id % 4 = 1").select(F.col("srcip").alias("ip")).distinct()
    return A.two_way_volume(flows.withColumn("yr", F.year("dt")), ["protocol", "yr"]).join(assets, "ip", "left_semi").select("ip", "protocol", "yr", "bytes")


_RATIO = "CASE WHEN downbytesize = 0 THEN CAST(upbytesize AS DOUBLE) ELSE CAST(upbytesize AS DOUBLE) / downbytesize END"
_PERIOD = "CASE WHEN hh >= 9 AND hh < 12 THEN 'morning' WHEN hh >= 12 AND hh < 14 THEN 'noon' WHEN hh >= 14 AND hh < 18 THEN 'afternoon' WHEN hh >= 18 THEN 'evening' ELSE 'night' END"


@query("ag2_max_ratio", f"SELECT srcip AS ip, {_PERIOD} AS period, round(max({_RATIO}), 6) AS max_ratio FROM v_flow_ts WHERE dd <= 20 GROUP BY 1, 2", FLOW)
def ag2(spark, d):
    from sparkwarden.plans.flows import ratio_baseline

    return ratio_baseline(view(spark, d, "v_flow_ts").where("dd <= 20")).select("ip", "period", F.round("max_ratio", 6).alias("max_ratio"))


@query("ag3_set_text", "SELECT dstip, array_to_string(list_sort(list(DISTINCT CAST(dstport AS VARCHAR))), '#') AS ports FROM v_flow GROUP BY dstip", ("v_flow",))
def ag3(spark, d):
    return view(spark, d, "v_flow").groupBy("dstip").agg(A.set_text(F.col("dstport").cast("string")).alias("ports"))


@query("ag4_first_ten", "SELECT srcip, array_to_string(list_sort(list(DISTINCT dstip))[1:10], '#') AS trace FROM v_flow GROUP BY srcip", ("v_flow",))
def ag4(spark, d):
    return A.first_texts(view(spark, d, "v_flow"), "srcip", "dstip", 10).withColumnRenamed("dstip", "trace")


@query("ag5_requests_responses", """
    SELECT srcip, count(*) FILTER (flags_response = 0) AS requests, count(*) FILTER (flags_response = 1) AS responses,
           CAST(coalesce(sum(size) FILTER (flags_response = 0), 0) AS BIGINT) AS request_bytes, CAST(coalesce(sum(size) FILTER (flags_response = 1), 0) AS BIGINT) AS response_bytes
    FROM v_dns GROUP BY srcip HAVING count(*) FILTER (flags_response = 0) > 0 AND count(*) FILTER (flags_response = 1) > 0""", ("v_dns",))
def ag5(spark, d):
    from sparkwarden.plans.dns import request_response_summary

    return request_response_summary(view(spark, d, "v_dns"))


@query("ag6_latest_row", "SELECT ip, modeltype, sec, id, round(value, 2) AS value FROM (SELECT *, row_number() OVER (PARTITION BY ip, modeltype ORDER BY sec DESC, id DESC) AS k FROM v_evt) WHERE k = 1", ("v_evt",))
def ag6(spark, d):
    events = view(spark, d, "v_evt").select("ip", "modeltype", "sec", "id", F.round("value", 2).alias("value"))
    return A.latest(events, ["ip", "modeltype"], "sec", "id")


@query("ag7_mode", "SELECT queries_name, size, n FROM (SELECT *, row_number() OVER (PARTITION BY queries_name ORDER BY n DESC, size) AS k FROM (SELECT queries_name, size, count(*) AS n FROM v_dns GROUP BY ALL)) WHERE k = 1", ("v_dns",))
def ag7(spark, d):
    return A.mode(view(spark, d, "v_dns"), ["queries_name"], "size")


@query("ag8_shared_domains", "SELECT queries_name, count(DISTINCT srcip) AS n FROM v_dns GROUP BY queries_name HAVING count(DISTINCT srcip) >= 3", ("v_dns",))
def ag8(spark, d):
    return A.shared_by(view(spark, d, "v_dns"), "queries_name", "srcip", 3)


@query("ag9_kinds", "SELECT ip, count(DISTINCT modeltype) AS n FROM v_evt GROUP BY ip HAVING count(DISTINCT modeltype) >= 4", ("v_evt",))
def ag9(spark, d):
    return A.shared_by(view(spark, d, "v_evt"), "ip", "modeltype", 4)


@query("ag10_upper_limit", "SELECT uri, count(content_length) AS n, round(CASE WHEN count(content_length) = 1 THEN 3 * max(content_length) ELSE avg(content_length) + 3 * stddev_pop(content_length) END, 4) AS upper FROM v_http GROUP BY uri", ("v_http",))
def ag10(spark, d):
    return view(spark, d, "v_http").groupBy("uri").agg(F.count("content_length").alias("n"), F.round(A.upper_limit("content_length"), 4).alias("upper"))


@query("ag11_mean_fill", """
    WITH x AS (SELECT srcip, dd, CASE WHEN dd % 4 = 0 THEN NULL ELSE sum(upbytesize) END AS b FROM v_flow_ts GROUP BY srcip, dd)
    SELECT srcip, dd, round(coalesce(CAST(b AS DOUBLE), avg(b) OVER (PARTITION BY srcip)), 4) AS bytes FROM x""", FLOW)
def ag11(spark, d):
    daily = view(spark, d, "v_flow_ts").groupBy("srcip", "dd").agg(F.sum("upbytesize").cast("double").alias("b")).withColumn("b", F.when(F.col("dd") % 4 != 0, F.col("b")))
    return daily.select("srcip", "dd", F.round(A.fill_with_mean(daily, "srcip", "b"), 4).alias("bytes"))


@query("ag12_failure_rate", "SELECT srcip, round(avg(f), 6) AS failure_rate FROM (SELECT DISTINCT srcip, queries_name, CASE WHEN flags_reply_code = 3 THEN 1.0 ELSE 0.0 END AS f FROM v_dns) GROUP BY srcip", ("v_dns",))
def ag12(spark, d):
    from sparkwarden.plans.dns import failure_rate

    return failure_rate(view(spark, d, "v_dns"))


@query("ag13_bot_rate", "SELECT status, count(*) AS hosts, count(*) FILTER (ip IN (SELECT srcip FROM v_flow_ts WHERE protocol = 'icmp')) AS bots, round(count(*) FILTER (ip IN (SELECT srcip FROM v_flow_ts WHERE protocol = 'icmp')) * 1.0 / count(*), 6) AS bot_rate FROM v_asset GROUP BY status", ASSET)
def ag13(spark, d):
    from sparkwarden.plans.botnets import bot_rate

    bots = view(spark, d, "v_flow_ts").where("protocol = 'icmp'").select(F.col("srcip").alias("ip"))
    return bot_rate(view(spark, d, "v_asset"), bots, "status")


@query("ag14_mean_upload", "SELECT srcip, dstip, protocol, round(avg(upbytesize), 4) AS mean_up FROM v_flow_ts GROUP BY srcip, dstip, protocol", FLOW)
def ag14(spark, d):
    return view(spark, d, "v_flow_ts").groupBy("srcip", "dstip", "protocol").agg(F.round(F.avg("upbytesize"), 4).alias("mean_up"))


_VALUES = r"p AS (SELECT page_id, unnest(string_split(regexp_extract(uri, '[?](.*)$', 1), '&')) AS pair FROM v_page), v AS (SELECT string_split(pair, '=')[1] AS param, regexp_extract(pair, '=(.*)$', 1) AS value FROM p WHERE contains(pair, '=') AND regexp_extract(pair, '=(.*)$', 1) <> '')"


@query("ag15_parameter_ranges", f"""
    WITH {_VALUES}, k AS (SELECT DISTINCT param, CASE WHEN regexp_matches(ch, '[A-Z]') THEN 'U' WHEN regexp_matches(ch, '[a-z]') THEN 'D' WHEN regexp_matches(ch, '[0-9]') THEN 'N' WHEN unicode(ch) BETWEEN 33 AND 126 THEN 'P' ELSE '#' END AS class FROM (SELECT param, unnest(string_split(value, '')) AS ch FROM v))
    SELECT param, low, high, classes FROM (SELECT param, CAST(min(length(value)) AS INTEGER) AS low, CAST(max(length(value)) AS INTEGER) AS high FROM v GROUP BY param) JOIN (SELECT param, array_to_string(list_sort(list(class)), ',') AS classes FROM k GROUP BY param) USING (param)""", ("v_page",))
def ag15(spark, d):
    from sparkwarden.functions import strings

    pairs = strings.query_pairs(view(spark, d, "v_page"), "uri", ["page_id"])
    return A.length_and_classes(pairs, ["param"], "value")


@query("ag16_term_weights", """
    WITH t AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^a-z]+')) AS term FROM documents), c AS (SELECT term, doc_id, count(*) AS n FROM t WHERE length(term) > 2 GROUP BY ALL)
    SELECT term, CAST(sum(n) AS BIGINT) AS tf, count(*) AS df, round(ln(sum(n)) / count(*), 6) AS weight FROM c GROUP BY term ORDER BY tf DESC, term LIMIT 200""")
def ag16(spark, d):
    terms = table(spark, d, "documents").select("doc_id", F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("term")).where(F.length("term") > 2)
    return A.term_weights(terms).orderBy(F.desc("tf"), "term").limit(200)


_PRED = "SELECT l.doc_id, toxic AS label, CASE WHEN n_chars % 7 < 2 THEN 1 ELSE 0 END AS prediction, d.lang, (n_chars % 100) / 100.0 AS score FROM labels l JOIN documents d ON d.doc_id = l.doc_id"


def _predictions(spark, d):
    docs = table(spark, d, "documents").selectExpr("doc_id", "lang", "IF(n_chars % 7 < 2, 1, 0) AS prediction", "(n_chars % 100) / 100.0D AS score")
    return table(spark, d, "labels").withColumnRenamed("toxic", "label").join(docs, "doc_id")


_CONF = "count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp, count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 0 AND prediction = 0) AS tn"
_RATES = "round(tp / nullif(tp + fp, 0)::DOUBLE, 6) AS precision, round(tp / nullif(tp + fn, 0)::DOUBLE, 6) AS recall, round((tp + tn) / nullif(tp + fp + fn + tn, 0)::DOUBLE, 6) AS accuracy, round(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 6) AS f1"


@query("ag17_confusion", f"WITH p AS ({_PRED}), c AS (SELECT lang, {_CONF} FROM p GROUP BY lang) SELECT *, {_RATES} FROM c")
def ag17(spark, d):
    return A.confusion(_predictions(spark, d), by=["lang"])


@query("ag18_per_label", f"""
    WITH p AS ({_PRED}), k AS (SELECT DISTINCT label FROM p UNION SELECT DISTINCT prediction FROM p),
         c AS (SELECT k.label, count(*) FILTER (p.label = k.label) AS actual, count(*) FILTER (prediction = k.label) AS said, count(*) FILTER (p.label = k.label AND prediction = k.label) AS tp, count(*) AS total FROM p CROSS JOIN k GROUP BY k.label),
         r AS (SELECT *, coalesce(tp / nullif(said, 0)::DOUBLE, 0) AS p, coalesce(tp / nullif(actual, 0)::DOUBLE, 0) AS r FROM c)
    SELECT label, actual, round(p, 6) AS precision, round(r, 6) AS recall, round(coalesce((said - tp) / nullif(total - actual, 0)::DOUBLE, 0), 6) AS fpr, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f_measure FROM r""")
def ag18(spark, d):
    return A.per_label_metrics(_predictions(spark, d))


@query("ag19_cutoffs", f"WITH p AS ({_PRED}), q AS (SELECT cutoff, label, CASE WHEN score >= cutoff THEN 1 ELSE 0 END AS prediction FROM p CROSS JOIN (VALUES (0.1::DOUBLE), (0.25), (0.5), (0.9)) t(cutoff)), c AS (SELECT cutoff, {_CONF} FROM q GROUP BY cutoff) SELECT *, {_RATES} FROM c")
def ag19(spark, d):
    cutoffs = F.explode(F.array(*map(F.lit, (0.1, 0.25, 0.5, 0.9)))).alias("cutoff")
    judged = _predictions(spark, d).select("label", "score", cutoffs).withColumn("prediction", (F.col("score") >= F.col("cutoff")).cast("int"))
    return A.confusion(judged, by=["cutoff"])


@query("ag20_class_profile", "WITH x AS (SELECT label, unnest(embedding) AS v, unnest(range(1, len(embedding) + 1)) AS k FROM v_xy) SELECT label, CAST(k AS INTEGER) AS feature, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM x GROUP BY label, k", ("v_xy",))
def ag20(spark, d):
    from sparkwarden.ml.features import class_profile

    return class_profile(view(spark, d, "v_xy"))


@query("ag21_global_ratio", "SELECT ip, status, round((SELECT count(*) FROM v_asset WHERE status = 2) * 1.0 / (SELECT count(*) FROM v_asset), 6) AS retired_share FROM v_asset", ASSET)
def ag21(spark, d):
    assets = view(spark, d, "v_asset")
    share = assets.agg(F.round(F.avg((F.col("status") == 2).cast("double")), 6).alias("retired_share"))
    return assets.join(F.broadcast(share), how="cross")


# Sort, limit, distinct rows, set operations


@query("st1_order", "SELECT id, sec FROM v_evt ORDER BY sec, id", ("v_evt",))
def st1(spark, d):
    return view(spark, d, "v_evt").select("id", "sec").orderBy("sec", "id")


@query("st2_top_per_group", "SELECT srcip, queries_name, n, k AS rank FROM (SELECT *, row_number() OVER (PARTITION BY srcip ORDER BY n DESC, queries_name) AS k FROM (SELECT srcip, queries_name, count(*) AS n FROM v_dns GROUP BY ALL)) WHERE k <= 10", ("v_dns",))
def st2(spark, d):
    counts = view(spark, d, "v_dns").groupBy("srcip", "queries_name").agg(F.count(F.lit(1)).alias("n"))
    return S.top_k(counts, ["srcip"], [F.desc("n"), F.col("queries_name")], 10)


@query("st3_top", "SELECT srcip, CAST(sum(upbytesize) AS BIGINT) AS bytes FROM v_flow GROUP BY srcip ORDER BY bytes DESC, srcip LIMIT 20", ("v_flow",))
def st3(spark, d):
    return view(spark, d, "v_flow").groupBy("srcip").agg(F.sum("upbytesize").alias("bytes")).orderBy(F.desc("bytes"), "srcip").limit(20)


@query("st4_distinct_by_key", "SELECT srcip, dstip, hh, min(flow_id) AS flow_id FROM v_flow_ts GROUP BY srcip, dstip, hh", FLOW)
def st4(spark, d):
    return view(spark, d, "v_flow_ts").groupBy("srcip", "dstip", "hh").agg(F.min("flow_id").alias("flow_id"))


@query("st5_balance", "WITH r AS (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY doc_id * 7919 % 10007, doc_id) AS k FROM labels) SELECT doc_id, toxic FROM r WHERE k <= (SELECT min(n) FROM (SELECT count(*) AS n FROM labels GROUP BY toxic))")
def st5(spark, d):
    return S.balance_classes(table(spark, d, "labels").select("doc_id", "toxic"), "toxic", "doc_id")


@query("so1_union_all", "SELECT srcip AS ip, upbytesize AS bytes FROM v_flow UNION ALL SELECT dstip, downbytesize FROM v_flow", ("v_flow",))
def so1(spark, d):
    flows = view(spark, d, "v_flow")
    return flows.selectExpr("srcip AS ip", "upbytesize AS bytes").unionByName(flows.selectExpr("dstip AS ip", "downbytesize AS bytes"))


@query("so2_union_distinct", "SELECT dstip, dstport FROM v_flow_ts WHERE dd <= 20 UNION SELECT dstip, dstport FROM v_flow_ts WHERE event_type = 'error'", FLOW)
def so2(spark, d):
    flows = view(spark, d, "v_flow_ts")
    return flows.where("dd <= 20").select("dstip", "dstport").union(flows.where("event_type = 'error'").select("dstip", "dstport")).distinct()


@query("so3_except", "SELECT dstip, dstport, protocol FROM v_flow_ts WHERE dd > 20 EXCEPT SELECT dstip, dstport, protocol FROM v_flow_ts WHERE dd <= 20", FLOW)
def so3(spark, d):
    flows = view(spark, d, "v_flow_ts")
    return S.new_keys(flows.where("dd > 20"), flows.where("dd <= 20").select("dstip", "dstport", "protocol"))


@query("so4_intersect", "SELECT srcip FROM v_flow_ts WHERE dd <= 15 INTERSECT SELECT srcip FROM v_flow_ts WHERE dd > 15", FLOW)
def so4(spark, d):
    flows = view(spark, d, "v_flow_ts")
    return flows.where("dd <= 15").select("srcip").intersect(flows.where("dd > 15").select("srcip"))


@query("so5_common_members", "WITH q AS (SELECT flow_id, string_split(uri, '?')[1] AS path, unnest(string_split(regexp_extract(uri, '[?](.*)$', 1), '&')) AS pair FROM v_http), v AS (SELECT path, flow_id, string_split(pair, '=')[1] AS param FROM q WHERE contains(pair, '=') AND regexp_extract(pair, '=(.*)$', 1) <> ''), u AS (SELECT path, count(DISTINCT flow_id) AS n FROM v GROUP BY path), s AS (SELECT path, param, count(DISTINCT flow_id) AS n FROM v GROUP BY path, param) SELECT s.path, s.param FROM s JOIN u ON s.path = u.path AND s.n = u.n", ("v_http",))
def so5(spark, d):
    pairs = query_pairs(view(spark, d, "v_http").withColumn("path", request_path(F.col("uri"))), "uri", ["path", "flow_id"])
    return S.common_members(pairs, "path", "flow_id", "param")


@query("so6_split", "SELECT doc_id, CASE WHEN doc_id * 7919 % 100 < 70 THEN 'train' ELSE 'test' END AS part FROM labels")
def so6(spark, d):
    return table(spark, d, "labels").select("doc_id", S.split_by_key(F.col("doc_id")).alias("part"))


@query("so7_concatenate_files", "SELECT DISTINCT n_nationkey, n_name FROM nation UNION SELECT n_nationkey, n_name FROM nation WHERE n_regionkey > 1")
def so7(spark, d):
    return spark.read.parquet(f"{d}/nation.parquet", f"{d}/nation.parquet").select("n_nationkey", "n_name").dropDuplicates()


# Sinks and lookups whose rows can be compared


@query("snk1_json_messages", """
    SELECT concat('{"flow_id":', CAST(flow_id AS VARCHAR), ',"srcip":"', srcip, '","protocol":"', protocol, '","bytes":', CAST(upbytesize AS VARCHAR), '}') AS value FROM v_flow_ts""", FLOW)
def snk1(spark, d):
    from sparkwarden.sources.sinks import messages

    return messages(view(spark, d, "v_flow_ts").selectExpr("flow_id", "srcip", "protocol", "upbytesize AS bytes"))


@query("snk4_upsert", "WITH o AS (SELECT srcip, max(dd) AS dd FROM v_flow_ts WHERE dd <= 20 GROUP BY srcip), n AS (SELECT srcip, max(dd) AS dd FROM v_flow_ts WHERE dd > 25 GROUP BY srcip) SELECT coalesce(o.srcip, n.srcip) AS srcip, coalesce(n.dd, o.dd) AS dd FROM o FULL JOIN n ON o.srcip = n.srcip", FLOW)
def snk4(spark, d):
    flows = view(spark, d, "v_flow_ts")
    last = lambda where: flows.where(where).groupBy("srcip").agg(F.max("dd").alias("dd"))
    return M.upsert(last("dd <= 20"), last("dd > 25"), ["srcip"], "dd")


@query("snk5_update_insert", "WITH t AS (SELECT DISTINCT srcip FROM v_flow_ts WHERE dd = 30), y AS (SELECT DISTINCT srcip FROM v_flow_ts WHERE dd = 29) SELECT srcip, CASE WHEN srcip IN (SELECT srcip FROM y) THEN 'update' ELSE 'insert' END AS action FROM t", FLOW)
def snk5(spark, d):
    flows = view(spark, d, "v_flow_ts")
    update, insert = M.update_insert_sets(flows.where("dd = 30").select("srcip").distinct(), flows.where("dd = 29"), "srcip")
    return update.withColumn("action", F.lit("update")).unionByName(insert.withColumn("action", F.lit("insert")))


@query("snk6_message_id", "SELECT flow_id, sha256(concat_ws('#', CAST(flow_id AS VARCHAR), srcip, dstip)) AS message_id FROM v_flow_ts", FLOW)
def snk6(spark, d):
    from sparkwarden.sources.sinks import message_id

    return view(spark, d, "v_flow_ts").select("flow_id", message_id("flow_id", "srcip", "dstip").alias("message_id"))


@query("snk7_retention", "SELECT DISTINCT CAST(dt AS VARCHAR) AS partition FROM v_flow_ts WHERE dt < DATE '2024-01-11'", FLOW)
def snk7(spark, d):
    from sparkwarden.sources.sinks import expired_partitions

    return expired_partitions(view(spark, d, "v_flow_ts").select(F.col("dt").cast("string").alias("partition")).distinct(), "2024-01-31", 20)
