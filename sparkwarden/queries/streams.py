"""Streams over the event table's files, run until they are read, and file formats written and read back."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sparkwarden.adapters import VIEWS, view
from sparkwarden.plans import flows as plans
from sparkwarden.queries import query
from sparkwarden.queries.relational import _PERIOD, _RATIO, FLOW
from sparkwarden.sources import index, readers, sinks
from sparkwarden.sources.versions import Versions
from sparkwarden.storage import discard, shared_dir, written
from sparkwarden.streaming import jobs, runs


def flow_stream(spark, d):
    path = f"{d}/events.parque[t]"  # a pattern may be one file or a folder
    events = jobs.new_files(spark, path, spark.read.parquet(path).schema)
    return spark.sql(VIEWS["v_flow_ts"], events=events).withColumn("ts", F.col("ts").cast("timestamp"))


@query("sm1_ingest", "SELECT flow_id, srcip, dstip, upbytesize FROM v_flow_ts", FLOW)
def sm1(spark, d):
    return jobs.drained(flow_stream(spark, d).select("flow_id", "srcip", "dstip", "upbytesize")).drop("batch")


@query("sm2_slot_volumes", "WITH e AS (SELECT CAST(floor(sec / 300) AS BIGINT) AS slot, srcip AS ip, upbytesize AS n FROM v_flow_ts UNION ALL SELECT CAST(floor(sec / 300) AS BIGINT), dstip, downbytesize FROM v_flow_ts) SELECT slot, ip, CAST(sum(n) AS BIGINT) AS bytes FROM e GROUP BY slot, ip", FLOW)
def sm2(spark, d):
    return jobs.last_updates(jobs.drained(jobs.slot_volumes(flow_stream(spark, d)), "update"), ["slot", "ip"])


@query("sm3_ratio_alerts", f"""
    WITH r AS (SELECT flow_id, srcip AS ip, dd, {_PERIOD} AS period, {_RATIO} AS ratio FROM v_flow_ts), b AS (SELECT ip, period, max(ratio) AS max_ratio FROM r WHERE dd <= 20 GROUP BY ip, period)
    SELECT flow_id, r.ip, r.period FROM r JOIN b ON b.ip = r.ip AND b.period = r.period WHERE dd > 20 AND ratio > max_ratio""", FLOW)
def sm3(spark, d):
    base = plans.ratio_baseline(view(spark, d, "v_flow_ts").where("dd <= 20"))
    alerts = plans.ratio_anomalies(flow_stream(spark, d).where("dd > 20"), base)
    return jobs.drained(alerts.select("flow_id", "ip", "period")).drop("batch")


#: The month in five parts, as flows arrive; every fifth flow's alert is rejected by the analyst.
_PARTS = 5
_LEARNED = f"""r AS (SELECT flow_id, srcip AS ip, CAST(floor((dd - 1) / 6) AS INTEGER) AS part, {_PERIOD} AS period, {_RATIO} AS ratio FROM v_flow_ts),
    f AS (SELECT *, min(part) OVER (PARTITION BY ip, period) AS first_part FROM r),
    p AS (SELECT ip, period, part, max(CASE WHEN part = first_part OR flow_id % 5 = 0 THEN ratio END) AS trains FROM f GROUP BY ALL),
    b AS (SELECT ip, period, part, max(trains) OVER (PARTITION BY ip, period ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS max_ratio FROM p)"""


def _learning_run(spark, d):
    """One run of the job for each part that has come: folder and baselines after the last one."""
    folder, arrived = _folder(spark, "learning"), _folder(spark, "arrived")
    flows = view(spark, d, "v_flow_ts").select("flow_id", "srcip", "upbytesize", "downbytesize", "hh", "dd")
    baselines = Versions(spark, f"{folder}/baseline", "ip string, period string, max_ratio double")

    def detect(batch, baseline):
        return plans.ratio_anomalies(batch, baseline).select("flow_id", "ip", "period", "max_ratio")

    def learn(batch, baseline):
        return plans.raised_ratios(baseline, plans.normal_ratios(batch, baseline, batch.where("flow_id % 5 = 0")))

    for k in range(_PARTS):
        flows.where(F.floor((F.col("dd") - 1) / 6) == k).write.mode("append").parquet(arrived)
        jobs.learning(jobs.new_files(spark, arrived, flows.schema, files_per_batch=10_000), baselines, "flows", detect, learn, folder)
    return folder, baselines


@query("sm3_learning_alerts", f"WITH {_LEARNED} SELECT flow_id, r.ip, r.period, round(max_ratio, 6) AS max_ratio FROM r JOIN b ON b.ip = r.ip AND b.period = r.period AND b.part = r.part WHERE ratio > max_ratio", FLOW)
def sm3_learning(spark, d):
    folder, _ = _learning_run(spark, d)
    return spark.read.parquet(f"{folder}/alerts").select("flow_id", "ip", "period", F.round("max_ratio", 6).alias("max_ratio"))


@query("dt3_learned_ratios", f"WITH {_LEARNED} SELECT ip, period, round(max(trains), 6) AS max_ratio FROM p GROUP BY ip, period", FLOW)
def dt3_learned(spark, d):
    """The baseline that the stream has learned, after its last batch."""
    _, baselines = _learning_run(spark, d)
    return baselines.read().select("ip", "period", F.round("max_ratio", 6).alias("max_ratio"))


@query("sm4_without_repeats", "SELECT DISTINCT srcip, dstip, dd, hh FROM v_flow_ts", FLOW)
def sm4(spark, d):
    rows = jobs.drained(jobs.without_repeats(flow_stream(spark, d).select("ts", "srcip", "dstip", "dd", "hh"), ["srcip", "dstip", "dd", "hh"]))
    # The horizon bounds the state, so a key can come again after it; the stored table is made distinct.
    return rows.select("srcip", "dstip", "dd", "hh").distinct()


@query("sm5_running_exceedances", """
    WITH s AS (SELECT srcip AS ip, dd * 24 + hh AS slot, CASE WHEN sum(upbytesize) > 3000 THEN 1 ELSE 0 END AS exceeds FROM v_flow_ts GROUP BY ALL), i AS (SELECT *, slot - row_number() OVER (PARTITION BY ip, exceeds ORDER BY slot) AS island FROM s),
         r AS (SELECT ip, count(*) AS n FROM i WHERE exceeds = 1 GROUP BY ip, island)
    SELECT ip, coalesce(max(n), 0) AS longest FROM (SELECT DISTINCT ip FROM s) LEFT JOIN r USING (ip) GROUP BY ip""", FLOW)
def sm5(spark, d):
    """Hours arrive in two files, the even ones first: the watermark lets the odd ones in."""
    hour = F.col("dd") * 24 + F.col("hh")
    slots = view(spark, d, "v_flow_ts").groupBy(F.col("srcip").alias("ip"), hour.alias("slot")).agg((F.sum("upbytesize") > 3000).cast("int").alias("exceeds"))
    slots = written(slots.withColumn("at", F.timestamp_seconds(F.col("slot") * 3600)), "slots")
    folder = _folder(spark, "slots")
    with runs.keyed_state(spark):
        for part in (0, 1):
            slots.where(F.col("slot") % 2 == part).write.mode("append").parquet(folder)
            stream = jobs.new_files(spark, folder, slots.schema, files_per_batch=10_000)
            rows = jobs.drained(runs.running_exceedances(stream, late="40 days", idle_hours=2000), "update", folder + "-out")
    discard(slots)
    return rows.groupBy("ip").agg(F.max("longest").alias("longest"))


def _folder(spark, name):
    return f"{shared_dir(spark)}/sparkwarden/{name}-{uuid.uuid4().hex}"


_NATION = "SELECT n_nationkey, n_name, n_regionkey FROM nation"


@query("src1_json", "SELECT flow_id, srcip, upbytesize FROM v_flow_ts", FLOW)
def src1(spark, d):
    path, rows = _folder(spark, "json"), view(spark, d, "v_flow_ts").select("flow_id", "srcip", "upbytesize")
    rows.write.json(path)
    return readers.read_json(spark, path, rows.schema)


@query("src2_tsv", "SELECT flow_id, srcip, upbytesize FROM v_flow_ts", FLOW)
def src2(spark, d):
    path, rows = _folder(spark, "tsv"), view(spark, d, "v_flow_ts").select("flow_id", "srcip", "upbytesize")
    rows.write.option("sep", "\t").option("header", True).csv(path)
    return readers.read_tsv(spark, path, rows.schema)


@query("src3_closed_files", "SELECT flow_id, srcip FROM v_flow_ts WHERE dd <= 24", FLOW)
def src3(spark, d):
    """A file for each eight days; the newest one is still open."""
    path, rows = _folder(spark, "hours"), view(spark, d, "v_flow_ts").select("flow_id", "srcip", "dd")
    rows.repartitionById(4, F.floor((F.col("dd") - 1) / 8).cast("int")).write.json(path)
    return readers.read_closed_files(spark, path, rows.schema, "part-").select("flow_id", "srcip")


@query("src4_list", "SELECT DISTINCT host FROM v_page WHERE trim(host) <> ''", ("v_page",))
def src4(spark, d):
    path = _folder(spark, "list")
    view(spark, d, "v_page").select("host").write.text(path)
    return readers.read_list(spark, path, "host")


@query("src6_time_range", "SELECT id, ip, dd FROM v_evt WHERE dd BETWEEN 10 AND 12", ("v_evt",))
def src6(spark, d):
    path = _folder(spark, "events")
    sinks.overwrite_partitions(view(spark, d, "v_evt").select("id", "ip", "dd"), path, ["dd"])
    return readers.read_between(spark, path, "dd", 10, 12).select("id", "ip", F.col("dd").cast("int").alias("dd"))


def _indexed(spark, d):
    """The event log as an index of three appends."""
    root, rows = _folder(spark, "index"), view(spark, d, "v_evt").select("id", "ip", F.col("sec").cast("long").alias("sec"))
    for part in ("dd <= 10", "dd BETWEEN 11 AND 20", "dd > 20"):
        index.append_segments(view(spark, d, "v_evt").where(part).select("id", "ip", F.col("sec").cast("long").alias("sec")), root, "sec")
    return root, rows.schema


@query("src6_index_scan", "SELECT id, ip, sec FROM v_evt WHERE sec >= 10 * 86400 AND sec < 12 * 86400 AND id % 2 = 0", ("v_evt",))
def src6_index(spark, d):
    root, schema = _indexed(spark, d)
    return index.read_segments(spark, root, "sec", schema).where(f"sec >= {10 * 86400} AND sec < {12 * 86400} AND id % 2 = 0")


@query("src6_index_stream", "SELECT ip, count(*) AS n FROM v_evt GROUP BY ip", ("v_evt",))
def src6_stream(spark, d):
    root, schema = _indexed(spark, d)
    return jobs.drained(index.stream_segments(spark, root, "sec", schema)).groupBy("ip").agg(F.count(F.lit(1)).alias("n"))


@query("src7_svmlight", "SELECT CAST(label AS DOUBLE) AS label, count(*) AS n FROM v_xy GROUP BY label", ("v_xy",))
def src7(spark, d):
    path, rows = _folder(spark, "svmlight"), view(spark, d, "v_xy")
    rows.select(F.col("label").cast("double").alias("label"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features")).write.format("libsvm").save(path)
    return readers.read_svmlight(spark, path, 64).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("src8_magic", "SELECT CAST(page_id % 4 AS INTEGER) AS part, CAST(sum(octet_length(encode(html)) + 1) AS BIGINT) AS length FROM v_page WHERE page_id % 4 < 3 GROUP BY page_id % 4", ("v_page",))
def src8(spark, d):
    """Four files, one of which begins otherwise."""
    path, part = _folder(spark, "raw"), (F.col("page_id") % 4).cast("int")
    lines = view(spark, d, "v_page").repartitionById(4, part).select(F.when(part == 3, F.concat(F.lit("x"), "html")).otherwise(F.col("html")))
    lines.write.text(path)
    found = readers.read_magic(spark, path, b"<!")
    return found.select(F.regexp_extract("path", r"part-(\d+)-[^/]*$", 1).cast("int").alias("part"), "length")


@query("snk2_partitioned", "SELECT flow_id, srcip, dd FROM v_flow_ts", FLOW)
def snk2(spark, d):
    path = _folder(spark, "partitioned")
    sinks.overwrite_partitions(view(spark, d, "v_flow_ts").select("flow_id", "srcip", "dd"), path, ["dd"])
    return spark.read.parquet(path).withColumn("dd", F.col("dd").cast("int"))


@query("snk3_append", "SELECT flow_id, srcip FROM v_flow_ts", FLOW)
def snk3(spark, d):
    path, rows = _folder(spark, "appended"), view(spark, d, "v_flow_ts").select("flow_id", "srcip", "dd")
    for batch, part in (("old", "dd <= 20"), ("new", "dd > 20"), ("new", "dd > 20")):  # the last one again, as after a failure
        sinks.append_rows(rows.where(part).select("flow_id", "srcip"), path, batch)
    return spark.read.parquet(path).select("flow_id", "srcip")


@query("st6_non_empty_gate", "SELECT dstip, count(*) AS n FROM v_flow_ts WHERE protocol = 'icmp' GROUP BY dstip", FLOW)
def st6(spark, d):
    errors = view(spark, d, "v_flow_ts").where("protocol = 'icmp'")
    return errors.groupBy("dstip").agg(F.count(F.lit(1)).alias("n")) if not errors.isEmpty() else errors.select("dstip", F.lit(0).cast("long").alias("n"))


@query("src5_range_scan", "SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey BETWEEN 10 AND 500")
def src5(spark, d):
    """The condition that the relational scan hands to its database, pushed down to Parquet."""
    return readers.read_between(spark, f"{d}/customer.parquet", "c_custkey", 10, 500).select("c_custkey", "c_nationkey")
