"""The engine's log schemas as views over the given tables.

Each view is one SQL text that Spark and DuckDB both run, so a query and its check start from the same rows.  In Spark
the names in braces are DataFrames; times are read without a zone, so results do not depend on the session's zone.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "v_flow_ts": """
        SELECT event_id AS flow_id, user_id, event_type, ts,
               concat('10.0.', CAST(user_id % 4 AS STRING), '.', CAST(user_id AS STRING)) AS srcip,
               concat('172.16.0.', CAST(event_id % 50 AS STRING)) AS dstip,
               1025 + event_id % 40000 AS srcport,
               CASE CAST(floor(event_id / 50) AS BIGINT) % 8 WHEN 0 THEN 22 WHEN 1 THEN 25 WHEN 2 THEN 53 WHEN 3 THEN 80
                    WHEN 4 THEN 110 WHEN 5 THEN 443 WHEN 6 THEN 445 ELSE 8080 END AS dstport,
               CASE event_type WHEN 'click' THEN 'tcp' WHEN 'view' THEN 'tcp' WHEN 'error' THEN 'icmp' ELSE 'udp' END AS protocol,
               CASE WHEN event_id % 3 = 0 THEN 'tls' ELSE 'http' END AS proto7,
               CAST(round(value * 100) AS BIGINT) AS upbytesize,
               ((event_id * 7919) % 200) * 100 AS downbytesize,
               event_id % 6 AS uppkts,
               hour(ts) AS hh, minute(ts) AS mi, day(ts) AS dd, CAST(ts AS DATE) AS dt,
               CAST(day(ts) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + floor(second(ts)) AS BIGINT) AS sec
        FROM {events}""",
    "v_flow": """
        SELECT l_orderkey * 10 + l_linenumber AS flow_id,
               concat('10.1.', CAST(l_suppkey % 8 AS STRING), '.', CAST(l_suppkey AS STRING)) AS srcip,
               concat('172.17.', CAST(l_partkey % 16 AS STRING), '.', CAST(l_partkey AS STRING)) AS dstip,
               1025 + (l_orderkey * 13) % 40000 AS srcport,
               CASE l_linenumber WHEN 1 THEN 22 WHEN 2 THEN 25 WHEN 3 THEN 53 WHEN 4 THEN 80 WHEN 5 THEN 443 WHEN 6 THEN 445 ELSE 8080 END AS dstport,
               CASE l_returnflag WHEN 'A' THEN 'tcp' WHEN 'R' THEN 'udp' ELSE 'icmp' END AS protocol,
               CASE l_linestatus WHEN 'O' THEN 'TLS' ELSE 'http' END AS proto7,
               CAST(round(l_quantity * 1000) AS BIGINT) AS upbytesize,
               CAST(floor(l_extendedprice) AS BIGINT) AS downbytesize,
               CAST(l_shipdate AS DATE) AS dt
        FROM {lineitem}""",
    "v_asset": """
        SELECT DISTINCT concat('10.0.', CAST(user_id % 4 AS STRING), '.', CAST(user_id AS STRING)) AS ip, CASE WHEN user_id % 7 = 0 THEN 2 ELSE 1 END AS status FROM {events}
        UNION
        SELECT DISTINCT concat('172.16.0.', CAST(event_id % 50 AS STRING)), CASE WHEN event_id % 50 % 7 = 0 THEN 2 ELSE 1 END FROM {events}""",
    "v_page": """
        SELECT page_id, url, html, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host,
               regexp_extract(url, '://[^/?#]*([^#]*)', 1) AS uri
        FROM {pages}""",
    "v_dns": """
        SELECT e.event_id AS flow_id, concat('10.0.', CAST(user_id % 4 AS STRING), '.', CAST(user_id AS STRING)) AS srcip,
               concat('172.16.0.', CAST(event_id % 50 AS STRING)) AS dstip, 1025 + event_id % 40000 AS srcport, 53 AS dstport,
               lower(regexp_extract(url, '://([^/?#]*)', 1)) AS queries_name, event_id % 2 AS flags_response,
               CASE WHEN event_id % 5 = 0 THEN 3 ELSE 0 END AS flags_reply_code,
               concat(CAST(event_id % 60 AS STRING), '#', CAST(event_id % 300 AS STRING)) AS answers_ttl,
               concat(CAST(event_id % 16 AS STRING), '#', CAST(event_id % 90 AS STRING)) AS answers_data_length,
               CAST(round(value) AS BIGINT) AS size, hour(ts) AS hh, minute(ts) AS mi, day(ts) AS dd,
               CAST(day(ts) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + floor(second(ts)) AS BIGINT) AS sec, p.page_id
        FROM (SELECT *, event_id % (SELECT count(*) FROM {pages}) AS page_no FROM {events}) e JOIN {pages} p ON p.page_id = e.page_no""",
    "v_http": """
        SELECT e.event_id AS flow_id, concat('10.0.', CAST(user_id % 4 AS STRING), '.', CAST(user_id AS STRING)) AS srcip,
               concat('172.16.0.', CAST(event_id % 50 AS STRING)) AS dstip,
               lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host,
               concat(regexp_extract(url, '://[^/?#]*([^#]*)', 1), CASE WHEN url LIKE '%=%' THEN concat('&id=',
                      CASE WHEN event_id % 31 = 0 AND day(ts) > 20 THEN concat('Xx', CAST(event_id AS STRING)) ELSE CAST(event_id % 100 AS STRING) END) ELSE '' END) AS uri,
               CASE WHEN event_id % 4 = 3 THEN 'image/png' ELSE 'text/html; charset=utf-8' END AS content_type,
               CAST(day(ts) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + floor(second(ts)) AS BIGINT) AS request_date,
               CAST(day(ts) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + floor(second(ts)) + event_id % 9 AS BIGINT) AS response_date,
               CAST(length(html) + event_id % 7 AS DOUBLE) AS content_length, day(ts) AS dd
        FROM (SELECT *, event_id % (SELECT count(*) FROM {pages}) AS page_no FROM {events}) e JOIN {pages} p ON p.page_id = e.page_no""",
    "v_doc": """
        SELECT doc_id, text, concat('10.0.0.', CAST(doc_id % 20 AS STRING)) AS owner, doc_id % 24 AS hh, source AS tag, n_chars AS bytes,
               CASE WHEN doc_id % 3 = 0 THEN '172.16.0.9' ELSE concat('10.0.0.', CAST(doc_id % 7 AS STRING)) END AS peer
        FROM {documents}""",
    "v_evt": """
        SELECT event_id AS id, concat('10.0.', CAST(user_id % 4 AS STRING), '.', CAST(user_id AS STRING)) AS ip,
               concat('172.16.0.', CAST(event_id % 50 AS STRING)) AS dstip, event_type AS modeltype, value,
               CAST(day(ts) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + floor(second(ts)) AS BIGINT) AS sec, day(ts) AS dd
        FROM {events}""",
    "v_xy": """
        SELECT vec_id, label, embedding FROM {embeddings}""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame. Only the columns that a query uses are read."""
    sql = VIEWS[name]
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(re.findall(r"\{(\w+)\}", sql))}
    return spark.sql(sql, **frames)


def oracle(views: tuple[str, ...], sql: str) -> str:
    """The same views as CTEs in front of DuckDB's SQL."""
    ctes = ", ".join(f"{v} AS ({re.sub(r'[{}]', '', VIEWS[v])})" for v in views)
    body = sql.strip()
    if not views:
        return body
    recursive = body.upper().startswith("WITH RECURSIVE")
    if body.upper().startswith("WITH"):
        body = ", " + body.split(None, 2 if recursive else 1)[-1]
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes} {body}"
