"""The registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkwarden.llm import decontaminate, exact_dedup, personal_data, prefix_trie, quality, sentencepiece_codec, simhash, substring_dedup, token_counts, token_store, toxicity, url_filter, whitening

URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
#: What op10 appends to each document.
END_ID = 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), digest_all=True)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), min_words=1)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeated(table(spark, sf_dir, "documents"), window=35)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.stored(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), "tokens", end_id=END_ID)


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find_personal_data(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=8)


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_decontamination, op3_token_counts, op4_url_filter, op5_sentencepiece, op6_simhash, op7_substring_dedup, op8_quality, op9_toxicity, op10_token_store, op11_personal_data, op12_prefix_trie, op13_whitening)}

ORACLES = {
    "op1_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM d""",
    "op4_url_filter": r"""
        WITH rules(rhost, rpath, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
               ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS r FROM pages),
        h AS (SELECT page_id,
                translate(coalesce(regexp_extract(r, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
        m AS (SELECT h.*, rhost || rpath AS rule, verdict,
                row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) AS k
              FROM h LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1""",
    "op12_prefix_trie": r"""
        WITH ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
        crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
                lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(i))),
        heads AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT,
                list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 6 AS h FROM ids, crc),
        turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                  sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, ''))) AS k FROM conversations WHERE conv_id IS NOT NULL),
        sizes AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY 1),
        r AS (SELECT heads.conv_id, k AS pos, role, text FROM heads JOIN turns ON turns.conv_id = base AND k <= h
              UNION ALL
              SELECT heads.conv_id, least(h, coalesce(n, 0)) + k - h AS pos, role, text
              FROM heads JOIN turns USING (conv_id) LEFT JOIN sizes ON sizes.conv_id = base WHERE k > h),
        m AS (SELECT conv_id, 0 AS d, '' AS prefix, 0 AS chars FROM ids
              UNION ALL
              SELECT conv_id, pos AS d, string_agg(length(role) || ':' || role || length(text) || ':' || text, '')
                OVER (PARTITION BY conv_id ORDER BY pos) AS prefix, length(text) AS chars FROM r),
        nodes AS (SELECT d, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM m GROUP BY d, prefix),
        place AS (SELECT m.conv_id AS member, m.d, nodes.conv_id FROM m JOIN nodes USING (d, prefix)),
        linked AS (SELECT nodes.*, place.conv_id AS parent_conv_id FROM nodes LEFT JOIN place ON place.member = nodes.conv_id AND place.d = nodes.d - 1),
        kids AS (SELECT parent_conv_id AS conv_id, d - 1 AS d, count(*) AS n_children FROM linked WHERE d > 0 GROUP BY 1, 2),
        full_nodes AS (SELECT linked.*, coalesce(n_children, 0) AS n_children FROM linked LEFT JOIN kids USING (conv_id, d)),
        below AS (SELECT place.conv_id, place.d, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * chars)::BIGINT AS saved_tokens
                  FROM full_nodes y JOIN place ON place.member = y.conv_id AND place.d <= y.d GROUP BY 1, 2),
        stops AS (SELECT place.conv_id, place.d, string_agg(member::VARCHAR, ',' ORDER BY member) AS ends
                  FROM place JOIN (SELECT conv_id, max(d) AS d FROM m GROUP BY 1) l ON l.conv_id = member AND l.d = place.d GROUP BY 1, 2)
        SELECT conv_id, d::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
        FROM full_nodes JOIN below USING (conv_id, d) LEFT JOIN stops USING (conv_id, d)""",
}
