"""String functions over hosts, requests and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwarden.adapters import view
from sparkwarden.functions import strings as S
from sparkwarden.queries import query, table

PAGE = ("v_page",)
_HOSTS = "h AS (SELECT DISTINCT host FROM v_page WHERE host <> '')"
_CHARS = "c AS (SELECT host, unnest(string_split(host, '')) AS ch, length(host) AS n FROM h), g AS (SELECT host, ch, n, count(*) AS k FROM c GROUP BY ALL)"


def hosts(spark, d):
    return view(spark, d, "v_page").where("host <> ''").select("host").distinct()


@query("fn1_entropy", f"WITH {_HOSTS}, {_CHARS} SELECT host, round(-sum(k / n * ln(k / n)), 6) AS entropy FROM g GROUP BY host", PAGE)
def fn1(spark, d):
    return hosts(spark, d).select("host", F.round(S.entropy(F.col("host")), 6).alias("entropy"))


@query("fn2_entropy_bits", f"WITH h AS (SELECT DISTINCT replace(host, '.', '') AS host FROM v_page WHERE host <> ''), {_CHARS} SELECT host AS name, round(-sum(k / n * log2(k / n)), 6) AS bits FROM g GROUP BY host", PAGE)
def fn2(spark, d):
    return hosts(spark, d).select(F.replace("host", F.lit("."), F.lit("")).alias("name")).distinct().select("name", F.round(S.entropy(F.col("name"), 2.0), 6).alias("bits"))


@query("fn3_vowels_digits", f"WITH {_HOSTS} SELECT host, round(length(regexp_replace(host, '[^aeiou]', '', 'g')) / length(host), 6) AS vowels, round(length(regexp_replace(host, '[^0-9]', '', 'g')) / length(host), 6) AS digits FROM h", PAGE)
def fn3(spark, d):
    return hosts(spark, d).select("host", F.round(S.share(F.col("host"), S.VOWELS), 6).alias("vowels"), F.round(S.share(F.col("host"), S.DIGITS), 6).alias("digits"))


@query("fn4_repeated", f"WITH {_HOSTS}, {_CHARS} SELECT host, round(coalesce(sum(k) FILTER (k > 1 AND ch BETWEEN 'a' AND 'z'), 0) / any_value(n), 6) AS repeated FROM g GROUP BY host", PAGE)
def fn4(spark, d):
    return hosts(spark, d).select("host", F.round(S.repeated_share(F.col("host")), 6).alias("repeated"))


@query("fn5_runs", f"WITH {_HOSTS} SELECT host, round((length(host) - length(regexp_replace(host, '[bcdfghjklmnpqrstvwxyz]{{2,}}', '', 'g'))) / length(host), 6) AS consonant_runs, round((length(host) - length(regexp_replace(host, '[0-9]{{2,}}', '', 'g'))) / length(host), 6) AS digit_runs FROM h", PAGE)
def fn5(spark, d):
    return hosts(spark, d).select("host", F.round(S.run_share(F.col("host"), S.CONSONANTS), 6).alias("consonant_runs"), F.round(S.run_share(F.col("host"), S.DIGITS), 6).alias("digit_runs"))


_GRAMS = "g AS (SELECT host, substr('^' || host || '$', CAST(i AS BIGINT), 3) AS gram FROM h, unnest(range(1, length(host) + 1)) t(i))"


@query("fn6_ngrams", f"WITH {_HOSTS}, {_GRAMS} SELECT gram, count(*) AS n FROM g GROUP BY gram", PAGE)
def fn6(spark, d):
    return hosts(spark, d).select(F.explode(S.ngrams(F.col("host"), 3)).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


@query("fn7_average_rank", f"WITH {_HOSTS}, {_GRAMS}, r AS (SELECT gram, dense_rank() OVER (ORDER BY n DESC, gram) AS rank FROM (SELECT gram, count(*) AS n FROM g GROUP BY gram HAVING count(*) > 2)) SELECT host, round(avg(coalesce(rank, 0)), 6) AS avg_rank FROM g LEFT JOIN r USING (gram) GROUP BY host", PAGE)
def fn7(spark, d):
    from sparkwarden.plans.dns import gram_ranks

    names = hosts(spark, d)
    return S.average_rank(names, "host", gram_ranks(names, "host", 3, least=3), 3).select("host", F.round("avg_rank", 6).alias("avg_rank"))


@query("fn8_transitions", f"""
    WITH {_HOSTS}, p AS (SELECT host, substr(host, CAST(i AS BIGINT), 2) AS pair FROM h, unnest(range(1, length(host))) t(i)),
         t AS (SELECT pair, n / sum(n) OVER (PARTITION BY substr(pair, 1, 1)) AS p FROM (SELECT pair, count(*) AS n FROM p GROUP BY pair HAVING count(*) > 1))
    SELECT host, round(CASE WHEN bool_or(pair IS NOT NULL AND t.p IS NULL) THEN -999.0 ELSE coalesce(sum(ln(t.p)), 0) END, 6) AS transition FROM h LEFT JOIN p USING (host) LEFT JOIN t USING (pair) GROUP BY host""", PAGE)
def fn8(spark, d):
    from sparkwarden.plans.dns import transition_table

    names = hosts(spark, d)
    return S.transition_score(names, "host", transition_table(names, "host", least=2)).select("host", F.round("transition", 6).alias("transition"))


@query("fn9_split_host", f"""
    WITH {_HOSTS}, s(suffix) AS (VALUES ('com'), ('net'), ('org'), ('co.uk'), ('example.org')),
         m AS (SELECT host, suffix, row_number() OVER (PARTITION BY host ORDER BY length(suffix) DESC) AS k FROM h LEFT JOIN s ON ends_with(host, '.' || suffix)),
         r AS (SELECT host, suffix, substr(host, 1, length(host) - length(suffix) - 1) AS rest FROM m WHERE k = 1)
    SELECT host, CASE WHEN suffix IS NULL THEN 'No-Parse' WHEN contains(rest, '.') THEN regexp_replace(rest, '[.][^.]*$', '') ELSE '' END AS subdomain,
           CASE WHEN suffix IS NULL THEN 'No-Parse' ELSE string_split(rest, '.')[-1] END AS domain, coalesce(suffix, 'No-Parse') AS suffix FROM r""", PAGE)
def fn9(spark, d):
    suffixes = spark.createDataFrame([("com",), ("net",), ("org",), ("co.uk",), ("example.org",)], "suffix string")
    return S.split_host(hosts(spark, d), "host", suffixes)


@query("fn10_name_lists", """
    SELECT flow_id, CAST(len(string_split(queries_name, '.')) AS INTEGER) AS labels, CAST(length(replace(queries_name, '.', '')) AS INTEGER) AS name_length,
           list_max(list_transform(string_split(answers_ttl, '#'), lambda x: x::DOUBLE)) AS max_ttl, list_sum(list_transform(string_split(answers_data_length, '#'), lambda x: x::DOUBLE)) AS sum_length FROM v_dns""", ("v_dns",))
def fn10(spark, d):
    from sparkwarden.plans.dns import list_features

    return view(spark, d, "v_dns").select("flow_id", *(c.alias(k) for k, c in list_features().items()))


@query("fn11_percent_decoded", "SELECT page_id, uri, url_decode(replace(uri, '+', ' ')) AS decoded FROM v_page", PAGE)
def fn11(spark, d):
    return view(spark, d, "v_page").select("page_id", "uri", S.percent_decoded(F.col("uri")).alias("decoded"))


@query("fn12_uri_split", "SELECT page_id, string_split(uri, '?')[1] AS path, regexp_extract(uri, '[?](.*)$', 1) AS query FROM v_page", PAGE)
def fn12(spark, d):
    return view(spark, d, "v_page").select("page_id", S.request_path(F.col("uri")).alias("path"), S.query_string(F.col("uri")).alias("query"))


@query("fn13_query_pairs", "WITH p AS (SELECT page_id, unnest(string_split(regexp_extract(uri, '[?](.*)$', 1), '&')) AS pair FROM v_page) SELECT page_id, string_split(pair, '=')[1] AS param, regexp_extract(pair, '=(.*)$', 1) AS value FROM p WHERE contains(pair, '=') AND regexp_extract(pair, '=(.*)$', 1) <> ''", PAGE)
def fn13(spark, d):
    return S.query_pairs(view(spark, d, "v_page"), "uri", ["page_id"])


@query("fn14_shape", r"""
    WITH c AS (SELECT DISTINCT uri, unnest(string_split(uri, '')) AS ch FROM v_page WHERE uri <> ''),
         k AS (SELECT DISTINCT uri, CASE WHEN regexp_matches(ch, '[A-Z]') THEN 'U' WHEN regexp_matches(ch, '[a-z]') THEN 'D' WHEN regexp_matches(ch, '[0-9]') THEN 'N' WHEN ch BETWEEN '一' AND '龥' THEN 'C' WHEN unicode(ch) BETWEEN 33 AND 126 THEN 'P' ELSE '#' END AS class FROM c)
    SELECT uri, array_to_string(list_sort(list(class)), ',') AS shape FROM k GROUP BY uri""", PAGE)
def fn14(spark, d):
    return view(spark, d, "v_page").where("uri <> ''").select("uri").distinct().select("uri", S.shape(F.col("uri")).alias("shape"))


@query("fn15_spaced_tokens", r"""
    SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(uri), '(%[0-9a-f]{2})', ' \1 ', 'g'), '([()<>=,;''"/&?+*|-])', ' \1 ', 'g'), '\s+', ' ', 'g')) AS spaced FROM v_page""", PAGE)
def fn15(spark, d):
    return view(spark, d, "v_page").select("page_id", S.spaced_tokens(F.col("uri")).alias("spaced"))


@query("fn16_keywords", "SELECT page_id, regexp_matches(lower(html), 'script|alert|onerror|onload|javascript|iframe') AS script_words, regexp_matches(lower(html), 'select|union|insert|update|delete|drop') AS sql_words FROM v_page", PAGE)
def fn16(spark, d):
    return view(spark, d, "v_page").select("page_id", S.has_word(F.col("html"), S.SCRIPT_WORDS).alias("script_words"), S.has_word(F.col("html"), S.SQL_WORDS).alias("sql_words"))


@query("fn17_safe_ratio", "SELECT flow_id, CASE WHEN downbytesize = 0 THEN CAST(upbytesize AS DOUBLE) ELSE CAST(upbytesize AS DOUBLE) / downbytesize END AS ratio FROM v_flow_ts", ("v_flow_ts",))
def fn17(spark, d):
    return view(spark, d, "v_flow_ts").select("flow_id", S.safe_ratio(F.col("upbytesize"), F.col("downbytesize")).alias("ratio"))


@query("fn18_level", "SELECT id, CASE WHEN value >= 80 THEN 'high' WHEN value >= 70 THEN 'medium' WHEN value >= 60 THEN 'low' ELSE 'none' END AS level FROM v_evt", ("v_evt",))
def fn18(spark, d):
    from sparkwarden.operators.enrich import level

    return view(spark, d, "v_evt").select("id", level(F.col("value")).alias("level"))


@query("fn19_range_check", r"""
    WITH p AS (SELECT page_id, unnest(string_split(regexp_extract(uri, '[?](.*)$', 1), '&')) AS pair FROM v_page),
         v AS (SELECT page_id, string_split(pair, '=')[1] AS param, regexp_extract(pair, '=(.*)$', 1) AS value FROM p WHERE contains(pair, '=') AND regexp_extract(pair, '=(.*)$', 1) <> '')
    SELECT page_id, param, value, NOT length(value) BETWEEN 1 AND 2 OR regexp_matches(value, '[^0-9]') AS odd FROM v""", PAGE)
def fn19(spark, d):
    pairs = S.query_pairs(view(spark, d, "v_page"), "uri", ["page_id"])
    return pairs.select("page_id", "param", "value", S.outside_range(F.col("value"), F.lit(1), F.lit(2), S.shape(F.col("value")), F.lit("N")).alias("odd"))


@query("fn20_snippets", r"""
    WITH s AS (SELECT doc_id, unnest(string_split_regex(text, '[.!?\n]+')) AS sentence, generate_subscripts(string_split_regex(text, '[.!?\n]+'), 1) AS place FROM documents),
         f AS (SELECT doc_id, place, regexp_extract(sentence, '(?i)(.{0,10})(license|reserved|public)(.{0,10})', 0) AS snippet FROM s WHERE regexp_matches(lower(sentence), 'license|reserved|public')),
         r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS k FROM f)
    SELECT doc_id, string_agg(snippet, ' ... ' ORDER BY place) AS snippets FROM r WHERE k <= 3 GROUP BY doc_id""")
def fn20(spark, d):
    return S.snippets(table(spark, d, "documents"), "doc_id", "text", ["license", "reserved", "public"])


@query("fn21_ideographs", "SELECT term, FALSE AS ideographs FROM (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS term FROM documents)")
def fn21(spark, d):
    terms = table(spark, d, "documents").select(F.explode(F.split(F.lower("text"), " ")).alias("term")).distinct()
    return terms.select("term", S.ideographs_only(F.col("term")).alias("ideographs"))


@query("fn22_clean_tokens", "WITH t AS (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS term FROM documents) SELECT doc_id, count(*) AS n FROM t WHERE length(term) > 1 AND NOT regexp_matches(term, '^[0-9]+$') AND term NOT IN ('the', 'of', 'and') GROUP BY doc_id")
def fn22(spark, d):
    kept = S.clean_tokens(F.split(F.lower("text"), " "), ["the", "of", "and"])
    return table(spark, d, "documents").select("doc_id", F.size(kept).cast("long").alias("n")).where("n > 0")


@query("fn23_dates", "SELECT flow_id, CAST(dt - 7 AS VARCHAR) AS week_before, concat(CAST(dt AS VARCHAR), ' ', lpad(CAST(hh AS VARCHAR), 2, '0'), ':00') AS hour_label, CAST(date_diff('day', DATE '2024-01-01', CAST(dt AS DATE)) AS INTEGER) AS day_no FROM v_flow_ts", ("v_flow_ts",))
def fn23(spark, d):
    return view(spark, d, "v_flow_ts").select("flow_id", F.date_sub("dt", 7).cast("string").alias("week_before"), F.concat(F.col("dt").cast("string"), F.lit(" "), F.lpad(F.col("hh").cast("string"), 2, "0"), F.lit(":00")).alias("hour_label"), F.datediff("dt", F.lit("2024-01-01").cast("date")).alias("day_no"))


@query("fn24_class_profile", "SELECT page_id, " + ", ".join(f"CAST(length(url) - length(regexp_replace(url, '{p}', '', 'g')) AS INTEGER) AS {n}" for n, p in (("lower", "[a-z]"), ("upper", "[A-Z]"), ("digits", "[0-9]"), ("dots", "[.]"), ("other", "[^a-zA-Z0-9.]"))) + ", CAST(length(url) AS INTEGER) AS len FROM v_page", PAGE)
def fn24(spark, d):
    return view(spark, d, "v_page").select("page_id", *(c.alias(k) for k, c in S.class_profile(F.col("url")).items()))


_TAGS = {"open_p": "<p>", "close_p": "</p>", "links": "<a ", "scripts": "<script", "items": "<li>"}


@query("fn25_structure_counts", "SELECT page_id, " + ", ".join(f"CAST(len(regexp_extract_all(html, '{p}')) AS INTEGER) AS {n}" for n, p in _TAGS.items()) + ", CAST(len(regexp_extract_all(html, '<p>')) - len(regexp_extract_all(html, '</p>')) AS INTEGER) AS unclosed_p FROM v_page", PAGE)
def fn25(spark, d):
    counted = view(spark, d, "v_page").select("page_id", *(c.alias(k) for k, c in S.structure_counts(F.col("html"), _TAGS).items()))
    return counted.withColumn("unclosed_p", F.col("open_p") - F.col("close_p"))
