"""Features of names, request strings and documents, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Character classes of the domain features.
VOWELS, DIGITS, CONSONANTS = "aeiou", "0123456789", "bcdfghjklmnpqrstvwxyz"
#: The value of a transition chain with a pair that was never seen.
UNSEEN = -999.0


def characters(text: Column) -> Column:
    """The characters of a text as an array."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def share(text: Column, kept: str) -> Column:
    """Share of characters that belong to a set; null for the empty text."""
    n = F.length(text)
    return F.when(n > 0, (n - F.length(F.translate(text, kept, ""))) / n)


def entropy(text: Column, base: float | None = None) -> Column:
    """Shannon entropy of the characters, natural logarithm or to a base; null for the empty text.

    One term for each distinct character, so a name costs its length times its alphabet.
    """
    n = F.length(text)
    log = (lambda x: F.log(x)) if base is None else (lambda x: F.log(base, x))

    def term(total: Column, c: Column) -> Column:
        p = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return total - p * log(p)

    return F.when(n > 0, F.aggregate(F.array_distinct(characters(text)), F.lit(0.0), term))


def repeated_share(text: Column) -> Column:
    """Share of the text that is letters a to z which occur more than once in it."""
    kinds = F.filter(F.array_distinct(characters(text)), lambda c: c.between("a", "z") & (F.length(c) == 1))
    n = F.length(text)
    often = F.filter(kinds, lambda c: n - F.length(F.replace(text, c, F.lit(""))) > 1)
    inside = F.aggregate(often, F.lit(0), lambda s, c: s + n - F.length(F.replace(text, c, F.lit(""))))
    return F.when(n > 0, inside / n)


def run_share(text: Column, of: str) -> Column:
    """Share of the text in runs of two or more characters of a class."""
    return F.when(F.length(text) > 0, (F.length(text) - F.length(F.regexp_replace(text, f"[{of}]{{2,}}", ""))) / F.length(text))


def ngrams(text: Column, n: int) -> Column:
    """The n-grams of the text between ``^`` and ``$``."""
    padded = F.concat(F.lit("^"), text, F.lit("$"))
    last = F.length(padded) - (n - 1)
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.substr(padded, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def average_rank(names: DataFrame, name: str, ranks: DataFrame, n: int) -> DataFrame:
    """Mean rank of a name's n-grams; those without a rank count as 0. ``ranks``: gram, rank (a bounded dictionary)."""
    from sparkwarden.operators.enrich import bounded

    grams = names.select(name, F.explode(ngrams(F.col(name), n)).alias("gram"))
    return grams.join(bounded(ranks), "gram", "left").groupBy(name).agg(F.avg(F.coalesce("rank", F.lit(0))).alias("avg_rank"))


def transition_score(names: DataFrame, name: str, table: DataFrame) -> DataFrame:
    """Sum of the log probabilities of a name's neighbouring characters; ``UNSEEN`` if one pair is not in the table (pair, p)."""
    from sparkwarden.operators.enrich import bounded

    x = F.col(name)
    pairs = F.when(F.length(x) >= 2, F.transform(F.sequence(F.lit(1), F.length(x) - 1), lambda i: F.substr(x, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    spread = names.select(name, F.explode_outer(pairs).alias("pair"))
    joined = spread.join(bounded(table), "pair", "left")
    missing = F.max(F.when(F.col("pair").isNotNull() & F.col("p").isNull(), 1).otherwise(0)) == 1
    return joined.groupBy(name).agg(F.when(missing, UNSEEN).otherwise(F.coalesce(F.sum(F.log("p")), F.lit(0.0))).alias("transition"))


def split_host(hosts: DataFrame, host: str, suffixes: DataFrame) -> DataFrame:
    """``subdomain``, ``domain`` and the longest listed ``suffix`` of each host; ``No-Parse`` without one.

    Every host offers its label suffixes, which meet the list in an equi join; the longest that is listed wins.
    """
    from sparkwarden.operators.enrich import bounded

    labels = F.split(F.col(host), r"\.")
    n = F.size(labels)
    offers = F.when(n >= 2, F.transform(F.sequence(F.lit(2), n), lambda i: F.array_join(F.slice(labels, i, n), "."))).otherwise(F.array().cast("array<string>"))
    offered = hosts.select(host, F.explode_outer(offers).alias("suffix"))
    listed = bounded(suffixes.select(F.col("suffix"), F.lit(True).alias("listed")).distinct())
    best = offered.join(listed, "suffix", "left").groupBy(host).agg(F.max(F.when(F.col("listed"), F.struct(F.length("suffix").alias("size"), "suffix"))).alias("best"))
    rest = F.expr(f"substr({host}, 1, length({host}) - best.size - 1)")
    none = F.lit("No-Parse")
    found = F.col("best").isNotNull()
    return best.select(
        host,
        F.when(found, F.when(F.contains(rest, F.lit(".")), F.regexp_replace(rest, r"\.[^.]*$", "")).otherwise("")).otherwise(none).alias("subdomain"),
        F.when(found, F.substring_index(rest, ".", -1)).otherwise(none).alias("domain"),
        F.when(found, F.col("best.suffix")).otherwise(none).alias("suffix"),
    )


def numbers(text: Column, sep: str = "#") -> Column:
    """A ``#``-joined list as an array of doubles."""
    return F.transform(F.split(text, sep), lambda x: x.try_cast("double"))


def percent_decoded(text: Column) -> Column:
    """The decoded text, or the raw one where its escapes are broken."""
    return F.coalesce(F.try_url_decode(text), text)


def request_path(uri: Column) -> Column:
    return F.substring_index(uri, "?", 1)


def query_string(uri: Column) -> Column:
    """What follows the first ``?``; empty without one."""
    return F.regexp_extract(uri, r"\?(.*)$", 1)


def query_pairs(df: DataFrame, uri: str, keep: list[str]) -> DataFrame:
    """One row for each ``key=value`` of the query string; keys without a value go."""
    pairs = df.select(*keep, F.explode(F.split(query_string(F.col(uri)), "&")).alias("pair"))
    key, value = F.substring_index("pair", "=", 1), F.regexp_extract("pair", "=(.*)$", 1)
    return pairs.where(F.contains("pair", F.lit("="))).select(*keep, key.alias("param"), value.alias("value")).where("value <> ''")


def shape(text: Column) -> Column:
    """The distinct character classes of a text, sorted: U, D (upper, lower), N digits, C ideographs, P punctuation, # others."""
    one = lambda c: (
        F.when(c.rlike(r"[A-Z]"), "U").when(c.rlike(r"[a-z]"), "D").when(c.rlike(r"[0-9]"), "N").when(c.rlike(r"[\x{4E00}-\x{9FA5}]"), "C").when(c.rlike(r"[!-/:-@\[-`{-~]"), "P").otherwise("#")
    )
    return F.array_join(F.array_sort(F.array_distinct(F.transform(characters(text), one))), ",")


def spaced_tokens(text: Column) -> Column:
    """Separators padded with blanks and escapes set off, so that a tokenizer sees attack words apart."""
    out = F.lower(text)
    out = F.regexp_replace(out, r"(%[0-9a-f]{2})", r" $1 ")
    out = F.regexp_replace(out, r"([()<>=,;'\"/&?+*|-])", r" $1 ")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


# Words that confirm a request that a classifier reported.
SQL_WORDS = ["select", "union", "insert", "update", "delete", "drop"]
SCRIPT_WORDS = ["script", "alert", "onerror", "onload", "javascript", "iframe"]


def has_word(text: Column, words: list[str]) -> Column:
    return F.lower(text).rlike("|".join(words))


def safe_ratio(up: Column, down: Column) -> Column:
    """``up / down``; ``up`` itself where nothing came down."""
    return F.when(down == 0, up.cast("double")).otherwise(up / down)


def outside_range(value: Column, low: Column, high: Column, classes: Column, allowed: Column) -> Column:
    """Whether a value's length or one of its character classes is not what the baseline saw."""
    return ~F.length(value).between(low, high) | (F.size(F.array_except(F.split(classes, ","), F.split(allowed, ","))) > 0)


def snippets(df: DataFrame, key: str, text: str, words: list[str], around: int = 10, first: int = 3) -> DataFrame:
    """The first snippets of a text: the first keyword of each sentence with ``around`` characters on both sides."""
    pattern = f"(?i)(.{{0,{around}}})({'|'.join(words)})(.{{0,{around}}})"
    sentences = df.select(key, F.posexplode(F.split(text, r"[.!?\n]+")).alias("place", "sentence"))
    found = sentences.where(F.lower("sentence").rlike("|".join(words))).select(key, "place", F.regexp_extract("sentence", pattern, 0).alias("snippet"))
    return found.groupBy(key).agg(F.slice(F.array_sort(F.collect_list(F.struct("place", "snippet"))), 1, first).alias("s")).select(key, F.array_join(F.transform("s", lambda x: x["snippet"]), " ... ").alias("snippets"))


def ideographs_only(token: Column) -> Column:
    return token.rlike(r"^[\p{IsHan}]+$")


def clean_tokens(tokens: Column, stop: list[str]) -> Column:
    """Tokens of more than one character that are not only digits and not in the stop list."""
    return F.filter(tokens, lambda t: (F.length(t) > 1) & ~t.rlike("^[0-9]+$") & ~t.isin(stop))


def class_profile(text: Column) -> dict[str, Column]:
    """Counts of a metadata string's characters by class."""
    n = F.length(text)
    without = lambda p: n - F.length(F.regexp_replace(text, p, ""))
    return {"len": n, "lower": without("[a-z]"), "upper": without("[A-Z]"), "digits": without("[0-9]"), "dots": without(r"\."), "other": F.length(F.regexp_replace(text, r"[a-zA-Z0-9.]", ""))}


def structure_counts(text: Column, opens: dict[str, str]) -> dict[str, Column]:
    """How often each named pattern occurs in a raw document."""
    return {name: F.regexp_count(text, F.lit(p)) for name, p in opens.items()}
