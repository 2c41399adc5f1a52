"""Personal data by weak supervision: labellers vote on candidate spans, EM weighs them, a span classifier decides.

DataFrame functions only.  A *base* span is a match of a kind's pattern that passes its test; it always stays.  Other
candidates are matches of looser patterns outside the base spans of their kind (numbers that ran into one another,
spelled-out addresses, groups without a country code).  On every candidate, base ones included, five labellers vote for,
against or not at all: the strict pattern, a gazetteer, the words before, the characters around, and plausibility.
Expectation-maximisation over the counts of vote patterns (at most 4 x 3^5 of them) estimates each labeller's
reliability and how likely each pattern is personal data; with these soft labels a logistic model of the span's own
features is fitted, and it decides on the candidates that are not base spans.

Patterns are written so that time stays linear in the text: runs are possessive and start where no run goes on.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwarden.storage import discard, written

# Kinds in the order of the result, and the base pattern of each (leftmost, not overlapping).
KINDS = ["email", "ip", "card", "phone"]
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?: ?[\[({] ?(?:at|AT|@) ?[\])}] ?[A-Za-z0-9-]{1,63}(?:(?:\.| ?[\[({] ?(?:dot|DOT|\.) ?[\])}] ?| dot )[A-Za-z0-9-]{1,63}){1,4}"
    r"| at [A-Za-z0-9-]{1,63}(?: dot [A-Za-z0-9-]{1,63}){1,4})",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?: ?[\[(]\.[\])] ?[0-9]{1,3}){3}(?![0-9])|(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])(?:[0-9]{4}[ -]?){3}[0-9]{4}(?![0-9])|(?<![0-9])3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}(?![0-9])",
    "phone": r"(?<![0-9+])\+[0-9]{1,3}[ .-]?\([0-9]{1,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])|(?<![0-9+])(?:\+|00)[0-9]{1,3}(?:[ .-][0-9]{2,4}){2,4}(?![0-9])"
    r"|(?<![0-9+(])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9+.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9.-])",
}
#: What a text must hold for a pattern to be tried at all.
NEEDS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
LOOSE_NEEDS = {"email": r"[\[({] ?(?:at|AT|@)| dot ", "ip": r"[\[(]\.[\])]|[0-9A-Fa-f]:[0-9A-Fa-f]", "card": "[0-9]{4}", "phone": "[0-9]{3}"}
# The gazetteers, words that tell kinds (four languages) and words that tell other numbers.
TLDS = "com org net edu gov mil int info biz io dev app ai eu de at ch fr be nl lu es pt it uk us ca mx br ar cl co pl cz se no dk fi ru ua in cn jp kr au nz za"
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 351 352 353 358 380 420"
ISSUERS = r"^(?:4|5[1-5]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|3[47]|6011|65|62)"
NOT_PERSONAL_IP = r"^0*(?:0|10|127|22[4-9]|2[34][0-9]|25[0-5])\.|^0*192\.0*168\.|^0*172\.0*(?:1[6-9]|2[0-9]|3[01])\."
CUES = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|contacto|correo|courriel|kontakt|write to|reach)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|from|login|adresse|dirección|client)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta|payment)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|telefon|téléphone|teléfono|call|mobile|fax|cell|handy)\b",
}
OTHER_NUMBERS = r"(?i)\b(?:version|build|isbn|issn|order|invoice|ref|page|token|hash|key|sha|md5|id|section|chapter|total|price)\b\W*$|[=\"'#$€£]\s*$"

#: Characters before a candidate that the context labeller reads, at most.
CONTEXT = 40
VOTERS = 5
#: Positions that one inner step of ``starts`` adds up.
CHUNK = 256
#: What the labellers are taken to be before any data: pseudo-counts of votes against, for, and none.
PRIOR = {1: (1.0, 4.0, 2.0), 0: (4.0, 1.0, 2.0)}


def _luhn(digits: Column) -> Column:
    """Whether a string of 13 to 19 digits passes the Luhn check; false for others."""
    signs = F.split(F.reverse(digits), "")
    weighed = F.transform(signs, lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise((2 * x.cast("int")) % 10 + (x.cast("int") / 5).cast("int")))
    return F.when(F.length(digits).between(13, 19), F.aggregate(weighed, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0).otherwise(False)


def _passes(kind: str, s: Column) -> Column:
    """Whether a match of a base pattern counts."""
    digits = F.regexp_replace(s, "[^0-9]", "")
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return s.rlike(rf"^(?:{part}\.){{3}}{part}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & _luhn(digits)
    return F.length(digits).between(8, 15) if kind == "phone" else F.lit(True)


def starts(lengths: Column) -> Column:
    """Of an array of lengths, the sum of those before each: chunk by chunk, so that no long array is copied again and again."""
    one = F.struct(F.lit(0).alias("to"), F.array().cast("array<int>").alias("at"))
    shape = "array<struct<to:int,at:array<int>>>"

    def chunk(done: Column, k: Column) -> Column:
        begin = F.struct(F.element_at(done, -1)["to"].alias("to"), F.array().cast("array<int>").alias("at"))
        add = lambda a, n: F.struct((a["to"] + n).alias("to"), F.concat(a["at"], F.array(a["to"])).alias("at"))
        return F.concat(done, F.array(F.aggregate(F.slice(lengths, k + 1, F.lit(CHUNK)), begin, add)))

    chunks = F.aggregate(F.sequence(F.lit(0), F.size(lengths) - 1, F.lit(CHUNK)), F.array(one).cast(shape), chunk)
    return F.flatten(F.transform(chunks, lambda c: c["at"]))


def _matches(df: DataFrame, text: str, kind: str, pattern: str, needs: str) -> DataFrame:
    """``df`` with ``<kind>_parts`` (the text between matches) and ``<kind>_found``: (s, start, before, after) of each match."""
    pieces, found, at = f"{kind}_parts", f"{kind}_raw", f"{kind}_at"
    tried = F.col(text).rlike(needs)
    df = df.withColumns({pieces: F.when(tried, F.split(text, pattern, -1)), found: F.when(tried, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))})
    lengths = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, f: F.length(p) + F.length(f))
    df = df.withColumn(at, F.when(F.size(found) > 0, starts(lengths)))
    whole = F.zip_with(
        F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, f: F.struct(f.alias("s"), F.length(p).alias("skip"), F.right(p, F.lit(CONTEXT)).alias("before"))),
        F.zip_with(at, F.slice(pieces, 2, F.size(found)), lambda a, p: F.struct(a.alias("at"), F.left(p, F.lit(1)).alias("after"))),
        lambda m, n: F.struct(m["s"].alias("s"), (m["skip"] + n["at"]).alias("start"), m["before"].alias("before"), n["after"].alias("after")),
    )
    return df.withColumn(f"{kind}_found", F.when(F.size(found) > 0, whole))


def _vote(yes: Column, no: Column) -> Column:
    """``+`` for, ``-`` against, ``.`` for no vote."""
    return F.when(F.coalesce(yes, F.lit(False)), "+").when(F.coalesce(no, F.lit(False)), "-").otherwise(".")


def _judged(kind: str, base: bool) -> Callable[[Column], Column]:
    """A candidate as (kind, start, stop, base, votes, features): what labellers say and what the classifier sees."""

    def judged(m: Column) -> Column:
        s, before, after = m["s"], m["before"], m["after"]
        digits = F.regexp_replace(s, "[^0-9]", "")
        n = F.length(digits)
        no = F.lit(False)
        glued = before.rlike(r"[\p{L}\p{N}_]$") | after.rlike(r"^[\p{L}\p{N}_]")
        free = (before == "") | before.rlike(r"[\s(\[<:;,|]$")
        free &= (after == "") | after.rlike(r"^[\s)\]>:;,.!?|]")
        cue, other = before.rlike(CUES[kind]), before.rlike(OTHER_NUMBERS)
        tail = F.lower(F.regexp_extract(s, r"([A-Za-z0-9-]+)$", 1))
        if kind == "email":
            known, unknown = tail.isin(TLDS.split()), ~tail.rlike("^[a-z]{2,}$")
            sound, unsound = s.rlike(r"^[^@ ]*[A-Za-z]") & tail.rlike("^[a-z]{2,24}$"), tail.rlike("[0-9]") | s.rlike(r"^[._%+-]")
        elif kind == "ip":
            known, unknown = no, s.rlike(NOT_PERSONAL_IP)
            sound = s.rlike(r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:[^0-9A-Fa-f:]+|$)){4}$") | s.rlike("^(?:[0-9A-Fa-f]{1,4}:){7}")
            unsound = s.rlike(r"(?:^|[^0-9A-Fa-f:])0[0-9]")
        elif kind == "card":
            known, unknown = digits.rlike(ISSUERS), ~digits.rlike("^[2-6]")
            sound, unsound = _luhn(digits), ~_luhn(digits)
        else:
            code = F.regexp_extract(s, r"^(?:\+|00)([0-9]{1,3})", 1)
            known = F.exists(F.array(*[F.lit(c) for c in CALLING_CODES.split()]), lambda c: code.startswith(c) & (code != ""))
            unknown = (code != "") & ~known
            sound, unsound = n.between(9, 13), (n < 8) | (n > 15)
        strict = F.lit(True) if base else (s.rlike(rf"^(?:{BASE[kind]})$") & _passes(kind, s))
        votes = F.concat(_vote(strict, ~strict if not base else no), _vote(known, unknown), _vote(cue, other), _vote(free & ~glued, glued), _vote(sound, unsound))
        grouped = s.rlike(r"[0-9][ ().-]+[0-9]") if kind in ("card", "phone") else s.rlike(r"[\[({ ]")
        marks = [F.lit(base), cue, other, glued, free, grouped, known, unknown, sound, unsound]
        features = F.concat(*[F.when(F.coalesce(x, no), "1").otherwise("0") for x in marks])
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), m["start"].alias("start"), (m["start"] + F.length(s)).alias("stop"), F.lit(base).alias("base"), votes.alias("votes"), features.alias("features"))

    return judged


FEATURES = 10
_SPAN = "array<struct<kind:int,start:int,stop:int,base:boolean,votes:string,features:string>>"


def candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, spans)``: base spans and other candidates of each text, with votes and features. One pass, no shuffle."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = []
    for kind in KINDS:
        df = _matches(df, "text", kind, BASE[kind], NEEDS[kind])
        passing = F.filter(f"{kind}_found", lambda m: _passes(kind, m["s"]))
        # The kind's base spans become lines of the same length, so that no looser match overlaps them.
        raw = F.col(f"{kind}_raw")
        blank = F.transform(raw, lambda f: F.when(_passes(kind, f), F.repeat(F.lit("\n"), F.length(f))).otherwise(f))
        glue = F.zip_with(f"{kind}_parts", blank, lambda p, f: F.concat(p, F.coalesce(f, F.lit(""))))
        df = df.withColumn(f"{kind}_base", passing)
        df = df.withColumn(f"{kind}_rest", F.when(F.size(f"{kind}_base") > 0, F.array_join(glue, "")).otherwise(F.col("text")))
        df = df.select("doc_id", "text", *[p for p in parts], f"{kind}_base", f"{kind}_rest")
        df = _matches(df, f"{kind}_rest", kind, LOOSE[kind], LOOSE_NEEDS[kind])
        empty = F.array().cast(_SPAN)
        both = F.concat(F.coalesce(F.transform(f"{kind}_base", _judged(kind, True)), empty), F.coalesce(F.transform(f"{kind}_found", _judged(kind, False)), empty))
        df = df.select("doc_id", "text", *parts, both.cast(_SPAN).alias(f"{kind}_spans"))
        parts.append(f"{kind}_spans")
    return df.select("doc_id", F.concat(*parts).alias("spans"))


def reliabilities(counts: dict[tuple[int, str], int], rounds: int = 200) -> dict[tuple[int, str], float]:
    """EM over vote patterns: of each (kind, votes), the probability that such a candidate is personal data.

    For each kind the labellers vote independently given the truth; pseudo-counts say that a vote is more often right.
    The table is bounded by the number of kinds and labellers, whatever the corpus.
    """
    out = {}
    for kind in sorted({k for k, _ in counts}):
        own = {votes: n for (k, votes), n in counts.items() if k == kind}
        belief = {votes: (1 + votes.count("+")) / (2 + votes.count("+") + votes.count("-")) for votes in own}
        for _ in range(rounds):
            share = {1: 2.0, 0: 2.0}
            told = {c: [dict(zip("-+.", PRIOR[c], strict=True)) for _ in range(VOTERS)] for c in (0, 1)}
            for votes, n in own.items():
                for c, p in ((1, belief[votes]), (0, 1 - belief[votes])):
                    share[c] += n * p
                    for j, v in enumerate(votes):
                        told[c][j][v] += n * p
            after = {}
            for votes in own:
                logs = [math.log(share[c]) + sum(math.log(told[c][j][v] / sum(told[c][j].values())) for j, v in enumerate(votes)) for c in (0, 1)]
                after[votes] = 1 / (1 + math.exp(min(max(logs[0] - logs[1], -500), 500)))
            moved = max(abs(after[v] - belief[v]) for v in own)
            belief = after
            if moved < 1e-9:
                break
        out |= {(kind, votes): p for votes, p in belief.items()}
    return out


def _vector(span: Column) -> list[Column]:
    """The features of a span and, for each kind, the features of spans of that kind, as 0.0 or 1.0."""
    bits = [F.when(F.substring(span["features"], k + 1, 1) == "1", 1.0).otherwise(0.0) for k in range(FEATURES)]
    return bits + [F.when(span["kind"] == c, b).otherwise(0.0) for c in range(len(KINDS)) for b in [F.lit(1.0), *bits]]


def fit_classifier(spans: DataFrame) -> Callable[[Column], Column] | None:
    """From ``spans`` (kind, votes, features: one row per candidate) the probability of a span, or None without candidates."""
    grouped = written(spans.groupBy("kind", "votes", "features").agg(F.count(F.lit(1)).alias("n")), "votes")
    counts = {(r.kind, r.votes): r.n for r in grouped.groupBy("kind", "votes").agg(F.sum("n").alias("n")).collect()}
    if not counts:
        discard(grouped)
        return None
    belief = reliabilities(counts)
    keyed = F.create_map(*[x for (kind, votes), p in sorted(belief.items()) for x in (F.lit(f"{kind}{votes}"), F.lit(float(p)))])
    p = F.element_at(keyed, F.concat(F.col("kind").cast("string"), F.col("votes")))
    soft = grouped.withColumn("p", p).groupBy("kind", "features").agg(F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no"))
    span = F.struct("kind", "features")
    cases = soft.select(array_to_vector(F.array(*_vector(span))).alias("x"), F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("yes").alias("weight")), F.struct(F.lit(0.0).alias("label"), F.col("no").alias("weight")))).alias("case")).select("x", "case.*").where("weight > 0")
    model = LogisticRegression(featuresCol="x", labelCol="label", weightCol="weight", regParam=1e-4, maxIter=100, standardization=False).fit(cases.orderBy("label", F.col("x").cast("string")))
    weights, bias = [float(w) for w in model.coefficients], float(model.intercept)
    discard(grouped)

    def probability(span: Column) -> Column:
        total = F.lit(bias)
        for w, f in zip(weights, _vector(span), strict=True):
            if w:
                total = total + F.lit(w) * f
        return 1 / (1 + F.exp(-total))

    return probability


def _listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, by kind, then start."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: id, base spans per kind (``n_email``...), ``base_sha256``, ``spans``, ``n_added``.

    ``spans`` lists all spans, base and added; added ones never overlap a base span of their kind.  Places are code
    points, ends exclusive.  Null and empty texts have no spans; a corpus without any candidate gets none added.  Rows
    are judged one by one with the same model: repeated or missing ids change nothing.  An empty table gives an empty
    result; other columns are not looked at.
    """
    found = written(candidates(docs, id_col, text_col), "candidates")
    probability = fit_classifier(found.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.features"))
    base = F.filter("spans", lambda s: s["base"])
    added = F.filter("spans", lambda s: ~s["base"] & (probability(s) >= threshold)) if probability else F.filter("spans", lambda s: F.lit(False))
    rows = found.select("doc_id", base.alias("base"), added.alias("added"))
    of = [F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return rows.select(
        F.col("doc_id").alias(id_col), *of, F.sha2(F.encode(_listed(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        _listed(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )
