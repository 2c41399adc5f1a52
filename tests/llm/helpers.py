"""Small tables and brute-force versions for the tests of the llm operators."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, extra=False):
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", "'x' as size", "1 as n", "2 as row", "'y' as clean", "3 as fp", "'z' as component_id") if extra else df


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def simhash(text, size=4, seed=42):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(text)
    parts = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(p.encode(), seed) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def without_repeats(texts, window=35):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def exact_groups(texts):
    groups = defaultdict(list)
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    for i, t in enumerate(norm):
        groups[t].append(i)
    return [(i, groups[t][0], len(groups[t]), groups[t][0] == i, hashlib.sha256(t.encode()).hexdigest()) for i, t in enumerate(norm)]
