import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkwarden.llm import decontaminate, labelled, quality, toxicity, url_filter
from sparkwarden.llm.queries import URL_RULES

from .helpers import docs_of, rows_of
from .test_dedup import ODD, SF, table_texts


def brute_url(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.split(r"[?#]", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for verdict, rule in rules:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and (not slash or path.startswith("/" + p)):
            fits.append((len(rule), len(h), verdict == "block", rule, verdict))
    best = max(fits, default=(0, 0, 0, None, default))
    return host, path, best[3], best[4]


@pytest.mark.parametrize("size", [1_000_000, 2])
def test_urls(spark, size):
    rng = random.Random(2)
    rules = [*URL_RULES, ("block", "com"), ("allow", "a.com/x/y"), ("block", "a.com/x/y"), ("allow", "b.a.com/x"), ("block", "a.com/")]
    urls = [None, "", "nothing", "http://", "://org", "HTTP://EXAMPLE.ORG/es/", "http://example.org/en/1", "https://x.example.org/en/17?q", "http://example.org", "http://xexample.org/es/1", "http://a.com/x/yz/w", "http://b.a.com/x/y", "http://org/#/es/", "http://example.org/es", "a://b://c.org/", "http://a.org:80/", "http://com/fr/" + "x" * 9000]
    for _ in range(300):
        urls.append("://" + ".".join(rng.choice(["a", "b", "example", "org", "com", "fr", "M"]) for _ in range(rng.randint(1, 4))) + "".join("/" + rng.choice(["es", "en", "1", "12", "fr", "de", "x", "y", ""]) for _ in range(rng.randint(0, 4))) + rng.choice(["", "?a=/b", "#c"]))
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = rows_of(url_filter.judge_urls(df, rules, max_rules=size), "page_id", "host", "path", "rule", "verdict")
    assert got == sorted(((i, *brute_url(u, rules)) for i, u in enumerate(urls)), key=repr)
    assert url_filter.judge_urls(df.limit(0), rules).count() == 0
    assert rows_of(url_filter.judge_urls(df.limit(1), []), "rule", "verdict") == [(None, "allow")]


def brute_overlap(text, item, overlap=12, share=0.8):
    """Any diagonal with enough agreeing words: every pair of places is tried."""
    tok = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[!-/:-@\[-`{-~]", " ", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))
    a, b = tok(text), tok(item)
    n = min(overlap, len(b))
    if len(b) < 5:
        return False
    for i in range(len(a) - n + 1):
        for j in range(len(b) - n + 1):
            if sum(x == y for x, y in zip(a[i : i + n], b[j : j + n], strict=True)) >= share * n:
                return True
    return False


def test_contamination(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(5))
    items = [" ".join(word() for _ in range(n)) for n in (4, 5, 6, 9, 11, 12, 15, 40, 60)] + ["", None]
    texts = list(ODD)
    for item in items[:-2]:
        w = item.split()
        fill = [" ".join(word() for _ in range(30)) for _ in range(2)]
        texts += [f"{fill[0]} {item} {fill[1]}", item, item.upper().replace(" ", ", "), f"{fill[0]} {' '.join(w[: len(w) // 2])} {fill[1]}"]
        for every in (7, 8):
            texts.append(fill[0] + " " + " ".join(word() if k % every == every - 1 else x for k, x in enumerate(w)))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = rows_of(decontaminate.contamination(docs_of(spark, texts, True), bench), "doc_id", "contaminated", "items")
    want = [(i, bool(found := [j for j, b in enumerate(items) if brute_overlap(t, b)]), found) for i, t in enumerate(texts)]
    assert got == sorted(want, key=repr)
    kept = decontaminate.drop_contaminated(docs_of(spark, texts, True), bench)
    assert rows_of(kept, "doc_id") == sorted(((i,) for i, hit, _ in want if not hit), key=repr)
    assert decontaminate.contamination(docs_of(spark, []), bench).count() == 0
    assert rows_of(decontaminate.contamination(docs_of(spark, ["a b"]), bench.limit(0)), "contaminated", "n_items") == [(False, 0)]


def test_seeds_hit_substituted_stretches():
    """Of 12 aligned words with one substitution every place is hit, with two nearly every pair of places."""
    hit = lambda off: any(all(p + k not in off for k, c in enumerate(m) if c == "1") for m in decontaminate.MASKS for p in range(12 - len(m) + 1))
    assert all(hit({i}) for i in range(12))
    pairs = [{i, j} for i in range(12) for j in range(i)]
    assert sum(map(hit, pairs)) >= 0.9 * len(pairs)


def test_masks_hit_every_placement():
    """Whatever words of an item of 5 to 12 are substituted, up to the share that is allowed, one mask hits."""
    hit = lambda n, off, masks: any(all(p + k not in off for k, c in enumerate(m) if c == "1") for m in masks for p in range(n - len(m) + 1))
    assert all(hit(12, off, decontaminate.MASKS) for off in itertools.combinations(range(12), 2))
    for n in range(5, 12):
        assert all(hit(n, off, decontaminate.SHORT_MASKS) for off in itertools.combinations(range(n), int(0.2 * n + 1e-9)))


def test_substitutions_anywhere(spark):
    """Items of 5 to 12 words are found with every placement of as many other words as are allowed, and with no more."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(6))
    items, texts, want = [" ".join(word() for _ in range(n)) for n in range(5, 13)], [], []
    for item in items:
        w = item.split()
        most = int(0.2 * len(w) + 1e-9)
        for changed in (most, most + 1):
            for off in itertools.combinations(range(len(w)), changed):
                texts.append(f"{word()} {' '.join(word() if k in off else x for k, x in enumerate(w))} {word()}")
                want.append(changed == most)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontaminate.contamination(docs_of(spark, texts, True), bench)
    assert rows_of(got, "doc_id", "contaminated") == sorted(enumerate(want), key=repr)


def tables(spark, sf):
    return (spark.read.parquet(f"/root/testdata/{sf}/{n}.parquet") for n in ("documents", "labels"))


def held_out_scores(spark, frame, labels, column):
    return frame.join(labels.select("doc_id", column), "doc_id").where("held_out").select("score", "predicted", column).toPandas()


def test_quality(spark):
    docs, labels = tables(spark, "sf0.1")
    out = quality.score_quality(docs, labels).cache()
    assert out.count() == docs.count() and out.where("score < 0 or score > 1 or score is null").count() == 0
    found = held_out_scores(spark, out, labels, "quality")
    good, bad = found[found.quality == 1], found[found.quality == 0]
    assert (good.predicted == 1).mean() > 0.97 and (bad.predicted == 0).mean() > 0.8


def test_quality_is_rules_times_weights(spark):
    """The compiled expression gives what plain Python makes of each text's statistics, rule by rule."""
    docs, labels = tables(spark, "sf0.001")
    sample = labelled.training_sample(docs, labels, "quality", {0: 500, 1: 500})
    model = quality.fit_rules(sample)
    assert model.rules
    rows = quality.with_statistics(docs, "text", ["doc_id"])
    rows = rows.withColumn("score", model.score({n: F.col(f"__{n}") for n in quality.NAMES})).collect()
    for r in rows:
        holds = [all((r[f"__{n}"] <= t) == below for n, below, t in rule) for rule, _ in model.rules]
        total = model.intercept + sum(w for (_, w), h in zip(model.rules, holds, strict=True) if h)
        assert abs(r["score"] - 1 / (1 + math.exp(-total))) < 1e-9


def test_quality_edges(spark):
    docs, labels = tables(spark, "sf0.001")
    odd = docs_of(spark, ODD, True)
    assert quality.score_quality(odd, labels.limit(0)).where("score <> 0.5 or score is null").count() == 0
    extra = odd.withColumn("upper", odd["text"])
    out = quality.score_quality(docs.select("doc_id", "text").unionByName(extra.select("doc_id", "text")), labels)
    assert out.count() == docs.count() + len(ODD) and out.where("score is null or predicted is null").count() == 0


def test_gradients():
    """The network's gradients agree with finite differences."""
    rng = np.random.default_rng(0)
    net = toxicity.train(["a b c d", "e f g h"], [0, 1], steps=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rows = net.inputs(["alpha", "beta", "gamma", "delta", "word"])
    index, mask = rng.integers(0, 5, (toxicity.WINDOW, 3)), np.ones((toxicity.WINDOW, 3))
    mask[20:, 1] = 0
    target = np.array([0.0, 1.0, 1.0])

    def loss():
        z = net.run(net.project(net.vectors(rows))[index], mask).astype(np.float64)
        return float((np.logaddexp(0, z) - target * z).mean())

    grads = toxicity._gradients(net, rows, index, mask, lambda z: (toxicity._sigmoid(z) - target) / 3)
    for name, grad in grads.items():
        p = net.p[name]
        if isinstance(grad, tuple):
            full = np.zeros_like(p)
            np.add.at(full, grad[0], grad[1])
            grad = full
        where = np.unravel_index(np.argsort(-np.abs(grad).ravel())[:2], p.shape)
        for at in zip(*where, strict=True):
            old, eps = p[at], 2e-2
            p[at] = old + eps
            up = loss()
            p[at] = old - eps
            down = loss()
            p[at] = old
            assert abs((up - down) / (2 * eps) - grad[at]) < 0.02 * abs(grad[at]) + 2e-4, name


def test_windows():
    for n in (0, 1, 31, 32, 33, 48, 49, 1000):
        starts = toxicity.window_starts(n)
        assert {k for s in starts for k in range(s, min(n, s + toxicity.WINDOW))} == set(range(n))


def test_long_runs_are_read_whole():
    """Of a text without blanks every character reaches the score."""
    for n in (39, 40, 41, 70, 71, 100, 1000):
        run = "".join(chr(97 + (k * k + k // 7) % 26) for k in range(n))
        got = toxicity.tokens(f"a {run} b")
        assert all(any(run[k : k + toxicity.OVERLAP] in w for w in got) for k in range(n - toxicity.OVERLAP + 1)) and max(map(len, got)) <= toxicity.PIECE
    rng = random.Random(6)
    clean = lambda k: ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(k)]
    texts = [" ".join([*clean(10), *["vilezwqx"] * (k % 2), *clean(10)]) for k in range(200)]
    scorer = toxicity.Scorer(toxicity.train(texts, [k % 2 for k in range(200)], steps=150))
    before, after = "_".join(clean(10)), "_".join(clean(10))
    plain, vile = scorer.scores([f"{before}_{after}", f"{before}_vilezwqx_vilezwqx_vilezwqx_{after}"])
    assert vile > plain


def test_toxicity_scores_are_the_best_windows():
    """A document's score, from caches and batches of windows, is the best of its windows run one by one."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 60)))
    texts = [" ".join(word() for _ in range(n)) for n in (0, 1, 5, 31, 32, 33, 40, 48, 49, 200, 500)] + [None, "  \n "]
    net = toxicity.train([t for t in texts if t], [k % 2 for k in range(len([t for t in texts if t]))], steps=5)
    got = toxicity.Scorer(net).scores(texts)
    for text, score in zip(texts, got, strict=True):
        words = toxicity.tokens(text) or [""]
        best = -np.inf
        for s in toxicity.window_starts(len(words)):
            gates = net.project(net.vectors(net.inputs(words[s : s + toxicity.WINDOW])))
            best = max(best, float(net.run(gates[:, None, :], None)[0]))
        assert abs(score - 1 / (1 + math.exp(-best))) < 1e-4


def test_excerpts():
    words = [f"w{k}" for k in range(5000)]
    assert toxicity.excerpt(" ".join(words[:800])) == " ".join(words[:800])
    taken = toxicity.excerpt(" ".join(words)).split()
    assert len(taken) == toxicity.TRAIN_WORDS and taken[0] == "w0" and taken[-1] == "w4999"
    assert len(toxicity.excerpt("x" * 10**6).split()) <= toxicity.TRAIN_WORDS and toxicity.excerpt(None) == ""


def test_agreement_of_spans():
    """Best shares around hits, all pairs at once, against one by one."""
    rng = random.Random(3)
    spans, hits, sizes, want = ([], []), ([], []), [], []
    for _ in range(300):
        a, b = ([rng.randint(0, 2) for _ in range(rng.randint(1, 30))] for _ in range(2))
        i, j, n = rng.randrange(len(a)), rng.randrange(len(b)), rng.choice([5, 8, 12])
        back = min(i, j)
        room = min(len(a) - i, len(b) - j) + back
        x, y = a[i - back : i - back + room], b[j - back : j - back + room]
        want.append(max((sum(p == q for p, q in zip(x[k : k + n], y[k : k + n], strict=True)) / n for k in range(room - n + 1)), default=0))
        for side, span, at in zip((0, 1), (a, b), (i, j), strict=True):
            spans[side].append(np.array(span, np.uint32).tobytes())
            hits[side].append(at)
        sizes.append(n)
    got = decontaminate.agreements(pa.array(spans[0], pa.binary()), np.array(hits[0]), pa.array(spans[1], pa.binary()), np.array(hits[1]), np.array(sizes))
    assert np.allclose(got, want)


def test_short_items_on_demand(spark):
    bench = spark.createDataFrame([(0, "alpha beta"), (1, "gamma"), (2, "Alpha, beta")], "item_id long, text string")
    docs = docs_of(spark, ["x alpha beta y", "alpha x beta", "Gamma!", None])
    assert rows_of(decontaminate.contamination(docs, bench), "contaminated").count((True,)) == 0
    got = rows_of(decontaminate.contamination(docs, bench, min_words=1), "doc_id", "items")
    assert got == [(0, [0, 2]), (1, []), (2, [1]), (3, [])]


def test_toxicity(spark):
    docs, labels = tables(spark, "sf0.1")
    out = toxicity.score_toxicity(docs, labels).cache()
    assert out.count() == docs.count() and out.where("score < 0 or score > 1 or score is null").count() == 0
    found = held_out_scores(spark, out, labels, "toxic")
    bad, good = found[found.toxic == 1], found[found.toxic == 0]
    print("toxic", (bad.predicted == 1).mean(), "clean", (good.predicted == 0).mean())
    assert (bad.predicted == 1).mean() > 0.7 and (good.predicted == 0).mean() > 0.97


def test_toxicity_edges(spark):
    docs, labels = tables(spark, "sf0.001")
    odd = docs_of(spark, [*ODD, "w " * 5000], True)
    assert toxicity.score_toxicity(odd, labels.limit(0)).where("score is null").count() == 0
    kept = toxicity.drop_toxic(odd, labels.limit(0), threshold=0.6)
    assert sorted(kept.columns) == sorted(odd.columns) and kept.count() == odd.count()
    assert toxicity.score_toxicity(odd.limit(0), labels).count() == 0


def test_held_out(spark):
    got = dict(rows_of(docs_of(spark, ODD * 3).withColumn("h", labelled.held_out(F.col("doc_id"))), "doc_id", "h"))
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in got}
