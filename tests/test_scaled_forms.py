"""Forms for large keys and many files: index scans, balanced classes, count vectors, cached features."""

import os
import random
from collections import Counter

import pytest
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from sparkwarden.ml import models
from sparkwarden.operators import sequences, sets
from sparkwarden.plans import dns
from sparkwarden.plans import events as E
from sparkwarden.plans.scoring import ScoreRegistry
from sparkwarden.queries import detections
from sparkwarden.registry import QUERIES
from sparkwarden.sources import index
from sparkwarden.sources.cache import FeatureCache
from sparkwarden.streaming import jobs

from .conftest import SF

EVENTS = "id long, sec long, ip string"


def test_index_scan_opens_what_the_range_touches(spark, tmp_path):
    root = f"file://{tmp_path}/index"
    rows = [(k, k * 10, f"h{k % 3}") for k in range(100)] + [(1000, None, "x")]
    index.append_segments(spark.createDataFrame(rows[:60], EVENTS), root, "sec", 4)
    index.append_segments(spark.createDataFrame(rows[60:], EVENTS), root, "sec", 4)
    scan = lambda: index.read_segments(spark, root, "sec", EVENTS)
    assert sorted(map(tuple, scan().collect()), key=repr) == sorted(rows, key=repr)
    part = scan().where("sec >= 200 AND sec < 300 AND ip = 'h0'")
    want = sorted(r for r in rows if r[1] is not None and 200 <= r[1] < 300 and r[2] == "h0")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "segments" in plan and "ReadSchema" in plan or "BatchScan" in plan
    entries = [s for a in index._appends(root) for s in a]
    touched = [s for s in entries if s["lo"] is not None and s["lo"] < 300 and s["hi"] >= 200]
    assert 0 < len(touched) < len(entries) and part.rdd.getNumPartitions() == len(touched)
    for s in entries:  # what lies outside the range is not even there
        if s not in touched:
            (tmp_path / "index" / s["file"]).unlink()
    assert sorted(map(tuple, part.collect())) == want
    assert scan().where("sec = 250").count() == 1 and scan().where("sec > 99999").count() == 0


def test_index_stream_goes_on_after_a_restart(spark, tmp_path):
    root, folder = f"file://{tmp_path}/index", str(tmp_path / "out")
    index.append_segments(spark.createDataFrame([(1, 10, "a"), (2, 20, "a")], EVENTS), root, "sec", 2)
    run = lambda: sorted(r.id for r in jobs.drained(index.stream_segments(spark, root, "sec", EVENTS), folder=folder).collect())
    assert run() == [1, 2]
    index.append_segments(spark.createDataFrame([(3, 5, "late"), (4, 40, "a")], EVENTS), root, "sec", 2)
    assert run() == [1, 2, 3, 4] and run() == [1, 2, 3, 4]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_balanced_classes_equal_a_sort(spark, seed):
    """Ties of the scrambled key, classes of very different sizes, nulls."""
    r = random.Random(seed)
    keys = [k * 10007 + r.choice([0, 1, 5]) for k in range(400)]
    rows = [(k, r.choices(["a", "b", "c"], [1, 5, 20])[0]) for k in keys]
    df = spark.createDataFrame(rows + [(None, "a"), (3, None)], "k long, y string")
    got = sorted((x.k, x.y) for x in sets.balance_classes(df, "y", "k").collect())
    least = min(Counter(y for _, y in rows).values())
    want = sorted(x for y in "abc" for x in sorted((x for x in rows if x[1] == y), key=lambda x: (x[0] * 7919 % 10007, x[0]))[:least])
    assert got == want
    assert sets.balance_classes(df.limit(0), "y", "k").count() == 0


def test_count_vectors_equal_count_vectorizer(spark):
    r = random.Random(5)
    rows = [("hot", f"i{r.randrange(12)}") for _ in range(3000)] + [(f"e{k % 7}", f"i{r.randrange(20)}") for k in range(200)] + [("only", None), (None, "i1")]
    df = spark.createDataFrame(rows, "e string, i string")
    got = models.count_vectors(df, "e", "i", min_df=2)
    bags = df.where("e is not null").groupBy("e").agg(F.collect_list("i").alias("items"))
    other = CountVectorizer(inputCol="items", outputCol="features", minDF=2).fit(bags)
    want = {x.e: sorted(v for v in x.features.values) for x in other.transform(bags).collect()}
    assert {x.e: sorted(x.features.values) for x in got.collect()} == want
    assert {x.features.size for x in got.collect()} == {len(other.vocabulary)}
    totals = Counter(i for e, i in rows if e and i)
    order = [x for x, _ in sorted(totals.items(), key=lambda t: (-t[1], t[0]))]
    hot = next(x.features for x in got.collect() if x.e == "hot")
    per = Counter(i for e, i in rows if e == "hot")
    assert {order[int(k)]: v for k, v in zip(hot.indices, hot.values, strict=True)} == {k: float(v) for k, v in per.items()}
    assert models.clusters(got, "e", k=2).count() == len(want)
    small = models.count_vectors(df, "e", "i", vocabulary=3)
    assert {x.features.size for x in small.collect()} == {3} and small.count() == len(want)


def test_known_files_are_not_read_again(spark, tmp_path):
    """A file whose content changes while name, length and time stay is not noticed: its content was not read."""
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.pdf").write_bytes(b"%PDF obj obj \xff")
    (source / "b.pdf").write_bytes(b"%PDF obj")
    (source / "c.txt").write_bytes(b"text obj")
    cache = FeatureCache(spark, str(tmp_path / "cache"), {"objs": F.regexp_count("text", F.lit("obj")), "size": F.length("text")})
    rows = lambda: {r.path.rsplit("/", 1)[-1]: (r.objs, r["size"]) for r in cache.read().collect()}
    assert rows() == {}
    assert cache.update(str(source), "*.pdf", b"%PDF") == 2 and rows() == {"a.pdf": (2, 14), "b.pdf": (1, 8)}
    before = os.stat(source / "b.pdf")
    (source / "b.pdf").write_bytes(b"%PDF xxx")
    os.utime(source / "b.pdf", ns=(before.st_atime_ns, before.st_mtime_ns))
    (source / "d.pdf").write_bytes(b"%PDF")
    assert cache.update(str(source), "*.pdf", b"%PDF") == 1 and rows() == {"a.pdf": (2, 14), "b.pdf": (1, 8), "d.pdf": (0, 4)}
    assert cache.update(str(source), "*.pdf", b"%PDF") == 0
    (source / "b.pdf").write_bytes(b"%PDF obj obj")  # longer: a changed file is read, and its newest row counts
    assert cache.update(str(source), "*.pdf") == 1 and rows()["b.pdf"] == (2, 12) and len(rows()) == 3


def test_scores_of_a_day_rest_on_earlier_labels(spark, tmp_path):
    registry = ScoreRegistry(spark, str(tmp_path / "scores"))
    flags = lambda *on: [1 if k in on else 0 for k in E.KINDS]
    columns = ", ".join(f"{k} int" for k in E.KINDS) + ", label int"
    bad = lambda kind: [(*flags(kind), 1)] * 8 + [(*flags("covert_channel"), 1)] * 3 + [(*flags("covert_channel"), 0)] * 2 + [(*flags("up_down"), 0)] * 8 + [(*flags(), 0)] * 4
    assert registry.for_day(9)[0] == dict.fromkeys(E.KINDS, 0.1) and registry.for_day(9)[1].count() == 0
    registry.learn(spark.createDataFrame(bad("botnet"), columns), 10)
    first, rules = registry.for_day(11)
    assert max(first, key=first.get) == "botnet" and abs(sum(first.values()) - 1) < 1e-4
    assert [(r.botnet, r.heartbeat, r.pattern_score) for r in rules.collect()] == [(1, 0, 100.0)]
    registry.learn(spark.createDataFrame(bad("heartbeat"), columns), 12)
    registry.learn(spark.createDataFrame(bad("threat"), columns), 12)  # learned already
    assert registry.for_day(11)[0] == first and registry.for_day(12)[0] == first and max(registry.for_day(13)[0], key=registry.for_day(13)[0].get) == "heartbeat"
    registry.learn(spark.createDataFrame([(*flags("threat"), 1)] * 3, columns), 14)  # one class only
    assert registry.for_day(15)[0] == dict.fromkeys(E.KINDS, 0.1)


@pytest.mark.parametrize("stretches", [1, 3, 7, 4096])
def test_gaps_in_stretches_equal_a_sorted_list(spark, monkeypatch, stretches):
    """Busy and rare keys, null keys and times, equal times."""
    monkeypatch.setattr(sequences, "STRETCHES", stretches)
    r = random.Random(stretches)
    rows = [(r.choice(["hot", "hot", "hot", "b", None]), r.randrange(0, 500), k) for k in range(300)] + [("few", 3, 900), ("few", 4, 901), ("hot", None, 902)]
    got = sorted((x.e, x.t, x.i, x.gap, x.k) for x in sequences.gaps(spark.createDataFrame(rows, "e string, t long, i long"), ["e"], "t", "i").fillna("-", ["e"]).collect())
    want = []
    for e in {x[0] for x in rows}:
        own = sorted((t, i) for k, t, i in rows if k == e and t is not None)
        if len(own) >= 4:
            want += [(e or "-", own[n][0], own[n][1], own[n][0] - own[n - 1][0], n + 1) for n in range(1, len(own))]
    assert got == sorted(want)
    assert sequences.gaps(spark.createDataFrame([], "e string, t long, i long"), ["e"], "t", "i").count() == 0


def test_models_learn_what_is_planted(spark):
    """Held-out quality: boosted trees and forest on DNS records, names, injections."""
    for name, least in (("ml1_boosted_scores", 0.9), ("ml2_cross_validated_forest", 0.85)):
        held = QUERIES[name](spark, SF).where("flow_id % 10 >= 7")
        assert held.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0] > least
        assert held.where("label = 1 AND prediction = 1").count() > 10
    for kind, name in (("sql", "dt11_sql_injections"), ("script", "dt12_script_injections")):
        bad = {x.flow_id for x in detections.planted_requests(spark, SF, kind).where("label = 1 AND flow_id % 10 >= 7").collect()}
        found = {x.flow_id for x in QUERIES[name](spark, SF).collect()}
        assert len(found & bad) > 0.8 * len(bad) > 0 and len(found - bad) <= 0.2 * len(found)
    listed, pages = detections.listed_names(spark, SF)
    bad = {x.queries_name for x in listed.collect()}
    found = {x.queries_name for x in dns.detected_names(pages.select("queries_name").distinct(), listed, pages).collect()}
    assert len(found & bad) > 0.7 * len(bad) > 0 and len(found - bad) <= 0.3 * len(found)
