"""Hand-computed cases: nulls, ties, single rows, zero denominators, empty tables."""

import math
import random

import pytest
from pyspark.sql import functions as F

from sparkwarden.functions import strings as S
from sparkwarden.operators import aggregates as A
from sparkwarden.operators import enrich as E
from sparkwarden.operators import graph as G
from sparkwarden.operators import runs
from sparkwarden.operators import sequences as Q
from sparkwarden.operators.runs import longest_slot_run
from sparkwarden.plans import flows, hosts


def one(spark, value, *columns):
    kind = "string" if isinstance(value, str) or value is None else "array<double>"
    return tuple(spark.createDataFrame([(value,)], f"x {kind}").select(*columns).first())


@pytest.mark.parametrize("gaps,score", [([10.0] * 4, 0.75), ([10.0] * 6, 5 / 6), ([0.0] * 4, None), ([5.0], None), ([], None)])
def test_strided_autocorrelation(spark, gaps, score):
    got = one(spark, gaps, Q.strided_autocorrelation(F.col("x")))[0]
    assert got is None if score is None else math.isclose(got, score)


def test_runs(spark):
    """Slot 4 is absent and 9 to 19 are: both end a run."""
    slots = {0: 1, 1: 1, 2: 0, 3: 1, 5: 1, 6: 1, 7: 1, 8: 0, 20: 1}
    df = spark.createDataFrame([("a", i, f) for i, f in slots.items()], "k string, i int, flag int")
    assert sorted((r["first"], r["flag"], r["length"]) for r in Q.runs(df, ["k"], "i", "flag").collect()) == [(0, 1, 2), (2, 0, 1), (3, 1, 1), (5, 1, 3), (8, 0, 1), (20, 1, 1)]
    assert [tuple(r) for r in longest_slot_run(df, ["k"], "i", "flag").collect()] == [("a", 3, 5)]
    assert Q.longest_run(df.limit(0), ["k"], "i", "flag").count() == 0


def _longest(slots):
    best, now, start, prev = (0, 0), 0, 0, None
    for s in sorted(slots):
        now, start = (now + 1, start) if prev is not None and s == prev + 1 else (1, s)
        best, prev = ((now, start) if now > best[0] else best), s
    return best


@pytest.mark.parametrize("fan", [2, 3, 1024])
def test_merged_runs_equal_brute_force(spark, monkeypatch, fan):
    """Runs with holes that cross ranges of every width; negative slots, repeated rows, nulls."""
    monkeypatch.setattr(runs, "FAN", fan)
    r = random.Random(fan)
    rows, want = [], {}
    for k in range(40):
        density = r.choice([0.2, 0.6, 0.9, 1.0])
        low = r.choice([-20, 0, 5, 1000])
        slots = {s: int(r.random() < density) for s in range(low, low + r.choice([1, 7, 60])) if r.random() < 0.9}
        rows += [(str(k), s, f) for s, f in slots.items()] + [(str(k), s, 0) for s in list(slots)[:3]] + [(str(k), None, 1), (str(k), 3000, None)]
        if any(slots.values()):
            want[str(k)] = _longest([s for s, f in slots.items() if f])
    got = longest_slot_run(spark.createDataFrame(rows, "k string, s int, f int"), ["k"], "s", "f").collect()
    assert {g.k: (g.longest, g.first_slot) for g in got} == want


def test_volume_anomaly_needs_slots_and_neighbours(spark):
    """Exceeding hours 3 and 9 are no run; two hours of traffic are too few to judge; 5 and 6 are a run of two."""
    day = lambda s, d, hours: [(s, d, h, float(b)) for h, b in hours.items()]
    rows = []
    for s in "abc":
        for d in range(1, 5):
            rows += day(s, d, {3: 10, 4: 10, 5: 10, 6: 10, 9: 10})
    rows += day("a", 5, {3: 99, 4: 1, 5: 1, 9: 99}) + day("b", 5, {3: 1, 5: 99, 6: 99}) + day("c", 5, {5: 99, 6: 99})
    found = flows.volume_anomalies(spark.createDataFrame(rows, "s string, d int, h int, bytes double"), ["s"], "d", "h", first_day=5).collect()
    assert [(r.s, r.d, r.longest, r.first_slot, r.present) for r in found] == [("b", 5, 2, 5, 3)]


def test_upper_limit_and_mean_fill(spark):
    df = spark.createDataFrame([("a", 100.0), ("b", 10.0), ("b", 20.0), ("c", None)], "k string, x double")
    got = {r["k"]: r["u"] for r in df.groupBy("k").agg(A.upper_limit("x").alias("u")).collect()}
    assert got["a"] == 300 and got["b"] == 30 and got["c"] is None
    holes = spark.createDataFrame([("a", 4.0), ("a", None), ("a", 8.0), ("b", None)], "k string, x double")
    assert sorted(str(r[0]) for r in holes.select(A.fill_with_mean(holes, "k", "x")).collect()) == ["4.0", "6.0", "8.0", "None"]


def test_string_features(spark):
    x = F.col("x")
    assert math.isclose(one(spark, "aabb", S.entropy(x))[0], math.log(2)) and one(spark, "aaaa", S.entropy(x))[0] == 0
    assert one(spark, "abab", S.entropy(x, 2.0))[0] == 1 and one(spark, "", S.entropy(x))[0] is None and one(spark, None, S.entropy(x))[0] is None
    assert one(spark, "abc123", S.share(x, S.VOWELS), S.share(x, S.DIGITS)) == (1 / 6, 0.5)
    assert one(spark, "aabbc1", S.repeated_share(x))[0] == 4 / 6 and one(spark, "11.a-b.22-a", S.repeated_share(x))[0] == 2 / 11
    assert one(spark, "bcd12a3", S.run_share(x, S.CONSONANTS), S.run_share(x, S.DIGITS)) == (3 / 7, 2 / 7)
    assert one(spark, "Ab9-", S.shape(x))[0] == "D,N,P,U"
    assert one(spark, "", S.ngrams(x, 3), S.ngrams(x, 2)) == ([], ["^$"])
    assert one(spark, "%zz", S.percent_decoded(x))[0] == "%zz" and one(spark, "%41b", S.percent_decoded(x))[0] == "Ab"


def test_split_host(spark):
    suffixes = spark.createDataFrame([("com",), ("uk",), ("co.uk",)], "suffix string")
    names = spark.createDataFrame([("a.b.example.co.uk",), ("x.com",), ("none",), ("com",)], "h string")
    got = {r["h"]: (r["subdomain"], r["domain"], r["suffix"]) for r in S.split_host(names, "h", suffixes).collect()}
    assert got["a.b.example.co.uk"] == ("a.b", "example", "co.uk") and got["x.com"] == ("", "x", "com")
    assert got["none"] == got["com"] == ("No-Parse",) * 3


def test_transitions(spark):
    table = spark.createDataFrame([("ab", 0.5), ("bc", 0.25)], "pair string, p double")
    got = {r["n"]: r["transition"] for r in S.transition_score(spark.createDataFrame([("abc",), ("abd",), ("a",)], "n string"), "n", table).collect()}
    assert math.isclose(got["abc"], math.log(0.125)) and got["abd"] == -999 and got["a"] == 0


def test_ratio_and_level(spark):
    df = spark.createDataFrame([(10, 0), (10, 4)], "u long, d long")
    assert sorted(r[0] for r in df.select(S.safe_ratio(F.col("u"), F.col("d"))).collect()) == [2.5, 10]
    scores = spark.createDataFrame([(s,) for s in (59, 60, 69, 70, 79, 80, 100, 120)], "s int")
    assert [r[0] for r in scores.select(E.level(F.col("s"))).collect()] == ["none", "low", "low", "medium", "medium", "high", "high", "high"]


def test_weights_and_scores(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", -1.0), ("c", 4.0)], "indicator string, coefficient double")
    assert {r["indicator"]: r["weight"] for r in hosts.normalised_weights(df).collect()} == {"a": 0.307692, "b": 0.076923, "c": 0.615385}
    flags = spark.createDataFrame([("h", 1, 0)], "ip string, threat int, other int")
    none = spark.createDataFrame([], "threat int, other int, pattern_score double")
    assert hosts.compromise_scores(flags, {"threat": 0.35, "other": 0.1}, none, "threat").first()["score"] == 60


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 6), (9, 9), (None, 1)], "a long, b long")
    assert sorted(map(tuple, G.connected_components(edges, "a", "b").collect())) == [(1, 1), (2, 1), (3, 1), (5, 5), (6, 5), (9, 9)]
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    assert {r["component"] for r in G.connected_components(chain, "a", "b").collect()} == {0}
    assert G.connected_components(edges.limit(0), "a", "b").count() == 0


def test_cosine_links_lose_nothing(spark):
    import random

    rng = random.Random(3)
    rows = sorted({(f"e{e}", f"x{rng.randrange(12)}") for e in range(25) for _ in range(rng.randint(1, 9))})
    sets = {}
    for e, x in rows:
        sets.setdefault(e, set()).add(x)
    want = {(a, b) for a in sets for b in sets if a < b and round(len(sets[a] & sets[b]) / math.sqrt(len(sets[a]) * len(sets[b])), 6) >= 0.6}
    got = G.cosine_links(spark.createDataFrame(rows, "e string, x string"), "e", "x", 0.6).collect()
    assert {(r["a"], r["b"]) for r in got} == want


def test_latest_and_mode_ties(spark):
    df = spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 2, "y"), ("b", 3, 1, None)], "k string, t int, id int, v string")
    assert sorted((r["k"], r["v"]) for r in A.latest(df, ["k"], "t", "id").collect()) == [("a", "y"), ("b", None)]
    values = spark.createDataFrame([("a", 5), ("a", 3), ("a", None)], "k string, v int")
    assert [tuple(r) for r in A.mode(values, ["k"], "v").collect()] == [("a", 3, 1)]
