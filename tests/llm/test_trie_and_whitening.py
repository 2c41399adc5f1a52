"""The prefix trie against sets of prefixes, whitening against numpy's eigenvectors."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sparkwarden.llm import prefix_trie, queries, whitening

from .. import oracle
from ..conftest import SF

TURNS = "conv_id long, turn long, role string, text string"


def trie_of(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((turn is not None, turn or 0, role, hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).digest(), text))
    own = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in turns.items()}
    h = lambda c: zlib.crc32(str(c).encode()) % 6
    whole = {c: own.get(c - c % 100, [])[: h(c)] + own[c][h(c) :] for c in own}
    members, ends = defaultdict(set), defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].add(c)
        ends[tuple(whole[c])].append(c)
    out = []
    for p in members:
        below = [q for q in members if q[: len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = sum(not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in members) for q in below)
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q)
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids), leaves, saved, hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def conversations(seed):
    r = random.Random(seed)
    rows = []
    for c in list(range(0, 40)) + [100, 105, 117, 399, 250, 260] + list(range(300, 330)):
        for t in range(r.choice([1, 2, 2, 3, 7, 8])):
            rows.append((c, r.choice([t, t, t, None]), r.choice(["user", "assistant", None]), r.choice(["a", "b", "é", "", None, "long text"])))
    return rows + rows[:5] + [(None, 1, "user", "lost")]


@pytest.mark.parametrize("seed,block", [(1, 64), (2, 2), (3, 3)])
def test_trie_equals_prefix_sets(spark, monkeypatch, seed, block):
    """Small blocks make several levels of merging."""
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rows = conversations(seed)
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as own", "'x' as key", "2 as KIND")
    assert found(prefix_trie.prefix_trie(df)) == trie_of(rows)


def test_trie_of_copies_spans_partitions(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 2)
    rows = [(c * 7, t, "user", f"t{t}") for c in range(300) for t in range(9)] + [(5001, 0, "user", "x")]
    assert found(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS))) == trie_of(rows)


def test_trie_edges(spark):
    assert found(prefix_trie.prefix_trie(spark.createDataFrame([], TURNS))) == []
    for rows in ([(7, 1, None, None)], [(0, t, "user", "w" * 50_000) for t in range(700)], [(c, 0, "user", "x") for c in (1, 2, 3)]):
        assert found(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS))) == trie_of(rows)


def test_trie_equals_sql(spark):
    assert oracle.difference(spark, oracle.connect(SF), SF, queries.QUERIES["op12_prefix_trie"], queries.ORACLES["op12_prefix_trie"]) is None


def test_forest_is_the_trie_in_any_cut():
    """The union-find by itself: whatever is cut where, the closed nodes are the same."""
    r = random.Random(4)
    items = sorted((bytes(r.choice([1, 1, 2]) for _ in range(r.choice([0, 1, 2, 4, 5]))), c) for c in range(60))
    keys = [(b"".join(bytes([x]) * prefix_trie.WIDTH for x in k), c, len(k)) for k, c in items]

    def path(group):
        p = prefix_trie.Path.of(group[0][1], group[0][0], [3] * group[0][2])
        for _, c, _ in group[1:]:
            p.n, p.low = [x + 1 for x in p.n], [min(x, c) for x in p.low]
        return p

    def paths(part):
        groups = defaultdict(list)
        for k in part:
            groups[k[0]].append(k)
        return [path(g) for g in groups.values()]

    def nodes(forest):
        return [(forest.paths[k].key[: d * prefix_trie.WIDTH], *(c[d] for c in forest.paths[k].row())) for k, d, _ in forest.closed()]

    want = sorted(nodes(prefix_trie.Forest(paths(keys), whole=True)))
    for cuts in ([10, 30, 31, 59], [1, 2, 3], [20]):
        got, open_paths = [], []
        for a, b in zip([0, *cuts], [*cuts, 60], strict=True):
            f = prefix_trie.Forest(paths(keys[a:b]))
            got += nodes(f)
            open_paths += f.contracted()
        f = prefix_trie.Forest(open_paths, whole=True)
        assert sorted(got + nodes(f)) == want


def test_rank_one_updates():
    r = np.random.default_rng(0)
    for d, n in ((1, 5), (2, 40), (7, 100), (33, 80)):
        x = np.floor(r.normal(size=(n, d)) * 200) + 100_000
        x[n // 4 : n // 2] = x[0]
        x[:, 0] = x[0, 0] if d > 2 else x[:, 0]
        left, right = whitening.Spectrum(d), whitening.Spectrum(d)
        for k, row in enumerate(x):
            (left if k % 3 else right).add(row)
        left.merge(right)
        scatter = (x - x.mean(0)).T @ (x - x.mean(0))
        back = left.vectors @ np.diag(left.values) @ left.vectors.T
        top = max(np.abs(scatter).max(), 1)
        assert np.abs(back - scatter).max() < 1e-10 * top and np.abs(left.vectors.T @ left.vectors - np.eye(d)).max() < 1e-10
        assert np.abs(left.values - np.linalg.eigvalsh(scatter)).max() < 1e-10 * top


def whitened(spark, rows, block=16, monkeypatch=None):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as x", "2 as N", "3 as dim").repartition(11)
    return whitening.whiten(df).collect()


def test_whitening_equals_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 3)
    r = np.random.default_rng(1)
    base = r.normal(size=(400, 12)) * np.linspace(0.5, 0.05, 12)
    base[100:230] = base[0]
    good = [(k if k % 50 else None, [float(x) for x in v], 0) for k, v in enumerate(base)]
    nan, inf = float("nan"), float("inf")
    bad = [(900, None, 0), (901, [None] * 12, 0), (902, [nan] * 12, 0), (903, [inf] * 12, 0), (904, [], 0), (905, [0.5] * 3, 0)]
    got = whitened(spark, good + bad)
    x = np.floor(1024 * base.astype(np.float32).astype(float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    mu = s / n
    v = (x - mu).T @ (x - mu) / n
    e, c = np.linalg.eigh(v)
    e, c = e[::-1], c[:, ::-1]
    assert len(got) == 8 * n and {r.component for r in got} == set(range(1, 9)) and all(r.n == n for r in got)
    assert got[0].identity_error < 1e-9 and {r.identity_error for r in got} == {got[0].identity_error}
    by = defaultdict(dict)
    for r in got:
        if r.vec_id is not None:
            by[r.vec_id][r.component] = r
    for k in by:
        assert all(row.deviation == int(((n * x[k] - s).astype(object) ** 2).sum()) for row in by[k].values())
    for j in range(8):
        want = (x - mu) @ c[:, j] / np.sqrt(e[j])
        have = np.array([by[k][j + 1].whitened for k in sorted(by)])
        want = want[sorted(by)]
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-8
        assert abs(by[1][j + 1].explained / (e[j] / e.sum()) - 1) < 1e-9


def test_whitening_edges(spark):
    assert whitened(spark, []) == [] and whitened(spark, [(1, None, 0)]) == []
    alone = whitened(spark, [(1, [0.5, 0.25], 0)])
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(1, 1, 0, 0.0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0, 0.0)]
    flat = whitened(spark, [(k, [k / 8, 0.0, 1.0], 0) for k in (1, 1, 2, 3)])
    assert len(flat) == 12 and all(r.whitened == 0 for r in flat if r.component > 1) and flat[0].identity_error < 1e-9
