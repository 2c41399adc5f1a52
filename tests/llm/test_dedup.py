import random

import numpy as np
import pytest

from sparkwarden.llm import simhash, substring_dedup
from sparkwarden.llm.exact_dedup import drop_exact_copies, exact_groups

from .helpers import components, docs_of, rows_of, simhash as one_simhash, without_repeats
from .helpers import exact_groups as brute_groups

SF = "/root/testdata/sf0.001"
ODD = ["", None, " ", "\n\t ", "a", "A", "a b  c", "a b c", "x" * 50_000, "é ß", "a b c d", "A b c d", "a b c d"]


def table_texts(spark, n=None):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    return [r["text"] for r in rows][:n]


@pytest.mark.parametrize("digest_all", [True, False])
def test_exact_groups(spark, digest_all):
    texts = ODD + table_texts(spark)
    got = rows_of(exact_groups(docs_of(spark, texts, True), digest_all=digest_all), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    want = brute_groups(texts)
    assert [g[:4] for g in got] == sorted((w[:4] for w in want), key=repr)
    by = {w[0]: w for w in want}
    assert all(g[4] == by[g[0]][4] for g in got if digest_all or g[2] > 1)


def test_exact_empty_nulls_and_drop(spark):
    assert exact_groups(docs_of(spark, [])).count() == 0
    df = spark.createDataFrame([(None, "a"), (None, "a"), (3, None), (4, ""), (3, None)], "doc_id long, text string")
    got = rows_of(exact_groups(df), "doc_id", "keep_id", "group_size", "kept")
    assert got == sorted([(None, None, 2, True), (None, None, 2, True), (3, 3, 3, True), (3, 3, 3, True), (4, 3, 3, False)], key=repr)
    kept = drop_exact_copies(docs_of(spark, ["a b", "a  b", "c"], True))
    assert rows_of(kept, "doc_id") == [(0,), (2,)] and "size" in kept.columns


def test_fingerprints_equal_brute_force(spark):
    texts = ODD + table_texts(spark, 60) + ["word " * 3000]
    got = dict(rows_of(simhash.near_duplicates(docs_of(spark, texts, True)), "doc_id", "fingerprint"))
    assert got == {i: f"{one_simhash(t):016x}" for i, t in enumerate(texts)}


@pytest.mark.parametrize("radius,widths,parts", [(4, (1, 1, 2), 2), (4, (1,), 3), (8, (1, 1, 2), 3), (4, (3,), 2)])
def test_links_equal_brute_force(spark, radius, widths, parts):
    rng = random.Random(radius * 10 + len(widths))
    fps = {0, 1, (1 << 64) - 1, 1 << 63}
    for _ in range(25):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            fps.add(x)
            for _ in range(rng.randint(1, 5)):
                x ^= 1 << rng.randrange(64)
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    frame = spark.createDataFrame([(x, 1 + abs(x) % 3) for x in signed], "fp long, n long")
    links = simhash.fingerprint_links(frame, radius, widths, parts).collect()
    at = {x: k for k, x in enumerate(signed)}
    diff = lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count()
    assert all(diff(r["a"], r["b"]) <= radius for r in links)
    want = components(len(signed), [(i, j) for i in range(len(signed)) for j in range(i) if diff(signed[i], signed[j]) <= radius])
    assert components(len(signed), [(at[r["a"]], at[r["b"]]) for r in links]) == want


def test_near_duplicates_on_the_table(spark):
    texts = table_texts(spark) + ODD
    got = dict(rows_of(simhash.near_duplicates(docs_of(spark, texts)), "doc_id", "component_id"))
    f = [one_simhash(t) for t in texts]
    want = components(len(texts), [(i, j) for i in range(len(f)) for j in range(i) if (f[i] ^ f[j]).bit_count() <= 4])
    assert [got[i] for i in range(len(texts))] == want
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_difference_cover():
    d = substring_dedup.COVER
    assert {(a - b) % substring_dedup.PERIOD for a in d for b in d} == set(range(substring_dedup.PERIOD))


@pytest.mark.parametrize("bits", [27, 15])
def test_substrings_equal_brute_force(spark, bits):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared, long = text(36), text(300)
    texts = ODD + [text(40) + " " + shared + "\n" + text(9), shared, text(3) + "\t" + shared + " " + text(80), long, long, long + " x", text(50) + " " + long[:900], "r " * 90, text(35), text(34), " ".join(shared.split()[:35])]
    texts += [shared + " " + text(5) + " " + shared] + table_texts(spark, 80)
    got = rows_of(substring_dedup.remove_repeated(docs_of(spark, texts, True), bits=bits), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(((i, *x) for i, x in enumerate(without_repeats(texts))), key=repr)


def test_substring_texts_and_empty(spark):
    assert substring_dedup.remove_repeated(docs_of(spark, [])).count() == 0
    long = " ".join(f"w{k}" for k in range(50))
    got = rows_of(substring_dedup.remove_repeated(docs_of(spark, [long + " end", "start\n" + long, "a  b"]), with_text=True), "doc_id", "n_removed", "kept_text")
    assert got == [(0, 50, "end"), (1, 50, "start"), (2, 0, "a b")]


def jaccard(a, b, size=5):
    cut = lambda t: {" ".join(w[i : i + size]) for w in [t.lower().split()] for i in range(max(1, len(w) - size + 1))}
    a, b = cut(a), cut(b)
    return len(a & b) / len(a | b)


def test_near_copies(spark):
    """Light edits are found, nothing below the bound is linked, copies of different spacing count."""
    rng = random.Random(8)
    texts, base = [], []
    for _ in range(25):
        w = ["".join(rng.choice("abcdef") for _ in range(5)) for _ in range(rng.randint(80, 300))]
        base.append(len(texts))
        texts.append(" ".join(w))
        for edits in (1, 2, 40):
            v = list(w)
            for at in rng.sample(range(len(v)), edits):
                v[at] = "zz"
            texts.append(" ".join(v))
    texts += [texts[0] + " ", "", None, "one"]
    df = docs_of(spark, texts, True)
    got = dict(rows_of(simhash.near_copies(df), "doc_id", "component_id"))
    for i, c in got.items():
        if c != i and i < 100:
            assert i // 4 == c // 4 and jaccard(texts[i], texts[c]) >= 0.8
    light = [b + k for b in base for k in (1, 2) if jaccard(texts[b], texts[b + k]) >= 0.9]
    assert sum(got[i] != i for i in light) >= 0.95 * len(light)
    assert got[100] == 0 and got[102] == 101 and got[103] == 103
    assert simhash.near_copies(docs_of(spark, [])).count() == 0
    null_ids = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    assert rows_of(simhash.drop_near_copies(null_ids), "doc_id") == [(1,), (1,), (None,)]


def all_links(texts, least=0.8):
    return [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(texts[i], texts[j]) >= least]


def test_near_copies_at_the_bound(spark):
    """Groups are those of all pairs at 0.8 and above, also where edits leave just that."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    common, texts = " ".join(word() for _ in range(9)), []
    for k in range(60):
        w = [word() for _ in range(200)] + ([common] if k % 3 == 0 else [])
        v = list(w)
        for at in rng.sample(range(200), 4):
            v[at] = word()
        texts += [" ".join(w), " ".join(v)]
    texts += [f"{common} {word()}" for _ in range(40)]
    pairs = all_links(texts)
    assert sum(0.8 <= jaccard(texts[2 * k], texts[2 * k + 1]) < 0.86 for k in range(60)) >= 40
    got = dict(rows_of(simhash.near_copies(docs_of(spark, texts)), "doc_id", "component_id"))
    assert [got[i] for i in range(len(texts))] == components(len(texts), pairs)


def test_near_copies_under_one_fingerprint(spark):
    """Texts of one repeated line share fingerprints; two with nearly the same tail are found though a third has another."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    line, texts = " ".join(word() for _ in range(11)), []
    for _ in range(4):
        tail = [word() for _ in range(60)]
        texts += [" ".join([line] * 60 + tail), " ".join([line] * 60 + tail[:-1] + [word()])]
    texts = [texts[0], *texts[2:], texts[1]]
    assert len({one_simhash(t, 5) for t in texts}) == 1
    got = dict(rows_of(simhash.near_copies(docs_of(spark, texts)), "doc_id", "component_id"))
    want = components(len(texts), all_links(texts))
    assert [got[i] for i in range(len(texts))] == want and want[-1] == 0 and want[2] == 1


def test_odd_sketches_bound_differences():
    rng = np.random.default_rng(11)
    for size in (1, 40, 300, 5000):
        one = rng.integers(0, 2**63, size, dtype=np.uint64)
        for moved in (0, 1, size // 10, size):
            other = np.concatenate([one[moved:], rng.integers(0, 2**63, moved, dtype=np.uint64)])
            both = simhash._odd_sketches(np.concatenate([one, other]), np.repeat([0, 1], [len(one), len(other)]), 2).reshape(2, -1)
            bits = int(np.bitwise_count(both[0] ^ both[1]).sum())
            assert bits <= len(np.setxor1d(one, other))
            assert moved or bits == 0


def test_near_copies_of_long_texts_and_repeated_ids(spark):
    """Texts that fill the sketch, and ids with several texts, of which any may be the link."""
    rng = random.Random(12)
    words = lambda n: ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(n)]

    def changed(text, share):
        return [w if rng.random() > share else "x" + w for w in text]

    long = words(6000)
    near, far = changed(long, 0.012), changed(long, 0.06)
    one, two = words(150), words(150)
    rows = [(0, long), (1, near), (2, far), (10, one), (11, two), (12, [*one[:-1], "other"]), (12, ["other", *two[1:]]), (13, words(150))]
    assert jaccard(" ".join(long), " ".join(near)) >= 0.8 > jaccard(" ".join(long), " ".join(far))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    got = rows_of(simhash.near_copies(docs), "doc_id", "component_id")
    assert sorted(got) == sorted([(0, 0), (1, 0), (2, 2), (10, 10), (11, 10), (12, 10), (12, 10), (13, 13)])


def test_similar_texts_share_a_part(spark):
    """Any two texts at the bound have a cell in common, also short ones and those of two size classes; chance shingles make few."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    common, texts = [[word() for _ in range(5)] for _ in range(300)], []
    for n in (5, 6, 7, 8, 9, 11, 12, 14, 18, 20, 30, 36, 67, 70, 130, 260, 300):
        for _ in range(8):
            w = [word() for _ in range(n)]
            v = list(w)
            for _ in range(rng.randint(1, max(1, n // 50))):
                v[rng.choice([0, len(v) - 1, rng.randrange(len(v))])] = word()
            longer = [*w, *(word() for _ in range((n - 4) // 4))]
            texts += [" ".join(t) for t in (w, v, longer)]
    near = all_links(texts)
    assert len(near) >= 150
    cells = {}
    for r in simhash.part_cells(docs_of(spark, texts).select("doc_id", "text"), len(texts), 5, 0.8).collect():
        cells.setdefault(r["doc"], set()).add(r["cell"])
    assert all(cells[i] & cells[j] for i, j in near)
    # Each shingle of these is in some forty texts, but no two texts are alike.
    chance = [" ".join(w for line in rng.sample(common, 40) for w in line) for _ in range(300)]
    rows = simhash.part_cells(docs_of(spark, chance).select("doc_id", "text"), len(chance), 5, 0.8).groupBy("cell").count().where("count > 1")
    assert rows.count() <= 0.1 * 300 * 49


def test_near_copies_are_proposed_by_the_grid(spark, monkeypatch):
    """The range-join on grid points proposes pairs whose fingerprints differ; texts far from them are found beside it."""
    rng = random.Random(5)
    w = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    texts = [" ".join(w), " ".join([*w[:-1], "other"])]
    made, proposed = simhash.fingerprint_links, []

    def watched(*args):
        links = made(*args)
        proposed.append(links.count())
        return links

    monkeypatch.setattr(simhash, "fingerprint_links", watched)
    assert dict(rows_of(simhash.near_copies(docs_of(spark, texts)), "doc_id", "component_id")) == {0: 0, 1: 0}
    assert one_simhash(texts[0], 5) != one_simhash(texts[1], 5) and proposed == [1]


def test_windows_take_turns(spark):
    """Each window of the runs comes in one turn, with its place."""
    hashes = np.random.default_rng(3).integers(-(2**62), 2**62, 200)
    runs = spark.createDataFrame([(7, 10, bytearray(hashes[:150].tobytes()), 1), (8, 0, bytearray(hashes[150:].tobytes()), 1)], "row long, first int, hashes binary, n long")
    turns = [rows_of(substring_dedup._windows(runs, True, k), "h", "row", "at") for k in range(substring_dedup.TURNS)]
    assert all(turns)
    assert sorted(r for t in turns for r in t) == sorted((int(h), 7, 10 + k) if k < 150 else (int(h), 8, k - 150) for k, h in enumerate(hashes))
