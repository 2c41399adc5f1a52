"""SimHash near-deduplication: segment popcounts, a grid range-join under Manhattan distance, exact verification.

Fingerprints are cut into segments whose sizes repeat ``widths`` (small segments tell more fingerprints apart, large
ones have fewer grid points); the vector of the segments' bit counts moves by at most as much (in Manhattan distance)
as the fingerprint does in Hamming distance.  The vectors are cut into ``parts``; of two
vectors within ``radius``, at least one part is within ``radius // parts``.  In each part a pair within distance 2
shares a grid point at distance 1 or less from both, so every fingerprint registers at its own point and at the
points one step away, and an equi join on grid points finds all pairs within the bound.  Their Hamming distance is
then taken exactly, inside the join condition.

Dense groups are not paired with themselves: fingerprints are first linked to the most frequent one that shares some
bits with them, connected components of these links are formed, and the range-join then looks only for pairs of
different components, from all but the largest component at each grid point.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwarden.llm import arrays, workers
from sparkwarden.operators.graph import connected_components
from sparkwarden.storage import discard, free_shuffles, scratch, shuffled, small_or_shuffled, written


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seeds: tuple[int, ...] = (42,)) -> DataFrame:
    """``(id, f0, f1, ...)``: one 64-bit SimHash (as a signed long) for each seed.

    A-Z are folded, words are runs of other bytes than ``[\\x20\\x09-\\x0D]``, shingles of ``shingle`` words joined by
    one space are hashed with XXH64, repeats included.  Fewer words make one shingle; no words (or null) give zero.
    """
    names = [f"f{k}" for k in range(len(seeds))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = arrays.as_strings(batch.column(1))
            out = [[] for _ in seeds]
            for a, b in arrays.slices(texts):
                words = arrays.split_words(*arrays.buffers(texts.slice(a, b - a)), lower=True)
                start, length, first = arrays.shingles(words, shingle)
                for k, seed in enumerate(seeds):
                    out[k].append(arrays.bit_majority(arrays.xxh64(words.data, start, length, seed), first))
            columns = [pa.array(np.concatenate(x).view(np.int64) if x else np.zeros(0, np.int64)) for x in out]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_col, *names])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(workers.lean(run), f"{id_col} {kind}, " + ", ".join(f"{n} long" for n in names))


def distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


#: Sizes of the segments, repeated to the end of the fingerprint.
WIDTHS = (1, 1, 2)


def _segments(widths: tuple[int, ...], parts: int) -> list[list[tuple[int, int]]]:
    """For each part, its segments as (first bit, bits)."""
    segments, at = [], 0
    while at < 64:
        n = min(widths[len(segments) % len(widths)], 64 - at)
        segments.append((at, n))
        at += n
    cut = [round(p * len(segments) / parts) for p in range(parts + 1)]
    return [segments[a:b] for a, b in zip(cut, cut[1:], strict=False)]


def grid_points(fps: DataFrame, radius: int, widths: tuple[int, ...], parts: int) -> DataFrame:
    """The rows of ``fps`` (column ``fp``) once for each grid point (``cell``) at which they register.

    A grid point is a part and the bit counts of its segments, packed two bits each (one if all segments are one bit).
    """
    reach = radius // parts
    if reach > 2:
        raise ValueError("radius // parts must be 2 or less")
    if not set(widths) <= {1, 2, 3}:
        raise ValueError("segments have 1, 2 or 3 bits")
    room = 1 if set(widths) == {1} else 2
    cells = []
    for p, segments in enumerate(_segments(widths, parts)):
        if len(segments) * room > 56:
            raise ValueError("too many segments in a part")
        counts = [F.bit_count(F.col("fp").bitwiseAND(F.lit(((1 << n) - 1) << at if at + n < 64 else -(1 << at)).cast("long"))).cast("long") for at, n in segments]
        own = F.lit(p << 56).cast("long")
        for k, c in enumerate(counts):
            own = own + F.shiftleft(c, k * room)
        steps = [own]
        if reach:
            for k, (c, (_, n)) in enumerate(zip(counts, segments, strict=True)):
                one = F.lit(1 << (k * room)).cast("long")
                steps += [F.when(c > 0, own - one), F.when(c < n, own + one)]
        cells += steps
    return fps.select("*", F.explode(F.array_compact(F.array(*cells))).alias("cell"))


def _star_links(fps: DataFrame, radius: int) -> DataFrame:
    """Links from each fingerprint to the most frequent one (ties: the largest) of those that share a quarter of the bits with it."""
    quarter = fps.select("fp", "n", F.explode(F.array(*[F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF)).cast("long") + F.lit(k << 16) for k in range(4)])).alias("key"))
    top = quarter.groupBy("key").agg(F.max(F.struct("n", "fp")).alias("top")).select((F.col("key") + 0).alias("of"), F.col("top.fp").alias("hub"))
    spread = quarter.select("fp", (F.col("key") + 0).alias("of"))
    return shuffled(spread).join(top, (spread["of"] == top["of"]) & (spread["fp"] != top["hub"]) & (distance("fp", "hub") <= radius)).select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct()


def fingerprint_links(fps: DataFrame, radius: int = 4, widths: tuple[int, ...] = WIDTHS, parts: int = 2) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints whose components are those of *all* pairs within ``radius``.

    ``fps`` has distinct ``fp`` (long) and their frequency ``n``.  Pairs inside a component that is already joined are
    left out: they change no component.
    """
    stars = written(_star_links(fps, radius), "stars")
    known = connected_components(stars, "a", "b").select(F.col("node").alias("fp"), F.col("component").alias("c"))
    labelled = written(fps.join(shuffled(known), "fp", "left").select("fp", F.coalesce("c", "fp").alias("c")), "labelled")
    # Each row becomes some sixty: they are dealt out again first, however few files hold them.
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = grid_points(labelled.repartition(tasks), radius, widths, parts)
    # Grid points with one component only have nothing left to find.
    sizes = points.groupBy("cell", "c").agg(F.count(F.lit(1)).alias("m"))
    mixed = sizes.groupBy("cell").agg(F.max(F.struct("m", "c")).alias("top"), F.count(F.lit(1)).alias("k")).where("k > 1").select(F.col("cell").alias("at"), F.col("top.c").alias("largest"))
    held = written(shuffled(points).join(mixed, F.col("cell") == F.col("at")).select("cell", "fp", "c", "largest"), "points")
    free_shuffles(fps.sparkSession)
    few = held.where("c <> largest").select((F.col("cell") + 0).alias("x_cell"), F.col("fp").alias("x"), F.col("c").alias("x_c"))
    many = held.select((F.col("cell") + 0).alias("y_cell"), F.col("fp").alias("y"), F.col("c").alias("y_c"))
    found = shuffled(few).join(many, (few["x_cell"] == many["y_cell"]) & (few["x_c"] != many["y_c"]) & (distance("x", "y") <= radius))
    # Pairs of fingerprints collapse to pairs of components at once.
    found = found.groupBy(F.least("x_c", "y_c").alias("p"), F.greatest("x_c", "y_c").alias("q")).agg(F.min(F.struct(F.col("x").alias("a"), F.col("y").alias("b"))).alias("pair"))
    links = written(stars.unionByName(found.select("pair.a", "pair.b")), "links")
    discard(held, labelled, stars)
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4, widths: tuple[int, ...] = WIDTHS, parts: int = 2, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Fingerprints link at ``radius`` or fewer differing bits; the component is the smallest id reachable.  Rows with
    the same fingerprint are one class and are never paired.  Texts without words have fingerprint zero, which links
    like any other.  Repeated rows stay, one result each; rows without an id get their class's component.
    """
    rows = written(fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), shingle=shingle, seeds=(seed,)).withColumnRenamed("f0", "fp"), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "classes")
    links = fingerprint_links(classes, radius, widths, parts)
    nodes = connected_components(links, "a", "b")
    # Components have numbers of fingerprints; each gets the smallest id of its classes.
    lone = classes.join(shuffled(nodes), classes["fp"] == nodes["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("c"))
    smallest = lone.groupBy("c").agg(F.min("least").alias("component_id"))
    named = written(shuffled(lone).select("fp", (F.col("c") + 0).alias("c")).join(smallest.select((F.col("c") + 0).alias("c"), "component_id"), "c").select("fp", "component_id"), "named")
    discard(links, classes, nodes)
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.join(shuffled(named), "fp").select(F.col("doc_id").alias(id_col), hexed.alias("fingerprint"), "component_id")


def _in_common(x: pa.Array, y: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each pair of texts: how many distinct shingles the first has, the second has, and both have."""
    (hx, fx), (hy, fy) = _distinct_hashes(x, shingle), _distinct_hashes(y, shingle)
    n, m = np.diff(fx), np.diff(fy)
    hashes, owner = np.concatenate([hx, hy]), np.concatenate([np.repeat(np.arange(len(n)), n), np.repeat(np.arange(len(m)), m)])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    twice = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    return n, m, np.bincount(owner[1:][twice], minlength=len(n))


def verified_links(pairs: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` of ids whose texts' shingle sets have a Jaccard similarity of ``similarity`` or more, as a written table.

    Two texts without words are alike.  ``docs`` has ``doc_id`` and ``text``; only texts of documents in a pair are
    shuffled, and whole texts rather than their hashes, which take twice the room.
    """
    pairs = written(pairs, "pairs")
    # Written, since it is counted and then joined at both ends.
    needed = written(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "needed")
    texts = docs.join(small_or_shuffled(needed), "doc_id", "left_semi")
    of_a, of_b = (shuffled(texts).select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = arrays.as_strings(batch.column(2)), arrays.as_strings(batch.column(3))
            for lo, hi in arrays.slices(x):
                for c, d in arrays.slices(y.slice(lo, hi - lo)):
                    n, m, both = _in_common(x.slice(lo + c, d - c), y.slice(lo + c, d - c), shingle)
                    keep = both >= similarity * (n + m - both) - 1e-9
                    yield pa.RecordBatch.from_arrays([batch.column(k).slice(lo + c, d - c) for k in (0, 1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    links = written(pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "text_a", "text_b").mapInArrow(workers.lean(run), "a long, b long").distinct(), "verified")
    discard(pairs, needed)
    return links


#: Documents whose shingles tell how frequent shingles are, and the number of frequent shingles that are kept.
SAMPLE_DOCS, FREQUENT = 20_000, 100_000
#: The cell of all texts without words.
_EMPTY = 0


def _distinct_hashes(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text of a slice, in rising order, and the index of each text's first one."""
    words = arrays.split_words(*arrays.buffers(texts), lower=True)
    start, length, first = arrays.shingles(words, shingle)
    hashes = arrays.xxh64(words.data, start, length)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], np.searchsorted(owner[fresh], np.arange(len(first)))


def _frequent_shingles(docs: DataFrame, total: int, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) that three or more documents of a sample of fixed size have, and in how many they are."""
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, total // SAMPLE_DOCS))) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = arrays.as_strings(batch.column(1))
            for a, b in arrays.slices(texts):
                yield pa.RecordBatch.from_arrays([pa.array(_distinct_hashes(texts.slice(a, b - a), shingle)[0].view(np.int64))], ["h"])

    counts = some.select("doc_id", "text").mapInArrow(workers.lean(run), "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n >= 3")
    found = counts.orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow()  # as arrays: rows would take tens of MB of the driver
    hashes, n = (found.column(k).to_numpy() for k in ("h", "n"))
    order = np.argsort(hashes.view(np.uint64))
    return hashes.view(np.uint64)[order], n[order]


#: Bits of the odd sketch of all shingles of a text, in words of 64.
ODD_WORDS = 16
_ODD = [f"o{k}" for k in range(ODD_WORDS)]


def _odd_sketches(hashes: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Of each text ``ODD_WORDS`` words whose bits tell which residues an odd number of its hashes have."""
    bits = hashes & np.uint64(64 * ODD_WORDS - 1)
    words = np.zeros(texts * ODD_WORDS, np.uint64)
    np.bitwise_xor.at(words, owner * ODD_WORDS + (bits >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bits & np.uint64(63)))
    return words


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Parts that a set is cut into, for each shingle that a pair may differ by, and besides.
PARTS, MORE_PARTS = 1.3, 8


def _part_cells(hashes: np.ndarray, owner: np.ndarray, rare: np.ndarray, sizes: np.ndarray, level: np.ndarray, similarity: float, own: bool) -> tuple[np.ndarray, np.ndarray]:
    """``(owner, cell)``: the cells of texts as the smaller one of a pair or of the same level (``own``), or as the larger one a level higher.

    ``sizes`` are the texts' numbers of shingles, ``level`` the size class in which the cells are made.
    """
    top = (np.int64(2) << level) - 1
    bound = (1 - similarity) / (1 + similarity)
    most = sizes * (1 - similarity) / similarity if own else bound * (sizes + np.minimum(sizes, top))
    differ = np.floor(most + 1e-6).astype(np.int64)
    parts = np.ceil(PARTS * top * (1 - similarity) / similarity).astype(np.int64) + MORE_PARTS
    salt = _mixed(level.astype(np.uint64) + np.uint64(1))
    part = (_mixed(hashes ^ salt[owner]) % parts[owner].astype(np.uint64)).astype(np.int64)
    order = np.lexsort((part, owner))
    hashes, owner, part, rare = hashes[order], owner[order], part[order], rare[order]
    starts = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (part[1:] != part[:-1])]) if len(owner) else np.zeros(0, np.int64)
    of = owner[starts]
    cells = _mixed(np.add.reduceat(_mixed(hashes), starts) + _mixed(part[starts].astype(np.uint64) ^ salt[of])) if len(starts) else np.zeros(0, np.uint64)
    told = np.add.reduceat(rare.astype(np.int64), starts) if len(starts) else starts
    order = np.lexsort((cells, -told, of))
    of, cells = of[order], cells[order]
    filled = np.bincount(of, minlength=len(sizes))
    ahead = np.arange(len(of)) - (np.cumsum(filled) - filled)[of] <= differ[of]
    # Sets that fill too few parts for a whole one to be left: their first shingles, among themselves.
    poor = np.flatnonzero((filled <= differ) & (sizes > 0))
    plain = np.isin(owner, poor)
    mine, single = owner[plain], _mixed(hashes[plain] ^ salt[owner[plain]])
    order = np.lexsort((single, mine))
    mine, single = mine[order], single[order]
    each = np.bincount(mine, minlength=len(sizes))
    first = np.arange(len(mine)) - (np.cumsum(each) - each)[mine] < (sizes - np.ceil(similarity * sizes - 1e-9).astype(np.int64) + 1)[mine]
    return np.concatenate([of[ahead], mine[first]]), np.concatenate([cells[ahead], single[first]])


def part_cells(docs: DataFrame, total: int, shingle: int, similarity: float) -> DataFrame:
    """``(doc, cell, n, odd)``: cells of which any two texts at ``similarity`` or more have one in common.

    ``n`` and ``odd``, in a text's first row only, are the number of its distinct shingles and their odd sketch.

    Shingles are dealt by their hashes into parts, as many for all texts of one size class (up to twice the smallest);
    a cell is the hash of all shingles of one part.  Two texts that differ by d shingles have equal shingles in all but d
    of the parts, so in any one order of cells the first d + 1 of both have one in common.  Cells of many rare shingles
    come first: unlike the shingles themselves, they are not met by chance, and common lines are sought only where a text
    has little else.  A text is dealt as its own size class, and as the one below where a partner may be in that.  Texts
    that fill no more than d parts are also sought by single shingles, all but the last ``ceil(similarity * n) - 1``.
    """
    if similarity <= 0.5:
        raise ValueError("similarity must be over 0.5")
    held = docs.sparkSession.sparkContext.broadcast(_frequent_shingles(docs, total, shingle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, _ = held.value
        for batch in batches:
            texts = arrays.as_strings(batch.column(1))
            for a, b in arrays.slices(texts):
                hashes, first = _distinct_hashes(texts.slice(a, b - a), shingle)
                n = np.diff(first)
                owner = np.repeat(np.arange(len(n)), n)
                sketch = _odd_sketches(hashes, owner, len(n)).reshape(-1, ODD_WORDS)
                rare = np.ones(len(hashes), bool)
                if len(known) and len(hashes):
                    rare = known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] != hashes
                level = np.frexp(np.maximum(n, 1).astype(np.float64))[1].astype(np.int64) - 1
                below = np.ceil(similarity * n - 1e-6) < np.int64(1) << level
                also = below[owner]
                found = [_part_cells(hashes, owner, rare, n, level, similarity, True)]
                found.append(_part_cells(hashes[also], owner[also], rare[also], np.where(below, n, 0), np.maximum(level - 1, 0), similarity, False))
                empty = np.flatnonzero(n == 0)
                of = np.concatenate([found[0][0], found[1][0], empty])
                cells = np.concatenate([found[0][1].view(np.int64), found[1][1].view(np.int64), np.full(len(empty), _EMPTY, np.int64)])
                order = np.argsort(of, kind="stable")
                of, cells = of[order], cells[order]
                lead = np.r_[True, of[1:] != of[:-1]] if len(of) else np.zeros(0, bool)
                ends = np.concatenate([[0], np.cumsum(lead)]) * ODD_WORDS
                odd = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(sketch[of[lead]].ravel().view(np.int64)), mask=pa.array(~lead))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).take(pa.array(of)), pa.array(cells), pa.array(n[of], pa.int32(), mask=~lead), odd], ["doc", "cell", "n", "odd"])

    return docs.select("doc_id", "text").mapInArrow(workers.lean(run), "doc long, cell long, n int, odd array<long>")


def _grid_pairs(rows: DataFrame, radius: int, widths: tuple[int, ...] = WIDTHS, parts: int = 2) -> DataFrame:
    """Pairs ``(a, b)`` of ids of ``rows`` (``doc_id``, ``f0``): each document with the first one of its fingerprint, and the first ones of fingerprints that the range-join on grid points links."""
    classes = written(rows.groupBy(F.col("f0").alias("fp")).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "classes")
    links = fingerprint_links(classes.select("fp", "n"), radius, widths, parts)
    same = rows.join(shuffled(classes), rows["f0"] == classes["fp"]).where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    of_a, of_b = (shuffled(classes).select(F.col("fp").alias(x), F.col("rep").alias(f"rep_{x}")) for x in "ab")
    near = links.join(of_a, "a").join(of_b, "b").select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b"))
    pairs = written(same.unionByName(near).distinct(), "proposed")
    discard(classes, links)
    return pairs


#: Cells of a document that each of its rows names, in order.
HEAD = 32


def _odd_of_documents(cells: DataFrame) -> DataFrame:
    """``(of_doc, n, o0, ...)``: the number of shingles and the odd sketch of each document; null where rows of one id have different ones."""
    words = cells.where("odd is not null").select("doc", "n", *(F.get("odd", F.lit(k)).alias(o) for k, o in enumerate(_ODD)))
    return words.groupBy(F.col("doc").alias("of_doc")).agg(*(F.when(F.min(o) == F.max(o), F.min(o)).alias(o) for o in ("n", *_ODD)))


def _may_agree(similarity: float) -> Column:
    """Whether two texts can have few enough shingles that only one of them has: by their numbers, and by their odd sketches.

    Each such shingle turns one bit of the odd sketch over, so at least as many are different as bits are.  Texts of
    thousands of shingles fill the sketch, which then excludes nothing.
    """
    differ = sum((F.bit_count(F.col(f"x_{o}").bitwiseXOR(F.col(f"y_{o}"))) for o in _ODD), F.lit(0))
    differ = F.greatest(differ, F.abs(F.col("x_n") - F.col("y_n")))
    return F.coalesce(differ <= F.lit((1 - similarity) / (1 + similarity)) * (F.col("x_n") + F.col("y_n")) + 1e-6, F.lit(True))


def _sketched(cells: DataFrame, odd: DataFrame) -> DataFrame:
    """``cells`` with, of each document, the first of its cells here (``head``), its number of shingles and its odd sketch."""
    head = F.slice(F.sort_array(F.collect_set("cell")), 1, HEAD).alias("head")
    both = cells.groupBy(F.col("doc").alias("__doc")).agg(head).join(shuffled(odd), F.col("__doc") == F.col("of_doc")).drop("of_doc")
    return shuffled(cells).join(both, F.col("doc") == F.col("__doc")).drop("__doc")


def _first_shared() -> Column:
    """Whether this is the cell in which a pair is to be named: the first one that both heads have, any one if they have none."""
    both = F.array_intersect("x_head", "y_head")
    return (F.size(both) == 0) | (F.col("x_cell") == F.get(both, F.lit(0)))


def _side(cells: DataFrame, side: str, *more: str) -> DataFrame:
    """The columns of one side of a comparison within a cell."""
    named = [F.col(c).alias(f"{side}_{c}") for c in ("n", "c", "head", *_ODD) if c in cells.columns]
    return cells.select((F.col("cell") + 0).alias(f"{side}_cell"), *more, F.col("doc").alias(side), *named)


def _mixed_cells(shared: DataFrame, known: DataFrame) -> DataFrame:
    """``shared`` (``doc``, ``cell``) with each document's component ``c`` and the cell's size ``m``, in the cells where several components meet."""
    labels = known.select(F.col("node").alias("doc"), F.col("component"))
    labelled = written(shared.join(small_or_shuffled(labels), "doc", "left").select("cell", "doc", F.coalesce("component", "doc").alias("c")), "labelled")
    mixed = labelled.groupBy("cell").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo < hi").select((F.col("cell") + 0).alias("of"), "m")
    out = written(shuffled(labelled).join(mixed, F.col("cell") + 0 == F.col("of")).drop("of"), "mixed")
    discard(labelled)
    free_shuffles(shared.sparkSession)
    return out


#: Documents of one cell that are compared with the same partner in one round.
PARTY = 8
#: Rounds with single partners at most, and the pairs a row of the cells that the last round may have without another one.
ROUNDS, FEW_PAIRS = 3, 2


def _cell_stars(cells: DataFrame, similarity: float, salt: int) -> DataFrame:
    """Pairs of each document with one document of each of its cells.

    A cell's documents are dealt into parties of about ``PARTY``, others for each ``salt``, and each meets its party's
    first one: in a large cell different documents have different partners, so that a few odd ones do not spoil a round.
    """
    party = F.pmod(F.xxhash64("doc", F.lit(salt)), F.greatest(F.floor(F.col("m") / PARTY), F.lit(1).cast("long")))
    dealt = cells.withColumn("party", party)
    hubs = dealt.groupBy("cell", "party").agg(F.min(F.struct(F.xxhash64("doc", F.lit(-salt)).alias("first"), "doc", "n", "c", *_ODD)).alias("hub"))
    hubs = _side(hubs.select("cell", F.col("party").alias("of_party"), "hub.*"), "y", "of_party")
    met = (F.col("x_cell") == F.col("y_cell")) & (F.col("party") == F.col("of_party")) & (F.col("x_c") != F.col("y_c"))
    found = shuffled(_side(dealt, "x", "party")).join(hubs, met & _may_agree(similarity))
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _pairs_to_come(cells: DataFrame) -> tuple[int, int]:
    """How many pairs ``_all_pairs`` would look at and the rows of the cells."""
    sizes = cells.groupBy("cell", "c").agg(F.count(F.lit(1)).alias("m"))
    per = sizes.groupBy("cell").agg(F.sum("m").alias("m"), F.max("m").alias("top"))
    found = per.agg(F.sum((F.col("m") - F.col("top")) * F.col("m")).alias("pairs"), F.sum("m").alias("rows")).first()
    return found.pairs or 0, found.rows or 0


def _all_pairs(cells: DataFrame, similarity: float) -> DataFrame:
    """All pairs of documents of different components that share a cell, where their odd sketches leave room for ``similarity``."""
    sizes = cells.groupBy("cell", "c").agg(F.count(F.lit(1)).alias("m"))
    top = sizes.groupBy("cell").agg(F.max(F.struct("m", "c")).alias("top")).select((F.col("cell") + 0).alias("of"), F.col("top.c").alias("largest"))
    few = _side(shuffled(cells).join(top, F.col("cell") + 0 == F.col("of")).where("c <> largest"), "x")
    found = shuffled(few).join(_side(cells, "y"), (F.col("x_cell") == F.col("y_cell")) & (F.col("x_c") != F.col("y_c")) & _first_shared() & _may_agree(similarity))
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, radius: int = 4, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: id and ``component_id``, for links of ``similarity`` or more on word shingles.

    Components are those of *all* pairs whose shingle sets have that Jaccard similarity.  Pairs are proposed by
    the grid range-join of SimHashes first, and what that leaves out by equal parts of their shingle sets (see
    ``part_cells``) then; each is compared exactly.
    Dense groups are not paired with themselves: rounds compare documents with single others, until few pairs are left,
    a round finds none or ``ROUNDS`` were made, and the last round takes every proposed pair whose ends are in different components by then.  Ids are integers; rows without an id are
    left out of groups (component null), rows that repeat an id are one document.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    present = own.where("doc_id is not null")
    spark = docs.sparkSession
    free_shuffles(spark)  # those of whoever made ``docs``
    rows = written(fingerprints(present, shingle=shingle, seeds=(seed,)), "fingerprints")
    total = rows.count()
    proposed = _grid_pairs(rows, radius)
    links = verified_links(proposed, own, shingle, similarity)
    found = [links]
    discard(rows, proposed)
    free_shuffles(spark)
    every = written(part_cells(present, total, shingle, similarity), "parts")
    # Cells of one document have nothing to find. A document's cells differ, so that a count tells.
    shared = every.groupBy("cell").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select((F.col("cell") + 0).alias("of"))
    # Merged, not broadcast where it is small, so that small inputs say what large ones will shuffle.
    cells = written(every.select("doc", "cell").join(shared.hint("merge"), F.col("cell") + 0 == F.col("of"), "left_semi"), "shared")
    odd = written(_odd_of_documents(every), "odd")
    discard(every)
    free_shuffles(spark)

    def narrowed(cells: DataFrame, links: DataFrame) -> DataFrame:
        known = connected_components(links, "a", "b")
        mixed = _mixed_cells(cells.select("doc", "cell"), known)
        out = written(_sketched(mixed, odd), "sketched")
        discard(known, cells, mixed)
        return out

    # Single partners until what is left has few pairs: they only save work, the last round takes all that is left.
    cells = narrowed(cells, links)
    for salt in range(1, ROUNDS + 1):
        pairs, held = _pairs_to_come(cells)
        if pairs <= FEW_PAIRS * held:
            break
        more = verified_links(_cell_stars(cells, similarity, salt), own, shingle, similarity)
        found = [*found, more]
        if more.isEmpty():
            break
        links = links.unionByName(more)
        free_shuffles(spark)
        cells = narrowed(cells, links)
    last = verified_links(_all_pairs(cells, similarity), own, shingle, similarity)
    nodes = connected_components(links.unionByName(last), "a", "b").withColumnRenamed("component", "component_id")
    discard(cells, odd, *found, last)
    return own.select("doc_id").join(shuffled(nodes), F.col("doc_id") == F.col("node"), "left").select(F.col("doc_id").alias(id_col), F.coalesce("component_id", "doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group of near copies, that of the smallest id; all columns stay."""
    with scratch() as keep:
        groups = near_copies(docs, id_col, text_col, **options)
        gone = keep(written(groups.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("__gone")).distinct(), "gone"))
    return docs.join(small_or_shuffled(gone), docs[id_col] == gone["__gone"], "left_anti")
