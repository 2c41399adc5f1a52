"""Similarity graphs over entities: cosine links, connected components, string indexing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwarden.operators.enrich import bounded
from sparkwarden.storage import discard, scratch, shuffled, written

#: Moves of a round of ``connected_components`` that are broadcast at most.
MOVES = 100_000


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)``: the smallest node that each node of the graph reaches.

    Contraction rounds: every node moves to the smallest node next to it, moves once more to where that one
    went, and the edges are rewritten and made distinct.  Long chains at least halve in each round, so the
    number of rounds grows with the logarithm of the longest path.  Each round's moves and edges are written to the
    shared folder, which keeps plans short; the moves are put together at the end, the last and smallest ones first.
    The minimum is combined before the shuffle, so a node with very many edges is no hot group.  Edges with a null end
    are left out; an edge from a node to itself gives a component of one node.  The result is a ``written`` table.
    """
    ends = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    given = written(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    moves, marks, rewritten = [], [], []
    live = given.where("a <> b")
    while not live.isEmpty():
        near = live.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("e"))
        step = near.groupBy(F.col("e.node").alias("node")).agg(F.min("e.other").alias("m")).select("node", F.least("node", "m").alias("to"))
        onward = step.select(F.col("node").alias("to"), F.col("to").alias("onward"))
        jump = written(step.join(onward, "to", "left").select("node", F.coalesce("onward", "to").alias("to")), "jump")
        mark = F.broadcast if jump.limit(MOVES + 1).count() <= MOVES else shuffled
        at_a, at_b = (mark(jump).select(F.col("node").alias(x), F.col("to").alias(f"to_{x}")) for x in "ab")
        moved = live.join(at_a, "a").join(at_b, "b").select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        live = written(moved.where("a <> b").distinct(), "edges")
        discard(*rewritten)
        moves, marks, rewritten = [*moves, jump], [*marks, mark], [live]
    labels = given.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node"))
    if moves:
        whole = moves[-1]
        for jump, mark in zip(reversed(moves[:-1]), reversed(marks[1:]), strict=True):
            onward = mark(whole).select(F.col("node").alias("to"), F.col("to").alias("onward"))
            whole = jump.join(onward, "to", "left").select("node", F.coalesce("onward", "to").alias("to"))
        labels = labels.join(marks[0](whole), "node", "left").select("node", F.coalesce("to", "component").alias("component"))
    labels = written(labels, "labels")
    discard(given, *moves, *rewritten)
    return labels


def cosine_links(visits: DataFrame, entity: str, attribute: str, least: float, most_common: int | None = None) -> DataFrame:
    """Pairs ``(a, b)`` of entities, a < b, with the cosine similarity of their 0/1 attributes, where it is ``least`` or more.

    An inverted index is joined with itself.  A pair at ``least`` has a set-size ratio of at least its square, so each
    entity only needs to be found through its rarest attributes (prefix filtering): all but the last
    ``ceil(least**2 * n) - 1`` of its n attributes, rarest first.  Attributes in more than ``most_common`` entities are
    left out of the similarity altogether, if that is given.  Where the index would look at more pairs than there are,
    since most entities share common attributes, blocks of entities are compared as matrices instead (``_block_links``).
    """
    # Written, since it is read several times and records may be far more than distinct visits.
    visits = written(visits.select(F.col(entity).alias("e"), F.col(attribute).alias("x")).distinct(), "visits")
    if most_common is not None:
        visits = visits.join(visits.groupBy("x").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") <= most_common).select("x"), "x", "left_semi")
    sought = _rarest(visits, least)
    looked = sought.groupBy("x").agg(F.count(F.lit(1)).cast("double").alias("df")).agg(F.sum(F.col("df") * F.col("df"))).first()[0] or 0
    entities = visits.select("e").distinct().count()
    if looked > entities**2:
        # Small inputs are cut into smaller blocks, which keep several tasks busy.
        return _block_links(attribute_sets(visits), entities, least, min(BLOCK, max(LEAST_BLOCK, -(-entities // 16))))
    a = sought.select(F.col("e").alias("a"), "x", F.col("n").alias("n_a"))
    b = sought.select(F.col("e").alias("b"), "x", F.col("n").alias("n_b"))
    pairs = a.join(b, "x").where((F.col("a") < F.col("b")) & _sizes_fit(least)).select("a", "b").distinct()
    return _verified(pairs, visits, least)


def _rarest(visits: DataFrame, least: float) -> DataFrame:
    """``(e, x, n)``: the attributes through which an entity of ``n`` must be found."""
    ranked = visits.join(visits.groupBy("x").agg(F.count(F.lit(1)).alias("df")), "x")
    w = Window.partitionBy("e")
    ranked = ranked.select("e", "x", F.row_number().over(w.orderBy("df", "x")).alias("k"), F.count(F.lit(1)).over(w).alias("n"))
    return ranked.where(F.col("k") <= F.col("n") - F.ceil(F.lit(least * least) * F.col("n") - 1e-9) + 1).select("e", "x", "n")


def _sizes_fit(least: float) -> Column:
    bound = F.lit(least * least - 1e-9)
    return (F.col("n_a") >= bound * F.col("n_b")) & (F.col("n_b") >= bound * F.col("n_a"))


def _verified(pairs: DataFrame, visits: DataFrame, least: float) -> DataFrame:
    """The pairs ``(a, b)`` whose similarity is ``least`` or more, with it."""
    sizes = visits.groupBy("e").agg(F.count(F.lit(1)).alias("n"))
    of_a, of_b = (sizes.select(F.col("e").alias(x), F.col("n").alias(f"n_{x}")) for x in "ab")
    one, two = visits.select(F.col("e").alias("a"), "x"), visits.select(F.col("e").alias("b"), "x")
    common = pairs.join(one, "a").join(two, ["b", "x"]).groupBy("a", "b").agg(F.count(F.lit(1)).alias("c")).join(of_a, "a").join(of_b, "b")
    return common.withColumn("similarity", F.round(F.col("c") / F.sqrt(F.col("n_a") * F.col("n_b")), 6)).where(F.col("similarity") >= least).select("a", "b", "similarity")


def attribute_sets(visits: DataFrame) -> DataFrame:
    """``(e, s, n)`` of distinct rows ``(e, x)``, as a written table: the attributes of each entity as numbers that rise with rarity.

    ``n`` counts a null among the attributes too, which equals no other; ``s`` does not hold it.
    """
    with scratch() as keep:
        visits = visits.where("e is not null")
        numbers = frequency_index(visits.where("x is not null"), "x").select("x", "index")
        rows = visits.join(bounded(numbers), "x", "left")
        return keep(written(rows.groupBy("e").agg(F.array_sort(F.collect_list("index")).alias("s"), F.count(F.lit(1)).alias("n")), "sets"))


#: Entities of a block at most and at least, attributes and rows of a block that are compared at once, and tasks at most.
BLOCK, LEAST_BLOCK, ATTRIBUTES, STRIPE, BLOCK_TASKS = 2048, 256, 4096, 256, 4000


def _block_links(sets: DataFrame, entities: int, least: float, block: int = BLOCK) -> DataFrame:
    """What ``cosine_links`` gives, from products of 0/1 matrices: each pair of blocks is one group.

    All pairs are looked at, so the time grows with their number; a task holds two blocks, one product and the pairs of
    ``STRIPE`` of its rows at a time, and each entity is sent once for each block.
    """
    blocks = max(1, -(-entities // block))
    own, other = F.pmod(F.xxhash64("e"), F.lit(blocks)).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    dealt = sets.select("e", "s", "n", own, other).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other")
    # A stated number of tasks: their work is the pairs, not the bytes by which Spark would put them together.
    dealt = dealt.repartition(min(blocks * (blocks + 1), BLOCK_TASKS), "i", "j")
    kind = sets.schema["e"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pa.Table.from_batches(list(batches)).combine_chunks()
        lists = group.column("s").chunk(0) if group.num_rows else pa.array([], pa.list_(pa.int32()))
        flat = np.asarray(lists.flatten()).astype(np.int64)
        lengths = np.diff(np.asarray(lists.offsets))
        owner = np.repeat(np.arange(len(lengths)), lengths)
        _, codes = np.unique(flat, return_inverse=True)
        mine, i, j = np.asarray(group.column("own")), group.column("i")[0].as_py(), group.column("j")[0].as_py()
        left, right = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        common = np.zeros((len(left), len(right)), np.float32)  # counts below 2**24
        for lo in range(0, int(codes.max()) + 1 if len(codes) else 0, ATTRIBUTES):
            here = (codes >= lo) & (codes < lo + ATTRIBUTES)
            ones = np.zeros((len(lengths), min(ATTRIBUTES, int(codes.max()) + 1 - lo)), np.float32)
            ones[owner[here], codes[here] - lo] = 1
            common += ones[left] @ ones[right].T
        n, e = np.asarray(group.column("n")).astype(np.int64), group.column("e").chunk(0)
        place = np.empty(len(e), np.int64)
        place[pc.array_sort_indices(e).to_numpy()] = np.arange(len(e))
        for lo in range(0, len(left), STRIPE):
            part, some = common[lo : lo + STRIPE], left[lo : lo + STRIPE]
            near = part >= (least - 1e-5) * np.sqrt(n[some][:, None].astype(np.float64) * n[right][None])
            near &= part > 0
            if i == j:  # within a block a pair comes in both orders, between two in one
                near &= place[some][:, None] < place[right][None]
            x, y = np.nonzero(near)
            c, x, y = part[x, y].astype(np.int64), some[x], right[y]
            a, b = np.where(place[x] < place[y], x, y), np.where(place[x] < place[y], y, x)
            yield pa.RecordBatch.from_arrays([e.take(pa.array(a)), e.take(pa.array(b)), pa.array(c), pa.array(n[a]), pa.array(n[b])], ["a", "b", "c", "n_a", "n_b"])

    found = dealt.groupBy("i", "j").applyInArrow(run, f"a {kind}, b {kind}, c long, n_a long, n_b long")
    similarity = F.round(F.col("c") / F.sqrt(F.col("n_a") * F.col("n_b")), 6)
    return found.select("a", "b", similarity.alias("similarity")).where(F.col("similarity") >= least)


#: Rounds with single partners at most, and the pairs a row that the last round may have without another one.
ROUNDS, FEW_PAIRS = 4, 2
#: Cells of a product of 0/1 matrices that cost about as much as a pair that is joined and shuffled.
CELLS_PER_PAIR = 20
#: Entities of a block on the side of the few, and on the side of all, and attributes that are compared at once.
FEW_BLOCK, ALL_BLOCK, FEW_ATTRIBUTES = 2048, 8192, 1024


def cosine_components(visits: DataFrame, entity: str, attribute: str, least: float, rounds: int = ROUNDS) -> DataFrame:
    """``(node, component)``: the components of all pairs that ``cosine_links`` would give, without making all of them.

    Entities with the same attributes are one class and are not paired.  In each round a class is compared with one other
    for each of its rarest attributes, until few pairs are left or ``rounds`` were made; then what is outside the largest
    component is compared with all: by the pairs that share a rarest attribute and are in different components by then, or
    as matrices (``_block_joins``) where these would be too many.  A crowd of similar entities is one component after the
    first rounds, and none of its pairs is made.  The result is a ``written`` table.
    """
    with scratch() as keep:
        sets = attribute_sets(visits.select(F.col(entity).alias("e"), F.col(attribute).alias("x")).distinct())
        # A class has the component ``c`` that it is in by now; it is ``linked`` if it is like another class.
        now = sets.where("size(s) > 0").groupBy("s", "n").agg(F.min("e").alias("e"), F.count(F.lit(1)).alias("m"))
        now = written(now.withColumns({"c": F.col("e"), "linked": F.lit(False)}), "classes")
        # Rarest first: the numbers rise with rarity.
        ahead = F.slice(F.reverse("s"), F.lit(1), (F.col("n") - F.ceil(F.lit(least * least) * F.col("n") - 1e-9) + 1).cast("int"))
        for turn in range(rounds + 1):
            marked = now.select("e", "s", "n", "c", F.explode(ahead).alias("x"))
            if turn:
                sizes = marked.groupBy("x", "c").agg(F.count(F.lit(1)).alias("m")).groupBy("x").agg(F.sum("m").alias("m"), F.max(F.struct("m", "c")).alias("top"))
                sizes = sizes.where("m > top.m").select("x", "m", F.col("top.m").alias("most"), F.col("top.c").alias("largest"))
            else:  # all are alone
                sizes = marked.groupBy("x").agg(F.count(F.lit(1)).alias("m"), F.lit(1).cast("long").alias("most"), F.min("c").alias("largest")).where("m > 1")
            sizes = written(sizes, "mixed")
            left = sizes.agg(F.sum(F.col("m").cast("double") * (F.col("m") - F.col("most"))).alias("pairs"), F.sum("m").alias("rows")).first()
            if not left["pairs"]:
                break
            last = turn == rounds or left["pairs"] <= FEW_PAIRS * left["rows"]
            joins = _last_joins(now, marked, sizes, left["pairs"], least) if last else _star_joins(marked, sizes, turn, least)
            joins = written(joins, "joins")
            if not joins.isEmpty():
                known = connected_components(joins, "a", "b").select(F.col("node").alias("c"), F.col("component"))
                found = now.join(bounded(known), "c", "left").withColumns({"c": F.coalesce("component", "c"), "linked": F.col("linked") | F.col("component").isNotNull()})
                now = written(found.drop("component"), "classes")
            if last:
                break
        alike = (F.col("m") > 1) & (F.round(F.size("s") / F.col("n"), 6) >= least)
        named = now.where(F.col("linked") | alike).select("s", "n", F.col("c").alias("component"))
        return keep(written(sets.join(named, ["s", "n"]).select(F.col("e").alias("node"), "component"), "nodes"))


def _similarity() -> Column:
    return F.round(F.size(F.array_intersect("s_a", "s_b")) / F.sqrt(F.col("n_a") * F.col("n_b")), 6)


def _joined() -> list[Column]:
    """The components of a pair, the smaller one first."""
    return [F.least("c_a", "c_b").alias("a"), F.greatest("c_a", "c_b").alias("b")]


def _side(of: DataFrame, x: str, *columns: str) -> DataFrame:
    return of.select("x", *(F.col(c).alias(f"{c}_{x}") for c in columns))


def _star_joins(marked: DataFrame, sizes: DataFrame, turn: int, least: float) -> DataFrame:
    """Components ``(a, b)`` that entities and the one hub of each of their attributes join; compared where they are read, so no pair is shuffled."""
    rows = marked.join(bounded(sizes.select("x")), "x", "left_semi").withColumn("h", F.xxhash64("e", F.lit(turn)))
    first = written(rows.groupBy("x").agg(F.min("h").alias("h")), "first")
    hubs = written(rows.join(bounded(first), ["x", "h"], "left_semi"), "hubs")
    pairs = _side(rows, "a", "s", "n", "c").join(bounded(_side(hubs, "b", "s", "n", "c")), "x").where((F.col("c_a") != F.col("c_b")) & _sizes_fit(least))
    return pairs.where(_similarity() >= least).select(*_joined()).distinct()


def _last_joins(now: DataFrame, marked: DataFrame, sizes: DataFrame, pairs: float, least: float) -> DataFrame:
    """Components ``(a, b)`` that all other links join."""
    counts = written(now.groupBy("c").agg(F.count(F.lit(1)).alias("k")), "counts")
    top = counts.agg(F.max(F.struct("k", "c")).alias("top"), F.sum("k").alias("all")).select("top.k", "top.c", "all").first()
    few = top["all"] - top["k"]
    if pairs * CELLS_PER_PAIR > float(few) * top["all"]:
        return _block_joins(now.where(F.col("c") != top["c"]), now, few, top["all"], least)
    # At each attribute, all but the largest component meet all entities.
    a, b = _side(marked.join(bounded(sizes), "x").where("c <> largest"), "a", "e", "n", "c"), _side(marked, "b", "e", "n", "c")
    found = a.join(b, "x").where((F.col("c_a") != F.col("c_b")) & _sizes_fit(least)).select(F.least("e_a", "e_b").alias("e_a"), F.greatest("e_a", "e_b").alias("e_b")).distinct()
    of_a, of_b = (now.select(*(F.col(c).alias(f"{c}_{x}") for c in ("e", "s", "n", "c"))) for x in "ab")
    return found.join(of_a, "e_a").join(of_b, "e_b").where(_similarity() >= least).select(*_joined()).distinct()


def _block_joins(few: DataFrame, every: DataFrame, n_few: int, n_every: int, least: float, blocks: tuple[int, int] = (FEW_BLOCK, ALL_BLOCK)) -> DataFrame:
    """Components ``(a, b)`` that links between entities of ``few`` and ``every`` (e, s, n, c) join, from products of 0/1 matrices.

    Each pair of blocks is one group, which holds one product at a time and gives at most one row for each of its entities.
    """
    parts = max(1, -(-n_few // blocks[0])), max(1, -(-n_every // blocks[1]))
    own = lambda k: F.pmod(F.xxhash64("e"), F.lit(parts[k])).cast("int")
    other = lambda k: F.explode(F.sequence(F.lit(0), F.lit(parts[k] - 1)))
    columns = ["s", "n", "c"]
    left = few.select(*columns, F.lit(True).alias("few"), own(0).alias("i"), other(1).alias("j"))
    right = every.select(*columns, F.lit(False).alias("few"), other(0).alias("i"), own(1).alias("j"))
    kind = every.schema["c"].dataType.simpleString()

    def forest(x: np.ndarray, y: np.ndarray, nodes: int) -> np.ndarray:
        """Indices of some of the edges ``(x, y)``, fewer than ``nodes``, that connect whatever all of them connect."""
        label, edge, kept = np.arange(nodes), np.arange(len(x)), [np.zeros(0, np.int64)]
        while True:
            p, q = label[x[edge]], label[y[edge]]
            live = p != q
            if not live.any():
                return np.concatenate(kept)
            edge, p, q = edge[live], p[live], q[live]
            roots, first = np.unique(np.maximum(p, q), return_index=True)
            kept.append(edge[first])
            label[roots] = np.minimum(p, q)[first]
            while (label[label] != label).any():
                label = label[label]

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        lists = group.column("s").chunk(0)
        flat = np.asarray(lists.flatten()).astype(np.int64)
        lengths = np.diff(np.asarray(lists.offsets))
        owner = np.repeat(np.arange(len(lengths)), lengths)
        of_few = np.asarray(group.column("few"))
        x, y = np.flatnonzero(of_few), np.flatnonzero(~of_few)
        values, codes = np.unique(flat, return_inverse=True)
        common = np.zeros((len(x), len(y)), np.float32)  # counts below 2**24
        for lo in range(0, len(values), FEW_ATTRIBUTES):
            here = (codes >= lo) & (codes < lo + FEW_ATTRIBUTES)
            ones = np.zeros((len(lengths), min(FEW_ATTRIBUTES, len(values) - lo)), np.float32)
            ones[owner[here], codes[here] - lo] = 1
            common += ones[x] @ ones[y].T
        n = np.asarray(group.column("n")).astype(np.float64)
        p, q = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lo in range(0, len(x), 256):  # a few rows at a time, as doubles
            part, some = common[lo : lo + 256], x[lo : lo + 256]
            i, j = np.nonzero((part > 0) & (part / np.sqrt(n[some][:, None] * n[y][None]) >= least - 5e-7))  # as rounded
            p.append(some[i])
            q.append(y[j])
        p, q = np.concatenate(p), np.concatenate(q)
        names = group.column("c").chunk(0).dictionary_encode()
        of = np.asarray(names.indices)
        kept = forest(of[p], of[q], len(names.dictionary))
        return pa.table({"a": names.dictionary.take(pa.array(of[p[kept]])), "b": names.dictionary.take(pa.array(of[q[kept]]))})

    found = left.unionByName(right).groupBy("i", "j").applyInArrow(run, f"a {kind}, b {kind}")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def frequency_index(df: DataFrame, column: str) -> DataFrame:
    """``(value, index)``: values numbered from 0 by descending frequency, ties by value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    # Ranges of the order are numbered by themselves; what comes before each is a sum over as many rows as there are ranges.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(counts.repartitionByRange(parts, F.desc("n"), F.col(column)).withColumn("__range", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("rows"))
    before = totals.select("__range", (F.sum("rows").over(Window.orderBy("__range")) - F.col("rows")).alias("before"))
    place = F.row_number().over(Window.partitionBy("__range").orderBy(F.desc("n"), column)) - 1
    return ranged.withColumn("__place", place).join(F.broadcast(before), "__range").select(column, "n", (F.col("before") + F.col("__place")).cast("int").alias("index"))
