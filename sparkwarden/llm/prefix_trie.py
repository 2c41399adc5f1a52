"""The trie of conversation prefixes, from sorted neighbours: union-find over LCP edges in descending depth.

Rebuilt conversations are sorted by their turns (16 bytes of SHA-256 each) over range partitions.  Within a partition an
edge joins each conversation with the one before it, at the depth of their longest common prefix.  Edges are taken from
the deepest to the shallowest; each merge of two components is a branch of the node at that depth, whose numbers are
summed from both sides, and closes the nodes below it.  Only nodes on the path of a partition's first or last
conversation can go on in its neighbours: they are contracted to those two paths with partial numbers, and blocks of
partitions are merged by the same procedure, level by level, until one block is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwarden.llm import workers
from sparkwarden.storage import discard, small_or_shuffled, written

#: Bytes of a turn in a key.
WIDTH = 16
#: Partitions whose paths one task merges.
BLOCK = 64
#: Turns that one range partition holds, about.
TURNS = 400_000

#: One row per node (kind 0), per open path (1) and per run of ends on an open path (2).
_OUT = (
    "kind int, at long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, own binary, parent binary, key binary, paths array<array<long>>, ends string"
)
_NAMES = [part.split()[0] for part in _OUT.split(", ")]
_TYPES = dict(zip(_NAMES, [pa.int32(), *[pa.int64()] * 8, pa.string(), *[pa.binary()] * 3, pa.list_(pa.list_(pa.int64())), pa.string()], strict=True))


@dataclass
class Path:
    """A sorted sequence with numbers per depth (0 to its length): what it adds to the node there.

    ``n`` members, ``low`` the smallest of them (None without), ``kids``, ``leaves`` and ``saved`` of closed subtrees
    that hang at the node, ``chars`` of the node's last text.
    """

    key: bytes
    n: list[int]
    low: list[int | None]
    kids: list[int]
    leaves: list[int]
    saved: list[int]
    chars: list[int]

    @property
    def length(self) -> int:
        return len(self.key) // WIDTH

    @classmethod
    def of(cls, conv_id: int, key: bytes, chars: list[int]) -> Path:
        d = len(key) // WIDTH + 1
        return cls(key, [1] * d, [conv_id] * d, [0] * d, [0] * d, [0] * d, [0, *chars])

    def row(self) -> list[list[int | None]]:
        return [self.n, self.low, self.kids, self.leaves, self.saved, self.chars]


def common(a: bytes, b: bytes) -> int:
    """Turns that two keys share at their beginning."""
    most = min(len(a), len(b)) // WIDTH
    if a[: most * WIDTH] == b[: most * WIDTH]:
        return most
    lo, hi = 0, most
    while lo < hi:  # the longest equal prefix, by halving
        mid = (lo + hi + 1) // 2
        if a[: mid * WIDTH] == b[: mid * WIDTH]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def prefix_ids(key: bytes) -> list[bytes]:
    """A name for each prefix of a key, from depth 0."""
    h = hashlib.sha256()
    out = [h.digest()[:WIDTH]]
    for at in range(0, len(key), WIDTH):
        h.update(key[at : at + WIDTH])
        out.append(h.digest()[:WIDTH])
    return out


class Forest:
    """The forest of sorted ``paths``; ``whole`` says that nothing goes on beyond them, so that every node closes."""

    def __init__(self, paths: list[Path], whole: bool = False):
        self.paths = paths
        m = len(paths)
        self.lcp = [-1] + [common(paths[k - 1].key, paths[k].key) for k in range(1, m)]
        self.link = list(range(m))
        # (path, depth) of each closed node's parent is known when its component merges: (path, lcp).
        self.up: dict[int, tuple[int, int]] = {}
        self.open = [-1] * m  # of each path, the deepest of its own nodes that lies on the first or last path
        if not whole:
            depth = paths[-1].length
            for k in range(m - 1, -1, -1):
                if depth > self.lcp[k]:
                    self.open[k] = depth
                depth = min(depth, self.lcp[k])
            self.open[0] = paths[0].length
        for k in sorted(range(1, m), key=lambda k: -self.lcp[k]):
            self._merge(k)
        if whole:
            self._close(0, -1)

    def _find(self, k: int) -> int:
        while self.link[k] != k:
            self.link[k] = self.link[self.link[k]]
            k = self.link[k]
        return k

    def _close(self, k: int, above: int) -> tuple[int, int, int]:
        """Sum up the closed nodes of path ``k`` from its end to ``above`` (exclusive): topmost depth, leaves, saved."""
        p = self.paths[k]
        stop = max(above, self.open[k])
        leaves = saved = 0
        for d in range(p.length, stop, -1):
            if d < p.length:
                p.kids[d] += 1
            p.leaves[d] = p.leaves[d] + leaves if p.kids[d] else 1
            p.saved[d] += saved + (p.n[d] - 1) * p.chars[d]
            leaves, saved = p.leaves[d], p.saved[d]
        if stop > above and stop < p.length:  # what is closed hangs at the deepest open node
            p.kids[stop] += 1
            p.leaves[stop] += leaves
            p.saved[stop] += saved
        return stop, leaves, saved

    def _merge(self, k: int) -> None:
        """The edge between path ``k`` and the one before: its component joins the other, which starts further left."""
        at = self.lcp[k]
        other = self._find(k - 1)
        p, into = self.paths[k], self.paths[other]
        stop, leaves, saved = self._close(k, at)
        for d in range(at + 1):
            into.n[d] += p.n[d]
            if p.low[d] is not None and (into.low[d] is None or p.low[d] < into.low[d]):
                into.low[d] = p.low[d]
            into.kids[d] += p.kids[d]
            into.leaves[d] += p.leaves[d]
            into.saved[d] += p.saved[d]
        if stop == at and p.length > at:
            into.kids[at] += 1
            into.leaves[at] += leaves
            into.saved[at] += saved
        self.link[k] = other
        self.up[k] = (other, at)

    def is_open(self, k: int, d: int) -> bool:
        return d <= self.open[k]

    def owner(self, k: int, d: int) -> int:
        """The path that holds the numbers of the node at depth ``d`` of path ``k``."""
        while d <= self.lcp[k]:
            k = self.up[k][0]
        return k

    def closed(self) -> Iterator[tuple[int, int, tuple[int, int] | None]]:
        """``(path, depth, parent)`` of each closed node; the root has no parent."""
        for k, p in enumerate(self.paths):
            for d in range(max(self.lcp[k], self.open[k]) + 1, p.length + 1):
                yield k, d, None if d == 0 else (k, d - 1) if d - 1 > self.lcp[k] else self.up[k]

    def contracted(self) -> list[Path]:
        """The first and the last path; what both share counts at the first."""
        first, last = self.paths[0], self.paths[-1]
        if first.key == last.key:
            return [first]
        out = Path(last.key, *([] for _ in range(6)))
        for d in range(last.length + 1):
            k = self.owner(len(self.paths) - 1, d)
            p = self.paths[k]
            values = (0, None, 0, 0, 0, p.chars[d]) if k == 0 else (p.n[d], p.low[d], p.kids[d], p.leaves[d], p.saved[d], p.chars[d])
            for column, value in zip(out.row(), values, strict=True):
                column.append(value)
        return [first, out]


def _ends(ids: list[int]) -> str:
    return ",".join(map(str, ids))


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], _TYPES[c]) for c in _NAMES], _NAMES)


def _rows_of(forest: Forest, at: int, ends: dict[int, list[int]] | None) -> Iterator[dict]:
    """Rows of the closed nodes, of the open paths and, with ``ends`` (of each path, who ends there), of open ends.

    Without ``ends`` the nodes are named, so that rows of lower levels find them; parents that are open are named too.
    """
    paths, names = forest.paths, {}

    def name(k: int, d: int) -> bytes:
        if k not in names:
            names[k] = prefix_ids(paths[k].key)
        return names[k][d]

    for k, d, parent in forest.closed():
        p = paths[k]
        row = {"kind": 0, "at": at, "conv_id": p.low[d], "depth": d, "n_convs": p.n[d], "n_children": p.kids[d], "n_leaves": p.leaves[d], "saved_tokens": p.saved[d]}
        if ends is None:
            row["own"] = name(k, d)
        else:
            row["ends_sha256"] = hashlib.sha256(_ends(ends.get(k, []) if d == p.length else []).encode()).hexdigest()
        if parent:
            if forest.is_open(*parent):
                row["parent"] = name(*parent)
            else:
                row["parent_conv_id"] = paths[parent[0]].low[parent[1]]
        yield row
    if any(d >= 0 for d in forest.open):
        for p in forest.contracted():
            yield {"kind": 1, "at": at, "key": p.key, "paths": p.row()}
        for k, ids in (ends or {}).items():
            if forest.is_open(k, paths[k].length):
                yield {"kind": 2, "at": at, "conv_id": ids[0], "own": name(k, paths[k].length), "ends": _ends(ids)}


def _batches(rows: Iterator[dict], size: int = 5_000) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _forest_of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of one range partition, sorted: copies become one path with several members first."""
    from pyspark import TaskContext

    paths: list[Path] = []
    ends: dict[int, list[int]] = {}
    for batch in batches:
        for conv_id, key, chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "key", "chars")), strict=True):
            if paths and paths[-1].key == key:
                p = paths[-1]
                p.n = [x + 1 for x in p.n]
            else:
                paths.append(Path.of(conv_id, key, chars))
                ends[len(paths) - 1] = []
            ends[len(paths) - 1].append(conv_id)
    if paths:
        yield from _batches(_rows_of(Forest(paths), TaskContext.get().partitionId(), ends))


def _merge_blocks(whole: bool):
    def run(key, table):
        rows = sorted(zip(table.column("key").to_pylist(), table.column("paths").to_pylist(), strict=True), key=lambda r: r[0])
        forest = Forest([Path(k, *p) for k, p in rows], whole)
        found = list(_rows_of(forest, key[0].as_py(), None))
        return pa.Table.from_batches([_batch(found)])

    return run


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node from its runs of ids, which come in order; of each node a hash state is held, not the ids."""
    own, h = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"of": [own], "hashed": [h.hexdigest()]}, schema=pa.schema([("of", pa.binary()), ("hashed", pa.string())]))

    for batch in batches:
        for name, ends in zip(batch.column("own").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if name != own:
                if h:
                    yield out()
                own, h = name, hashlib.sha256(ends.encode())
            else:
                h.update(b"," + ends.encode())
    if h:
        yield out()


def rebuilt_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, key, chars)``: the turns of each rebuilt conversation as one binary key, and their texts' lengths.

    A conversation starts with the first ``h`` turns of the conversation of the next lower multiple of 100 (h is the
    CRC-32 of its decimal id modulo 6) and goes on with its own turns from the h-th on.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text")).where("conv_id is not null")
    digest = F.unhex(F.substring(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary"), 256), 1, 2 * WIDTH))
    turn = F.struct("turn", "role", digest.alias("key"), F.length("text").alias("chars"))  # null turns sort first
    own = written(rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns")).select("conv_id", F.transform("turns", lambda t: F.struct(t["key"].alias("key"), t["chars"].alias("chars"))).alias("turns")), "own-turns")
    base = own.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 5).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int")
    met = own.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 100).alias("of"), "turns").join(base, F.col("of") == F.col("base"), "left")
    empty = F.slice("turns", 1, 0)
    whole = F.concat(F.slice(F.coalesce("head", empty), F.lit(1), h), F.slice("turns", h + 1, F.size("turns")))
    met = met.select("conv_id", whole.alias("turns"))
    out = met.select("conv_id", F.unhex(F.concat_ws("", F.transform("turns", lambda t: F.hex(t["key"])))).alias("key"), F.transform("turns", lambda t: t["chars"]).alias("chars"))
    out = written(out, "rebuilt")
    discard(own)
    return out


def prefix_trie(turns: DataFrame, **columns: str) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: see the module and ``rebuilt_conversations``.

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.  Null roles and texts are empty, rows without a conversation are
    left out, null turns come first, equal turns stand in the order of role and of a digest of the text, and a repeated
    row is a turn of its own.  A conversation may be left without turns; it ends at the root.  An empty table has no
    nodes.  Other columns are not looked at.  The ids that end at one node are hashed as a stream of runs, one run per
    partition, since SHA-256 allows no other way; nothing else of a node meets in one task.  Of one conversation 16
    bytes a turn are held by a task.
    """
    rebuilt = rebuilt_conversations(turns, **{f"{k}_col": v for k, v in columns.items()})
    spark = turns.sparkSession
    total = rebuilt.agg(F.sum(F.length("key") / WIDTH + 1)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total // TURNS) + 1)
    ordered = rebuilt.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    level = written(ordered.mapInArrow(workers.lean(_forest_of_partition), _OUT), "forests")
    discard(rebuilt)
    tables, left = [level], level.where("kind = 1").agg(F.max("at")).first()[0]
    ends = level.where("kind = 2")
    while left is not None:
        whole = left < BLOCK
        level = written(level.where("kind = 1").select(F.floor(F.col("at") / BLOCK).alias("block"), "key", "paths").groupBy("block").applyInArrow(_merge_blocks(whole), _OUT), "merged")
        tables.append(level)
        left = None if whole else left // BLOCK
    nodes = tables[0]
    for t in tables[1:]:
        nodes = nodes.unionByName(t)
    nodes = nodes.where("kind = 0").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "own", "parent")
    hashed = written(ends.select("own", "conv_id", "ends").repartition("own").sortWithinPartitions("own", "conv_id").mapInArrow(workers.lean(_hash_ends), "of binary, hashed string"), "ends")
    # Nodes that were open once: few, two paths a partition.
    spine = written(nodes.where("own is not null").select(F.col("own").alias("name"), F.col("conv_id").alias("name_conv_id")), "spine")
    none = F.sha2(F.lit("").cast("binary"), 256)
    out = nodes.join(small_or_shuffled(hashed), F.col("own") == F.col("of"), "left").join(small_or_shuffled(spine), F.col("parent") == F.col("name"), "left")
    return out.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "name_conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", "hashed", none).alias("ends_sha256"),
    )
