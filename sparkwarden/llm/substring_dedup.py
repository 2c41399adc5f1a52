"""Substring deduplication with difference-cover anchors.

Windows of ``window`` words that occur twice anywhere are found without comparing documents:

1. *Anchors.* A difference cover D modulo ``v`` has, for any two positions i and j, a shift s < v with i+s and j+s both
   in D (mod v).  So two equal windows share an aligned anchor of ``window - v + 1`` words that starts at a cover
   position of both.  Only anchors at cover positions are hashed and counted (5 of 21 positions).  Repeated ones are
   told by a broadcast bitmap of fixed size while they are few enough for it, and by a join of places beyond that.
2. *Extension.* Around anchors that occur twice, the full windows are hashed.  Neighbouring windows make a run; runs
   that are copied whole are counted by one digest, and only the windows of distinct runs are counted one by one.
3. *Removal.* Words under a repeated window go.

Counts are combined before each shuffle, so a passage in a third of all documents is no hot group, and nothing is
paired.  Anchors are only a filter.  Windows count as equal by a 64-bit hash of their words' 64-bit hashes: among n
distinct candidate windows about n * n / 2**65 pairs collide, a few in ten billion.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwarden.llm import arrays, bitmap
from sparkwarden.storage import discard, free_shuffles, written

#: A perfect difference set: every residue modulo 21 is a difference of two of its members.
PERIOD = 21
COVER = (3, 6, 7, 12, 14)
_HASH_BYTES = 8
#: Bits of the bitmap that a repeated anchor needs: one in so many other anchors passes then.
BITS_PER_ANCHOR = 16


def _positions(words: arrays.Words) -> np.ndarray:
    """Of each word, its position in its document."""
    n = words.count
    return np.arange(len(words.start)) - np.repeat(words.first[:-1], n)


def _anchors(words: arrays.Words, hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and hash of each anchor in documents of at least one window."""
    size = window - PERIOD + 1
    found = arrays.window_hashes(hashes, size)
    room = np.repeat(np.where(words.count >= window, words.count, 0), words.count)
    at = _positions(words)
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    index = np.flatnonzero((cover[at % PERIOD] & (at + size <= room))[: len(found)])
    return index, found[index]


def _word_hashes(words: arrays.Words) -> np.ndarray:
    return arrays.xxh64(words.data, words.start, words.length, 7)


def anchor_counts(docs: DataFrame, text_col: str, window: int) -> DataFrame:
    """``(h, n)`` of all anchors, counted over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = arrays.as_strings(batch.column(0))
            for a, b in arrays.slices(texts, 4 * arrays.SLICE_BYTES):
                found = []
                for c, d in arrays.slices(part := texts.slice(a, b - a)):
                    words = arrays.split_words(*arrays.buffers(part.slice(c, d - c)))
                    found.append(_anchors(words, _word_hashes(words), window)[1])
                h, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    return docs.select(text_col).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _anchor_places(numbered: DataFrame, text_col: str, window: int) -> DataFrame:
    """``(row, at, h)`` of all anchors: the document's number, the anchor's place in it, its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = arrays.as_strings(batch.column(1))
            for a, b in arrays.slices(texts):
                words = arrays.split_words(*arrays.buffers(texts.slice(a, b - a)))
                index, found = _anchors(words, _word_hashes(words), window)
                doc = np.searchsorted(words.first, index, side="right") - 1
                rows = batch.column(0).slice(a, b - a).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([rows, pa.array((index - words.first[doc]).astype(np.int32)), pa.array(found.view(np.int64))], ["row", "at", "h"])

    return numbered.select("row", text_col).mapInArrow(run, "row long, at int, h long")


def _mark(docs: DataFrame, id_col: str, text_col: str, window: int, repeated: np.ndarray | None, keep_text: bool) -> DataFrame:
    """One row per document: its runs of candidate windows with their hashes, or its digest where it has none.

    Repeated anchors are those in the bitmap ``repeated``, or without one those whose places the column ``at`` lists.
    The text goes along where there are runs, or if ``keep_text``.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(repeated)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            everything = arrays.as_strings(batch.column(1))
            for a, b in arrays.slices(everything):
                texts = everything.slice(a, b - a)
                words = arrays.split_words(*arrays.buffers(texts))
                hashes = _word_hashes(words)
                count, at = words.count, _positions(words)
                if held.value is not None:
                    index, anchors = _anchors(words, hashes, window)
                    index = index[bitmap.holds(held.value, anchors)]
                else:
                    places = batch.column(2).slice(a, b - a)
                    per = pc.fill_null(pc.list_value_length(places), 0).to_numpy(zero_copy_only=False)
                    index = np.repeat(words.first[:-1], per) + places.flatten().to_numpy()
                hit = np.zeros(len(hashes) + 1, np.int64)
                hit[index + 1] = 1
                hit = np.cumsum(hit)  # hit[k]: repeated anchors before word k
                last = np.repeat(words.first[1:], count) - window  # the last window of each word's document
                starts = np.arange(len(hashes))
                candidate = (starts <= last) & (hit[np.minimum(starts + PERIOD, len(hashes))] > hit[starts])
                chosen = np.flatnonzero(candidate)
                full = arrays.window_hashes(hashes, window, 2)[chosen]
                # A run ends where the next candidate isn't the next word, or is in another document.
                cuts = np.flatnonzero(np.r_[True, (np.diff(chosen) > 1) | (at[chosen[1:]] == 0)]) if len(chosen) else np.zeros(0, np.int64)
                ends = np.r_[cuts[1:], len(chosen)].astype(np.int64)
                doc_of = np.searchsorted(words.first, chosen[cuts], side="right") - 1
                first_run = np.searchsorted(doc_of, np.arange(len(texts) + 1))
                out = {k: [] for k in ("row", "n_words", "sha", "text", "first", "runs")}
                for k in range(len(texts)):
                    row += 1
                    lo, hi = int(first_run[k]), int(first_run[k + 1])
                    out["row"].append(row)
                    out["n_words"].append(int(count[k]))
                    if lo == hi:
                        end = int(words.first[k + 1]) - 1
                        span = words.data[words.start[words.first[k]] : words.start[end] + words.length[end]].tobytes() if count[k] else b""
                        out["sha"].append(hashlib.sha256(span).hexdigest())
                        out["text"].append(span.decode() if keep_text else None)
                    else:
                        out["sha"].append(None)
                        out["text"].append(texts[k].as_py())
                    out["first"].append([int(at[chosen[cuts[r]]]) for r in range(lo, hi)])
                    out["runs"].append([full[cuts[r] : ends[r]].tobytes() for r in range(lo, hi)])
                kinds = {"row": pa.int64(), "n_words": pa.int64(), "sha": pa.string(), "text": pa.string(), "first": pa.list_(pa.int32()), "runs": pa.list_(pa.binary())}
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(v, kinds[k]) for k, v in out.items())], [id_col, *out])

    return docs.select(id_col, text_col, *(["at"] if repeated is None else [])).mapInArrow(run, f"{id_col} {kind}, row long, n_words long, sha string, text string, first array<int>, runs array<binary>")


#: Shares of all windows, by their hashes, that are shuffled one after the other: disk is needed for one of them.
TURNS = 2


def _windows(runs: DataFrame, with_place: bool, turn: int) -> DataFrame:
    """The windows of runs whose turn it is: their hash ``h``, and ``n`` (of the run) or their place (``row``, ``at``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                blobs = part.column(0).to_pylist()
                hashes = np.frombuffer(b"".join(blobs), np.int64)
                per = np.array([len(x) // _HASH_BYTES for x in blobs])
                mine = hashes % TURNS == turn
                more = np.repeat(part.column(1).to_numpy(), per)[mine]
                if with_place:
                    base = np.cumsum(per) - per
                    at = (np.arange(len(hashes)) - np.repeat(base - part.column(2).to_numpy(), per))[mine]
                    yield pa.RecordBatch.from_arrays([pa.array(hashes[mine]), pa.array(more), pa.array(at)], ["h", "row", "at"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(hashes[mine]), pa.array(more)], ["h", "n"])

    if with_place:
        return runs.select("hashes", "row", F.col("first").cast("long")).mapInArrow(run, "h long, row long, at long")
    return runs.select("hashes", F.col("n").cast("long")).mapInArrow(run, "h long, n long")


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, with_text: bool = False, bits: int = bitmap.BITS) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_removed``, ``kept_sha256`` (and ``kept_text`` if asked for).

    A word goes if a window of ``window`` words over it has the same words as a window that starts anywhere else, in
    another document or the same one; all windows are judged on the input.  ``kept_sha256`` is of the kept words joined
    by one space.  A null text has no words; texts shorter than a window keep everything; rows that repeat an id are
    documents of their own and, being copies, lose what they share.  An empty table gives an empty result.
    """
    if window <= PERIOD:
        raise ValueError(f"window must be over {PERIOD} words")
    anchors = written(anchor_counts(docs, text_col, window).where("n > 1").select("h"), "anchors")
    if anchors.count() * BITS_PER_ANCHOR <= 1 << bits:
        marked = written(_mark(docs, id_col, text_col, window, bitmap.build(anchors, "h", bits), with_text), "marked")
    else:  # a full bitmap would let everything pass: the anchors' places are joined with the repeated ones instead
        numbered = written(docs.select(F.col(id_col), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row")), "numbered")
        places = _anchor_places(numbered, "text", window).join(anchors, "h", "left_semi").groupBy("row").agg(F.collect_list("at").alias("at"))
        marked = written(_mark(numbered.join(places, "row", "left").select(id_col, "text", "at"), id_col, "text", window, None, with_text), "marked")
        discard(numbered)
    discard(anchors)
    free_shuffles(docs.sparkSession)
    listed = marked.where(F.size("runs") > 0).select("row", F.explode(F.arrays_zip("first", "runs")).alias("r")).select("row", F.col("r.first").alias("first"), F.col("r.runs").alias("hashes"))
    keyed = listed.select("row", "first", "hashes", F.xxhash64("hashes").alias("d1"), F.xxhash64("hashes", F.lit(1)).alias("d2"), (F.length("hashes") / _HASH_BYTES).cast("int").alias("size"))
    groups = keyed.groupBy("d1", "d2", "size").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "first")).alias("one"))
    # Joined on the first place of each group: every run is read once more, but only its first copy keeps its hashes.
    firsts = groups.select(F.col("one.row").alias("row"), F.col("one.first").alias("first"), "n")
    distinct_runs = written(keyed.select("row", "first", "hashes").join(firsts, ["row", "first"]), "runs")
    free_shuffles(docs.sparkSession)
    turns = []
    for turn in range(TURNS):
        repeated = written(_windows(distinct_runs, False, turn).groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h"), "repeated")
        free_shuffles(docs.sparkSession)
        single = _windows(distinct_runs.where("n = 1"), True, turn)
        turns.append(written(single.join(repeated, "h", "left_semi").select("row", "at"), "places"))
        discard(repeated)
        free_shuffles(docs.sparkSession)
    places = functools.reduce(DataFrame.unionByName, turns)
    spans = written(places.groupBy("row").agg(F.sort_array(F.collect_list("at")).alias("at")), "spans")
    # Runs that are copied whole: every window of every copy is repeated.
    lone = written(distinct_runs.where("n = 1").select("row", "first"), "lone")
    discard(distinct_runs, *turns)
    free_shuffles(docs.sparkSession)
    lone = lone.select((F.col("row") + 0).alias("row"), F.col("first"))
    whole = keyed.select("row", "first", F.col("size").alias("len")).join(lone, ["row", "first"], "left_anti")
    wholes = whole.groupBy("row").agg(F.collect_list(F.struct("first", "len")).alias("whole"))
    touched = marked.where(F.size("runs") > 0).select(id_col, "row", "n_words", "text").join(spans, "row", "left").join(wholes, "row", "left")
    out_text = ", kept_text string" if with_text else ""
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, digests, kept_texts = [], [], []
            for n, text, at, full in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4)), strict=True):
                edge = np.zeros(n + 1, np.int64)
                if at:
                    at = np.asarray(at)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + window, -1)
                for x in full or ():
                    edge[x["first"]] += 1
                    edge[x["first"] + x["len"] + window - 1] -= 1
                covered = np.cumsum(edge[:-1]) > 0
                words = text.encode().split()
                kept = b" ".join([w for w, c in zip(words, covered.tolist(), strict=True) if not c]) if covered.any() else b" ".join(words)
                removed.append(int(covered.sum()))
                digests.append(hashlib.sha256(kept).hexdigest())
                kept_texts.append(kept.decode())
            columns = [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(kept_texts, pa.string())] if with_text else [])], [id_col, "n_words", "n_removed", "kept_sha256", *(["kept_text"] if with_text else [])])

    changed = touched.select(id_col, "n_words", "text", "at", "whole").mapInArrow(cut, f"{id_col} {kind}, n_words long, n_removed long, kept_sha256 string{out_text}")
    same = marked.where(F.size("runs") == 0).select(id_col, "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"), *([F.col("text").alias("kept_text")] if with_text else []))
    return same.unionByName(changed)
