"""Benchmark decontamination by spaced-seed hashing.

A *seed* looks at the words of a span through a fixed mask that ignores some positions, so a substituted word there
does not spoil the hit.  Hashes of all seeds of the benchmark are joined with those of the documents, and around every
hit the words of both sides are compared on the hit's diagonal: a document is contaminated where at least ``overlap``
aligned words (or a whole shorter item) agree but for a share of ``substitutions``.

Before the join, document hashes pass a bitmap of the benchmark's hashes that has a fixed size.  The join itself is an
ordinary equi join: it holds for benchmarks of any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwarden.llm import arrays, bitmap, workers
from sparkwarden.storage import scratch, small_or_shuffled, written

#: Positions that each mask reads. With these, an aligned stretch of 12 words is hit wherever two of them are substituted.
MASKS = ("111111", "11011011", "1101000111", "10110011001", "110110101")
#: For items of 5 to 11 words: hit wherever a fifth of the words (one, from 10 words on two) is substituted.
SHORT_MASKS = ("1111", "11011", "10111", "11101")
#: Aligned words that make contamination, and the share of them that may differ.
OVERLAP = 12
SUBSTITUTIONS = 0.2
#: Words of the shortest items that count. Shorter ones, down to one word, can be asked for: they match as they stand.
MIN_WORDS = 5
_PUNCTUATION = np.array([c for c in range(33, 127) if not chr(c).isalnum()], np.uint8)


def _words(texts: pa.Array) -> tuple[arrays.Words, np.ndarray]:
    """Words with A-Z folded and ASCII punctuation taken as blanks, and a 64-bit hash of each."""
    data, offsets = arrays.buffers(texts)
    plain = data.copy()
    plain[np.isin(plain, _PUNCTUATION)] = 32
    words = arrays.split_words(plain, offsets, lower=True)
    return words, arrays.xxh64(words.data, words.start, words.length, 11)


def _masked(hashes: np.ndarray, mask: str, seed: int) -> np.ndarray:
    """The hash of each span of the mask's length, by the positions that the mask reads."""
    n = max(0, len(hashes) - len(mask) + 1)
    out = np.full(n, seed + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k, on in enumerate(mask):
            if on == "1":
                out = arrays.mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n])
    return out


def _seeds(texts: pa.Array, masks: dict[int, str], reach: int, held: np.ndarray | None, sizes: dict[int, tuple[int, int]]) -> dict[str, list]:
    """Seeds of a slice: document (index), place, hash and the words around it (32 bits each), those in ``held`` only.

    ``masks`` go by number. ``sizes``: the numbers of words, from and to, that a text has for a mask (those not there: any).
    """
    words, hashes = _words(texts)
    count = words.count
    owner = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(hashes)) - words.first[owner]
    room = count[owner]
    short = hashes.astype(np.uint32)
    out: dict[str, list] = {"doc": [], "place": [], "size": [], "h": [], "around": []}
    for m, mask in masks.items():
        found = _masked(hashes, mask, m)
        ok = (place + len(mask) <= room)[: len(found)]
        if m in sizes:
            ok &= ((room >= sizes[m][0]) & (room <= sizes[m][1]))[: len(found)]
        if held is not None:
            ok &= bitmap.holds(held, found)
        index = np.flatnonzero(ok)
        lo = np.maximum(index - reach, words.first[owner[index]])
        hi = np.minimum(index + len(mask) + reach, words.first[owner[index] + 1])
        out["doc"].extend(owner[index].tolist())
        out["place"].extend((index - lo).tolist())
        out["size"].extend(room[index].tolist())
        out["h"].extend(found[index].view(np.int64).tolist())
        out["around"].extend(short[a:b].tobytes() for a, b in zip(lo.tolist(), hi.tolist(), strict=True))
    return out


def _scan(rows: DataFrame, id_col: str, text_col: str, masks: dict[int, str], reach: int, held, sizes: dict[int, tuple[int, int]]) -> DataFrame:
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = arrays.as_strings(batch.column(1))
            for a, b in arrays.slices(texts):
                found = _seeds(texts.slice(a, b - a), masks, reach, held.value if held else None, sizes)
                ids = batch.column(0).slice(a, b - a).take(pa.array(found["doc"], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(found["place"], pa.int32()), pa.array(found["size"], pa.int32()), pa.array(found["h"], pa.int64()), pa.array(found["around"], pa.binary())], [id_col, "place", "size", "h", "around"])

    return rows.select(id_col, text_col).mapInArrow(workers.lean(run), f"{id_col} {kind}, place int, size int, h long, around binary")


def _aligned(spans: pa.Array, at: np.ndarray, middle: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans of words as the rows of a matrix, each with its hit in column ``middle``, and where the rows have words."""
    blobs = spans.to_pylist()
    per = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
    row = np.repeat(np.arange(len(blobs)), per)
    column = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per + at - middle, per)
    ok = (column >= 0) & (column < width)
    words, there = np.zeros((len(blobs), width), np.uint32), np.zeros((len(blobs), width), bool)
    words[row[ok], column[ok]] = np.frombuffer(b"".join(blobs), np.uint32)[ok]
    there[row[ok], column[ok]] = True
    return words, there


def agreements(a: pa.Array, at_a: np.ndarray, b: pa.Array, at_b: np.ndarray, overlap: np.ndarray) -> np.ndarray:
    """For each pair of spans, the best share of equal words over ``overlap`` neighbouring places of the diagonal through the hit (0: too short)."""
    middle = int(min(at_a.max(initial=0), at_b.max(initial=0)))
    width = middle + max([0, *(len(x) // 4 - k for x, k in zip(b.to_pylist(), at_b.tolist(), strict=True))])
    words_a, in_a = _aligned(a, at_a, middle, width)
    words_b, in_b = _aligned(b, at_b, middle, width)
    both = in_a & in_b
    same = np.pad(np.cumsum((words_a == words_b) & both, axis=1), ((0, 0), (1, 0)))
    room = np.pad(np.cumsum(both, axis=1), ((0, 0), (1, 0)))
    out = np.zeros(len(overlap))
    for n in np.unique(overlap).tolist():
        rows = np.flatnonzero(overlap == n)
        if n <= width:
            full = room[rows, n:] - room[rows, :-n] == n
            out[rows] = np.where(full, same[rows, n:] - same[rows, :-n], 0).max(axis=1, initial=0) / n
    return out


def find_overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", masks: tuple[str, ...] = MASKS, overlap: int = OVERLAP, substitutions: float = SUBSTITUTIONS, min_words: int = MIN_WORDS, each_item: bool = True) -> DataFrame:
    """Pairs ``(id, item)`` with the best share of agreeing words, for all pairs over the bound.

    Items of equal text are one item, that of the smallest id.  Without ``each_item``, of items that share a stretch
    only one may be named: enough to tell which documents quote any, and a stretch that many items share is sought once.
    """
    reach = overlap
    # Items shorter than a stretch have masks of their own, which documents need only where there are such items.
    numbered = dict(enumerate((*masks, *SHORT_MASKS, *("1" * n for n in range(min_words, 5)))))
    sizes = {m: (overlap, 2**31) if m < len(masks) else (max(min_words, 5), overlap - 1) if m < len(masks) + len(SHORT_MASKS) else (len(mask), len(mask)) for m, mask in numbered.items()}
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("item_text")).where("item_text is not null")
    items = items.groupBy("item_text").agg(F.min("item").alias("item"))
    seeds = _scan(items, "item", "item_text", numbered, reach, None, sizes)
    if not each_item:
        seeds = seeds.groupBy("place", "size", "h", "around").agg(F.min("item").alias("item"))
    seeds = written(seeds, "seeds")
    if seeds.where(F.col("size") < overlap).isEmpty():
        numbered = dict(enumerate(masks))
    held = docs.sparkSession.sparkContext.broadcast(bitmap.build(seeds, "h"))
    own = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("doc_text"))
    hits = _scan(own, "doc", "doc_text", numbered, reach, held, {}).withColumnsRenamed({"place": "doc_place", "around": "doc_around", "size": "doc_size"})
    joined = hits.join(seeds.select("item", "place", "size", F.col("h").alias("item_h"), "around"), F.col("h") == F.col("item_h"))
    kinds = f"doc {docs.schema[id_col].dataType.simpleString()}, item {benchmark.schema[item_col].dataType.simpleString()}, share double"

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_place, place, size = (batch.column(k).to_numpy() for k in (2, 4, 6))
            shares = agreements(batch.column(3), doc_place, batch.column(5), place, np.minimum(overlap, size))
            keep = pa.array(shares >= 1 - substitutions - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shares, pa.float64())], ["doc", "item", "share"]).filter(keep)

    found = joined.select("doc", "item", "doc_place", "doc_around", "place", "around", "size").mapInArrow(workers.lean(verify), kinds)
    return found.groupBy("doc", "item").agg(F.max("share").alias("share")).select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "share")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", **options) -> DataFrame:
    """One row per row of ``docs``: id, ``contaminated``, ``n_items``, ``items`` (sorted) and ``best_share``.

    Words are compared with A-Z folded and without ASCII punctuation.  Null and empty texts, on either side, and items
    of fewer than ``min_words`` (five) words never match.  Rows that repeat an id share the findings of all rows of that
    id; rows without an id are not flagged.  Empty tables on either side flag nothing.  A document quotes few items, so
    the sorted list of a document's items is short; of copies of one item in the benchmark, the smallest id is listed.
    """
    ids = docs.select(id_col)
    with scratch() as keep:
        found = find_overlaps(docs, benchmark, id_col, text_col, item_col, **options)
        by_doc = found.groupBy(id_col).agg(F.sort_array(F.collect_list(item_col)).alias("items"), F.max("share").alias("best_share"))
        flagged = keep(written(by_doc.select(F.col(id_col).alias("__doc"), "items", "best_share"), "flagged"))
    out = ids.join(small_or_shuffled(flagged), ids[id_col] == flagged["__doc"], "left")
    none = F.array().cast(flagged.schema["items"].dataType)
    return out.select(id_col, F.col("items").isNotNull().alias("contaminated"), F.when(F.col("items").isNotNull(), F.size("items")).otherwise(0).cast("long").alias("n_items"), F.coalesce("items", none).alias("items"), F.coalesce("best_share", F.lit(0.0)).alias("best_share"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without contaminated rows; all columns stay. Rows without an id stay."""
    with scratch() as keep:
        found = find_overlaps(docs, benchmark, id_col, each_item=False, **options).select(F.col(id_col).alias("__doc")).distinct()
        found = keep(written(found, "contaminated"))
    return docs.join(small_or_shuffled(found), docs[id_col] == found["__doc"], "left_anti")
