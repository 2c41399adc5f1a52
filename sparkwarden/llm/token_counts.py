"""Token counts by a map-side two-tier lookup, without shuffling pre-tokens.

Pre-tokens are taken with the space before them, word by word.  Tier one is a broadcast table of the lengths of
frequent ones, learned from a bounded first look at the input; tier two is a cache in each worker, filled by encoding
what the table misses, in batches.  Both only save time: the counts are the library's for every text, whatever the
table holds.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwarden.llm import arrays
from sparkwarden.llm.pretokens import CACHE_ENTRIES, encode, kind_of, known_counts, load, odd_documents, spaced_pieces

#: Entries of the broadcast table, and how much text the driver looks at to choose them.
TABLE_ENTRIES = 1 << 16
LOOK_TEXTS = 1000
LOOK_CHARS = 4096


def frequent_lengths(docs: DataFrame, text_col: str, tokenizer: str, entries: int = TABLE_ENTRIES) -> dict[str, int]:
    """Piece -> tokens of it and the space before it, for the most frequent pieces at the first rows' beginnings."""
    seen: Counter[str] = Counter()
    for row in docs.select(F.substring(text_col, 1, LOOK_CHARS).alias("t")).take(LOOK_TEXTS):
        seen.update((spaced_pieces(row["t"] or "") or [])[1:-1])
    pieces = [t for t, _ in seen.most_common(entries)]
    return dict(zip(pieces, map(len, encode(load(tokenizer), [" " + p for p in pieces])), strict=True))


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    Counts are those of the library for the tokenizer file (a path all executors have), over whole texts, without
    begin, end or added special tokens; special strings inside a text count as the library's default counts them.
    Null is the empty text: no bytes, no tokens.  Repeated rows and rows without an id each get a row; an empty table
    gives an empty result; other columns are not looked at.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, text_col, tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_piece = kind_of(tokenizer) == "spaced"
        library, known = known_counts(tokenizer)
        known.update(table.value)
        for batch in batches:
            column = arrays.as_strings(batch.column(1))
            counts: list[int] = []
            for a, b in arrays.slices(column):
                texts = column.slice(a, b - a)
                odd = odd_documents(*arrays.buffers(texts)).tolist()
                cut = [None if not by_piece or o else spaced_pieces(t) for t, o in zip(texts.to_pylist(), odd, strict=True)]
                found = [None if p is None else list(map(known.get, p[1:])) for p in cut]
                fresh = list({x for p, f in zip(cut, found, strict=True) if f and None in f for x, n in zip(p[1:], f, strict=True) if n is None})
                known.update(zip(fresh, map(len, encode(library, [" " + x for x in fresh])), strict=True))
                # First pieces have no space before them; texts that can't be cut are encoded whole.
                heads = encode(library, [t if p is None else p[0] for t, p in zip(texts.to_pylist(), cut, strict=True)])
                for p, f, head in zip(cut, found, heads, strict=True):
                    rest = 0 if not f else sum(map(known.__getitem__, p[1:])) if None in f else sum(f)
                    counts.append(len(head) + rest)
                if len(known) > len(table.value) + CACHE_ENTRIES:
                    known.clear()
                    known.update(table.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], [id_col, "n_bytes", "n_tokens"])

    bytes_of = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes")
    counted = docs.select(id_col, text_col, bytes_of).mapInArrow(run, f"{id_col} {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
