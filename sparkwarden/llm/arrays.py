"""Vectorised numpy kernels over Arrow text columns, used inside Spark tasks.

Every kernel works on one small slice of a column: the raw UTF-8 bytes and the
offsets of its documents.  A word is a maximal run of bytes other than
``[\\x20\\x09-\\x0D]``; that set is plain ASCII, so bytes and characters agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, StructType

U64 = np.uint64
#: Bytes of text that one kernel call takes on: its temporaries stay near 50 MB.
SLICE_BYTES = 1 << 20


@dataclass
class Words:
    """The words of a slice: normalised bytes (words, each followed by one space) and where they are."""

    data: np.ndarray  # uint8, ends with 8 spare bytes
    start: np.ndarray  # of each word in data
    length: np.ndarray
    first: np.ndarray  # of each document, the index of its first word; one more entry than documents

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)


def as_strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as large strings without nulls: null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a large string array, without a copy."""
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None and n else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``size`` bytes each; a document is never cut."""
    _, offsets = buffers(texts)
    at, n = 0, len(texts)
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def split_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Find the words of each document; ``lower`` folds A-Z only."""
    n = len(data)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    solid = ~space
    edge = np.zeros(n + 1, bool)  # where a document begins
    edge[offsets[:-1]] = True
    edge[n] = True
    begins = solid.copy()
    begins[1:] &= space[:-1] | edge[1:n]
    ends = solid.copy()
    ends[:-1] &= space[1:] | edge[1:n]
    raw_start = np.flatnonzero(begins)
    length = np.flatnonzero(ends) + 1 - raw_start
    index = np.arange(len(raw_start))
    start = np.zeros(len(raw_start), np.int64)
    np.cumsum(length[:-1] + 1, out=start[1:])
    out = np.full(int(length.sum()) + len(length) + 8, 32, np.uint8)
    # The k-th solid byte goes to k plus the number of words before it.
    out[np.arange(int(length.sum())) + np.repeat(index, length)] = data[solid]
    if lower:
        out += ((out >= 65) & (out <= 90)).astype(np.uint8) * np.uint8(32)
    return Words(out, start, length, np.searchsorted(raw_start, offsets))


def unaligned(data: np.ndarray, kind: str) -> np.ndarray:
    """A view of the bytes with one little-endian number from each byte offset."""
    width = np.dtype(kind).itemsize
    return np.ndarray((len(data) - width + 1,), kind, data, strides=(1,))


# The primes of the XXH64 specification.
P1, P2, P3, P4, P5 = (U64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U64(r)) | (x >> U64(64 - r))


def xxh64(data: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of many byte ranges at once. ``data`` needs 8 spare bytes at its end."""
    with np.errstate(over="ignore"):
        eight, four = unaligned(data, "<u8"), unaligned(data, "<u4")
        turn = lambda acc, lane: rotl(acc + lane * P2, 31) * P1
        s, at, stripes = U64(seed), start.copy(), length >> 5
        h = np.full(len(start), s + P5, U64)
        long = np.flatnonzero(stripes)
        if len(long):
            v = [np.full(len(long), x, U64) for x in (s + P1 + P2, s + P2, s, s - P1)]
            for k in range(int(stripes[long].max())):
                on = np.flatnonzero(stripes[long] > k)
                p = start[long[on]] + 32 * k
                for j in range(4):
                    v[j][on] = turn(v[j][on], eight[p + 8 * j])
            acc = rotl(v[0], 1) + rotl(v[1], 7) + rotl(v[2], 12) + rotl(v[3], 18)
            for j in range(4):
                acc = (acc ^ turn(U64(0), v[j])) * P1 + P4
            h[long] = acc
            at[long] += stripes[long] << 5
        h += length.astype(U64)
        rest = length & 31
        for k in range(3):
            on = np.flatnonzero((rest >> 3) > k)
            if len(on):
                h[on] = rotl(h[on] ^ turn(U64(0), eight[at[on] + 8 * k]), 27) * P1 + P4
        at += rest & 24
        on = np.flatnonzero(rest & 4)
        if len(on):
            h[on] = rotl(h[on] ^ (four[at[on]].astype(U64) * P1), 23) * P2 + P3
        at += rest & 4
        for k in range(3):
            on = np.flatnonzero((rest & 3) > k)
            if len(on):
                h[on] = rotl(h[on] ^ (data[at[on] + k].astype(U64) * P5), 11) * P1
        h = (h ^ (h >> U64(33))) * P2
        h = (h ^ (h >> U64(29))) * P3
        return h ^ (h >> U64(32))


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word shingles as byte ranges: start, length and, per document, the index of its first shingle.

    A document of fewer words than ``size`` gives its whole word sequence, one of no words gives none.
    """
    n = words.count
    per = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    first = np.zeros(len(n) + 1, np.int64)
    np.cumsum(per, out=first[1:])
    head = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], per)
    tail = head + np.repeat(np.minimum(n, size), per) - 1
    begin = words.start[head]
    return begin, words.start[tail] + words.length[tail] - begin, first


def bit_majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per document, the 64-bit number whose bits are set in over half of its hashes (0 without any)."""
    n = np.diff(first)
    ones = np.zeros((len(n), 64), np.int64)
    full = np.flatnonzero(n)
    if len(full):
        # Eight 8-bit counters per machine word; 255 hashes at most before they are read out.
        blocks = (n[full] + 254) // 255
        owner = np.repeat(np.arange(len(full)), blocks)
        base = np.cumsum(blocks) - blocks
        cut = np.repeat(first[full], blocks) + 255 * (np.arange(len(owner)) - base[owner])
        for k in range(8):
            lanes = np.add.reduceat((hashes >> U64(k)) & U64(0x0101010101010101), cut)
            counts = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
            ones[full, k::8] = np.add.reduceat(counts, base, axis=0)
    bits = (2 * ones > n[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def window_hashes(word_hashes: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` word hashes (runs across documents included: callers mask them)."""
    n = len(word_hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        x = mix(word_hashes + U64((seed * 0x9E3779B97F4A7C15) % 2**64))
        base = U64((0xD1342543DE82EF95 + 2 * seed) % 2**64 | 1)
        # Horner's rule by doubling: h[w] covers w words; log2(size) passes in all.
        done, width, out, covered = x, 1, None, 0
        power, left = base, size
        while left:
            if left & 1:
                if out is None:
                    out, covered = done, width
                else:
                    m = len(word_hashes) - covered - width + 1
                    out = out[:m] * power + done[covered : covered + m]
                    covered += width
            left >>= 1
            if left:
                m = len(done) - width
                done = done[:m] * power + done[width:]
                power, width = power * power, 2 * width
        return mix(out[:n])


def extended(docs: DataFrame, text_col: str, column: str, kind: DataType) -> tuple[DataFrame, int, StructType]:
    """For ``mapInArrow`` with one more column: ``docs`` under plain names, the place of the text, and the result's schema.

    A column named like the new one, as Spark compares names, is left out.  Names may hold dots, which Spark's own call
    would read as fields of structs.
    """
    kept = docs.drop(column)
    names = kept.columns
    at = names.index(text_col) if text_col in names else [c.lower() for c in names].index(text_col.lower())
    return kept.toDF(*(f"c{k}" for k in range(len(names)))), at, StructType([*kept.schema.fields]).add(column, kind)
