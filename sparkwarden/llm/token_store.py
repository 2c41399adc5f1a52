"""Token ids as directly addressable codes: any token can be read without decoding a block.

An id is cut into 8-bit chunks, one level each.  Level k holds the k-th chunk of the ids that have one, and a bitmap
that says which of them continue on level k+1; a rank directory (ones before every 512th bit) turns a position on one
level into the position on the next.  A *block* holds the ids of consecutive documents, their doc ids and offsets.
Blocks are rows of Parquet files, so that Spark commits them and any store that Spark writes to can hold them.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkwarden.llm import arrays
from sparkwarden.llm.pretokens import word_codes
from sparkwarden.storage import shared_dir

MAGIC = b"DAC1"
RANK_BITS = 512
#: Ids of a block, but for a document that has more by itself.
BLOCK_IDS = 1 << 20


def pack(ids: np.ndarray, doc_ids: np.ndarray, present: np.ndarray, counts: np.ndarray) -> bytes:
    """A block: header, documents (id, whether it has one, first token), then for each level chunks, bitmap, ranks."""
    rest = ids.astype(np.uint32, copy=False)
    levels = []
    while True:
        more = rest > 255
        bitmap = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-max(len(rest), 1) // RANK_BITS) * RANK_BITS // 8, np.uint8)
        padded[: len(bitmap)] = bitmap
        ones = np.bitwise_count(padded).reshape(-1, RANK_BITS // 8).sum(axis=1, dtype=np.uint32)
        ranks = (np.cumsum(ones, dtype=np.uint32) - ones).astype("<u4")
        levels.append((len(rest), (rest & 255).astype(np.uint8).tobytes() + padded.tobytes() + ranks.tobytes()))
        if not more.any():
            break
        rest = rest[more] >> 8
    starts = np.concatenate([[0], np.cumsum(counts)]).astype("<i8")
    head = MAGIC + struct.pack("<QB", len(doc_ids), len(levels)) + struct.pack(f"<{len(levels)}Q", *(n for n, _ in levels))
    return head + doc_ids.astype("<i8").tobytes() + present.astype(np.uint8).tobytes() + starts.tobytes() + b"".join(x for _, x in levels)


class Block:
    """Random access to a packed block (bytes, or a memory map of them)."""

    def __init__(self, data):
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not a block of directly addressable codes")
        n, k = struct.unpack_from("<QB", data, 4)
        sizes = struct.unpack_from(f"<{k}Q", data, 13)
        at = 13 + 8 * k
        self.doc_ids = np.frombuffer(data, "<i8", n, at)
        self.present = np.frombuffer(data, np.uint8, n, at + 8 * n)
        self.starts = np.frombuffer(data, "<i8", n + 1, at + 9 * n)
        at += 17 * n + 8
        self.levels = []
        for size in sizes:
            words = -(-max(size, 1) // RANK_BITS)
            chunks = np.frombuffer(data, np.uint8, size, at)
            bits = np.frombuffer(data, np.uint8, words * RANK_BITS // 8, at + size)
            ranks = np.frombuffer(data, "<u4", words, at + size + words * RANK_BITS // 8)
            at += size + words * RANK_BITS // 8 + 4 * words
            self.levels.append((chunks, bits, ranks))

    def token(self, i: int) -> int:
        """The i-th id of the block, by one look-up on each of its levels."""
        out = 0
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            out |= int(chunks[i]) << (8 * k)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            word = i // RANK_BITS
            before = bits[word * RANK_BITS // 8 : i >> 3]
            i = int(ranks[word]) + int(np.bitwise_count(before).sum()) + int(bits[i >> 3] & ((1 << (i & 7)) - 1)).bit_count()
        return out

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to ``stop``: a range on each level."""
        out = np.zeros(stop - start, np.uint32)
        where = np.arange(stop - start)
        a, b = start, stop
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            out[where] |= chunks[a:b].astype(np.uint32) << np.uint32(8 * k)
            more = np.unpackbits(bits[a >> 3 : (b + 7) >> 3], bitorder="little")[a & 7 : (a & 7) + b - a].astype(bool)
            if not more.any():
                break
            word = a // RANK_BITS
            before = np.unpackbits(bits[word * RANK_BITS // 8 : (a >> 3) + 1], bitorder="little")[: a - word * RANK_BITS]
            where = where[more]
            a = int(ranks[word]) + int(before.sum())
            b = a + len(where)
        return out

    def document(self, k: int) -> np.ndarray:
        return self.tokens(int(self.starts[k]), int(self.starts[k + 1]))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = None) -> None:
    """Encode every text and write blocks to ``path``, in ascending order of the (integer) id.

    Part k of the files holds no larger ids than part k+1.  Null is the empty text.  Rows without an id come first; rows
    that repeat an id are in the order of their texts' hashes, which lets many of them go to several parts.  ``end_id``
    is appended to each document.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    tail = np.asarray([] if end_id is None else [end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = word_codes(tokenizer)
        part, number, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[int | None, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, before, held, size
            counts = np.array([len(x) for _, x in held], np.int64)
            doc_ids = np.array([d or 0 for d, _ in held], np.int64)
            present = np.array([d is not None for d, _ in held], bool)
            payload = pack(np.concatenate([x for _, x in held]), doc_ids, present, counts)
            out = pa.RecordBatch.from_arrays([pa.array([part]), pa.array([number]), pa.array([before]), pa.array([size]), pa.array([payload], pa.binary())], ["part", "block", "start_in_part", "n_ids", "payload"])
            number, before, held, size = number + 1, before + size, [], 0
            return out

        for batch in batches:
            column = arrays.as_strings(batch.column(1))
            for a, b in arrays.slices(column, 4 * arrays.SLICE_BYTES):
                flat, counts = codes.ids(column.slice(a, b - a))
                ends = np.cumsum(counts)
                for doc_id, end, n in zip(batch.column(0).slice(a, b - a).to_pylist(), ends.tolist(), counts.tolist(), strict=True):
                    found = np.concatenate([flat[end - n : end], tail])
                    if held and size + len(found) > BLOCK_IDS:
                        yield flush()
                    held.append((doc_id, found))
                    size += len(found)
        if held:
            yield flush()

    ordered.mapInArrow(run, "part long, block long, start_in_part long, n_ids long, payload binary").write.option("compression", "uncompressed").parquet(path)


_COLUMNS = "part long, block long, start_in_part long, n_ids long, payload binary"


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``first``, the number of ids before each.

    The totals of the parts are the only thing that is summed in one place: as many rows as there are parts, which the
    writer's partition number bounds.
    """
    blocks = spark.read.schema(_COLUMNS).parquet(path)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    offsets = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"))
    return blocks.join(F.broadcast(offsets), "part").withColumn("first", F.col("offset") + F.col("start_in_part"))


def tokens_at(positions: DataFrame, path: str, column: str = "position") -> DataFrame:
    """``(position, token)`` for each row of ``positions``: the id at that place of the whole store.

    A directory of the blocks' first places (no payloads) is joined by ranges of ``BLOCK_IDS`` places; then each id is
    read from its block by look-ups, without decoding it.  Null places and those outside the store give no row;
    repeated ones give a row each.
    """
    spark = positions.sparkSession
    placed = _placed(spark, path)
    last = F.col("first") + F.col("n_ids") - 1
    reach = F.sequence(F.floor(F.col("first") / BLOCK_IDS), F.floor(last / BLOCK_IDS))
    directory = placed.where("n_ids > 0").select("part", "block", "first", last.alias("last"), F.explode(reach).alias("range"))
    sought = positions.select(F.col(column).cast("long").alias("position")).where("position is not null").withColumn("range", F.floor(F.col("position") / BLOCK_IDS))
    held = sought.join(directory, "range").where("position between first and last").select("position", "part", "block", (F.col("position") - F.col("first")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [Block(payload.as_buffer()).token(at) for at, payload in zip(batch.column(1).to_pylist(), batch.column(2), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens, pa.int64())], [column, "token"])

    payloads = placed.select("part", "block", "payload")
    return held.join(payloads, ["part", "block"]).select("position", "at", "payload").mapInArrow(run, f"{column} long, token long")


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per document of the files: id, ``start``, ``n_tokens``, ``ids_crc32`` (and ``ids`` if asked for).

    ``start`` counts the ids of all documents before it.
    """
    extra = ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block = Block(payload.as_buffer())
                whole = block.tokens(0, int(block.starts[-1])).astype("<u4")
                spans = list(zip(block.starts[:-1].tolist(), block.starts[1:].tolist(), strict=True))
                crcs = [zlib.crc32(whole[a:b].tobytes()) for a, b in spans]
                columns = [pa.array(block.doc_ids, mask=block.present == 0), pa.array(block.starts[:-1] + first), pa.array(np.diff(block.starts)), pa.array(crcs, pa.int64())]
                if with_ids:
                    columns.append(pa.array([whole[a:b].astype(np.int32) for a, b in spans], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, [id_col, "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])])

    return _placed(spark, path).select("first", "payload").mapInArrow(run, f"{id_col} long, start long, n_tokens long, ids_crc32 long{extra}")


def stored(docs: DataFrame, tokenizer: str, name: str, **options) -> DataFrame:
    """Write ``docs`` to a new folder beside the other shared tables and read it back."""
    path = f"{shared_dir(docs.sparkSession)}/sparkwarden/{name}-{uuid.uuid4().hex}"
    write_tokens(docs, path, tokenizer, **options)
    return read_tokens(docs.sparkSession, path)
