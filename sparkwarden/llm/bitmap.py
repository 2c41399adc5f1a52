"""A set of 64-bit hashes as a bitmap of fixed size: a filter that passes too much at worst, never too little.

Its size is a parameter and does not grow with the data, so it can be broadcast at any scale.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of the number of bits; 27 is 16 MB.
BITS = 27
_BLOCK = 15  # bitmap_construct_agg makes blocks of 2**15 bits


def build(hashes: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The bitmap of a column of longs, as bytes. Blocks are made by Spark; ``2**(bits-3)`` bytes at most reach the driver."""
    spread = hashes.where(F.col(column).isNotNull()).select(F.col(column).bitwiseAND(F.lit((1 << bits) - 1)).alias("bit")).select(F.shiftright("bit", _BLOCK).alias("block"), F.col("bit").bitwiseAND(F.lit((1 << _BLOCK) - 1)).alias("at"))
    # One shuffle of plain longs by block; blocks are then built where they lie.
    parts = int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = spread.distinct().repartition(parts, "block").groupBy("block").agg(F.bitmap_construct_agg("at").alias("bytes"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (_BLOCK - 3)
    for row in blocks.toLocalIterator():
        out[row["block"] * size : (row["block"] + 1) * size] = np.frombuffer(row["bytes"], np.uint8)
    return out


def holds(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the set."""
    bit = hashes.astype(np.uint64, copy=False) & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0
