"""A Bloom filter over 64-bit hashes, to thin a scan before its rows are shuffled.

It has at least BITS_A_ROW bits for each row, so about one other row in a hundred passes. The bit
map is built with a grouped bit_or and broadcast; beyond MAX_BITS there is none and
the exact join that follows it everywhere gets the whole scan. No row is ever lost.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_A_ROW = 12
#: 8 MB, enough for five million rows.
MAX_BITS = 1 << 26


def build(df: DataFrame, col: str) -> np.ndarray | None:
    """The bit map of a column of 64-bit hashes, None if there are too many rows for one."""
    need = df.count() * BITS_A_ROW
    if need > MAX_BITS:
        return None
    size = 1 << max(12, (need - 1).bit_length())
    at = F.explode(F.array(F.col(col).bitwiseAND(size - 1), F.shiftrightunsigned(col, 32).bitwiseAND(size - 1)))
    one = df.select(at.alias("at")).select(F.shiftright("at", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
    words = one.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out.view(np.uint8)


def test(bits: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    """Mask of the hashes that may be in the filter; all of them if there is none."""
    if bits is None:
        return np.ones(len(h), bool)
    h, low = h.view(np.uint64), np.uint64(8 * len(bits) - 1)

    def bit(x: np.ndarray) -> np.ndarray:
        x = (x & low).astype(np.int64)
        return bits[x >> 3] >> (x & 7).astype(np.uint8) & 1

    return (bit(h) & bit(h >> np.uint64(32))).astype(bool)
