"""Bitmaps of a fixed number of bits over hashes: they tell a task what it may
leave out, at a broadcast size that doesn't depend on the data. A bit that is
set for another value only means that something is kept and dropped by the join
that follows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BUCKET = 32768  # bits of one value of bitmap_construct_agg


def build(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """Sets bit h mod ``bits`` (a power of two) for every value of a long
    column. At most bits / 32768 parts of 4 KiB reach the driver."""
    bit = F.pmod(column, F.lit(bits).cast("long"))
    parts = (hashes.select(bit.alias("bit")).groupBy(F.expr(f"bit div {_BUCKET}").alias("bucket"))
             .agg(F.expr(f"bitmap_construct_agg(bit % {_BUCKET})").alias("part")))
    out = np.zeros(bits // 8, np.uint8)
    for r in parts.collect():  # of a bounded size, in one job however many partitions there are
        at = r["bucket"] * _BUCKET // 8
        out[at:at + _BUCKET // 8] = np.frombuffer(bytes(r["part"]), np.uint8)
    return out


def has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash (uint64) is set."""
    at = hashes & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 != 0
