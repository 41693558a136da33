"""A one-hash filter of bounded size over a column of 64-bit hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 27


def hash_filter(hashes: DataFrame, most: int = FILTER_BITS) -> np.ndarray:
    """The bits of a filter that holds every value of the long column ``h``: 16 bits a value,
    but at most 2 ** ``most`` bits in all, which also bounds what reaches the driver. A fuller
    filter lets more through and never loses a value."""
    width = min(most, max(16, (16 * hashes.count()).bit_length()))
    words = hashes.selectExpr(f"shiftrightunsigned(h, {64 - width}) AS p").selectExpr(
        "shiftright(p, 6) AS at", "shiftleft(1L, cast(p & 63 AS int)) AS b").groupBy("at").agg(F.expr("bit_or(b)").alias("b"))
    found = words.toArrow()  # packed columns: no row objects on the driver
    bits = np.zeros(1 << (width - 6), dtype=np.int64)
    bits[found["at"].to_numpy()] = found["b"].to_numpy()
    return bits


def holds(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each of the hashes."""
    p = np.asarray(h).view(np.uint64) >> np.uint64(64 - (len(bits).bit_length() + 5))
    return (bits[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)).astype(np.int64)) & 1 == 1
