"""Bloom filters of a fixed size, built by Spark and small enough to send to every task."""

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

FILTER_BITS = 1 << 23  # one MiB, however many values it holds
PROBES = 3


def filter_words(values: DataFrame, column: str) -> np.ndarray:
    """The filter over a column of 64-bit hashes, as 64-bit words.

    Only the filter's own words reach the driver: at most FILTER_BITS / 64 rows.
    More values than it is meant for only let more false candidates pass.
    """
    bits = F.explode(F.array(*[probe(F.col(column), i) for i in range(PROBES)]))
    words = (
        values.select(bits.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(bit & 63))")).alias("set"))
        .toPandas()
    )
    out = np.zeros(FILTER_BITS >> 6, np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["set"].to_numpy(np.int64).view(np.uint64)
    return out


def probe(value: Column, i: int) -> Column:
    """Bit number `i` of a value: its hash is spread already, so slices of it serve."""
    return F.shiftrightunsigned(value, 20 * i).bitwiseAND(F.lit(FILTER_BITS - 1).cast("bigint"))


def passes(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes the filter may hold."""
    found = np.ones(len(hashes), bool)
    for i in range(PROBES):
        at = np.flatnonzero(found)
        bit = (hashes[at] >> np.uint64(20 * i)) & np.uint64(FILTER_BITS - 1)
        found[at] = (words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) != 0
    return found
