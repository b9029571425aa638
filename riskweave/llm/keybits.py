"""Fixed-size bit filters that spare rows a shuffle.

A filter has one bit per residue of a 64-bit key. It answers "maybe" or "surely not", so it only
saves work: whatever passes meets the exact join afterwards. Its size does not depend on the data;
on huge inputs it fills up and lets more rows pass.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 8 MB, whatever the input.
BITS = 1 << 26


def key_bits(df: DataFrame, key: Column, bits: int = BITS) -> np.ndarray:
    """Bit filter over a 64-bit integer column, as 64-bit words."""
    at = F.pmod(key, F.lit(bits))
    words = (
        df.select(at.alias("at")).groupBy(F.shiftright("at", 6).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("mask")).toArrow()
    )
    out = np.zeros(bits >> 6, np.uint64)
    out[words.column("word").to_numpy()] = words.column("mask").to_numpy().view(np.uint64)
    return out


def may_hold(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each signed 64-bit key may be in the filter."""
    at = keys.view(np.uint64) & np.uint64(len(words) * 64 - 1)  # a power of two: the same as pmod
    return (words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
