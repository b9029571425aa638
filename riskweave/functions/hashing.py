"""Seeded hash families as column expressions.

``kind='xx'`` uses the built-in 64-bit xxHash. ``kind='md5'`` gives the same numbers in any
SQL engine with ``md5``, so results that depend on hashing can be compared across engines.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: modulus of the linear hash family, the Mersenne prime 2^31 - 1.
PRIME = 2147483647


def _hex_to_long(hex_text: Column) -> Column:
    return F.conv(hex_text, 16, 10).cast("bigint")


def base31(col: Column, kind: str = "xx") -> Column:
    """Hash of a value in [0, PRIME)."""
    if kind == "xx":
        return F.pmod(F.xxhash64(col), F.lit(PRIME))
    return F.pmod(_hex_to_long(F.substring(F.md5(col.cast("string")), 1, 8)), F.lit(PRIME))


def pair56(col: Column, kind: str = "xx") -> tuple[Column, Column]:
    """Two independent 56-bit hashes; small multiples of them still fit a bigint."""
    if kind == "xx":
        return (
            F.shiftrightunsigned(F.xxhash64(col), 8),
            F.shiftrightunsigned(F.xxhash64(col, F.lit(1)), 8),
        )
    digest = F.md5(col.cast("string"))
    return _hex_to_long(F.substring(digest, 1, 14)), _hex_to_long(F.substring(digest, 15, 14))


def coefficients(n: int, seed: int = 0) -> list[tuple[int, int]]:
    """Multiplier and offset of ``n`` linear hash functions over the prime field."""
    def number(tag: str) -> int:
        return int(hashlib.md5(tag.encode()).hexdigest()[:15], 16)

    return [
        (1 + number(f"{seed}:{i}:a") % (PRIME - 1), number(f"{seed}:{i}:b") % PRIME)
        for i in range(n)
    ]


def linear_hash(base: Column, a: int, b: int) -> Column:
    """``(a * base + b) mod PRIME``; the product stays below 2^62."""
    return (base * F.lit(a) + F.lit(b)) % F.lit(PRIME)


def _joined(seed: int | str, cols) -> Column:
    return F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols])


def draw(seed: int | str, *cols: Column, kind: str = "xx") -> Column:
    """Uniform number in [0, 1) fixed by the seed and the given values."""
    text = _joined(seed, cols)
    if kind == "xx":
        whole = F.pmod(F.xxhash64(text), F.lit(1 << 32))
    else:
        whole = _hex_to_long(F.substring(F.md5(text), 1, 8))
    return whole / F.lit(float(1 << 32))


def order_key(seed: int | str, *cols: Column) -> Column:
    """Text whose sort order is a seeded random permutation of the rows."""
    return F.md5(_joined(seed, cols))
