"""Key hashing: deterministic salts and the bitmap offset of user ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def salt(c: Column | str, buckets: int) -> Column:
    """Deterministic salt in [0, buckets): replay-safe, unlike ``rand``."""
    return F.pmod(F.xxhash64(c), F.lit(buckets))


def bitmap_offset(c: Column | str, cap: int = 1 << 30) -> Column:
    """Bit position of a string id in a ``cap``-bit bitmap.

    Polynomial string hash r <- r*32 + char (i.e. r += r*31 + c), masked to
    cap-1 where cap is a power of two. Masking at every step gives the same
    low bits as masking once and keeps ANSI arithmetic from overflowing.
    Only the last ceil(log2(cap)/5) characters can reach the result.
    """
    if cap <= 0 or cap & (cap - 1):
        raise ValueError("cap must be a power of two")
    mask = F.lit(cap - 1).cast("bigint")
    s = F.col(c) if isinstance(c, str) else c
    chars = F.transform(F.split(s.cast("string"), ""), lambda ch: F.ascii(ch).cast("bigint"))
    return F.aggregate(chars, F.lit(0).cast("bigint"),
                       lambda acc, ch: (acc * F.lit(32) + ch).bitwiseAND(mask))
