"""The one-hash bitmap offset (A11) as a native column expression.

The reference hashes the decimal text of an id with a polynomial over its
character codes, ``h = h * seed + code``, in 32-bit arithmetic, then masks the
result to the bitmap size (a power of two).  Masking at every step in 64-bit
arithmetic yields the same low bits without overflow, for bitmaps of up to
2^32 bits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bitmap_offset(value: Column, bits: int = 1 << 29, seed: int = 61) -> Column:
    """Offset of ``value`` (any type, hashed as its string form) in a ``bits``-bit bitmap."""
    if bits <= 0 or bits & (bits - 1) or bits > (1 << 32):
        raise ValueError("bits must be a power of two no larger than 2^32")
    mask = F.lit(bits - 1).cast("long")
    codes = F.transform(F.split(value.cast("string"), ""), lambda c: F.ascii(c).cast("long"))
    return F.aggregate(codes, F.lit(0).cast("long"),
                       lambda acc, x: (acc * F.lit(seed).cast("long") + x).bitwiseAND(mask))
