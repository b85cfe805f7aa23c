"""Reproducible randomness: every draw is an MD5 of a seed and a key.

The same row gets the same draw whatever the partitioning, on a retry, and in any other engine
that has MD5. Doubles are never hashed: engines print them differently.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(seed, *keys) -> Column:
    """32 hex digits determined by the seed and the key columns."""
    parts = [F.lit(str(seed))] + [k.cast("string") if isinstance(k, Column) else F.col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws("|", *parts))


def digits(hex_col: Column, start: int, length: int) -> Column:
    """The integer written in `length` hex digits from 1-based `start` (at most 15 digits)."""
    return F.conv(F.substring(hex_col, start, length), 16, 10).cast("bigint")


def unit(hex_col: Column, start: int = 1) -> Column:
    """A number in [0, 1) from 12 hex digits."""
    return digits(hex_col, start, 12).cast("double") / F.lit(float(16**12))
