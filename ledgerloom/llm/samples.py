"""Bounded samples for fitting models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_share(name: str, wanted: int, of: int) -> Column:
    """About wanted of so many rows, by 63 bits of a hash; all of them where they are not more."""
    if of <= wanted:
        return F.lit(True)
    return F.xxhash64(name).bitwiseAND(F.lit((1 << 63) - 1)) < F.lit((wanted << 63) // of)
