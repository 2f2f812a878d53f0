"""Reproducible pseudo-random numbers from a row's key.

They depend on the key and the seed only, never on partitioning or retries, so
a recomputed task draws the same sample.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_hash(*parts: Column | str) -> Column:
    """md5 over ``part|part|...`` as 32 hex digits."""
    columns = [p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.md5(F.concat_ws("|", *columns).cast("binary"))


def hash_number(hex_digits: Column, start: int = 1, digits: int = 8) -> Column:
    """Some of the hex digits as a non-negative long."""
    return F.conv(F.substring(hex_digits, start, digits), 16, 10).cast("long")


def hash_unit(hex_digits: Column, start: int = 1) -> Column:
    """Eight of the hex digits as a number in [0, 1)."""
    return hash_number(hex_digits, start, 8) / F.lit(float(1 << 32))
