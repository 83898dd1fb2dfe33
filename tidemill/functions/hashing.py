"""Reproducible pseudo-random values derived from (seed, key).

``rand(seed)`` depends on how rows are partitioned; these do not, so a split or
an augmentation is the same on any cluster, after any retry.
"""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

UINT32 = 4294967296.0


def _as_column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def as_list(cols) -> list:
    return list(cols) if isinstance(cols, (list, tuple)) else [cols]


def digest(seed, *keys) -> Column:
    """32 hex digits of md5('seed:key[:key...]')."""
    parts = [_as_column(k).cast("string") for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def hex_to_long(hex_digits: Column, start: int, length: int) -> Column:
    return F.conv(F.substring(hex_digits, start, length), 16, 10).cast("long")


def u32(seed, *keys) -> Column:
    """Unsigned 32-bit hash of the key, as BIGINT."""
    return hex_to_long(digest(seed, *keys), 1, 8)


def uniform(seed, *keys) -> Column:
    """Uniform double in [0, 1)."""
    return u32(seed, *keys) / F.lit(UINT32)


def uniform_below(fraction: float, seed, *keys) -> Column:
    """Whether uniform(seed, key) < fraction, compared as hex digits (no number is built)."""
    limit = math.ceil(fraction * UINT32)
    if limit >= UINT32:
        return F.lit(True)
    return digest(seed, *keys) < F.lit(f"{limit:08x}")


def uniform_part(hash_hex: Column, part: int) -> Column:
    """The part-th (0-3) of the four independent uniforms one digest holds."""
    return hex_to_long(hash_hex, 8 * part + 1, 8) / F.lit(UINT32)
