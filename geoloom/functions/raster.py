"""Pixel-level column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_index(geo: Column, origin: Column, step: Column) -> Column:
    """Row or column of a coordinate, rounding down (used to build training data)."""
    return F.floor((geo - origin) / step).cast("int")


def trunc_index(geo: Column, origin: Column, step: Column) -> Column:
    """Row or column of a coordinate, rounding towards zero (used on predictions)."""
    return ((geo - origin) / step).cast("int")


def to_geo(pixel: Column, origin: Column, step: Column) -> Column:
    return origin + pixel * step


def reflect_index(i: Column, n: Column) -> Column:
    """Source index of position ``i`` when ``n`` samples are mirrored without repeating the edge."""
    period = F.greatest(2 * (n - 1), F.lit(1))
    p = F.pmod(i, period)
    return F.when(n == 1, F.lit(0)).otherwise(F.least(p, period - p)).cast("int")


def reflect_targets(j: Column, n: Column, size: Column) -> Column:
    """All positions in ``[0, size)`` that mirror source sample ``j``.

    The inverse of ``reflect_index``: padding becomes a projection instead of a
    join from the padded grid back to the samples.
    """
    period = F.greatest(2 * (n - 1), F.lit(1))
    last = size - 1
    up = F.when(j <= last, F.sequence(j, last, period))
    start = period - j
    mirrored = (j > 0) & (j < n - 1) & (start <= last)
    down = F.when(mirrored, F.sequence(start, F.greatest(start, last), period))
    empty = F.array().cast("array<int>")
    both = F.concat(F.coalesce(up, empty), F.coalesce(down, empty))
    return F.when(n == 1, F.sequence(F.lit(0), last)).otherwise(both)


def taper(i: Column, size: int, overlap: int, power: int = 2) -> Column:
    """Half-cosine ramp over ``overlap`` samples at both ends, raised to ``power``."""
    ramp = lambda k: (F.cos(F.lit(math.pi) * k / overlap) + 1) / 2
    w = (
        F.when(i >= size - overlap, ramp(i - (size - overlap)))
        .when(i < overlap, ramp(overlap - 1 - i))
        .otherwise(F.lit(1.0))
    )
    return F.pow(w, F.lit(power))


def to_uint8_range(v: Column, lo: Column, hi: Column) -> Column:
    """Stretch ``lo..hi`` to 0..255, truncating; a constant band becomes 0."""
    return F.when(hi == lo, F.lit(0)).otherwise(F.floor((v - lo) / (hi - lo) * 255)).cast("int")


def narrow_dtype(v: Column, dtype: Column) -> Column:
    """Crop conversion: 16-bit values are divided by 256, others are taken modulo 256."""
    return (
        F.when(dtype == "uint8", v)
        .when(dtype == "uint16", F.floor(v / 256))
        .otherwise(F.pmod(v.cast("bigint"), F.lit(256)))
        .cast("int")
    )


def three_bands(n_bands: Column, b1: Column, b2: Column, b3: Column) -> list[Column]:
    """First three bands, or the first one three times."""
    rgb = n_bands >= 3
    return [
        b1.alias("b1"),
        F.when(rgb, b2).otherwise(b1).alias("b2"),
        F.when(rgb, b3).otherwise(b1).alias("b3"),
    ]
