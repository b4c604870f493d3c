"""Rescaling of values and resizing of pixel grids.

Resizing runs from the source: each pixel knows the target cells it contributes to
and its weight in them, so a resize is a projection and one partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.raster import to_uint8_range


def rescale_uint8(pixels: DataFrame, scope: list[str], bands: list[str]) -> DataFrame:
    """Stretch each band to 0..255 over ``scope`` (raster, or raster and strip).

    The extremes are a partial aggregate of one row per scope, joined back; a window
    would gather a whole raster in one task.
    """
    ends = pixels.groupBy(*scope).agg(
        *[F.min(b).alias(f"_lo_{b}") for b in bands], *[F.max(b).alias(f"_hi_{b}") for b in bands]
    )
    joined = pixels.join(ends, scope)
    keep = [c for c in pixels.columns if c not in bands]
    return joined.select(
        *keep, *[to_uint8_range(F.col(b), F.col(f"_lo_{b}"), F.col(f"_hi_{b}")).alias(b) for b in bands]
    )


def _area_weight(j: Column, i: Column, scale: Column) -> Column:
    return F.least(j + 1, (i + 1) * scale) - F.greatest(j, i * scale)


def _linear_weight(j: Column, i: Column, scale: Column, n: Column) -> Column:
    x = F.least(F.greatest((i + 0.5) * scale - 0.5, F.lit(0.0)), n - 1.0)
    return 1.0 - F.abs(x - j)


def _to_targets(pixels: DataFrame, j: Column, n: Column, size: Column, method: str, name: str) -> DataFrame:
    """A row per target position ``name`` of source sample ``j`` with positive weight ``name``_w.

    Plain columns: functions over arrays would be interpreted, pixel by pixel.
    """
    scale = n.cast("double") / size
    if method == "area":
        lo, hi = F.floor(j / scale) - 1, F.floor((j + 1) / scale) + 1
        weight = lambda i: _area_weight(j, i, scale)
    else:
        lo = F.when(j == 0, F.lit(0)).otherwise(F.floor((j - 0.5) / scale - 0.5) - 1)
        hi = F.when(j == n - 1, size - 1).otherwise(F.floor((j + 1.5) / scale - 0.5) + 1)
        weight = lambda i: _linear_weight(j, i, scale, n)
    span = F.sequence(F.greatest(lo, F.lit(0)).cast("int"), F.least(hi, size - 1).cast("int"))
    spread = pixels.withColumn(name, F.explode(span)).withColumn(f"{name}_w", weight(F.col(name)))
    return spread.filter(F.col(f"{name}_w") > 1e-12)


def resize(
    pixels: DataFrame,
    item: list[str],
    bands: list[str],
    height: Column,
    width: Column,
    out_height: Column,
    out_width: Column,
    method: str,
) -> DataFrame:
    """(item, r, c, bands) on a new grid; ``r`` and ``c`` are 0-based within the item.

    ``method`` is ``area`` (overlap-weighted mean) or ``linear`` (half-pixel centres,
    edges clamped).
    """
    src = pixels.select(
        *item, *bands, "r", "c", height.alias("_h"), width.alias("_v"), out_height.alias("_oh"), out_width.alias("_ov")
    )
    spread = _to_targets(src, F.col("r"), F.col("_h"), F.col("_oh"), method, "_i")
    spread = _to_targets(spread, F.col("c"), F.col("_v"), F.col("_ov"), method, "_k")
    w = F.col("_i_w") * F.col("_k_w")
    out = spread.groupBy(*item, F.col("_i").alias("r"), F.col("_k").alias("c")).agg(
        *[(F.sum(F.col(b) * w) / F.sum(w)).alias(b) for b in bands]
    )
    return out
