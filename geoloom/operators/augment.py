"""Geometric and mixing augmentations as coordinate arithmetic on pixel tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.model import CHANNEL_MEAN, CHANNEL_STD
from geoloom.operators.resample import resize
from geoloom.operators.split import batches
from geoloom.runtime import seeded, seeded_int


def with_transform(df: DataFrame, columns: list[str], transform: Callable[[Column], Column]) -> DataFrame:
    """Apply a caller's column function (or pandas UDF) to ``columns``."""
    return df.withColumns({c: transform(F.col(c)) for c in columns})


def normalise(pixels: DataFrame, bands: list[str]) -> DataFrame:
    """0..255 values to zero mean and unit deviation per channel."""
    scaled = {b: (F.col(b) / 255.0 - m) / s for b, m, s in zip(bands, CHANNEL_MEAN, CHANNEL_STD)}
    return pixels.withColumns(scaled)


# -- crops and padding --------------------------------------------------------------


def pad_to(pixels: DataFrame, item: list[str], height: Column, width: Column, size: int) -> DataFrame:
    """Grow items smaller than ``size`` around their centre, mirroring with the edge repeated.

    Each pixel computes all the positions it is mirrored to.
    """

    def spots(j: Column, n: Column) -> Column:
        total = F.greatest(n, F.lit(size))
        top = F.floor((total - n) / 2).cast("int")
        period = (2 * n).cast("int")
        run = lambda first: F.when(
            first < total, F.sequence(first.cast("int"), F.greatest(first, total - 1).cast("int"), period)
        ).otherwise(F.array().cast("array<int>"))
        both = F.concat(run(F.pmod(top + j, period)), run(F.pmod(top - 1 - j, period)))
        return F.when(n >= size, F.array(j)).otherwise(both)

    rest = [c for c in pixels.columns if c not in ("r", "c")]
    out = pixels.select(*rest, spots(F.col("r"), height).alias("_r"), spots(F.col("c"), width).alias("_c"))
    out = out.select(*rest, "_c", F.explode("_r").alias("r"))
    return out.select(*rest, "r", F.explode("_c").alias("c")).select(*pixels.columns)


def crop(pixels: DataFrame, r0: Column, c0: Column, height: Column, width: Column) -> DataFrame:
    inside = (F.col("r") >= r0) & (F.col("r") < r0 + height) & (F.col("c") >= c0) & (F.col("c") < c0 + width)
    return pixels.filter(inside).withColumns({"r": (F.col("r") - r0).cast("int"), "c": (F.col("c") - c0).cast("int")})


def centre_crop(pixels: DataFrame, height: Column, width: Column, size: int) -> DataFrame:
    start = lambda n: F.floor((n - size) / 2).cast("int")
    return crop(pixels, start(height), start(width), F.lit(size), F.lit(size))


def random_crop(pixels: DataFrame, item: Column, height: Column, width: Column, size: int, seed: int) -> DataFrame:
    """A crop whose place depends on the item and the seed only."""
    r0 = seeded_int(item, seed, height - size + 1).cast("int")
    c0 = seeded_int(item, seed + 1, width - size + 1).cast("int")
    return crop(pixels, r0, c0, F.lit(size), F.lit(size))


# -- symmetries -----------------------------------------------------------------------


def _turned(k: Column, r: Column, c: Column, h: Column, w: Column) -> tuple[Column, Column]:
    """Position after ``k`` quarter turns counter-clockwise."""
    rr = F.when(k == 0, r).when(k == 1, w - 1 - c).when(k == 2, h - 1 - r).otherwise(c)
    cc = F.when(k == 0, c).when(k == 1, r).when(k == 2, w - 1 - c).otherwise(h - 1 - r)
    return rr, cc


def symmetries(pixels: DataFrame, height: Column, width: Column, variants: list[int] | None = None) -> DataFrame:
    """Pixels under the eight square symmetries; adds ``variant``.

    Variants 0..3 are quarter turns counter-clockwise, 4..7 the same and then mirrored
    left to right.
    """
    out = pixels.withColumn("variant", F.explode(F.array(*[F.lit(v) for v in variants or range(8)])))
    k = F.col("variant") % 4
    rr, cc = _turned(k, F.col("r"), F.col("c"), height, width)
    turned_width = F.when(k % 2 == 0, width).otherwise(height)
    cc = F.when(F.col("variant") >= 4, turned_width - 1 - cc).otherwise(cc)
    return out.withColumns({"r": rr.cast("int"), "c": cc.cast("int")})


def undo_symmetry(pixels: DataFrame, height: Column, width: Column) -> DataFrame:
    """Bring pixels of a ``variant`` back; sizes are those of the original."""
    k = F.col("variant") % 4
    odd = k % 2 == 1
    h, w = F.when(odd, width).otherwise(height), F.when(odd, height).otherwise(width)
    c = F.when(F.col("variant") >= 4, w - 1 - F.col("c")).otherwise(F.col("c"))
    rr, cc = _turned((4 - k) % 4, F.col("r"), c, h, w)
    return pixels.withColumns({"r": rr.cast("int"), "c": cc.cast("int")})


def transpose(pixels: DataFrame) -> DataFrame:
    return pixels.withColumns({"r": F.col("c"), "c": F.col("r")})


def zoom(pixels: DataFrame, item: list[str], bands: list[str], height: int, width: int, keep: float = 0.8) -> DataFrame:
    """Centre part of an item, brought back to full size."""
    h, w = int(height * keep), int(width * keep)
    part = crop(pixels, F.lit((height - h) // 2), F.lit((width - w) // 2), F.lit(h), F.lit(w))
    return resize(part, item, bands, F.lit(h), F.lit(w), F.lit(height), F.lit(width), "linear")


# -- mixing ---------------------------------------------------------------------------------


def beta_draw(alpha: float, seed: int):
    """Pandas UDF: a Beta(alpha, alpha) draw per key, the same one every time."""

    @F.pandas_udf("double")
    def draw(key: pd.Series) -> pd.Series:
        return key.map(lambda k: np.random.default_rng([seed, int(k)]).beta(alpha, alpha))

    return draw


def partners(items: DataFrame, item: str, batch_size: int, seed: int) -> DataFrame:
    """(item, batch_id, partner): a seeded permutation inside each batch.

    Batches are of a fixed size, so ordering one is bounded work.
    """
    order = items.select(item).withColumn("_o", seeded(F.col(item), seed))
    b = batches(order, ["_o", item], batch_size).drop("_o")
    w = Window.partitionBy("batch_id").orderBy(seeded(F.col(item), seed + 1), item)
    slot = b.select("batch_id", F.col(item).alias("partner"), (F.row_number().over(w) - 1).alias("pos"))
    return b.join(slot, ["batch_id", "pos"]).select(item, "batch_id", "partner")


def cut_boxes(batch: DataFrame, lam: Column, height: int, width: int, seed: int) -> DataFrame:
    """(batch_id, y1, y2, x1, x2, lam): the cut of each batch and the share that stays."""
    ratio = F.sqrt(1.0 - lam)
    half = lambda n: F.floor((F.lit(n) * ratio).cast("int") / 2).cast("int")
    cx, cy = seeded_int(F.col("batch_id"), seed, F.lit(width)), seeded_int(F.col("batch_id"), seed + 1, F.lit(height))
    side = lambda mid, n: (
        F.greatest(mid - half(n), F.lit(0)).cast("int"), F.least(mid + half(n), F.lit(n)).cast("int")
    )
    (x1, x2), (y1, y2) = side(cx, width), side(cy, height)
    boxes = batch.select("batch_id", y1.alias("y1"), y2.alias("y2"), x1.alias("x1"), x2.alias("x2"))
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    return boxes.withColumn("lam", 1 - area / (height * width))


def cutmix(pixels: DataFrame, item: str, pairs: DataFrame, boxes: DataFrame) -> DataFrame:
    """Pixels with the cut area taken from the partner; labels are just more columns.

    A permutation gives every item exactly one receiver, so a pixel inside the cut moves
    to its receiver and all others stay: no pixel is joined with another.
    """
    give = pairs.select(F.col("partner").alias(item), "batch_id", F.col(item).alias("_receiver")).join(boxes, "batch_id")
    inside = (
        (F.col("r") >= F.col("y1")) & (F.col("r") < F.col("y2")) & (F.col("c") >= F.col("x1")) & (F.col("c") < F.col("x2"))
    )
    moved = pixels.join(give, item)
    return moved.withColumn(item, F.when(inside, F.col("_receiver")).otherwise(F.col(item))).select(*pixels.columns)


def mixup(pixels: DataFrame, item: str, pairs: DataFrame, lam: DataFrame, bands: list[str]) -> DataFrame:
    """lam x own + (1 - lam) x partner per pixel, by one aggregation over both shares."""
    give = pairs.select(F.col("partner").alias(item), "batch_id", F.col(item).alias("_receiver")).join(lam, "batch_id")
    shares = F.array(
        F.struct(F.col(item).alias("to"), F.col("lam").alias("w")),
        F.struct(F.col("_receiver").alias("to"), (1 - F.col("lam")).alias("w")),
    )
    sent = pixels.join(give, item).withColumn("_s", F.explode(shares))
    return sent.groupBy(F.col("_s.to").alias(item), "r", "c").agg(*[F.sum(F.col(b) * F.col("_s.w")).alias(b) for b in bands])
