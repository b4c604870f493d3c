"""Predictions: batch predictors, overlap blending, ensembles, roof labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions.raster import taper
from geoloom.operators.grid import TILE_KEY

# -- predictors ---------------------------------------------------------------------


def tile_arrays(padded: DataFrame, patch: int, bands: list[str]) -> DataFrame:
    """One row per padded tile with its pixels as a flat array (row, column, band).

    A tile never holds more than ``patch`` x ``patch`` pixels, so the array is bounded.
    """
    at = F.col("lr") * patch + F.col("lc")
    row = F.struct(at.alias("at"), F.array(*[F.col(b).cast("float") for b in bands]).alias("v"))
    packed = padded.groupBy(*TILE_KEY, "h", "w").agg(F.array_sort(F.collect_list(row)).alias("_p"))
    return packed.select(*TILE_KEY, "h", "w", F.flatten(F.transform("_p", lambda p: p["v"])).alias("pixels"))


def predict_tiles(
    tiles: DataFrame, make_predict_fn: Callable, patch: int, channels: int, num_classes: int, batch_size: int = 16
) -> DataFrame:
    """Class probabilities of every real pixel of every tile.

    ``make_predict_fn`` is called once per Python worker and returns a function from
    (batch, patch, patch, channels) to (batch, patch * patch * num_classes), classes last.
    """
    model = predict_batch_udf(
        make_predict_fn, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size,
        input_tensor_shapes=[[patch, patch, channels]],
    )
    out = tiles.withColumn("_y", model("pixels"))
    cells = out.select(*TILE_KEY, "h", "w", "_y", F.explode(F.sequence(F.lit(0), F.col("h") * F.col("w") - 1)).alias("_i"))
    lr, lc = F.floor(F.col("_i") / F.col("w")).cast("int"), (F.col("_i") % F.col("w")).cast("int")
    return cells.select(
        *TILE_KEY, lr.alias("lr"), lc.alias("lc"), (F.col("tile_r") + lr).alias("r"), (F.col("tile_c") + lc).alias("c"),
        F.slice("_y", (lr * patch + lc) * num_classes + 1, F.lit(num_classes)).cast("array<double>").alias("probs"),
    )


def item_arrays(pixels: DataFrame, item: list[str], size: int, bands: list[str]) -> DataFrame:
    """One row per item of ``size`` x ``size`` pixels (r, c from 0): a flat array (row, column, band).

    Items of which a pixel is missing are left out; an array never holds more than the item.
    """
    row = F.struct((F.col("r") * size + F.col("c")).alias("at"), F.array(*[F.col(b).cast("float") for b in bands]).alias("v"))
    packed = pixels.groupBy(*item).agg(F.array_sort(F.collect_list(row)).alias("_p")).filter(F.size("_p") == size * size)
    return packed.select(*item, F.flatten(F.transform("_p", lambda p: p["v"])).alias("pixels"))


def predict_items(items: DataFrame, make_predict_fn: Callable, column: str, shape: list[int], batch_size: int = 64) -> DataFrame:
    """Add ``probs`` from a predictor over fixed-shape arrays such as roof crops."""
    model = predict_batch_udf(
        make_predict_fn, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size, input_tensor_shapes=[shape]
    )
    return items.withColumn("probs", model(column).cast("array<double>"))


# -- blending ------------------------------------------------------------------------


def with_taper(tiles: DataFrame, patch: int, overlap: int) -> DataFrame:
    """Add the tile weight ``w`` of each pixel from its local position."""
    w = taper(F.col("lr"), patch, overlap) * taper(F.col("lc"), patch, overlap)
    return tiles.withColumn("w", w)


def blend(tile_probs: DataFrame, patch: int, overlap: int, num_classes: int) -> DataFrame:
    """(raster_id, r, c, probs): weighted mean of overlapping tile predictions.

    Classes are columns of one aggregation, so a pixel is shuffled once per tile and not
    once per tile and class.
    """
    p = lambda k: F.get("probs", F.lit(k))
    sums = with_taper(tile_probs, patch, overlap).groupBy("raster_id", "r", "c").agg(
        F.greatest(F.sum("w"), F.lit(1e-6)).alias("_w"), *[F.sum(p(k) * F.col("w")).alias(f"_s{k}") for k in range(num_classes)]
    )
    return sums.select("raster_id", "r", "c", F.array(*[F.col(f"_s{k}") / F.col("_w") for k in range(num_classes)]).alias("probs"))


def argmax(probs: Column) -> Column:
    """Position of the largest value, the lowest one on ties."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def softmax(z: Column) -> Column:
    top = F.array_max(z)
    e = F.transform(z, lambda x: F.exp(x - top))
    total = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    return F.transform(e, lambda x: x / total)


# -- ensembles --------------------------------------------------------------------------

# Weights of the test-time variants.
FAST_TTA = {"original": 2.0, "flip": 2.0, "zoom": 2.0}
FULL_TTA = {**{f"d4_{k}": 1.0 for k in range(8)}, "zoom": 4.0}


def tta_mean(variants: DataFrame, item: list[str], weights: dict[str, float] | None, num_classes: int) -> DataFrame:
    """Weighted mean of ``probs`` over variants; without weights a plain mean."""
    w = F.lit(1.0)
    if weights is not None:
        pairs = [F.lit(x) for kv in weights.items() for x in kv]
        w = F.try_element_at(F.create_map(*pairs), F.col("variant"))
        variants = variants.filter(F.col("variant").isin(*weights))
    p = lambda k: F.sum(F.get("probs", F.lit(k)) * w) / F.sum(w)
    sums = variants.groupBy(*item).agg(*[p(k).alias(f"_p{k}") for k in range(num_classes)])
    return sums.select(*item, F.array(*[F.col(f"_p{k}") for k in range(num_classes)]).alias("probs"))


# -- roofs ----------------------------------------------------------------------------------


def roof_class(probs: Column, names: tuple[str, ...], least: float) -> Column:
    """Best class name, or ``Other`` when even that is below ``least``."""
    best = F.element_at(F.array(*[F.lit(n) for n in names]), argmax(probs) + 1)
    return F.when(F.array_max(probs) < least, F.lit("Other")).otherwise(best)


def merge_roof_labels(buildings: DataFrame, predictions: DataFrame, key: list[str]) -> DataFrame:
    """Buildings with ``roof_pred``; those without a prediction become ``Unknown``."""
    joined = buildings.join(predictions.select(*key, F.col("label").alias("_l")), key, "left")
    return joined.withColumn("roof_pred", F.coalesce("_l", F.lit("Unknown"))).drop("_l")
