"""Hold-out splits, batches and image/mask pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.operators.scans import ranked
from geoloom.runtime import cut, seeded


def _flag(df: DataFrame, n_val: Column) -> DataFrame:
    return df.withColumn("split", F.when(F.col("rn") <= n_val, "val").otherwise("train")).drop("rn")


def holdout_split(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Add ``split``: the max(1, int(N x fraction)) first rows in seeded order are ``val``."""
    n_val = max(1, int(df.count() * fraction))
    order = [seeded(F.col(key), seed), F.col(key)]
    return _flag(ranked(df, [], order), F.lit(n_val))


def stratified_split(df: DataFrame, key: str, label: str, fraction: float, seed: int) -> DataFrame:
    """The same per class; a class with one item keeps it for training."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    n_val = F.when(F.col("_n") > 1, F.greatest(F.lit(1), F.floor(F.col("_n") * fraction))).otherwise(0)
    order = [seeded(F.col(key), seed), F.col(key)]
    out = ranked(df, [label], order).join(counts, label)
    return _flag(out, n_val).select(*df.columns, "split")


def prefix_split(df: DataFrame, name: str, fraction: float) -> DataFrame:
    """The first rows in name order are ``val``; at least one row stays for training."""
    # Counted, sampled for ranges and ranked: computed once.
    df = cut(df)
    n = df.count()
    if n < 2:
        raise ValueError("a split needs two items or more")
    n_val = min(max(1, int(n * fraction)), n - 1)
    return _flag(ranked(df, [], [F.col(name)]), F.lit(n_val))


def batches(df: DataFrame, order: list[str], size: int, drop_last: bool = False) -> DataFrame:
    """Add ``batch_id`` and ``pos`` for fixed-size batches in order."""
    out = ranked(df, [], [F.col(o) for o in order])
    if drop_last:
        whole = df.count() // size * size
        out = out.filter(F.col("rn") <= whole)
    i = F.col("rn") - 1
    return out.withColumn("batch_id", F.floor(i / size)).withColumn("pos", (i % size).cast("int")).drop("rn")


def image_mask_pairs(pixels: DataFrame, mask: DataFrame, num_classes: int) -> DataFrame:
    """Pixels with their class; missing mask pixels are background, ids are clipped."""
    key = ["raster_id", "r", "c"]
    joined = pixels.join(mask.select(*key, "class_id"), key, "left")
    clipped = F.greatest(F.lit(0), F.least(F.lit(num_classes - 1), F.coalesce("class_id", F.lit(0))))
    return joined.withColumn("class_id", clipped)


def labelled_images(files: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """(path, label, class_id) of ``.png`` files whose parent folder is a class name, by path."""
    label = F.element_at(F.split("path", "/"), -2)
    pos = F.array_position(F.array(*[F.lit(n) for n in names]), label)
    return (
        files.filter(F.col("path").endswith(".png"))
        .select("path", label.alias("label"), (pos - 1).cast("int").alias("class_id"))
        .filter("class_id >= 0")
        .orderBy("path")
    )
