"""Equi-joins on grid cells in place of spatial indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.geometry import box_iou


def cells_of_box(df: DataFrame, cell: float, prefix: str = "") -> DataFrame:
    """Repeat each box for every grid cell it touches; adds ``cell_x``, ``cell_y``."""
    at = lambda n: F.floor(F.col(f"{prefix}{n}") / cell)
    return df.withColumn("cell_x", F.explode(F.sequence(at("x1"), at("x2")))).withColumn(
        "cell_y", F.explode(F.sequence(at("y1"), at("y2")))
    )


def box_pairs(
    left: DataFrame, right: DataFrame, keys: list[str], cell: float, condition: Column | None = None
) -> DataFrame:
    """Overlapping boxes of two tables: columns ``a.*`` and ``b.*`` prefixed ``a_``, ``b_``.

    Both sides are spread over cells and meet on (keys, cell).  A pair that shares
    several cells is kept only in the one that holds the corner of its overlap, so no
    distinct is needed.
    """
    a = left.select(*keys, *[F.col(c).alias(f"a_{c}") for c in left.columns if c not in keys])
    b = right.select(*keys, *[F.col(c).alias(f"b_{c}") for c in right.columns if c not in keys])
    a, b = cells_of_box(a, cell, "a_"), cells_of_box(b, cell, "b_")
    corner_x = F.floor(F.greatest("a_x1", "b_x1") / cell)
    corner_y = F.floor(F.greatest("a_y1", "b_y1") / cell)
    meets = (
        (F.col("a_x1") < F.col("b_x2")) & (F.col("b_x1") < F.col("a_x2"))
        & (F.col("a_y1") < F.col("b_y2")) & (F.col("b_y1") < F.col("a_y2"))
    )
    pairs = a.join(b, [*keys, "cell_x", "cell_y"]).filter(
        meets & (F.col("cell_x") == corner_x) & (F.col("cell_y") == corner_y)
    )
    if condition is not None:
        pairs = pairs.filter(condition)
    return pairs.drop("cell_x", "cell_y")


def iou_pairs(left: DataFrame, right: DataFrame, keys: list[str], cell: float, min_iou: float) -> DataFrame:
    """Box pairs within ``keys`` with IoU of at least ``min_iou`` (and above zero)."""
    pairs = box_pairs(left, right, keys, cell).withColumn("iou", box_iou("a_", "b_"))
    return pairs.filter((F.col("iou") >= min_iou) & (F.col("iou") > 0))
