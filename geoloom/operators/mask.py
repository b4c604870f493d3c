"""Class masks: morphology, connected regions, composition, gradients.

Pixels are handled in square blocks, so a Python task sees at most one block and its
margin whatever the raster's size.  What crosses block borders is settled on tables of
border pixels and region pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.operators.graph import components as graph_components
from geoloom.operators.graph import min_labels
from geoloom.runtime import cut, shuffled

BLOCK = 256
# Pixel code: row * CODE + column, also the order of pixels within a raster.
CODE = 1 << 31


# -- blocks with margins -------------------------------------------------------------


def into_blocks(pixels: DataFrame, block: int, margin: Column) -> DataFrame:
    """Repeat each pixel for the blocks whose margin holds it; adds ``br``, ``bc``."""
    near = lambda x: F.sequence(
        F.greatest(F.lit(0), F.floor((F.col(x) - margin) / block)).cast("int"),
        F.floor((F.col(x) + margin) / block).cast("int"),
    )
    return pixels.withColumn("br", F.explode(near("r"))).withColumn("bc", F.explode(near("c")))


def with_size(blocks: DataFrame, meta: DataFrame, block: int) -> DataFrame:
    """Add ``height`` and ``width`` to rows of ``into_blocks``; blocks off the raster go.

    The sizes are dealt to a raster's blocks, so pixels meet them under the key they are
    grouped by next, and are shuffled once.
    """
    upto = lambda n: F.sequence(F.lit(0), F.floor((F.col(n) - 1) / block).cast("int"))
    sizes = meta.filter("height > 0 and width > 0").select("raster_id", "height", "width")
    sizes = sizes.withColumn("br", F.explode(upto("height"))).withColumn("bc", F.explode(upto("width")))
    return shuffled(blocks).join(sizes, ["raster_id", "br", "bc"])


# -- morphology ------------------------------------------------------------------------


def ellipse_rows(size: int) -> list[tuple[int, int, int]]:
    """(dy, dx_from, dx_to) spans of an elliptical kernel, ends inclusive.

    Half widths are rounded to the nearest integer, halves to even; the anchor is at
    ``size // 2``.
    """
    r = size // 2
    out = []
    for i in range(size):
        dy = i - r
        half = int(np.rint(r * np.sqrt((r * r - dy * dy) / (r * r)))) if r else 0
        lo, hi = max(r - half, 0), min(r + half, size - 1)
        out.append((dy, lo - r, hi - r))
    return out


def _shift(a: np.ndarray, dy: int, dx: int, fill: bool) -> np.ndarray:
    """``a`` read at (row + dy, column + dx)."""
    out = np.full_like(a, fill)
    h, w = a.shape
    y1, y2, x1, x2 = max(0, -dy), min(h, h - dy), max(0, -dx), min(w, w - dx)
    if y1 < y2 and x1 < x2:
        out[y1:y2, x1:x2] = a[y1 + dy : y2 + dy, x1 + dx : x2 + dx]
    return out


def dilate(a: np.ndarray, size: int, inside: np.ndarray) -> np.ndarray:
    """Any kernel cell set; cells outside the raster count for nothing."""
    src, out = a & inside, np.zeros_like(a)
    for dy, lo, hi in ellipse_rows(size):
        for dx in range(lo, hi + 1):
            out |= _shift(src, dy, dx, False)
    return out & inside


def erode(a: np.ndarray, size: int, inside: np.ndarray) -> np.ndarray:
    """All kernel cells set; cells outside the raster count for nothing."""
    src, out = a | ~inside, np.ones_like(a)
    for dy, lo, hi in ellipse_rows(size):
        for dx in range(lo, hi + 1):
            out &= _shift(src, dy, dx, True)
    return out & inside


# Steps per class as (operation, kernel size), before small regions go.
def cleanup_steps(min_road_width: int) -> dict[int, list[tuple[str, int]]]:
    wide, thin = min_road_width + 15, min_road_width
    return {
        1: [("dilate", 7), ("erode", 7)],
        2: [("dilate", wide), ("dilate", wide), ("erode", wide), ("erode", wide), ("erode", thin), ("dilate", thin)],
        3: [("dilate", 11), ("erode", 11)],
    }


def morphology(
    mask: DataFrame, meta: DataFrame, steps: dict[int, list[tuple[str, int]]], block: int = BLOCK
) -> DataFrame:
    """(raster_id, class_id, r, c): each class after its steps, as its own set of pixels.

    The margin of a class is the reach of its steps, so a block's own pixels come out
    exact.  Blocks without a pixel of the class in reach do not exist.
    """
    reach = {k: sum(max(size // 2, size - 1 - size // 2) for _, size in ops) for k, ops in steps.items()}
    margin = F.lit(0)
    for k, m in reach.items():
        margin = F.when(F.col("class_id") == k, m).otherwise(margin)
    used = mask.filter(F.col("class_id").isin(*steps)).select("raster_id", F.col("class_id").cast("int"), "r", "c")
    blocks = with_size(into_blocks(used, block, margin), meta, block)

    def run(g: pd.DataFrame) -> pd.DataFrame:
        first = g.iloc[0]
        k, m = int(first["class_id"]), reach[int(first["class_id"])]
        r0, c0 = int(first["br"]) * block - m, int(first["bc"]) * block - m
        n = block + 2 * m
        rows, cols = np.arange(r0, r0 + n), np.arange(c0, c0 + n)
        inside = ((rows >= 0) & (rows < first["height"]))[:, None] & ((cols >= 0) & (cols < first["width"]))[None, :]
        a = np.zeros((n, n), bool)
        a[g["r"].to_numpy() - r0, g["c"].to_numpy() - c0] = True
        for op, size in steps[k]:
            a = (dilate if op == "dilate" else erode)(a, size, inside)
        y, x = np.nonzero(a[m : m + block, m : m + block])
        return pd.DataFrame({"raster_id": first["raster_id"], "class_id": k, "r": y + r0 + m, "c": x + c0 + m})

    return blocks.groupBy("raster_id", "class_id", "br", "bc").applyInPandas(
        run, "raster_id bigint, class_id int, r int, c int"
    )


# -- connected regions ------------------------------------------------------------------

REGION = ["raster_id", "class_id"]
_EIGHT = [(0, 1), (1, -1), (1, 0), (1, 1)]
_FOUR = [(0, 1), (1, 0)]


def _label_block(neighbours: list[tuple[int, int]]):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        code = np.sort(g["r"].to_numpy().astype("int64") * CODE + g["c"].to_numpy())
        u, v = [], []
        for dy, dx in neighbours:
            want = code + dy * CODE + dx
            at = np.minimum(np.searchsorted(code, want), len(code) - 1)
            hit = code[at] == want
            u.append(np.flatnonzero(hit))
            v.append(at[hit])
        label = min_labels(len(code), np.concatenate(u), np.concatenate(v))
        first = g.iloc[0]
        return pd.DataFrame(
            {"raster_id": first["raster_id"], "class_id": first["class_id"], "r": code // CODE, "c": code % CODE, "part": code[label]}
        )

    return run


def regions(pixels: DataFrame, connectivity: int, block: int = BLOCK) -> DataFrame:
    """Add ``region``, the code of the region's first pixel, to (raster_id, class_id, r, c).

    Blocks are labelled on their own; pixels along block borders then link the parts,
    and only those links are solved across blocks.
    """
    neighbours = _EIGHT if connectivity == 8 else _FOUR
    at = lambda x: F.floor(F.col(x) / block).cast("int")
    typed = pixels.select(F.col("raster_id").cast("bigint"), F.col("class_id").cast("int"), "r", "c")
    parts = cut(
        typed.withColumn("br", at("r")).withColumn("bc", at("c")).groupBy(*REGION, "br", "bc")
        .applyInPandas(_label_block(neighbours), "raster_id bigint, class_id int, r int, c int, part bigint")
    )
    edge = lambda x: (F.col(x) % block).isin(0, block - 1)
    border = parts.filter(edge("r") | edge("c"))
    steps = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in neighbours])
    reach = border.withColumn("s", F.explode(steps)).select(
        *REGION, F.col("part").alias("u"), (F.col("r") + F.col("s.dy")).alias("r"), (F.col("c") + F.col("s.dx")).alias("c")
    )
    links = shuffled(reach).join(border.select(*REGION, "r", "c", F.col("part").alias("v")), [*REGION, "r", "c"])
    roots = graph_components(links.select(*REGION, "u", "v"), REGION)
    joined = shuffled(parts).join(roots.withColumnRenamed("node", "part"), [*REGION, "part"], "left")
    return joined.select(*REGION, "r", "c", F.coalesce("root", "part").alias("region"))


def region_areas(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy(*REGION, "region").agg(F.count("*").alias("area"))


def drop_small(labelled: DataFrame, min_area: dict[int, int]) -> DataFrame:
    """Pixels of regions that reach their class's least area."""
    least = F.lit(0)
    for k, n in min_area.items():
        least = F.when(F.col("class_id") == k, n).otherwise(least)
    keep = region_areas(labelled).filter(F.col("area") >= least)
    return shuffled(labelled).join(keep, [*REGION, "region"], "left_semi")


# -- composition ---------------------------------------------------------------------------


def compose(mask: DataFrame, cleaned: DataFrame, classes: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Final class per pixel, foreground only.

    In class order a class's cleaned pixels overwrite what is there, then pixels that
    had the class and lost it become background, whatever an earlier class put there.
    """
    pixel = ["raster_id", "r", "c"]
    rows = mask.filter("class_id > 0").select(*pixel, F.col("class_id").cast("int").alias("was"), F.lit(None).cast("int").alias("now"))
    rows = rows.unionByName(cleaned.select(*pixel, F.lit(None).cast("int").alias("was"), F.col("class_id").cast("int").alias("now")))
    one = rows.groupBy(*pixel).agg(
        F.coalesce(F.max("was"), F.lit(0)).alias("was"),
        *[F.max(F.col("now") == k).alias(f"now{k}") for k in classes],
    )
    value = F.col("was")
    for k in classes:
        value = F.when(F.coalesce(f"now{k}", F.lit(False)), k).when(F.col("was") == k, 0).otherwise(value)
    return one.select(*pixel, value.cast("int").alias("class_id")).filter("class_id > 0")


def clean_mask(
    mask: DataFrame, meta: DataFrame, min_building_area: int, min_road_width: int,
    block: int = BLOCK,
) -> DataFrame:
    """Closing and opening per class, small regions removed, classes put together."""
    closed = morphology(mask, meta, cleanup_steps(min_road_width), block)
    least = {1: min_building_area, 2: min_building_area // 2, 3: min_building_area * 2}
    kept = drop_small(regions(closed, 8, block), least)
    return compose(mask, kept)


# -- gradients ---------------------------------------------------------------------------------


def gradient(pixels: DataFrame, meta: DataFrame, band: str, block: int = BLOCK) -> DataFrame:
    """(raster_id, r, c, g): length of the 3 x 3 gradient, scaled to 0..1 per raster.

    Raster edges are mirrored without repeating the edge.
    """
    src = pixels.select(F.col("raster_id").cast("bigint"), "r", "c", F.col(band).cast("double").alias("v"))
    blocks = with_size(into_blocks(src, block, F.lit(1)), meta, block)

    def run(g: pd.DataFrame) -> pd.DataFrame:
        first = g.iloc[0]
        r0, c0, hh, ww = int(first["br"]) * block, int(first["bc"]) * block, int(first["height"]), int(first["width"])
        h, w = min(block, hh - r0), min(block, ww - c0)
        if h <= 0 or w <= 0:
            return pd.DataFrame({"raster_id": [], "r": [], "c": [], "g": []})
        a = np.zeros((block + 2, block + 2))
        a[g["r"].to_numpy() - r0 + 1, g["c"].to_numpy() - c0 + 1] = g["v"].to_numpy()
        mirror = lambda i, n: 0 if n == 1 else (-i if i < 0 else (2 * (n - 1) - i if i >= n else i))
        ys = np.array([mirror(r, hh) for r in range(r0 - 1, r0 + h + 1)]) - r0 + 1
        xs = np.array([mirror(c, ww) for c in range(c0 - 1, c0 + w + 1)]) - c0 + 1
        p = a[np.ix_(ys, xs)]
        gx = (p[:-2, 2:] + 2 * p[1:-1, 2:] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[1:-1, :-2] + p[2:, :-2])
        gy = (p[2:, :-2] + 2 * p[2:, 1:-1] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[:-2, 1:-1] + p[:-2, 2:])
        y, x = np.mgrid[0:h, 0:w]
        return pd.DataFrame(
            {"raster_id": first["raster_id"], "r": (y + r0).ravel(), "c": (x + c0).ravel(), "g": np.sqrt(gx**2 + gy**2).ravel()}
        )

    raw = cut(blocks.groupBy("raster_id", "br", "bc").applyInPandas(run, "raster_id bigint, r int, c int, g double"))
    ends = raw.groupBy("raster_id").agg(F.min("g").alias("lo"), F.max("g").alias("hi"))
    scaled = F.when(F.col("hi") == F.col("lo"), 0.0).otherwise((F.col("g") - F.col("lo")) / (F.col("hi") - F.col("lo")))
    return shuffled(raw).join(ends, "raster_id").select("raster_id", "r", "c", scaled.alias("g"))
