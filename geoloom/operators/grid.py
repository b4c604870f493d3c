"""Strips, tiles, windows and padding.

A pixel reaches its tiles by arithmetic on its own row and column, so fan-out is a
projection.  Per-tile aggregates go through grid cells first: all strip and tile
borders are multiples of one step, so pixels are reduced to cells (16,384 pixels
each at the default sizes) before anything overlaps or is shuffled twice.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.raster import reflect_targets
from geoloom.runtime import shuffled

TILE_KEY = ["raster_id", "tile_r", "tile_c"]


def _seq(lo: Column, hi: Column, step: int = 1) -> Column:
    """``sequence`` that is empty instead of counting down."""
    hi = hi.cast("int")
    lo = lo.cast("int")
    return F.when(lo <= hi, F.sequence(lo, hi, F.lit(step))).otherwise(F.array().cast("array<int>"))


def _div(a: Column, n: int) -> Column:
    return F.floor(a / n).cast("int")


# -- strips ---------------------------------------------------------------------


def strips(meta: DataFrame, strip_rows: int, patch: int) -> DataFrame:
    """(raster_id, strip, row_off, h, own_from, own_to): overlapping row bands.

    Bands advance by ``strip_rows - patch``.  Rows ``own_from .. own_to - 1`` are
    written by this band; ``own_from`` skips the part the band before has written.
    """
    advance = strip_rows - patch
    last = F.greatest(F.lit(0), F.ceil((F.col("height") - patch) / advance)).cast("int")
    off = F.col("strip") * advance
    h = F.least(F.lit(strip_rows), F.col("height") - off)
    return (
        meta.select("raster_id", "height", "width", F.explode(F.sequence(F.lit(0), last)).alias("strip"))
        .filter(off < F.col("height"))
        .select(
            "raster_id", "width", "strip", off.alias("row_off"), h.alias("h"),
            F.when(F.col("strip") == 0, 0).otherwise(off + patch).alias("own_from"),
            (off + h).alias("own_to"),
        )
    )


def owner_strip(rows: DataFrame, strip_rows: int, patch: int) -> DataFrame:
    """Add the one strip that writes each row, without a join."""
    advance = strip_rows - patch
    r = F.col("r")
    return rows.withColumn(
        "strip", F.when(r < strip_rows, 0).otherwise(1 + _div(r - strip_rows, advance)).cast("int")
    )


# -- tile grid --------------------------------------------------------------------


def tile_grid(meta: DataFrame, patch: int, overlap: int, strip_rows: int | None = None) -> DataFrame:
    """(raster_id, strip, tile_r, tile_c, h, w): starts at every stride inside each strip.

    Without ``strip_rows`` the raster is one strip.
    """
    stride = patch - overlap
    if strip_rows is None:
        bands = meta.select(
            "raster_id", "width", F.lit(0).alias("strip"), F.lit(0).alias("row_off"), F.col("height").alias("h")
        )
    else:
        bands = strips(meta, strip_rows, patch).select("raster_id", "width", "strip", "row_off", "h")
    return (
        bands.withColumn("lr", F.explode(_seq(F.lit(0), F.col("h") - 1, stride)))
        .withColumn("tile_c", F.explode(_seq(F.lit(0), F.col("width") - 1, stride)))
        .select(
            "raster_id", "strip", (F.col("row_off") + F.col("lr")).alias("tile_r"), "tile_c",
            F.least(F.lit(patch), F.col("h") - F.col("lr")).alias("h"),
            F.least(F.lit(patch), F.col("width") - F.col("tile_c")).alias("w"),
        )
    )


def _starts(x: Column, patch: int, stride: int) -> Column:
    """Tile starts (multiples of ``stride``) whose tile covers position ``x``."""
    lo = F.greatest(F.lit(0), F.ceil((x - patch + 1) / stride))
    return F.transform(_seq(lo, _div(x, stride)), lambda i: (i * stride).cast("int"))


def cover(
    df: DataFrame, meta: DataFrame, r: str, c: str, patch: int, overlap: int, strip_rows: int | None = None
) -> DataFrame:
    """Repeat each row for every tile that covers its (``r``, ``c``); adds strip, tile_r, tile_c, h, w."""
    stride = patch - overlap
    size = meta.select("raster_id", F.col("height").alias("_H"), F.col("width").alias("_W"))
    out = df.join(size, "raster_id")
    if strip_rows is None:
        out = out.withColumn("strip", F.lit(0)).withColumn("_off", F.lit(0)).withColumn("_h", F.col("_H"))
    else:
        advance = strip_rows - patch
        last = F.greatest(F.lit(0), F.ceil((F.col("_H") - patch) / advance))
        lo = F.greatest(F.lit(0), F.ceil((F.col(r) - strip_rows + 1) / advance))
        out = out.withColumn("strip", F.explode(_seq(lo, F.least(last, _div(F.col(r), advance)))))
        out = out.withColumn("_off", F.col("strip") * advance)
        out = out.withColumn("_h", F.least(F.lit(strip_rows), F.col("_H") - F.col("_off")))
    out = out.withColumn("_lr", F.explode(_starts(F.col(r) - F.col("_off"), patch, stride)))
    out = out.withColumn("tile_c", F.explode(_starts(F.col(c), patch, stride)))
    return out.select(
        *df.columns, "strip", (F.col("_off") + F.col("_lr")).alias("tile_r"), "tile_c",
        F.least(F.lit(patch), F.col("_h") - F.col("_lr")).alias("h"),
        F.least(F.lit(patch), F.col("_W") - F.col("tile_c")).alias("w"),
    )


def tile_aggregate(
    pixels: DataFrame,
    meta: DataFrame,
    patch: int,
    overlap: int,
    sums: dict[str, Column],
    maxima: dict[str, Column] | None = None,
    strip_rows: int | None = None,
) -> DataFrame:
    """Sums and maxima per tile, computed per grid cell first.

    Tiles without any input row are absent.
    """
    maxima = maxima or {}
    stride = patch - overlap
    g = gcd(patch, stride)
    if strip_rows is not None:
        g = gcd(g, gcd(strip_rows, strip_rows - patch))
    cell = lambda x: (_div(F.col(x), g) * g).alias(f"cell_{x}")
    cells = pixels.groupBy("raster_id", cell("r"), cell("c")).agg(
        *[F.sum(v).alias(n) for n, v in sums.items()], *[F.max(v).alias(n) for n, v in maxima.items()]
    )
    covered = cover(cells, meta, "cell_r", "cell_c", patch, overlap, strip_rows)
    return covered.groupBy("raster_id", "strip", "tile_r", "tile_c", "h", "w").agg(
        *[F.sum(n).alias(n) for n in sums], *[F.max(n).alias(n) for n in maxima]
    )


def foreground_tiles(
    mask: DataFrame, meta: DataFrame, patch: int, overlap: int, min_fg: float, strip_rows: int | None = None
) -> DataFrame:
    """Tiles whose foreground pixels make up ``min_fg`` of the full patch area.

    ``mask`` needs only the foreground pixels: background never reaches the shuffle.
    """
    fg = mask.filter("class_id > 0")
    out = tile_aggregate(fg, meta, patch, overlap, {"fg": F.lit(1)}, strip_rows=strip_rows)
    frac = F.col("fg") / (patch * patch)
    return out.withColumn("fg_frac", frac).filter(frac >= min_fg)


def padded_foreground(
    mask: DataFrame, meta: DataFrame, patch: int, overlap: int
) -> DataFrame:
    """Foreground share per tile after mirrored padding (older rule).

    Each pixel counts as often as the padding repeats it, so nothing is padded.
    """
    tiles = cover(mask.filter("class_id > 0"), meta, "r", "c", patch, overlap)
    times = lambda x, t, n: F.size(
        reflect_targets(F.col(x) - F.col(t), F.col(n), F.lit(patch))
    )
    n = times("r", "tile_r", "h") * times("c", "tile_c", "w")
    return tiles.groupBy(*TILE_KEY).agg((F.sum(n) / (patch * patch)).alias("fg_frac"))


def drop_blank_tiles(
    rgb: DataFrame, meta: DataFrame, patch: int, overlap: int, level: int
) -> DataFrame:
    """Tiles whose brightest value over all bands reaches ``level``."""
    top = {"brightest": F.greatest("b1", "b2", "b3")}
    out = tile_aggregate(rgb, meta, patch, overlap, {"n": F.lit(1)}, top)
    return out.filter(F.col("brightest") >= level)


# -- pixels of tiles ----------------------------------------------------------------


def tile_pixels(
    pixels: DataFrame, meta: DataFrame, patch: int, overlap: int, strip_rows: int | None = None
) -> DataFrame:
    """Pixels of every tile with local coordinates ``lr``, ``lc``."""
    out = cover(pixels, meta, "r", "c", patch, overlap, strip_rows)
    return out.withColumn("lr", F.col("r") - F.col("tile_r")).withColumn("lc", F.col("c") - F.col("tile_c"))


def pad_reflect(tiles: DataFrame, patch: int) -> DataFrame:
    """Fill edge tiles to ``patch`` by mirroring at the bottom and right (edge not repeated).

    Whole tiles skip the fan-out; padding is a projection of the source pixels.
    """
    spread = lambda x, n: F.when(F.col(n) == patch, F.array(x)).otherwise(
        reflect_targets(F.col(x), F.col(n), F.lit(patch))
    )
    return tiles.withColumn("lr", F.explode(spread("lr", "h"))).withColumn(
        "lc", F.explode(spread("lc", "w"))
    )


def pad_zero(tiles: DataFrame, grid: DataFrame, patch: int, values: list[str]) -> DataFrame:
    """Fill edge tiles with zeros: the missing positions are generated, not joined."""
    cols = [*TILE_KEY, "lr", "lc", *values]
    edge = grid.filter((F.col("h") < patch) | (F.col("w") < patch))
    blank = (
        edge.withColumn("lr", F.explode(_seq(F.lit(0), F.lit(patch - 1))))
        .withColumn("lc", F.explode(_seq(F.lit(0), F.lit(patch - 1))))
        .filter((F.col("lr") >= F.col("h")) | (F.col("lc") >= F.col("w")))
        .select(*TILE_KEY, "lr", "lc", *[F.lit(0).alias(v) for v in values])
    )
    return tiles.select(*cols).unionByName(blank)


def tile_name(prefix: Column, r: Column, c: Column, width: int = 6) -> Column:
    return F.format_string(f"%s_%0{width}d_%0{width}d.png", prefix, r, c)


def snapped_tiles(objects: DataFrame, size: int) -> DataFrame:
    """Objects counted per grid-aligned tile (older rule)."""
    snap = lambda x: (_div(F.col(x), size) * size)
    return objects.groupBy("raster_id", snap("pr").alias("tile_r"), snap("pc").alias("tile_c")).agg(
        F.count("*").alias("n_objects")
    )


# -- windows and bands ----------------------------------------------------------------


def window_pixels(pixels: DataFrame, boxes: DataFrame, block: int) -> DataFrame:
    """Pixels inside boxes (raster_id, box_id, r1, r2, c1, c2; ends exclusive).

    Boxes are spread over the blocks they touch and meet pixels on
    (raster_id, block) keys, so a raster's pixels spread over many tasks.
    """
    spread = boxes.withColumn(
        "_br", F.explode(_seq(_div(F.col("r1"), block), _div(F.col("r2") - 1, block)))
    ).withColumn("_bc", F.explode(_seq(_div(F.col("c1"), block), _div(F.col("c2") - 1, block))))
    keyed = pixels.withColumn("_br", _div(F.col("r"), block)).withColumn("_bc", _div(F.col("c"), block))
    inside = (
        (F.col("r") >= F.col("r1")) & (F.col("r") < F.col("r2"))
        & (F.col("c") >= F.col("c1")) & (F.col("c") < F.col("c2"))
    )
    return shuffled(keyed).join(spread, ["raster_id", "_br", "_bc"]).filter(inside).drop("_br", "_bc")


def strip_pixels(pixels: DataFrame, raster_id: int, row_off: int, rows: int) -> DataFrame:
    """One strip of one raster; the predicates reach the scan."""
    return pixels.filter(
        (F.col("raster_id") == raster_id) & (F.col("r") >= row_off) & (F.col("r") < row_off + rows)
    )


def header_reason() -> Column:
    """Why a raster cannot be used, as far as its metadata tells; null for usable ones."""
    return F.when((F.col("width") == 0) | (F.col("height") == 0), "zero-size raster").when(F.col("n_bands") == 0, "no bands")


def raster_health(meta: DataFrame, pixels: DataFrame) -> DataFrame:
    """(raster_id, reason, all_zero): unusable rasters get a reason, dark ones only a flag."""
    top = pixels.groupBy("raster_id").agg(F.max(F.greatest("b1", "b2", "b3")).alias("top"))
    joined = meta.join(top, "raster_id", "left")
    return joined.select(
        "raster_id",
        F.coalesce(header_reason(), F.when(F.col("top").isNull(), "read error")).alias("reason"),
        F.coalesce(F.col("top") == 0, F.lit(False)).alias("all_zero"),
    )


def readable(meta: DataFrame, health: DataFrame) -> DataFrame:
    return meta.join(health.filter("reason is null"), "raster_id", "left_semi")
