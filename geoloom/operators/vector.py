"""Vector layers: validity, reprojection, spatial joins, burning, crop extents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from geoloom.functions import geometry as G
from geoloom.functions.filling import Painter, by_block, polygon_spans
from geoloom.functions.mend import mended_batch
from geoloom.functions.projection import lonlat_to_utm, utm_number, utm_to_lonlat, utm_zone
from geoloom.functions.raster import floor_index, trunc_index
from geoloom.runtime import any_rows, cut, slices

# Rows of a large polygon that are filled together, and the side of a block of pixels that is painted at once.
BAND_ROWS = 256
# Edges of a polygon that are compared with each other, or filled, within its row.
FEW_EDGES = 64


def _empty() -> Column:
    return F.array().cast("array<int>")


def _seq(lo: Column, hi: Column) -> Column:
    return F.when(lo <= hi, F.sequence(lo.cast("int"), hi.cast("int"))).otherwise(_empty())


# -- validity and reference systems ------------------------------------------------


def _clashing(polygons: DataFrame) -> DataFrame:
    """(_shape): polygons of which two edges clash, found by grid cells of the polygon.

    ``polygons`` has _shape and rings.  A cell is as wide as the extent over the root of the
    number of edges, so a cell holds few edges whatever their number.
    """
    r = F.col("rings")
    every = polygons.select("_shape", G.numbered_edges(r).alias("_all"), *[
        f(g(r)).alias(n) for n, f, g in (("_x1", F.array_min, G.xs), ("_x2", F.array_max, G.xs), ("_y1", F.array_min, G.ys), ("_y2", F.array_max, G.ys))
    ])
    extent = F.greatest(F.col("_x2") - F.col("_x1"), F.col("_y2") - F.col("_y1"))
    each = every.select("_shape", (extent / F.ceil(F.sqrt(F.size("_all")))).alias("_w"), F.explode("_all").alias("e"))
    at = lambda a, b, f: F.floor(f(F.col(f"e.{a}"), F.col(f"e.{b}")) / F.col("_w"))
    cells = each.withColumn("_cx", F.explode(F.sequence(at("x1", "x2", F.least), at("x1", "x2", F.greatest)))).withColumn(
        "_cy", F.explode(F.sequence(at("y1", "y2", F.least), at("y1", "y2", F.greatest)))
    ).drop("_w")
    met = cells.join(cells.withColumnRenamed("e", "f"), ["_shape", "_cx", "_cy"])
    return met.filter(G.later_edge(F.col("e"), F.col("f")) & G.edges_clash(F.col("e"), F.col("f"))).select("_shape").distinct()


def feature_reason(features: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """Add ``reason``: why a feature cannot be used, or null.

    A polygon is invalid if a ring is open or flat, if its edges cross, overlap or touch
    within a ring, or if a hole leaves the shell.  Polygons of up to ``few`` edges are judged
    within their row, others by a join of their edges on grid cells.
    """
    rings = F.col("rings")
    polygon = F.col("geom_type").isin("Polygon", "MultiPolygon")
    outside = (F.col("geom_type") == "Polygon") & (F.size(rings) > 1) & G.hole_outside(rings)
    many = F.coalesce(polygon & (F.size(F.flatten(rings)) > few), F.lit(False))
    reason = (
        F.when(rings.isNull(), "missing geometry")
        .when(~G.is_present(rings), "empty geometry")
        .when(polygon & (G.has_flaw(F.when(polygon, rings), few) | outside), "invalid geometry")
    )
    # Stored with the judgement: whoever reads it, and however often, it is made once.
    stored = cut(features.select("*", many.alias("_many"), reason.alias("reason")))
    small = stored.filter("not _many").drop("_many")
    # Only large polygons take part in the join: the others have no key and would meet in one task.
    shaped = stored.filter("_many").drop("_many")
    if not any_rows(shaped):
        return small
    shaped = shaped.withColumn("_shape", F.xxhash64("rings"))
    clashing = _clashing(shaped.filter("reason is null").select("_shape", "rings").dropDuplicates(["_shape"]))
    marked = shaped.join(clashing.withColumn("_clash", F.lit("invalid geometry")), "_shape", "left")
    return small.unionByName(cut(marked.withColumn("reason", F.coalesce("reason", "_clash")).select(*features.columns, "reason")))


def mend(features: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """Features with invalid polygons replaced by the area they wind around, others as they are.

    What winds around nothing stays invalid.  A mended polygon of several shells becomes a
    multipolygon.  Only invalid polygons are repaired, a batch at a time.
    """
    marked = feature_reason(features, few)
    broken = marked.filter("reason = 'invalid geometry'").drop("reason")
    sound = marked.filter("reason is null or reason != 'invalid geometry'").drop("reason")
    return sound.unionByName(_repaired(broken))


def _repaired(broken: DataFrame) -> DataFrame:
    """Polygons replaced by the area they wind around, those without any as they are."""
    kind = broken.schema["rings"].dataType.simpleString()

    @F.arrow_udf(f"rings {kind}, shells int")
    def repaired(rings: pa.Array, geom_type: pa.Array) -> pa.Array:
        new, shells = mended_batch(rings, pc.fill_null(pc.equal(geom_type, "MultiPolygon"), False).to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([new, pa.array(shells.astype("int32"))], ["rings", "shells"])

    # The polygons may have come from one file.
    fixed = broken.repartition(slices(broken.sparkSession)).withColumn("_m", repaired("rings", "geom_type"))
    fixed = fixed.withColumn("rings", F.when(F.col("_m.shells") > 0, F.col("_m.rings")).otherwise(F.col("rings")))
    fixed = fixed.withColumn("geom_type", F.when(F.col("_m.shells") > 1, "MultiPolygon").otherwise(F.col("geom_type")))
    return fixed.select(*broken.columns)


def mend_and_split(features: DataFrame, few: int = FEW_EDGES) -> tuple[DataFrame, DataFrame]:
    """(usable, quarantined with ``reason``) of the mended features.

    As ``split_features(mend(features))``, but each feature is judged once and only mended ones again.
    """
    marked = feature_reason(features, few)
    broken = marked.filter("reason = 'invalid geometry'").drop("reason")
    again = feature_reason(_repaired(broken), few)
    judged = marked.filter("reason is null or reason != 'invalid geometry'").unionByName(again)
    return judged.filter("reason is null").drop("reason"), judged.filter("reason is not null")


def split_features(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, quarantined with ``reason``)."""
    marked = feature_reason(features)
    return marked.filter("reason is null").drop("reason"), marked.filter("reason is not null")


def reproject(features: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Features in ``target``, and those that cannot be brought there, with ``reason``.

    EPSG:4326, EPSG:3857 and the UTM zones of WGS 84 (EPSG:326zz, EPSG:327zz) convert into
    each other, row by row, whatever mixture of systems a table holds.  Equal or missing
    systems pass.  A feature with a point out of reach of a zone is set aside whole.
    """
    crs, wanted = F.col("crs"), utm_zone(target)
    same = crs.isNull() | (crs == target)
    reachable = wanted is not None or target in ("EPSG:4326", "EPSG:3857")

    def moved(p: Column, code: Column) -> Column:
        x, y = p["x"].cast("double"), p["y"].cast("double")
        lonlat = (
            F.when(crs == "EPSG:3857", G.mercator_to_lonlat(x, y)).when(code.isNotNull(), utm_to_lonlat(x, y, code))
            .otherwise(F.struct(x.alias("x"), y.alias("y")))
        )
        if wanted is not None:
            return G.let(lonlat, lambda q: lonlat_to_utm(q["x"], q["y"], F.lit(wanted)))
        if target == "EPSG:3857":
            return G.let(lonlat, lambda q: F.when(q.isNotNull(), G.lonlat_to_mercator(q["x"], q["y"])))
        return lonlat

    def outcome(code: Column) -> Column:
        known = same | crs.isin("EPSG:4326", "EPSG:3857") | code.isNotNull() if reachable else same
        new = F.transform("rings", lambda ring: F.transform(ring, lambda p: moved(p, code)))
        lost = lambda m: F.coalesce(~same & F.exists(F.flatten(m), lambda p: p.isNull()), F.lit(False))
        return G.let(F.when(same, F.col("rings")).when(known, new), lambda m: F.struct(
            m.alias("rings"), F.when(~known, "unknown reference system").when(lost(m), "outside the reference system").alias("reason")
        ))

    # Made by a generator, the outcome is not repeated in the filters; the system's code is read once a feature.
    out = features.withColumn("_out", F.explode(F.array(G.let(utm_number(crs), outcome))))
    bad = out.filter("_out.reason is not null").select(*features.columns, F.col("_out.reason").alias("reason"))
    good = out.filter("_out.reason is null").withColumns({"rings": F.col("_out.rings"), "crs": F.lit(target)})
    return good.select(*features.columns), bad


def place(features: DataFrame, meta: DataFrame) -> DataFrame:
    """Features (map coordinates) with every raster of their folder whose extent they meet.

    Layers are shared by the rasters of a folder, yet a feature lies on few of them.  The
    folder is covered by cells as large as its largest raster; both sides are spread over
    the cells they touch and meet on (folder, cell).  A pair counts in the cell that holds
    the lower corner of its overlap only, so no distinct is needed.
    """
    t = F.col("affine")
    x0, x1, y0, y1 = t["c"], t["c"] + t["a"] * F.col("width"), t["f"], t["f"] + t["e"] * F.col("height")
    boxes = meta.filter("width > 0 and height > 0").select(
        F.col("folder").alias("_folder"), "raster_id", "height", "width", "affine",
        F.least(x0, x1).alias("_rx1"), F.greatest(x0, x1).alias("_rx2"),
        F.least(y0, y1).alias("_ry1"), F.greatest(y0, y1).alias("_ry2"),
    )
    sizes = boxes.groupBy("_folder").agg(
        F.max(F.col("_rx2") - F.col("_rx1")).alias("_cw"), F.max(F.col("_ry2") - F.col("_ry1")).alias("_ch")
    )
    at = lambda v, size: F.floor(F.col(v) / F.col(size))

    def spread(df: DataFrame, p: str) -> DataFrame:
        return df.withColumn("_cx", F.explode(F.sequence(at(f"{p}x1", "_cw"), at(f"{p}x2", "_cw")))).withColumn(
            "_cy", F.explode(F.sequence(at(f"{p}y1", "_ch"), at(f"{p}y2", "_ch")))
        )

    rasters = spread(boxes.join(sizes, "_folder"), "_r").drop("_cw", "_ch")
    # One row per folder, joined to the features that are cut down to their boxes by it.
    sized = _with_box(features.filter(G.is_present(F.col("rings")))).join(sizes.withColumnRenamed("_folder", "folder"), "folder")
    cells = spread(sized, "_")
    same = (F.col("folder") == F.col("_folder")) & (cells["_cx"] == rasters["_cx"]) & (cells["_cy"] == rasters["_cy"])
    meets = (
        (F.col("_x1") <= F.col("_rx2")) & (F.col("_rx1") <= F.col("_x2"))
        & (F.col("_y1") <= F.col("_ry2")) & (F.col("_ry1") <= F.col("_y2"))
    )
    owner = (cells["_cx"] == F.floor(F.greatest("_x1", "_rx1") / F.col("_cw"))) & (
        cells["_cy"] == F.floor(F.greatest("_y1", "_ry1") / F.col("_ch"))
    )
    return cells.join(rasters, same & meets & owner).select(*features.columns, "raster_id", "height", "width", "affine")


def on_rasters(features: DataFrame, meta: DataFrame) -> DataFrame:
    """Features on the rasters of their folder that they meet, with rings in pixels."""
    return to_pixels(place(features, meta))


def to_pixels(features: DataFrame) -> DataFrame:
    """Replace map coordinates by pixel coordinates using the ``affine`` column."""
    t = F.col("affine")
    px = lambda p: F.struct(
        ((p["x"] - t["c"]) / t["a"]).alias("x"), ((p["y"] - t["f"]) / t["e"]).alias("y")
    )
    return features.withColumn("rings", F.transform("rings", lambda ring: F.transform(ring, px)))


# -- spatial joins --------------------------------------------------------------------


def _with_box(features: DataFrame) -> DataFrame:
    r = F.col("rings")
    return (
        features.withColumn("_x1", F.array_min(G.xs(r))).withColumn("_x2", F.array_max(G.xs(r)))
        .withColumn("_y1", F.array_min(G.ys(r))).withColumn("_y2", F.array_max(G.ys(r)))
    )


def features_in_blocks(features: DataFrame, height: int, width: int) -> DataFrame:
    """Each feature (pixel rings) with every block of ``height`` x ``width`` it meets.

    A feature computes the blocks under its extent and keeps those its exact shape
    meets; blocks are positions, so no index and no join is needed.
    """
    h, w = F.lit(float(height)), F.lit(float(width))
    lo = lambda c, n: F.greatest(F.lit(0), F.ceil(F.col(c) / n) - 1)
    boxed = _with_box(features).filter((F.col("_x2") >= 0) & (F.col("_y2") >= 0))
    spread = boxed.withColumn(
        "block_r", F.explode(_seq(lo("_y1", h), F.floor(F.col("_y2") / h)))
    ).withColumn("block_c", F.explode(_seq(lo("_x1", w), F.floor(F.col("_x2") / w))))
    x1, y1 = F.col("block_c") * w, F.col("block_r") * h
    meets = G.meets_box(F.col("rings"), F.col("geom_type"), x1, y1, x1 + w, y1 + h)
    return spread.filter(meets).drop("_x1", "_x2", "_y1", "_y2")


def features_in_strips(features: DataFrame, strips: DataFrame, reach: int) -> DataFrame:
    """Features (pixel rings) with every overlapping strip of their raster they meet.

    ``reach`` is the strip height: both sides are keyed by row bands of that height, so
    the join is on (raster_id, band) and not a range join.
    """
    band = lambda c: F.floor(c / reach)
    s = strips.withColumn(
        "_band", F.explode(_seq(band(F.col("row_off")), band(F.col("row_off") + F.col("h"))))
    )
    f = _with_box(features)
    f = f.withColumn("_band", F.explode(_seq(band(F.col("_y1")), band(F.col("_y2")))))
    joined = f.join(s, ["raster_id", "_band"])
    first = F.greatest(band(F.col("_y1")), band(F.col("row_off")))
    y1, y2 = F.col("row_off").cast("double"), (F.col("row_off") + F.col("h")).cast("double")
    meets = G.meets_box(
        F.col("rings"), F.col("geom_type"), F.lit(0.0), y1, F.col("width").cast("double"), y2
    )
    return joined.filter((F.col("_band") == first) & meets).drop("_band", "_x1", "_x2", "_y1", "_y2")


# -- burning ----------------------------------------------------------------------------


def _fields(features: DataFrame, *columns: str) -> str:
    return ", ".join(f"{c} {features.schema[c].dataType.simpleString()}" for c in columns)


_BURNT = ["raster_id", "layer_ord", "class_id"]


def _small_spans(polygons: DataFrame) -> DataFrame:
    """Runs of pixels (r, c1 to c2) of polygons with few edges, a batch of polygons at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for of, *runs in polygon_spans(b.column("rings"), b.column("height"), b.column("width")):
                keys = [b.column(c).take(pa.array(of)) for c in _BURNT]
                yield pa.RecordBatch.from_arrays(
                    [*keys, *[pa.array(v.astype("int32")) for v in runs]], names=[*_BURNT, "r", "c1", "c2"]
                )

    return polygons.select(*_BURNT, "height", "width", "rings").mapInArrow(
        run, f"{_fields(polygons, *_BURNT)}, r int, c1 int, c2 int"
    )


def _small_in_blocks(polygons: DataFrame) -> DataFrame:
    """As ``_small_spans``, the runs of a polygon in a block as one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for found in polygon_spans(b.column("rings"), b.column("height"), b.column("width")):
                if len(found[0]):
                    of, br, bc, spans = by_block(*found, BAND_ROWS)
                    keys = [b.column(c).take(pa.array(of)) for c in _BURNT]
                    where = [pa.array(v.astype("int32")) for v in (br, bc)]
                    yield pa.RecordBatch.from_arrays([*keys, *where, spans], names=[*_BURNT, "br", "bc", "spans"])

    return polygons.select(*_BURNT, "height", "width", "rings").mapInArrow(
        run, f"{_fields(polygons, *_BURNT)}, br int, bc int, spans array<int>"
    )


def _in_blocks(spans: DataFrame) -> DataFrame:
    """Runs of pixels (r, c1, c2) as rows of ``_small_in_blocks``, cut where blocks end."""
    at = lambda c: F.floor(F.col(c) / BAND_ROWS).cast("int")
    each = spans.withColumn("br", at("r")).withColumn("bc", F.explode(F.sequence(at("c1"), at("c2"))))
    left = F.greatest(F.col("c1"), F.col("bc") * BAND_ROWS)
    right = F.least(F.col("c2"), F.col("bc") * BAND_ROWS + BAND_ROWS - 1)
    return each.select(*_BURNT, "br", "bc", F.array(F.col("r").cast("int"), left.cast("int"), right.cast("int")).alias("spans"))


def _fill(bands: DataFrame) -> DataFrame:
    """Runs of pixels whose centre lies inside, one row band of a feature at a time.

    Each edge gives its crossings with the rows of the band, and no other rows are looked
    at.  A closed ring crosses a row an even number of times, so the crossings in order of
    (row, place) pair up; a pair spans the centres right of the first and up to the second.
    """
    top, end = F.col("_b"), F.least(F.col("_r2") + 1, F.col("_b") + BAND_ROWS)

    def crossings(e: Column) -> Column:
        # Row r is crossed where its centre r + 0.5 lies in [low, high).
        low, high = F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])
        first, last = F.greatest(top, F.ceil(low - 0.5)), F.least(end, F.ceil(high - 0.5)) - 1
        return F.transform(_seq(first, last), lambda r: F.struct(
            r.alias("r"), (e["x1"] + (r + 0.5 - e["y1"]) / (e["y2"] - e["y1"]) * (e["x2"] - e["x1"])).alias("x")
        ))

    def spans(q: Column) -> Column:
        pairs = _seq(F.lit(0), F.floor(F.size(q) / 2).cast("int") - 1)
        return F.transform(pairs, lambda k: F.struct(
            F.get(q, 2 * k)["r"].alias("r"),
            F.greatest(F.lit(0), F.floor(F.get(q, 2 * k)["x"] + 0.5)).alias("c1"),
            F.least(F.col("width") - 1, F.floor(F.get(q, 2 * k + 1)["x"] + 0.5) - 1).alias("c2"),
        ))

    every = F.sort_array(F.flatten(F.transform("_edges", crossings)))
    out = bands.withColumn("_s", F.explode(G.let(every, spans))).filter("_s.c1 <= _s.c2")
    return out.select(*_BURNT, F.col("_s.r").cast("int").alias("r"), F.col("_s.c1").cast("int").alias("c1"), F.col("_s.c2").cast("int").alias("c2"))


def _few_edges() -> Column:
    return F.coalesce(F.size(F.flatten("rings")) <= FEW_EDGES, F.lit(False))


def _large_spans(features: DataFrame) -> DataFrame:
    """Runs of pixels of polygons with many edges."""
    # Stored: few rows, while extents and edges would be worked out for all polygons where filters are merged.
    large = cut(features.filter(~_few_edges()))
    # An open ring is closed here, so that every row is crossed evenly.
    closed = F.transform("rings", lambda ring: F.concat(ring, F.slice(ring, 1, 1)))
    boxed = _with_box(large).withColumn("_edges", G.edges(closed))
    boxed = boxed.withColumn("_r1", F.greatest(F.lit(0), F.floor("_y1")).cast("int")).withColumn(
        "_r2", F.least(F.col("height") - 1, F.floor("_y2")).cast("int")
    ).filter("_r1 <= _r2").withColumn("_shape", F.xxhash64("rings"))
    return _fill(_filed(boxed, ["raster_id", "feature_id", "layer_ord", "class_id", "width", "_r2"]))


def _filed(boxed: DataFrame, key: list[str]) -> DataFrame:
    """Large polygons, which may span a raster: each edge is filed, once, under the row bands it meets."""
    edges = boxed.select(*key, "_shape", "_r1", F.posexplode("_edges").alias("_n", "_e"))
    band = lambda c: F.floor(c / BAND_ROWS).cast("int")
    low = F.greatest(F.col("_r1"), F.ceil(F.least("_e.y1", "_e.y2") - 0.5))
    high = F.least(F.col("_r2"), F.ceil(F.greatest("_e.y1", "_e.y2") - 0.5) - 1)
    met = edges.filter(low <= high).withColumn("_k", F.explode(F.sequence(band(low), band(high))))
    # Edges are numbered, so a feature that is listed twice is still crossed evenly.
    found = F.collect_set(F.struct("_n", "_e")).alias("_found")
    bands = met.groupBy(*key, "_shape", (F.col("_k") * BAND_ROWS).alias("_b")).agg(found)
    return bands.select(*key, "_b", F.transform("_found", lambda e: e["_e"]).alias("_edges"))


def _point_pixels(features: DataFrame) -> DataFrame:
    p = features.withColumn("_p", F.explode(F.flatten("rings")))
    return p.select(
        "raster_id", "layer_ord", "class_id", "height", "width",
        F.floor("_p.y").cast("int").alias("r"), F.floor("_p.x").cast("int").alias("c"),
    )


def _line_pixels(features: DataFrame) -> DataFrame:
    """Cells met when stepping along each segment one cell at a time on its longer axis."""
    e = features.withColumn("_e", F.explode(G.edges(F.col("rings"))))
    dx, dy = F.col("_e.x2") - F.col("_e.x1"), F.col("_e.y2") - F.col("_e.y1")
    n = F.greatest(F.ceil(F.greatest(F.abs(dx), F.abs(dy))), F.lit(1)).cast("int")
    stepped = e.withColumn("_n", n).withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n"))))
    at = lambda a, d: F.floor(F.col(f"_e.{a}") + d * F.col("_k") / F.col("_n")).cast("int")
    return stepped.select(
        "raster_id", "layer_ord", "class_id", "height", "width", at("y1", dy).alias("r"), at("x1", dx).alias("c")
    )


def _thin_pixels(features: DataFrame) -> DataFrame:
    """Pixels of lines and points on the raster."""
    kind = F.col("geom_type")
    inside = (F.col("r") >= 0) & (F.col("r") < F.col("height")) & (F.col("c") >= 0) & (F.col("c") < F.col("width"))
    lines = _line_pixels(features.filter(kind.isin("LineString", "MultiLineString")))
    points = _point_pixels(features.filter(kind.isin("Point", "MultiPoint")))
    return lines.unionByName(points).filter(inside).select(*_BURNT, "r", "c")


def _polygons(features: DataFrame) -> DataFrame:
    return features.filter(F.col("geom_type").isin("Polygon", "MultiPolygon"))


def burn_pixels(features: DataFrame) -> DataFrame:
    """(raster_id, layer_ord, class_id, r, c) for every pixel a feature covers;
    a polygon of more than ``FEW_EDGES`` edges listed twice counts once.

    ``features`` carry pixel rings with ``height`` and ``width`` of their raster.
    """
    polygons = _polygons(features)
    spans = _small_spans(polygons.filter(_few_edges())).unionByName(_large_spans(polygons))
    filled = spans.select(*_BURNT, "r", F.explode(F.sequence("c1", "c2")).alias("c"))
    return filled.unionByName(_thin_pixels(features))


def burn(features: DataFrame) -> DataFrame:
    """Class mask (foreground only): the highest layer ordinal wins each pixel.

    What is shuffled are features by blocks of pixels, not pixels.  Sorted by layer they paint
    over each other, one block at a time in memory.
    """
    polygons = _polygons(features)
    few, one = polygons.filter(_few_edges()), F.col("c")
    thin = _thin_pixels(features).select(*_BURNT, "r", one.alias("c1"), one.alias("c2"))
    rows = _small_in_blocks(few).unionByName(_in_blocks(_large_spans(polygons).unionByName(thin)))
    block = ["raster_id", "br", "bc"]
    ordered = rows.repartition(*block).sortWithinPartitions(*block, "layer_ord", "class_id")
    out = T.StructType([
        features.schema["raster_id"], T.StructField("r", T.IntegerType()), T.StructField("c", T.IntegerType()),
        features.schema["class_id"],
    ])
    schema = to_arrow_schema(out)

    def paint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from Painter(schema, BAND_ROWS).run(batches)

    return ordered.select(*block, "class_id", "spans").mapInArrow(paint, out)


def coverage(mask: DataFrame, features: DataFrame, meta: DataFrame) -> DataFrame:
    """(raster_id, features, fg, pixels, pct)."""
    fg = mask.groupBy("raster_id").agg(F.count_if(F.col("class_id") > 0).alias("fg"))
    n = features.groupBy("raster_id").agg(F.count("*").alias("features"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    pixels = F.col("height").cast("bigint") * F.col("width")
    return meta.join(fg, "raster_id", "left").join(n, "raster_id", "left").select(
        "raster_id", zero("features").alias("features"), zero("fg").alias("fg"), pixels.alias("pixels"),
        (100.0 * zero("fg") / pixels).alias("pct"),
    )


# -- crop extents and points ---------------------------------------------------------------


def _clamp(x: Column, n: str) -> Column:
    return F.greatest(F.lit(0), F.least(F.col(n), x))


def training_crops(features: DataFrame, min_px: int) -> DataFrame:
    """Crop extents of map features: floor index of the bounds, ordered, clamped; small
    ones are dropped.  Needs ``affine``, ``height`` and ``width``."""
    r, t = F.col("rings"), F.col("affine")
    row = lambda v: floor_index(v, t["f"], t["e"])
    col = lambda v: floor_index(v, t["c"], t["a"])
    raw = features.filter(G.is_present(r)).select(
        "*",
        row(F.array_max(G.ys(r))).alias("_ra"), row(F.array_min(G.ys(r))).alias("_rb"),
        col(F.array_min(G.xs(r))).alias("_ca"), col(F.array_max(G.xs(r))).alias("_cb"),
    )
    out = raw.select(
        *features.columns,
        _clamp(F.least("_ra", "_rb"), "height").alias("r1"), _clamp(F.greatest("_ra", "_rb"), "height").alias("r2"),
        _clamp(F.least("_ca", "_cb"), "width").alias("c1"), _clamp(F.greatest("_ca", "_cb"), "width").alias("c2"),
    )
    return out.filter((F.col("r2") - F.col("r1") >= min_px) & (F.col("c2") - F.col("c1") >= min_px))


def inference_crops(features: DataFrame, min_px: int, pad: float) -> DataFrame:
    """Crop extents of predicted buildings: truncated bounds, padded, clamped.

    ``fixed_label`` is ``Other`` where the unpadded size is below ``min_px`` or nothing
    of the crop lies on the raster; those are not classified.
    """
    r, t = F.col("rings"), F.col("affine")
    row = lambda v: trunc_index(v, t["f"], t["e"])
    col = lambda v: trunc_index(v, t["c"], t["a"])
    raw = features.filter(G.is_present(r)).select(
        "*",
        row(F.array_min(G.ys(r))).alias("_ya"), row(F.array_max(G.ys(r))).alias("_yb"),
        col(F.array_min(G.xs(r))).alias("_xa"), col(F.array_max(G.xs(r))).alias("_xb"),
    ).withColumn("_y1", F.least("_ya", "_yb")).withColumn("_y2", F.greatest("_ya", "_yb")).withColumn(
        "_x1", F.least("_xa", "_xb")).withColumn("_x2", F.greatest("_xa", "_xb"))
    h, w = F.col("_y2") - F.col("_y1"), F.col("_x2") - F.col("_x1")
    py, px = (h * pad).cast("int"), (w * pad).cast("int")
    boxed = raw.select(
        *features.columns, ((h < min_px) | (w < min_px)).alias("_small"),
        F.greatest(F.lit(0), F.col("_y1") - py).alias("r1"), F.least(F.col("height"), F.col("_y2") + py).alias("r2"),
        F.greatest(F.lit(0), F.col("_x1") - px).alias("c1"), F.least(F.col("width"), F.col("_x2") + px).alias("c2"),
    )
    empty = (F.col("r2") <= F.col("r1")) | (F.col("c2") <= F.col("c1"))
    return boxed.withColumn("fixed_label", F.when(F.col("_small") | empty, "Other")).drop("_small")


def object_pixels(features: DataFrame) -> DataFrame:
    """Row and column of each feature's centroid, kept when inside the raster."""
    t = F.col("affine")
    at = lambda p: F.struct(
        floor_index(p["y"], t["f"], t["e"]).alias("pr"), floor_index(p["x"], t["c"], t["a"]).alias("pc")
    )
    inside = lambda q: (
        q["pr"].between(0, F.col("height") - 1) & q["pc"].between(0, F.col("width") - 1)
    )
    place = G.let(G.centroid(F.col("rings"), F.col("geom_type")), at)
    # The test sits inside the generator, so the centroid is computed once per feature.
    out = features.filter(G.is_present(F.col("rings"))).withColumn("_q", F.explode(F.filter(F.array(place), inside)))
    return out.select(*features.columns, "_q.pr", "_q.pc")
