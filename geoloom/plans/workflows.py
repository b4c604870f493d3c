"""Whole workflows: build training data, evaluate predictions, turn predictions into features.

Each returns lazy DataFrames; nothing is collected and no raster is handled by itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions import ensemble
from geoloom.functions.text import layer_stem
from geoloom.model import (
    INFRA_CLASSES,
    ROOF_CLASSES,
    SEG_CLASSES,
    DetectParams,
    RoofParams,
    SegmentationParams,
)
from geoloom.operators import blend, detect, grid, inventory, labels, mask, metrics, resample, vector, vectorise
from geoloom.runtime import cut
from geoloom.sources.files import attribute


def preprocess(
    meta: DataFrame,
    features: DataFrame,
    target_crs: str,
    roof_column: str = "Roof_type",
    infra_column: str = "Utility_Ty",
    seg: SegmentationParams = SegmentationParams(),
    roof: RoofParams = RoofParams(),
    det: DetectParams = DetectParams(),
    failures: DataFrame | None = None,
    rgb: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Rasters and layers of their folders to mask, tiles, crops and detection labels.

    ``features`` has folder, layer (file name), feature_id, geom_type, rings, attrs, crs.
    Rasters in ``failures`` (raster_id, reason) and those whose metadata rule them out are
    left out and listed under ``failures``; the others go on.  With ``rgb`` (raster_id, r, c,
    b1, b2, b3) negatives that lie on blank pixels are rejected.
    """
    failed = meta.select("raster_id", grid.header_reason().alias("reason")).filter("reason is not null")
    if failures is not None:
        failed = failed.unionByName(failures.select("raster_id", "reason"))
        failed = failed.groupBy("raster_id").agg(F.min("reason").alias("reason"))
    failed = cut(failed)
    meta = meta.join(failed, "raster_id", "left_anti")
    # A layer is one file, so its features arrive in few tasks: spread them first.
    features = features.repartition("folder", "layer", "feature_id").withColumn("stem", layer_stem(F.col("layer")))
    features = features.withColumn("seg_class", inventory.layer_role(F.col("layer"))["class_id"])
    placed, unknown_crs = vector.reproject(features, target_crs)
    # Three branches read the checked features: they are stored when they are judged, with their roles.
    usable, broken = vector.mend_and_split(placed)
    roles = usable.filter("seg_class != 0").select(
        "folder", "feature_id", "geom_type", "rings", F.col("seg_class").alias("class_id"),
        # Later layers win; the order is by class and name, stated rather than as listed on disk.
        F.struct("seg_class", "stem").alias("layer_ord"),
    )
    # Polygons of either size, lines and points are burned by themselves, and placed once.
    on_raster = cut(vector.on_rasters(roles, meta))
    burned = vector.burn(on_raster)
    tiles = grid.foreground_tiles(
        burned, meta, seg.patch_size, seg.overlap, seg.min_foreground, seg.strip_rows
    )

    # A folder's buildings come from its preferred building layer alone.
    names = cut(usable.select("folder", F.col("layer").alias("name")).distinct())
    chosen = inventory.selected_layers(names)
    chosen = chosen.filter("use = 'buildings'").select("folder", F.col("name").alias("layer"))
    buildings = vector.place(usable.join(chosen, ["folder", "layer"], "left_semi"), meta)
    crops = vector.training_crops(
        buildings.withColumn("label", inventory.roof_label(attribute(roof_column))), roof.min_crop_px
    ).select("folder", "raster_id", "feature_id", "label", "r1", "r2", "c1", "c2")

    utilities = usable.filter(F.col("stem").startswith("utility")).withColumn("raw", attribute(infra_column))
    objects = vector.object_pixels(vector.place(inventory.infra_objects(utilities), meta)).select(
        "raster_id", F.xxhash64("layer", "feature_id").alias("obj_id"), "class_id", "pr", "pc"
    )
    objects = cut(objects)
    tiled = cut(labels.centred_tiles(objects, meta, det.tile_size))
    encoded = labels.encode_labels(tiled, objects, meta, det.tile_size, INFRA_CLASSES)
    negatives = labels.negative_tiles(tiled, meta, det.tile_size, det.neg_ratio, seg.seed, rgb, det.blank_level)
    return {
        "mask": burned,
        "tiles": tiles,
        "crops": crops,
        "labels": encoded,
        "negatives": negatives,
        "failures": failed,
        "quarantine": broken.select("folder", "layer", "feature_id", "reason").unionByName(
            unknown_crs.select("folder", "layer", "feature_id", "reason")
        ),
    }


def preprocess_totals(meta: DataFrame, out: dict[str, DataFrame]) -> DataFrame:
    """Rasters, patches, crops and objects per folder with the grand total.

    Each result is counted per raster before anything is joined.
    """
    count = lambda name, col: out[name].groupBy("raster_id").agg(F.count("*").alias(col))
    failed = out["failures"].select("raster_id", F.lit("failed").alias("status")).distinct()
    per = meta.select("raster_id", "folder").join(failed, "raster_id", "left").fillna("ok", ["status"])
    for name, col in (("tiles", "patches"), ("crops", "crops"), ("labels", "infra")):
        per = per.join(count(name, col), "raster_id", "left")
    return inventory.folder_totals(per.fillna(0), ["patches", "crops", "infra"])


def segment(
    meta: DataFrame, rgb: DataFrame, make_predict_fn: Callable, seg: SegmentationParams = SegmentationParams(), batch_size: int = 16,
    tta: dict[str, float] | None = None,
) -> DataFrame:
    """Blended class probabilities from a caller's tile predictor.

    ``tta`` (``blend.FAST_TTA`` or ``blend.FULL_TTA``) makes, predicts and undoes the variants
    of a tile inside its batch; their weighted mean is what is blended.
    """
    if tta is not None:
        make_predict_fn = ensemble.over_tiles(make_predict_fn, tta, seg.num_classes)
    tiles = grid.tile_pixels(rgb, meta, seg.patch_size, seg.overlap)
    padded = grid.pad_reflect(tiles, seg.patch_size)
    packed = blend.tile_arrays(padded, seg.patch_size, ["b1", "b2", "b3"])
    probs = blend.predict_tiles(packed, make_predict_fn, seg.patch_size, 3, seg.num_classes, batch_size)
    return blend.blend(probs, seg.patch_size, seg.overlap, seg.num_classes)


def classify_roofs(
    buildings: DataFrame, rgb: DataFrame, meta: DataFrame, make_predict_fn: Callable, roof: RoofParams = RoofParams(),
    steps: int = 1, block: int = 256,
) -> DataFrame:
    """(raster_id, region, label): the roof class of every building that can be judged.

    ``buildings`` has raster_id, region and rings in map coordinates.  Each is cut out with
    its margin by blocks of the pixel store, brought to the predictor's size by one partial
    aggregation and predicted in batches (mean of ``steps`` variants).  Small buildings and
    those off the raster are ``Other``.  A missing pixel is bridged by its neighbours; a
    building with a gap too wide for that has no row.
    """
    key = ["raster_id", "region"]
    placed = buildings.join(meta.select("raster_id", "height", "width", "affine"), "raster_id")
    boxes = cut(vector.inference_crops(placed, roof.min_crop_px, roof.pad_fraction).select(*key, "r1", "r2", "c1", "c2", "fixed_label"))
    bands = ["b1", "b2", "b3"]
    seen = grid.window_pixels(rgb.select("raster_id", "r", "c", *bands), boxes.filter("fixed_label is null"), block)
    local = seen.withColumns({"r": F.col("r") - F.col("r1"), "c": F.col("c") - F.col("c1")})
    size = F.lit(roof.crop_size)
    sized = resample.resize(
        local, key, bands, F.col("r2") - F.col("r1"), F.col("c2") - F.col("c1"), size, size, "linear"
    )
    arrays = blend.item_arrays(sized, key, roof.crop_size, bands)
    make = ensemble.over_items(make_predict_fn, steps) if steps > 1 else make_predict_fn
    probs = blend.predict_items(arrays, make, "pixels", [roof.crop_size, roof.crop_size, 3], roof.batch_size)
    named = probs.select(*key, blend.roof_class(F.col("probs"), ROOF_CLASSES, roof.min_confidence).alias("label"))
    return named.unionByName(boxes.filter("fixed_label is not null").select(*key, F.col("fixed_label").alias("label")))


def infer(
    meta: DataFrame,
    probs: DataFrame,
    roof_probs: DataFrame | None = None,
    tile_boxes: DataFrame | None = None,
    seg: SegmentationParams = SegmentationParams(),
    roof: RoofParams = RoofParams(),
    det: DetectParams = DetectParams(),
    tolerance: float = 0.5,
    block: int = mask.BLOCK,
    rgb: DataFrame | None = None,
    make_roof_fn: Callable | None = None,
    roof_steps: int = 16,
) -> dict[str, DataFrame]:
    """Probabilities to cleaned mask, outlines, roof labels and infrastructure points.

    Buildings are labelled from the pixels ``rgb`` by the predictor of ``make_roof_fn`` over
    ``roof_steps`` variants, or from given ``roof_probs`` (raster_id, region, probs);
    ``tile_boxes`` are detections with tile origins.
    """
    raw = probs.select("raster_id", "r", "c", blend.argmax(F.col("probs")).alias("class_id")).filter("class_id > 0")
    cleaned = cut(mask.clean_mask(cut(raw), meta, seg.min_building_area, seg.min_road_width, block))
    rings = cut(vectorise.ring_vertices(cleaned, block))
    outlines = vectorise.simplify(vectorise.to_map(rings, meta), tolerance, keep_topology=True, ends=True)
    outlines = cut(vectorise.valid_rings(outlines).drop("nx", "ny"))
    out = {"mask": cleaned, "outlines": vectorise.with_class_names(outlines, SEG_CLASSES)}
    named = None
    if make_roof_fn is not None:
        point = lambda f: F.struct(f("x").alias("x"), f("y").alias("y"))
        extents = outlines.filter("class_id = 1").groupBy("raster_id", "region").agg(F.array(F.array(point(F.min), point(F.max))).alias("rings"))
        named = classify_roofs(extents, rgb, meta, make_roof_fn, roof, roof_steps)
    elif roof_probs is not None:
        named = roof_probs.select(
            "raster_id", "region", blend.roof_class(F.col("probs"), ROOF_CLASSES, roof.min_confidence).alias("label")
        )
    if named is not None:
        buildings = vectorise.region_summary(rings).filter("class_id = 1")
        out["buildings"] = blend.merge_roof_labels(buildings, named, ["raster_id", "region"])
    if tile_boxes is not None:
        boxes = cut(detect.to_raster_coordinates(tile_boxes))
        kept = detect.soft_nms(boxes, det.sigma, det.conf_threshold)
        out["points"] = detect.detection_points(kept, meta, INFRA_CLASSES, "score")
    return out


def evaluate(target: DataFrame, predicted: DataFrame, meta: DataFrame, num_classes: int) -> tuple[DataFrame, DataFrame]:
    """(per class, summary) of a predicted mask; missing pixels on either side are background.

    Pixels that neither side lists are background on both: they are counted from the
    rasters' sizes rather than made into rows.
    """
    key = ["raster_id", "r", "c"]
    rows = target.select(*key, F.col("class_id").alias("t"), F.lit(0).alias("p")).unionByName(
        predicted.select(*key, F.lit(0).alias("t"), F.col("class_id").alias("p"))
    )
    pair = rows.groupBy(*key).agg(F.max("t").alias("target"), F.max("p").alias("pred"))
    listed = cut(metrics.confusion_matrix(metrics.valid_labels(pair, num_classes, both=False)).select("target", "pred", "n"))
    pixels = meta.agg(F.coalesce(F.sum(F.col("height").cast("bigint") * F.col("width")), F.lit(0)).alias("all"))
    seen = pair.agg(F.count("*").alias("seen"))
    zero = F.lit(0).cast("int")
    rest = pixels.crossJoin(seen).select(zero.alias("target"), zero.alias("pred"), (F.col("all") - F.col("seen")).alias("n"))
    matrix = listed.unionByName(rest)
    return metrics.class_metrics_of(matrix, num_classes), metrics.summary_of(matrix, num_classes)
