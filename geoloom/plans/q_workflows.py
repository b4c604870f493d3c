"""Queries: whole workflows and incremental files."""

import uuid

import numpy as np
from pyspark.sql import functions as F

from geoloom.model import DetectParams, RoofParams, SegmentationParams
from geoloom.operators import blend as B
from geoloom.plans import sqltables as S
from geoloom.plans import tables as T
from geoloom.plans import workflows as W
from geoloom.plans.q_blend import make_stub
from geoloom.plans.registry import query
from geoloom.streaming.folder import process_new_files

_AFFINE = "named_struct('a', 0.5D, 'b', 0D, 'c', 0D, 'd', 0D, 'e', -0.5D, 'f', 0D)"
SMALL = SegmentationParams(patch_size=32, overlap=8, strip_rows=64, min_building_area=12)


def _training_inputs(spark, sf):
    """One raster per supplier, ten to a folder side by side, every tenth empty; its line items are the features."""
    meta = T.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("raster_id"), F.expr("'f' || (s_suppkey div 10)").alias("folder"),
        F.expr(f"if(s_suppkey % 10 = 3, 0, {T.POLY_CANVAS})").alias("height"), F.lit(T.POLY_CANVAS).alias("width"), F.lit(3).alias("n_bands"),
        F.expr(_AFFINE.replace("'c', 0D", "'c', 200D * (s_suppkey % 10)")).alias("affine"),
    )
    names = ("Built_Up_Area_type", "Road", "Water_Body", "Utility", "Built_Up_Area_typ", "Utility_Poly_", "Contours")
    layer = F.element_at(F.array(*[F.lit(n + ".shp") for n in names]), ((F.col("feature_id") % 10 + F.col("layer_ord")) % 7 + 1).cast("int"))
    east = F.expr("200D * (raster_id % 10)")
    geo = lambda p: F.struct((p["x"] * 0.5 + east).alias("x"), (p["y"] * -0.5).alias("y"))
    attrs = F.create_map(
        F.lit("Roof_type"), F.element_at(F.array(*[F.lit(x) for x in ("Pucca_RCC", "tin", "", "clay")]), F.col("layer_ord").cast("int")),
        F.lit("Utility_Ty"), F.element_at(F.array(*[F.lit(x) for x in ("Well", "transformer 2", "pole")]), F.col("layer_ord").cast("int")),
    )
    features = T.triangles(spark, sf).select(
        F.expr("'f' || (raster_id div 10)").alias("folder"), layer.alias("layer"), "feature_id", "geom_type",
        F.transform("rings", lambda ring: F.transform(ring, geo)).alias("rings"), attrs.alias("attrs"), F.lit("EPSG:3857").alias("crs"),
    )
    return meta, features


@query("preprocess_totals", f"""WITH {S.TRIANGLES}, l AS (
  SELECT *, (feature_id % 10 + layer_ord) % 7 AS k, ['built','road','water','utility','built','utility','none'][(feature_id % 10 + layer_ord) % 7 + 1] AS layer FROM tri),
px AS (SELECT raster_id, CASE layer WHEN 'built' THEN 1 WHEN 'road' THEN 2 ELSE 3 END AS class_id,
    CAST(floor(y0) + i AS INTEGER) AS r, CAST(floor(x0) + j AS INTEGER) AS c
  FROM l, range(11) a(i), range(11) b(j) WHERE layer IN ('built', 'road', 'water')
    AND floor(y0) + i + 0.5 > y0 AND floor(x0) + j + 0.5 > x0 AND (floor(x0) + j + 0.5 - x0) + (floor(y0) + i + 0.5 - y0) < leg),
fg AS (SELECT DISTINCT raster_id, r, c FROM px),
tiles AS (SELECT raster_id, s, tr, tc FROM fg, (SELECT s, s * 32 + k * 24 AS tr, least(32, least(64, 240 - s * 32) - k * 24) AS h
    FROM range(8) a(s), range(3) b(k) WHERE k * 24 < least(64, 240 - s * 32)) g, (SELECT k * 24 AS tc FROM range(10) t(k)) h2
  WHERE r >= tr AND r < tr + h AND c >= tc AND c < tc + 32 GROUP BY ALL HAVING count(*) / 1024 >= 0.003),
best AS (SELECT raster_id // 10 AS folder, min(k) AS k FROM l WHERE layer = 'built' GROUP BY 1),
crops AS (SELECT raster_id, feature_id FROM l JOIN best ON best.folder = raster_id // 10 AND best.k = l.k WHERE layer = 'built' AND floor(y0 + leg) - floor(y0) >= 5 AND floor(x0 + leg) - floor(x0) >= 5),
infra AS (SELECT raster_id, feature_id FROM l WHERE layer = 'utility' AND layer_ord IN (1, 2)),
per AS (SELECT 'f' || (s_suppkey // 10) AS folder, s_suppkey % 10 <> 3 AS ok, (SELECT count(*) FROM tiles t WHERE t.raster_id = s_suppkey) AS patches,
  (SELECT count(*) FROM crops t WHERE t.raster_id = s_suppkey) AS crops, (SELECT count(*) FROM infra t WHERE t.raster_id = s_suppkey) AS infra FROM supplier)
SELECT folder, count(*) FILTER (ok) AS rasters, count(*) FILTER (NOT ok) AS failed, CAST(coalesce(sum(patches) FILTER (ok), 0) AS BIGINT) AS patches,
  CAST(coalesce(sum(crops) FILTER (ok), 0) AS BIGINT) AS crops, CAST(coalesce(sum(infra) FILTER (ok), 0) AS BIGINT) AS infra
FROM per GROUP BY ROLLUP (folder)""")
def preprocess_totals(spark, sf):
    meta, features = _training_inputs(spark, sf)
    out = W.preprocess(
        meta, features, "EPSG:3857", seg=SMALL, roof=RoofParams(min_crop_px=5), det=DetectParams(tile_size=48)
    )
    return W.preprocess_totals(meta, out)


def _probs(spark, sf):
    return W.segment(T.raster_meta(spark, sf), T.rgb(spark, sf), make_stub, SMALL)


@query("infer_features")
def infer_features(spark, sf):
    """Outlines from a stub predictor to regions on the map; checked in the tests."""
    meta = T.raster_meta(spark, sf).withColumn("affine", F.expr(_AFFINE))
    v = F.array(*[F.col("v") * k for k in (-8.0, 4.0, 9.0, 12.0)])
    probs = T.pixels(spark, sf).select("raster_id", "r", "c", B.softmax(v).alias("probs"))
    out = W.infer(meta, probs, seg=SMALL, block=32)
    return out["outlines"].groupBy("raster_id", "class_name").agg(
        F.count_distinct("region").alias("features"), F.count("*").alias("vertices")
    )


def make_roof_stub():
    """A predictor by arithmetic on the mean of the first band."""

    def predict(x: np.ndarray) -> np.ndarray:
        z = 12 * np.sin(9 * x[..., 0].mean((1, 2), dtype="float64")[:, None] / 255 + 2 * np.arange(1, 5))
        e = np.exp(z - z.max(1, keepdims=True))
        return (e / e.sum(1, keepdims=True)).astype("float32")

    return predict


def _buildings(spark, sf):
    """One box per vector on the raster of its vector, some small, some over the border."""
    p = lambda r, c: F.struct((F.expr(c) * 0.5).alias("x"), (F.expr(r) * -0.5).alias("y"))
    return T.table(spark, sf, "embeddings").selectExpr(
        "vec_id div 100 as raster_id", "vec_id as region", "vec_id * 7 % 90 as y", "vec_id * 13 % 55 as x", "4 + vec_id % 20 as h", "4 + vec_id % 17 as w"
    ).select("raster_id", "region", F.array(F.array(p("y", "x"), p("y + h", "x + w"))).alias("rings"))


@query("roof_chain", f"""WITH {S.RGB}, {S.META},
b AS (SELECT vec_id AS region, vec_id // 100 AS raster_id, vec_id * 7 % 90 AS y, vec_id * 13 % 55 AS x, 4 + vec_id % 20 AS h, 4 + vec_id % 17 AS w FROM embeddings),
q AS (SELECT raster_id, region, h < 5 OR w < 5 AS small, greatest(0, y - trunc(h * 0.15)) AS r1, least(height, y + h + trunc(h * 0.15)) AS r2,
  greatest(0, x - trunc(w * 0.15)) AS c1, least(width, x + w + trunc(w * 0.15)) AS c2 FROM b JOIN meta USING (raster_id)),
g AS (SELECT * FROM q WHERE NOT small AND r2 > r1 AND c2 > c1),
rw AS (SELECT *, least(greatest((i + 0.5) * (r2 - r1)::DOUBLE / 8 - 0.5, 0), r2 - r1 - 1) AS fy, least(greatest((j + 0.5) * (c2 - c1)::DOUBLE / 8 - 0.5, 0), c2 - c1 - 1) AS fx
  FROM g, range(8) a(i), range(8) d(j)),
tap AS (SELECT raster_id, region, CAST(r1 + floor(fy) + dy AS INTEGER) AS r, CAST(c1 + floor(fx) + dx AS INTEGER) AS c,
  abs(1 - dy - (fy - floor(fy))) * abs(1 - dx - (fx - floor(fx))) AS wt FROM rw, range(2) e(dy), range(2) f(dx)),
m AS (SELECT region, sum(b1 * wt) / 64 / 255 AS m FROM tap JOIN rgb USING (raster_id, r, c) WHERE wt > 0 GROUP BY 1),
z AS (SELECT region, [exp(12 * sin(9 * m + 2 * k)) FOR k IN [1, 2, 3, 4]] AS e FROM m),
n AS (SELECT region, CASE WHEN list_max(e) / list_sum(e) < 0.55 THEN 'Other' ELSE ['RCC','Tiled','Tin','Other'][list_position(e, list_max(e))] END AS label FROM z)
SELECT raster_id, region, coalesce(label, 'Other') AS label FROM q LEFT JOIN n USING (region)""")
def roof_chain(spark, sf):
    """Buildings to crops, resized pixels, predictions and roof labels."""
    meta = T.raster_meta(spark, sf).withColumn("affine", F.expr(_AFFINE))
    return W.classify_roofs(
        _buildings(spark, sf), T.rgb(spark, sf), meta, make_roof_stub, RoofParams(crop_size=8, min_crop_px=5), block=32
    )


_CONFUSION = S.MASK_PAIR + """, cm AS (SELECT target, pred, count(*)::DOUBLE AS n FROM pair GROUP BY ALL),
k AS (SELECT CAST(k AS INTEGER) AS class_id, coalesce((SELECT sum(n) FROM cm WHERE target = k AND pred = k), 0) AS tp,
  coalesce((SELECT sum(n) FROM cm WHERE target = k), 0) AS act, coalesce((SELECT sum(n) FROM cm WHERE pred = k), 0) AS prd FROM range(4) t(k)),
m AS (SELECT *, tp / greatest(act + prd - tp, 1e-6) AS iou, 2 * tp / greatest(act + prd, 1e-6) AS f1 FROM k)"""


def _evaluated(spark, sf):
    """Masks that store foreground only, as written by the workflow."""
    pair = T.mask_pair(spark, sf)
    side = lambda c: pair.filter(F.col(c) > 0).select("raster_id", "r", "c", F.col(c).alias("class_id"))
    return W.evaluate(side("target"), side("pred"), T.raster_meta(spark, sf), 4)


@query("evaluate_masks", f"WITH {_CONFUSION} SELECT class_id, round(iou, 6) AS iou, round(f1, 6) AS f1 FROM m")
def evaluate_masks(spark, sf):
    return _evaluated(spark, sf)[0].select("class_id", F.round("iou", 6).alias("iou"), F.round("f1", 6).alias("f1"))


@query("evaluate_summary", f"""WITH {_CONFUSION} SELECT round(sum(iou) FILTER (class_id > 0) / 3, 6) AS mean_iou,
  round(sum(f1) FILTER (class_id > 0) / 3, 6) AS mean_f1, round(sum(tp) / sum(act), 6) AS pixel_acc FROM m""")
def evaluate_summary(spark, sf):
    return _evaluated(spark, sf)[1].select(*[F.round(c, 6).alias(c) for c in ("mean_iou", "mean_f1", "pixel_acc")])


@query("incremental_folder", f"WITH {S.MASK} SELECT raster_id, class_id, count(*) AS n FROM mask GROUP BY ALL")
def incremental_folder(spark, sf):
    """Vectors arriving as files become mask statistics per batch."""
    from geoloom.runtime import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    base = spark.sparkContext.getCheckpointDir()
    work = f"{base}/incremental-{uuid.uuid4().hex}"

    def count(batch):
        px = batch.select(
            F.expr("vec_id div 100").alias("raster_id"), "source_file", F.explode("embedding").alias("e")
        )
        return px.groupBy("raster_id", "source_file", T.mask_class(F.col("e").cast("double")).alias("class_id")).agg(F.count("*").alias("n"))

    # The table may be one file or a folder of files.
    process_new_files(
        spark, f"{sf}/embeddings.parquet", "vec_id bigint, embedding array<float>, label int", count, f"{work}/out", f"{work}/state"
    )
    out = spark.read.parquet(f"{work}/out")
    return out.groupBy("raster_id", "class_id").agg(F.sum("n").alias("n"))
