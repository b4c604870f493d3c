"""Queries: boxes, suppression, matching and average precision."""

from pyspark.sql import functions as F

from geoloom.model import INFRA_CLASSES
from geoloom.operators import detect as D
from geoloom.operators.spatial import iou_pairs
from geoloom.plans import sqltables as S
from geoloom.plans import tables as T
from geoloom.plans.registry import query

CELL = 128.0


def _iou(a: str, b: str, plus: bool = False) -> str:
    inter = (
        f"(greatest(least({a}.x2,{b}.x2)-greatest({a}.x1,{b}.x1),0)"
        f"*greatest(least({a}.y2,{b}.y2)-greatest({a}.y1,{b}.y1),0))"
    )
    union = f"(({a}.x2-{a}.x1)*({a}.y2-{a}.y1)+({b}.x2-{b}.x1)*({b}.y2-{b}.y1)-{inter})"
    return f"({inter}/({union}+1e-6))" if plus else f"({inter}/greatest({union},1e-6))"


def _preds(spark, sf):
    return T.detections(spark, sf).drop("l_returnflag")


def _affine(df):
    """Map placement of the box rasters: 10 cm pixels, north up."""
    a = "named_struct('a', 0.1D, 'b', 0D, 'c', 1000D * raster_id, 'd', 0D, 'e', -0.1D, 'f', 5000D)"
    return df.select("raster_id").distinct().selectExpr("raster_id", f"{a} as affine")


@query("tile_to_raster", f"""WITH {S.DET} SELECT raster_id, det_id,
  x1 + CAST(det_id % 3 AS INTEGER) * 768 AS x1, y1 + CAST(det_id % 4 AS INTEGER) * 768 AS y1,
  x2 + CAST(det_id % 3 AS INTEGER) * 768 AS x2, y2 + CAST(det_id % 4 AS INTEGER) * 768 AS y2 FROM det WHERE conf > 0.1""")
def tile_to_raster(spark, sf):
    tiles = _preds(spark, sf).selectExpr(
        "*", "cast(det_id % 3 as int) * 768 as tile_c", "cast(det_id % 4 as int) * 768 as tile_r"
    )
    return D.confident(D.to_raster_coordinates(tiles), 0.1).select("raster_id", "det_id", *D.BOX)


@query("box_iou_join", f"""WITH {S.TRUTH} SELECT d.raster_id, d.class_id, det_id, gt_id, round({_iou('d', 't')}, 6) AS iou
FROM det d JOIN truth t ON d.raster_id = t.raster_id AND d.class_id = t.class_id
  AND d.x1 < t.x2 AND t.x1 < d.x2 AND d.y1 < t.y2 AND t.y1 < d.y2 WHERE {_iou('d', 't')} >= 0.3""")
def box_iou_join(spark, sf):
    pairs = iou_pairs(_preds(spark, sf), T.truth(spark, sf), D.GROUP, CELL, 0.3)
    return pairs.select(
        *D.GROUP, F.col("a_det_id").alias("det_id"), F.col("b_gt_id").alias("gt_id"), F.round("iou", 6).alias("iou")
    )


@query("self_overlaps", f"""WITH {S.DET} SELECT a.raster_id, a.class_id, count(*) AS pairs, round(max({_iou('a', 'b')}), 6) AS best
FROM det a JOIN det b ON a.raster_id = b.raster_id AND a.class_id = b.class_id AND a.det_id < b.det_id
  AND a.x1 < b.x2 AND b.x1 < a.x2 AND a.y1 < b.y2 AND b.y1 < a.y2 GROUP BY ALL""")
def self_overlaps(spark, sf):
    boxes = _preds(spark, sf)
    pairs = iou_pairs(boxes, boxes, D.GROUP, CELL, 0.0).filter("a_det_id < b_det_id")
    return pairs.groupBy(*D.GROUP).agg(F.count("*").alias("pairs"), F.round(F.max("iou"), 6).alias("best"))


_NMS = S.DET + f""", live AS (SELECT raster_id, class_id, det_id, x1, y1, x2, y2, conf FROM det),
nms AS (
  SELECT 0 AS step, *, conf AS score, row_number() OVER (PARTITION BY raster_id, class_id ORDER BY conf DESC, det_id, x1, y1, x2, y2) AS rk FROM live
  UNION ALL
  SELECT step + 1, raster_id, class_id, det_id, x1, y1, x2, y2, conf, s,
         row_number() OVER (PARTITION BY raster_id, class_id ORDER BY s DESC, det_id, x1, y1, x2, y2)
  FROM (SELECT o.*, o.score * exp(-pow({_iou('o', 'm', True)}, 2) / 0.9) AS s
        FROM nms o JOIN nms m ON o.raster_id = m.raster_id AND o.class_id = m.class_id AND m.rk = 1 AND o.rk > 1)
  WHERE s > 0.1)"""


@query("soft_nms", f"""WITH RECURSIVE {_NMS}
SELECT raster_id, class_id, det_id, conf, round(score, 6) AS score FROM nms WHERE rk = 1""")
def soft_nms(spark, sf):
    kept = D.soft_nms(_preds(spark, sf), 0.9, 0.1, CELL)
    return kept.select(*D.GROUP, "det_id", "conf", F.round("score", 6).alias("score"))


@query("det_points", f"""WITH RECURSIVE {_NMS}
SELECT raster_id, det_id, round(1000.0::DOUBLE * raster_id + (x1 + x2) / 2 * 0.1, 6) AS x,
  round(5000.0::DOUBLE - (y1 + y2) / 2 * 0.1, 6) AS y, class_id,
  ['transformer','overhead_tank','well'][class_id + 1] AS class_name, round(score, 4) AS confidence
FROM nms WHERE rk = 1""")
def det_points(spark, sf):
    boxes = _preds(spark, sf)
    kept = D.soft_nms(boxes, 0.9, 0.1, CELL)
    pts = D.detection_points(kept, _affine(boxes), INFRA_CLASSES, "score")
    return pts.withColumn("x", F.round("x", 6)).withColumn("y", F.round("y", 6))


def _match_sql(ts: str) -> str:
    """One step per prediction in confidence order; the state is the list of taken boxes."""
    return S.TRUTH + f""", nd AS (SELECT *, row_number() OVER (ORDER BY raster_id, class_id, det_id, x1, y1, x2, y2) AS p FROM det),
nt AS (SELECT *, row_number() OVER (ORDER BY raster_id, class_id, gt_id, x1, y1, x2, y2) AS g FROM truth), ts AS (SELECT unnest([{ts}]) AS t),
cand AS (SELECT d.raster_id, d.class_id, p, det_id, conf, g, gt_id, {_iou('d', 't')} AS iou
  FROM nd d JOIN nt t ON d.raster_id = t.raster_id AND d.class_id = t.class_id
    AND d.x1 < t.x2 AND t.x1 < d.x2 AND d.y1 < t.y2 AND t.y1 < d.y2),
c5 AS (SELECT cand.*, t, dense_rank() OVER (PARTITION BY raster_id, class_id, t ORDER BY conf DESC, p) AS rk
  FROM cand, ts WHERE iou >= t),
cl AS (SELECT raster_id, class_id, t, rk, p, det_id, list({{'g': g, 'id': gt_id, 'i': iou}} ORDER BY iou DESC, g) AS opts FROM c5 GROUP BY ALL),
run AS (
  SELECT raster_id, class_id, t, 0::BIGINT AS rk, 0::BIGINT AS p, 0::BIGINT AS det_id, []::BIGINT[] AS taken, NULL::BIGINT AS gt_id, NULL::DOUBLE AS iou
  FROM (SELECT DISTINCT raster_id, class_id, t FROM cl)
  UNION ALL
  SELECT raster_id, class_id, t, rk, p, det_id, CASE WHEN o IS NULL THEN taken ELSE list_append(taken, o.g) END, o.id, o.i
  FROM (SELECT r.raster_id, r.class_id, r.t, c.rk, c.p, c.det_id, r.taken,
               list_filter(c.opts, lambda x: NOT list_contains(r.taken, x.g))[1] AS o
        FROM run r JOIN cl c ON r.raster_id = c.raster_id AND r.class_id = c.class_id AND r.t = c.t AND c.rk = r.rk + 1)),
m AS (SELECT raster_id, class_id, t, p, det_id, gt_id, iou FROM run WHERE gt_id IS NOT NULL)"""


def _ap_sql(ts: str) -> str:
    return _match_sql(ts) + """, flags AS (
  SELECT d.class_id, ts.t, d.conf, d.p, d.det_id, d.raster_id, d.x1, d.y1, d.x2, d.y2, CASE WHEN m.p IS NULL THEN 0 ELSE 1 END AS hit
  FROM nd d CROSS JOIN ts LEFT JOIN m ON m.p = d.p AND m.t = ts.t),
cum AS (SELECT *, sum(hit) OVER w AS tp, count(*) OVER w AS n FROM flags
  WINDOW w AS (PARTITION BY class_id, t ORDER BY conf DESC, det_id, raster_id, x1, y1, x2, y2, p ROWS UNBOUNDED PRECEDING)),
pr AS (SELECT class_id, t, n, tp / (SELECT count(*) FROM truth g WHERE g.class_id = cum.class_id) AS rec, tp / n AS prec FROM cum),
env AS (SELECT class_id, t, rec, max(prec) OVER (PARTITION BY class_id, t ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p,
  lag(rec, 1, 0) OVER (PARTITION BY class_id, t ORDER BY n) AS before FROM pr),
ap AS (SELECT class_id, t, sum((rec - before) * p) AS ap FROM env GROUP BY ALL)"""


_COCO = ",".join(f"{t}::DOUBLE" for t in D.COCO_THRESHOLDS)


def _scored(spark, sf, thresholds):
    preds, truth = D.numbered(_preds(spark, sf)), T.truth(spark, sf)
    return D.average_precision(preds, truth, D.match(preds, truth, thresholds, CELL), 3, thresholds)


@query("greedy_match", f"WITH RECURSIVE {_match_sql('0.5::DOUBLE')} SELECT raster_id, class_id, det_id, gt_id, round(iou, 6) AS iou FROM m")
def greedy_match(spark, sf):
    m = D.match(_preds(spark, sf), T.truth(spark, sf), [0.5], CELL)
    return m.select(*D.GROUP, "det_id", "gt_id", F.round("iou", 6).alias("iou"))


@query("pr_curve", f"""WITH RECURSIVE {_ap_sql('0.5::DOUBLE')} SELECT class_id, raster_id, det_id, n AS rank, CAST(tp AS BIGINT) AS tp, CAST(n - tp AS BIGINT) AS fp FROM cum""")
def pr_curve(spark, sf):
    preds = D.numbered(_preds(spark, sf))
    return D.curve(preds, D.match(preds, T.truth(spark, sf), [0.5], CELL))


@query("ap50", f"WITH RECURSIVE {_ap_sql('0.5::DOUBLE')} SELECT CAST(class_id AS INTEGER) AS class_id, round(ap, 6) AS ap FROM ap")
def ap50(spark, sf):
    return _scored(spark, sf, [0.5]).select("class_id", F.round("ap", 6).alias("ap"))


@query("map_coco", f"WITH RECURSIVE {_ap_sql(_COCO)} SELECT round(avg(ap), 6) AS map FROM ap")
def map_coco(spark, sf):
    return D.mean_average_precision(_scored(spark, sf, D.COCO_THRESHOLDS)).select(F.round("map", 6).alias("map"))
