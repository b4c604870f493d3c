"""Queries: confusion matrices, scores, weights and losses."""

from pyspark.sql import functions as F

from geoloom.model import SEG_CLASSES, SegmentationParams
from geoloom.operators import metrics as M
from geoloom.plans import sqltables as S
from geoloom.plans import tables as T
from geoloom.plans.registry import query

P = SegmentationParams()

_CM = """, cm AS (SELECT target, pred, count(*) AS n FROM pair GROUP BY target, pred),
k AS (SELECT CAST(k AS INTEGER) AS class_id,
       coalesce((SELECT sum(n) FROM cm WHERE target = k AND pred = k), 0)::DOUBLE AS tp,
       coalesce((SELECT sum(n) FROM cm WHERE target = k), 0)::DOUBLE AS act,
       coalesce((SELECT sum(n) FROM cm WHERE pred = k), 0)::DOUBLE AS prd
      FROM range(4) t(k))"""
_SEG = _CM + """, m AS (SELECT class_id, tp, act, tp / greatest(act + prd - tp, 1e-6) AS iou,
       2 * tp / greatest(act + prd, 1e-6) AS f1 FROM k)"""
_CLF = _CM + """, pr AS (SELECT *, tp / greatest(prd, 1e-6) AS p, tp / greatest(act, 1e-6) AS q FROM k),
m AS (SELECT *, 2 * p * q / greatest(p + q, 1e-6) AS f FROM pr)"""


def _round(df, *cols, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("confusion_matrix", f"WITH {S.MASK_PAIR} SELECT target, pred, count(*) AS n FROM pair GROUP BY ALL")
def confusion(spark, sf):
    return M.confusion_matrix(M.valid_labels(T.mask_pair(spark, sf), 4, both=False))


@query("seg_class_metrics", f"WITH {S.MASK_PAIR} {_SEG} SELECT class_id, round(iou, 6) AS iou, round(f1, 6) AS f1 FROM m")
def seg_classes(spark, sf):
    return _round(M.seg_class_metrics(T.mask_pair(spark, sf), 4), "iou", "f1")


@query("seg_summary", f"""WITH {S.MASK_PAIR} {_SEG}
SELECT round(avg(iou) FILTER (class_id > 0), 6) AS mean_iou, round(avg(f1) FILTER (class_id > 0), 6) AS mean_f1,
       round(sum(tp) / sum(act), 6) AS pixel_acc,
       round(sum(tp) FILTER (class_id > 0) / sum(act) FILTER (class_id > 0), 6) AS fg_pixel_acc FROM m""")
def seg_summary(spark, sf):
    return _round(M.seg_summary(T.mask_pair(spark, sf), 4), "mean_iou", "mean_f1", "pixel_acc", "fg_pixel_acc")


@query("seg_report", f"""WITH {S.MASK_PAIR} {_SEG}
SELECT class_id, printf('%-14s %8.3f %8.3f', ['background','building','road','waterbody'][class_id + 1], iou, f1)
  AS line FROM m""")
def seg_report(spark, sf):
    return M.seg_report(T.mask_pair(spark, sf), SEG_CLASSES)


@query("clf_class_metrics", f"""WITH {S.CLS_PAIR} {_CLF}
SELECT class_id, round(p, 6) AS precision, round(q, 6) AS recall, round(f, 6) AS f1, CAST(act AS BIGINT) AS support FROM m""")
def clf_classes(spark, sf):
    return _round(M.clf_class_metrics(T.cls_pair(spark, sf), 4), "precision", "recall", "f1")


@query("clf_report", f"""WITH {S.CLS_PAIR} {_CLF}
SELECT round(sum(tp) / sum(act), 6) AS accuracy, round(avg(p), 6) AS macro_precision, round(avg(q), 6) AS macro_recall,
       round(avg(f), 6) AS macro_f1, round(sum(p * act) / sum(act), 6) AS weighted_precision,
       round(sum(q * act) / sum(act), 6) AS weighted_recall, round(sum(f * act) / sum(act), 6) AS weighted_f1 FROM m""")
def clf_report(spark, sf):
    df = M.clf_summary(T.cls_pair(spark, sf), 4)
    return _round(df, *df.columns)


@query("binary_report", f"""WITH pair AS (SELECT quality AS target, toxic AS pred FROM labels) {_CLF}
SELECT class_id, round(p, 6) AS precision, round(q, 6) AS recall, round(f, 6) AS f1, CAST(act AS BIGINT) AS support
FROM m WHERE class_id < 2""")
def binary_report(spark, sf):
    pair = T.table(spark, sf, "labels").selectExpr("quality as target", "toxic as pred")
    return _round(M.clf_class_metrics(pair, 2), "precision", "recall", "f1")


@query("class_weights", f"""WITH {S.CLS_PAIR}, n AS (
  SELECT CAST(k AS INTEGER) AS class_id, (SELECT count(*) FROM pair WHERE target = k) AS n FROM range(5) t(k))
SELECT class_id, n, round((1 / (n + 1e-6)) / (SELECT sum(1 / (n + 1e-6)) FROM n) * 5, 6) AS weight FROM n""")
def class_weights(spark, sf):
    return _round(M.class_weights(T.cls_pair(spark, sf), "target", 5), "weight")


@query("batch_accuracy", f"""WITH {S.CLS_PAIR}
SELECT item // 16 AS batch_id, round(avg(CASE WHEN pred = target THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy, count(*) AS n
FROM pair GROUP BY ROLLUP (item // 16)""")
def batch_accuracy(spark, sf):
    df = T.cls_pair(spark, sf).withColumn("batch_id", F.expr("item div 16"))
    return _round(M.batch_accuracy(df, "batch_id"), "accuracy")


@query("tri_loss", f"""WITH {S.SCORES},
w AS (SELECT [x / (6.65 + 1e-6) * 4 FOR x IN [0.05::DOUBLE, 1.6::DOUBLE, 3.0::DOUBLE, 2.0::DOUBLE]] AS w),
e AS (SELECT image, target, [exp(z1), exp(z2), exp(z3), exp(z4)] AS e FROM scores),
p AS (SELECT image, target, [x / list_sum(e) FOR x IN e] AS p, w FROM e, w),
q AS (SELECT image, target, p, w, w[target + 1] AS wt, -ln(p[target + 1]) AS nll,
             -(w[1] * ln(p[1]) + w[2] * ln(p[2]) + w[3] * ln(p[3]) + w[4] * ln(p[4])) AS spread FROM p),
ce AS (SELECT 0.95 * sum(wt * nll) / sum(wt) + 0.05 / 4 * sum(spread) / sum(wt) AS ce,
              avg(wt * pow(1 - p[target + 1], 2) * nll) AS focal FROM q),
d AS (SELECT image, k, any_value(w[k]) AS wk, sum(CASE WHEN target = k - 1 THEN p[k] ELSE 0 END) AS i,
             sum(p[k] + CASE WHEN target = k - 1 THEN 1 ELSE 0 END) AS u
      FROM q, range(1, 5) t(k) GROUP BY image, k),
dc AS (SELECT k, any_value(wk) AS wk, avg(ln(cosh(1 - (2 * i + 1e-6) / (u + 1e-6)))) AS v FROM d GROUP BY k),
di AS (SELECT sum(wk * v) / (sum(wk) + 1e-6) AS dice FROM dc)
SELECT round(ce, 6) AS ce, round(focal, 6) AS focal, round(dice, 6) AS dice,
       round(0.6 * dice + 0.2 * ce + 0.2 * focal, 6) AS loss FROM ce, di""")
def tri_loss(spark, sf):
    df = M.tri_loss(
        T.class_scores(spark, sf), ["z1", "z2", "z3", "z4"], P.class_weights, P.dice_weight,
        P.ce_weight, P.focal_weight, P.focal_gamma, P.label_smoothing, P.smooth,
    )
    return _round(df, *df.columns)


@query("mixed_label_loss", f"""WITH {S.SCORES}
SELECT round(avg(0.3 * (z1 * z1) + (1 - 0.3) * (z2 * z2)), 6) AS loss FROM scores""")
def mixed_label_loss(spark, sf):
    df = T.class_scores(spark, sf).selectExpr("0.3D as lam", "z1 * z1 as loss_a", "z2 * z2 as loss_b")
    return _round(M.mixed_label_loss(df), "loss")
