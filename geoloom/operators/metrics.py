"""Confusion-matrix metrics, class weights and evaluation losses.

Everything is one partial aggregation over the rows followed by arithmetic on a
table with at most (classes x classes) rows, so no class can overload a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPS = 1e-6


def valid_labels(df: DataFrame, n: int, both: bool) -> DataFrame:
    """Drop rows whose target (and prediction, if ``both``) is not in ``[0, n)``."""
    ok = F.col("target").between(0, n - 1)
    return df.filter(ok & F.col("pred").between(0, n - 1)) if both else df.filter(ok)


def confusion_matrix(df: DataFrame) -> DataFrame:
    return df.groupBy("target", "pred").agg(F.count("*").alias("n"))


def _class_counts(cm: DataFrame, n: int) -> DataFrame:
    """One row with an array of (tp, row sum, column sum) per class; unseen classes count 0."""
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    per_class = [
        F.struct(
            F.lit(k).alias("class_id"),
            total((F.col("target") == k) & (F.col("pred") == k)).cast("double").alias("tp"),
            total(F.col("target") == k).cast("double").alias("actual"),
            total(F.col("pred") == k).cast("double").alias("predicted"),
        )
        for k in range(n)
    ]
    return cm.agg(F.array(*per_class).alias("k"))


def _floor(x: Column) -> Column:
    return F.greatest(x, F.lit(EPS))


def _iou(k: Column) -> Column:
    return k["tp"] / _floor(k["actual"] + k["predicted"] - k["tp"])


def _dice(k: Column) -> Column:
    return 2 * k["tp"] / _floor(k["actual"] + k["predicted"])


def _mean(k: Column, f, n: int) -> Column:
    return F.aggregate(k, F.lit(0.0), lambda acc, x: acc + f(x)) / n


def _total(k: Column, field: str) -> Column:
    return F.aggregate(k, F.lit(0.0), lambda acc, x: acc + x[field])


def seg_class_metrics(df: DataFrame, n: int) -> DataFrame:
    """(class_id, iou, f1) for all ``n`` classes."""
    return class_metrics_of(confusion_matrix(valid_labels(df, n, both=False)), n)


def class_metrics_of(matrix: DataFrame, n: int) -> DataFrame:
    """The same from counts (target, pred, n)."""
    k = _class_counts(matrix, n)
    return k.select(F.explode("k").alias("k")).select(
        "k.class_id", _iou(F.col("k")).alias("iou"), _dice(F.col("k")).alias("f1")
    )


def seg_summary(df: DataFrame, n: int) -> DataFrame:
    """Means over the foreground classes, and pixel accuracy."""
    return summary_of(confusion_matrix(valid_labels(df, n, both=False)), n)


def summary_of(matrix: DataFrame, n: int) -> DataFrame:
    """The same from counts (target, pred, n)."""
    k = _class_counts(matrix, n)
    fg = F.slice("k", 2, n - 1)
    return k.select(
        _mean(fg, _iou, n - 1).alias("mean_iou"),
        _mean(fg, _dice, n - 1).alias("mean_f1"),
        (_total(F.col("k"), "tp") / _floor(_total(F.col("k"), "actual"))).alias("pixel_acc"),
        (_total(fg, "tp") / _floor(_total(fg, "actual"))).alias("fg_pixel_acc"),
    )


def _precision(k: Column) -> Column:
    return k["tp"] / _floor(k["predicted"])


def _recall(k: Column) -> Column:
    return k["tp"] / _floor(k["actual"])


def _harmonic(k: Column) -> Column:
    p, r = _precision(k), _recall(k)
    return 2 * p * r / _floor(p + r)


def clf_class_metrics(df: DataFrame, n: int) -> DataFrame:
    """(class_id, precision, recall, f1, support); a zero denominator gives 0."""
    k = _class_counts(confusion_matrix(valid_labels(df, n, both=True)), n)
    c = F.col("k")
    return k.select(F.explode("k").alias("k")).select(
        "k.class_id",
        _precision(c).alias("precision"),
        _recall(c).alias("recall"),
        _harmonic(c).alias("f1"),
        F.col("k.actual").cast("bigint").alias("support"),
    )


def clf_summary(df: DataFrame, n: int) -> DataFrame:
    """Accuracy with macro and support-weighted averages."""
    k = _class_counts(confusion_matrix(valid_labels(df, n, both=True)), n)
    c = F.col("k")
    support = _floor(_total(c, "actual"))
    weighted = lambda f: F.aggregate(
        c, F.lit(0.0), lambda acc, x: acc + f(x) * x["actual"]
    ) / support
    return k.select(
        (_total(c, "tp") / support).alias("accuracy"),
        _mean(c, _precision, n).alias("macro_precision"),
        _mean(c, _recall, n).alias("macro_recall"),
        _mean(c, _harmonic, n).alias("macro_f1"),
        weighted(_precision).alias("weighted_precision"),
        weighted(_recall).alias("weighted_recall"),
        weighted(_harmonic).alias("weighted_f1"),
    )


def seg_report(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Text lines of the segmentation summary: one per class, in class order."""
    rows = seg_class_metrics(df, len(names))
    name = F.element_at(F.array(*[F.lit(x) for x in names]), F.col("class_id") + 1)
    return rows.select(
        "class_id", F.format_string("%-14s %8.3f %8.3f", name, "iou", "f1").alias("line")
    )


def class_weights(df: DataFrame, label: str, n: int) -> DataFrame:
    """Inverse-frequency weights that sum to ``n``; unseen classes are included."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    per = F.array(
        *[
            F.struct(
                F.lit(k).alias("class_id"),
                F.coalesce(F.sum(F.when(F.col(label) == k, F.col("n"))), F.lit(0)).alias("n"),
            )
            for k in range(n)
        ]
    )
    inv = lambda x: 1 / (x["n"] + F.lit(EPS))
    one = counts.agg(per.alias("k")).withColumn(
        "s", F.aggregate("k", F.lit(0.0), lambda acc, x: acc + inv(x))
    )
    return one.select(F.explode("k").alias("k"), "s").select(
        "k.class_id", "k.n", (inv(F.col("k")) / F.col("s") * n).alias("weight")
    )


def normalised_weights(weights: tuple[float, ...]) -> list[float]:
    """Given weights scaled to sum to their number."""
    total = sum(weights) + EPS
    return [w / total * len(weights) for w in weights]


def batch_accuracy(df: DataFrame, batch: str) -> DataFrame:
    """Accuracy per batch plus the running total row (batch is null)."""
    return df.rollup(batch).agg(
        F.avg((F.col("pred") == F.col("target")).cast("double")).alias("accuracy"),
        F.count("*").alias("n"),
    )


def _softmax(z: list[str]) -> list[Column]:
    top = F.greatest(*[F.col(c) for c in z])
    e = [F.exp(F.col(c) - top) for c in z]
    total = sum(e[1:], e[0])
    return [x / total for x in e]


def tri_loss(
    df: DataFrame,
    scores: list[str],
    weights: tuple[float, ...],
    dice_weight: float,
    ce_weight: float,
    focal_weight: float,
    gamma: float,
    smoothing: float,
    smooth: float,
) -> DataFrame:
    """Weighted smoothed cross entropy, focal and log-cosh Dice over (image, target, scores).

    One aggregation per image (sums only), one over images.
    """
    n = len(scores)
    w = normalised_weights(weights)
    p = df.select("image", "target", *[q.alias(f"p{k}") for k, q in enumerate(_softmax(scores))])
    prob = [F.col(f"p{k}") for k in range(n)]
    w_target = F.element_at(F.array(*[F.lit(x) for x in w]), F.col("target") + 1)
    p_target = F.element_at(F.array(*prob), F.col("target") + 1)
    nll = -F.log(p_target)
    spread = sum((F.lit(w[k]) * -F.log(prob[k]) for k in range(1, n)), F.lit(w[0]) * -F.log(prob[0]))
    hit = [F.when(F.col("target") == k, 1.0).otherwise(0.0) for k in range(n)]
    per_image = p.groupBy("image").agg(
        F.sum(w_target * nll).alias("nll"),
        F.sum(spread).alias("spread"),
        F.sum(w_target).alias("w"),
        F.sum(w_target * F.pow(1 - p_target, F.lit(gamma)) * nll).alias("focal"),
        F.count("*").alias("n"),
        *[F.sum(prob[k] * hit[k]).alias(f"inter{k}") for k in range(n)],
        *[F.sum(prob[k] + hit[k]).alias(f"union{k}") for k in range(n)],
    )
    dice = [
        1 - (2 * F.col(f"inter{k}") + smooth) / (F.col(f"union{k}") + smooth) for k in range(n)
    ]
    share = [x / (sum(w) + EPS) for x in w]
    terms = per_image.agg(
        (
            (1 - smoothing) * F.sum("nll") / F.sum("w")
            + smoothing / n * F.sum("spread") / F.sum("w")
        ).alias("ce"),
        (F.sum("focal") / F.sum("n")).alias("focal"),
        sum(
            (F.avg(F.log(F.cosh(dice[k]))) * share[k] for k in range(1, n)),
            F.avg(F.log(F.cosh(dice[0]))) * share[0],
        ).alias("dice"),
    )
    return terms.withColumn(
        "loss", dice_weight * F.col("dice") + ce_weight * F.col("ce") + focal_weight * F.col("focal")
    )


def mixed_label_loss(df: DataFrame) -> DataFrame:
    """Mean of lam * loss_a + (1 - lam) * loss_b."""
    return df.agg(
        F.avg(F.col("lam") * F.col("loss_a") + (1 - F.col("lam")) * F.col("loss_b")).alias("loss")
    )
