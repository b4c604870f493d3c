"""Detections: coordinates, soft suppression, matching and average precision.

Suppression and matching are sequential by definition.  Groups of up to ``MOST_IN_TASK``
rows are shuffled once and settled in a task; larger ones exactly in rounds of joins and
aggregates that never gather a group, whatever its size.  Rows are told apart by a number of their own, so repeated ids do no harm; equal boxes are taken in
the order of id, then corners.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions.geometry import box_iou
from geoloom.functions.raster import to_geo
from geoloom.operators.scans import running
from geoloom.operators.spatial import cells_of_box, iou_pairs
from geoloom.runtime import any_rows, by_size, cut

GROUP = ["raster_id", "class_id"]
BOX = ["x1", "y1", "x2", "y2"]
# Boxes of a group that one task holds, and pairs of them it looks at together.
MOST_IN_TASK = 4_000
PAIRS = 1 << 18


def to_raster_coordinates(tile_boxes: DataFrame) -> DataFrame:
    """Tile-local boxes moved by their tile origin; overlapping tiles are not merged here."""
    return tile_boxes.select(
        *[c for c in tile_boxes.columns if c not in BOX],
        (F.col("x1") + F.col("tile_c")).alias("x1"), (F.col("y1") + F.col("tile_r")).alias("y1"),
        (F.col("x2") + F.col("tile_c")).alias("x2"), (F.col("y2") + F.col("tile_r")).alias("y2"),
    )


def confident(boxes: DataFrame, threshold: float) -> DataFrame:
    return boxes.filter(F.col("conf") > threshold)


# -- soft suppression ---------------------------------------------------------------


def numbered(df: DataFrame) -> DataFrame:
    """Stored rows with a number each in ``row``; a table that has one keeps it."""
    return df if "row" in df.columns else cut(df.withColumn("row", F.monotonically_increasing_id()))


def _before(score: str, row: str = "row", ids: tuple[str, ...] = ("det_id", "x1", "y1", "x2", "y2")):
    """Greatest for the box to take first: score, then the smaller id, corners and number."""
    return F.struct(F.col(score), *[(-F.col(c)).alias(f"o_{c}") for c in ids], (-F.col(row)).alias("o_row"))


def _overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, intersection, union) of overlapping boxes; ``a`` and ``b`` are (n, 4).

    Boxes of ``b`` in the order of x1 are looked at from the widest box left of a box's x1
    up to its x2, some pairs at a time.
    """
    found = [(np.empty(0, "int64"),) * 2 + (np.empty(0),) * 2]
    if len(a) and len(b):
        order = np.argsort(b[:, 0], kind="stable")
        s = b[order]
        lo = np.searchsorted(s[:, 0], a[:, 0] - np.maximum(0, (s[:, 2] - s[:, 0]).max()), "left")
        n = np.maximum(np.searchsorted(s[:, 0], a[:, 2], "left") - lo, 0)
        ends = np.cumsum(n)
        stops = np.searchsorted(ends, np.arange(0, ends[-1] + 1, PAIRS), "right")
        for p, q in zip(stops, [*stops[1:], len(a)]):
            i = np.repeat(np.arange(p, q), n[p:q])
            j = np.arange(len(i)) - np.repeat(ends[p:q] - n[p:q] - (ends[p - 1] if p else 0), n[p:q]) + np.repeat(lo[p:q], n[p:q])
            u, v = a[i], s[j]
            w = np.minimum(u[:, 2], v[:, 2]) - np.maximum(u[:, 0], v[:, 0])
            h = np.minimum(u[:, 3], v[:, 3]) - np.maximum(u[:, 1], v[:, 1])
            hit = (w > 0) & (h > 0)
            u, v, inter = u[hit], v[hit], (w * h)[hit]
            area = lambda x: (x[:, 2] - x[:, 0]) * (x[:, 3] - x[:, 1])
            found.append((i[hit], order[j[hit]], inter, area(u) + area(v) - inter))
    return tuple(np.concatenate(c) for c in zip(*found))


def _matrix(rows: pa.Table, columns: list[str]) -> np.ndarray:
    return np.stack([rows[c].to_numpy() for c in columns], 1)


def _first_to_last(rows: pa.Table, key: str) -> pa.Table:
    """Falling confidence, then id and corners."""
    return rows.sort_by([("conf", "descending"), *[(c, "ascending") for c in (key, *BOX)]])


def soft_nms(boxes: DataFrame, sigma: float, threshold: float, cell: float = 128.0, most: int = MOST_IN_TASK) -> DataFrame:
    """Gaussian soft suppression per (raster_id, class_id), adding the decayed ``score``.

    The best box is taken, the others lose ``exp(-iou^2 / sigma)``, those at or below
    ``threshold`` go, and so on.  A group whose best box is already at or below the
    threshold keeps that one box.
    """
    keep = [*GROUP, "det_id", *BOX, "conf"]
    typed = boxes.select(
        F.col("raster_id").cast("bigint"), F.col("class_id").cast("int"), F.col("det_id").cast("bigint"),
        *[F.col(c).cast("double") for c in [*BOX, "conf"]],
    ).dropna(subset=[*GROUP, *BOX, "conf"])
    small, large = by_size(typed, GROUP, most)

    def suppressed(rows: pa.Table) -> pa.Table:
        rows = _first_to_last(rows, "det_id")
        conf = rows["conf"].to_numpy()
        n = int((conf > threshold).sum())
        if n == 0:
            return rows.slice(0, 1).append_column("score", rows["conf"].slice(0, 1))
        box = _matrix(rows, BOX)[:n]
        i, j, inter, union = _overlaps(box, box)
        other = i != j
        i, j, iou = i[other], j[other], inter[other] / (union[other] + 1e-6)
        order = np.argsort(i, kind="stable")
        j, loss = j[order], np.exp(-np.power(iou[order], 2) / sigma)
        first = np.searchsorted(i[order], np.arange(n + 1))
        score, taken = conf[:n].copy(), np.zeros(n, bool)
        # Boxes without neighbours keep their score; the others wait in a heap.
        alone = first[1:] == first[:-1]
        taken[alone] = True
        turn = np.argsort(pc.sort_indices(rows.slice(0, n), [(c, "ascending") for c in ("det_id", *BOX)]).to_numpy())
        heap = [(-score[k], turn[k], k) for k in np.flatnonzero(~alone).tolist()]
        heapify(heap)
        while heap:
            s, _, k = heappop(heap)
            if taken[k] or -s != score[k]:
                continue
            taken[k] = True
            near = j[first[k] : first[k + 1]]
            open_ = ~taken[near] & (score[near] > threshold)
            near = near[open_]
            score[near] *= loss[first[k] : first[k + 1]][open_]
            for m in near[score[near] > threshold].tolist():
                heappush(heap, (-score[m], turn[m], m))
        kept = np.flatnonzero(taken)
        return rows.take(kept).append_column("score", pa.array(score[kept]))

    schema = "raster_id bigint, class_id int, det_id bigint, x1 double, y1 double, x2 double, y2 double, conf double, score double"
    done = small.groupBy(*GROUP).applyInArrow(suppressed, schema)
    return done if large is None else done.unionByName(_nms_in_rounds(large.select(*keep), sigma, threshold, cell))


def _nms_in_rounds(boxes: DataFrame, sigma: float, threshold: float, cell: float) -> DataFrame:
    """``soft_nms`` without holding a group in a task.

    A round takes all local maxima at once: a box that leads every grid cell it touches
    beats all boxes it overlaps, and their scores can only fall, so it is the next one taken
    among them whatever happens elsewhere.  Each cell has at most one leader per round: a
    round moves rows x cells, never pairs, and finding leaders is a partial aggregate.  A
    taken box lowers its neighbours, so there are no more rounds than overlapping boxes that
    stay above the threshold in one place, plus the steps in which a chain of neighbours
    waits for its better ones.
    """
    keep = [*GROUP, "det_id", *BOX, "conf"]
    typed = numbered(boxes)
    # A box at or below the threshold never decays another one, so it matters only when
    # it is the best of its group.
    tops = typed.groupBy(*GROUP).agg(F.max_by(F.struct(*keep), _before("conf")).alias("top")).select("top.*")
    done = tops.filter(F.col("conf") <= threshold).withColumn("score", F.col("conf"))
    left = typed.filter(F.col("conf") > threshold).withColumn("score", F.col("conf"))
    at = [*GROUP, "cell_x", "cell_y"]
    while any_rows(left):
        spread = cells_of_box(left, cell)
        lead = spread.groupBy(*at).agg(F.max_by("row", _before("score")).alias("lead"))
        led = spread.join(lead, at)
        flags = cut(led.groupBy("row", *keep, "score").agg(F.min(F.col("lead") == F.col("row")).alias("taken")))
        taken = flags.filter("taken").drop("taken")
        rest = flags.filter("not taken").drop("taken")
        t = cells_of_box(taken, cell).select(*at, *[F.col(c).alias(f"t_{c}") for c in BOX])
        near = cells_of_box(rest, cell).join(t, at)
        near = near.withColumn("iou", box_iou("", "t_", eps_added=True)).filter("iou > 0")
        corner = (F.col("cell_x") == F.floor(F.greatest("x1", "t_x1") / cell)) & (
            F.col("cell_y") == F.floor(F.greatest("y1", "t_y1") / cell)
        )
        decay = near.filter(corner).groupBy("row").agg(F.sum(-F.pow("iou", F.lit(2)) / sigma).alias("log_decay"))
        lowered = rest.join(decay, "row", "left").withColumn(
            "score", F.col("score") * F.exp(F.coalesce("log_decay", F.lit(0.0)))
        )
        done = done.unionByName(taken.select(*keep, "score"))
        left = cut(lowered.drop("log_decay").filter(F.col("score") > threshold))
    return done


def detection_points(boxes: DataFrame, meta: DataFrame, names: tuple[str, ...], score: str) -> DataFrame:
    """Box centres in map coordinates with class name and rounded confidence."""
    name = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("class_id") + 1).cast("int"))
    joined = boxes.join(meta.select("raster_id", "affine"), "raster_id")
    mid = lambda a, b: (F.col(a) + F.col(b)) / 2
    return joined.select(
        "raster_id", "det_id",
        to_geo(mid("x1", "x2"), F.col("affine.c"), F.col("affine.a")).alias("x"),
        to_geo(mid("y1", "y2"), F.col("affine.f"), F.col("affine.e")).alias("y"),
        "class_id", name.alias("class_name"), F.round(score, 4).alias("confidence"),
    )


# -- matching -------------------------------------------------------------------------


def match(preds: DataFrame, truth: DataFrame, thresholds: list[float], cell: float = 128.0, most: int = MOST_IN_TASK) -> DataFrame:
    """(raster_id, class_id, t, row, det_id, gt_id, iou): greedy one-to-one matching; ``row`` is the prediction's number.

    Predictions go by falling confidence (ties by id and corners); each takes the free
    ground-truth box of greatest IoU (ties likewise) if that reaches ``t``.  Boxes below
    ``t`` can never be taken, so only pairs at or above it are looked at.

    Predictions and boxes of a group are brought together once and taken in order; groups
    with more than ``most`` of them go by deferred acceptance, with the same result.
    """
    ids = [F.col("raster_id").cast("bigint"), F.col("class_id").cast("int")]
    corners = [F.col(c).cast("double") for c in BOX]
    none = lambda kind: F.lit(None).cast(kind)
    p = numbered(preds).select(*ids, F.col("det_id").cast("bigint").alias("id"), *corners, F.col("conf").cast("double"), F.col("row").cast("bigint"))
    g = truth.select(*ids, F.col("gt_id").cast("bigint").alias("id"), *corners, none("double").alias("conf"), none("bigint").alias("row"))
    small, large = by_size(p.unionByName(g).dropna(subset=[*GROUP, *BOX]), GROUP, most)

    def matched(rows: pa.Table) -> pa.Table:
        free = pc.is_null(rows["row"])
        dets = rows.filter(pc.invert(free))
        dets = dets.sort_by([("conf", "descending"), *[(c, "ascending") for c in ("id", *BOX, "row")]])
        gts = rows.filter(free).sort_by([(c, "ascending") for c in ("id", *BOX)])
        i, j, inter, union = _overlaps(_matrix(dets, BOX), _matrix(gts, BOX))
        iou = inter / np.maximum(union, 1e-6)
        # Predictions in turn, each with its best box first.
        order = np.lexsort((j, -iou, i))
        i, j, iou = i[order], j[order], iou[order]
        ts, hits = [], []
        for t in thresholds:
            used_p, used_g = set(), set()
            for k in np.flatnonzero(iou >= t).tolist():
                if i[k] not in used_p and j[k] not in used_g:
                    used_p.add(i[k])
                    used_g.add(j[k])
                    ts.append(float(t))
                    hits.append(k)
        hits = np.array(hits, "int64")
        won, got = dets.take(i[hits]), gts.take(j[hits])
        return pa.table({
            "raster_id": won["raster_id"], "class_id": won["class_id"], "t": pa.array(ts, "float64"), "row": won["row"],
            "det_id": won["id"], "gt_id": got["id"], "iou": pa.array(iou[hits]),
        })

    done = small.groupBy(*GROUP).applyInArrow(
        matched, "raster_id bigint, class_id int, t double, row bigint, det_id bigint, gt_id bigint, iou double"
    )
    if large is None:
        return done
    many = large.withColumnRenamed("id", "det_id").filter("row is not null"), large.withColumnRenamed("id", "gt_id").filter("row is null")
    return done.unionByName(_match_in_rounds(many[0], many[1].drop("row"), thresholds, cell))


def _match_in_rounds(preds: DataFrame, truth: DataFrame, thresholds: list[float], cell: float) -> DataFrame:
    """``match`` without holding a group in a task, by deferred acceptance.

    Every free prediction asks for its best box that has not refused it, every box keeps its
    first asker.  All boxes rank predictions the same way, so the one stable matching is the
    greedy one.  Each round is two partial aggregates and two joins over the open pairs; each
    refusal closes a pair.
    """
    pairs = iou_pairs(
        numbered(preds).select(*GROUP, "det_id", *BOX, "conf", "row"), numbered(truth.select(*GROUP, "gt_id", *BOX)),
        GROUP, cell, min(thresholds),
    ).select(
        F.col("raster_id").cast("bigint"), F.col("class_id").cast("int"),
        F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("t"),
        F.col("a_det_id").cast("bigint").alias("det_id"), F.col("b_gt_id").cast("bigint").alias("gt_id"),
        F.col("a_row").alias("p"), F.col("b_row").alias("g"), "iou",
        _before("a_conf", "a_row", ("a_det_id", "a_x1", "a_y1", "a_x2", "a_y2")).alias("turn"),
        _before("iou", "b_row", ("b_gt_id", "b_x1", "b_y1", "b_x2", "b_y2")).alias("wish"),
    ).filter("iou >= t")
    open_pairs = cut(pairs)
    while True:
        ask = open_pairs.groupBy("t", "p").agg(F.max_by(F.struct(*[c for c in open_pairs.columns if c not in ("t", "p")]), "wish").alias("b"))
        ask = ask.select("t", "p", "b.*")
        hold = ask.groupBy("t", "g").agg(F.max_by("p", "turn").alias("held"))
        asked = cut(ask.join(hold, ["t", "g"]).withColumn("refused", F.col("p") != F.col("held")))
        refused = asked.filter("refused").select("t", "p", "g")
        if not any_rows(refused):
            return asked.select(*GROUP, "t", F.col("p").alias("row"), "det_id", "gt_id", "iou")
        open_pairs = cut(open_pairs.join(refused, ["t", "p", "g"], "left_anti"))


# -- average precision -------------------------------------------------------------------


def _by_confidence() -> list:
    return [F.col("conf").desc(), *[F.col(c) for c in ("det_id", "raster_id", *BOX, "row")]]


def average_precision(
    preds: DataFrame, truth: DataFrame, matches: DataFrame, num_classes: int, thresholds: list[float]
) -> DataFrame:
    """(class_id, t, ap): area under the precision envelope for every class and threshold.

    ``preds`` are numbered rows, as matched.  Classes without ground truth have 0.  Precision falls between hits, so the envelope
    only needs the rows of true positives: ranks come from a scan over all predictions,
    the rest works on the matched ones.
    """
    spark = preds.sparkSession
    ts = F.array(*[F.lit(float(t)) for t in thresholds])
    n_gt = truth.groupBy("class_id").agg(F.count("*").alias("n_gt"))
    ranks = running(
        preds.select("class_id", "raster_id", "det_id", *BOX, "conf", "row"), ["class_id"], _by_confidence(),
        {"rank": ("sum", F.lit(1).cast("bigint"))},
    )
    # One row per matched prediction and a column per threshold, so that all thresholds share a scan.
    at = range(len(thresholds))
    marks = matches.groupBy("row").agg(*[F.count_if(F.col("t") == float(t)).alias(f"hit{k}") for k, t in enumerate(thresholds)])
    hits = ranks.select("class_id", "rank", "row").join(marks, "row").drop("row")
    hits = running(hits, ["class_id"], [F.col("rank")], {f"tp{k}": ("sum", F.col(f"hit{k}")) for k in at})
    precision = [F.when(F.col(f"hit{k}") > 0, F.col(f"tp{k}") / F.col("rank")).alias(f"p{k}") for k in at]
    back = [F.col("rank").desc()]
    hits = running(hits.select("class_id", "rank", *precision), ["class_id"], back, {f"envelope{k}": ("max", F.col(f"p{k}")) for k in at})
    sums = hits.groupBy("class_id").agg(*[F.sum(F.when(F.col(f"p{k}").isNotNull(), F.col(f"envelope{k}"))).alias(f"s{k}") for k in at])
    each = F.array(*[F.struct(F.lit(float(t)).alias("t"), F.col(f"s{k}").alias("s")) for k, t in enumerate(thresholds)])
    area = sums.select("class_id", F.explode(each).alias("a")).select("class_id", "a.*")
    grid = spark.range(num_classes).select(F.col("id").cast("int").alias("class_id"), F.explode(ts).alias("t"))
    return (
        grid.join(n_gt, "class_id", "left")
        .join(area, ["class_id", "t"], "left")
        .select("class_id", "t", F.coalesce(F.col("s") / F.col("n_gt"), F.lit(0.0)).alias("ap"))
    )


def mean_average_precision(ap: DataFrame) -> DataFrame:
    """Mean over all classes and thresholds, including classes with 0."""
    return ap.agg(F.avg("ap").alias("map"))


def class_average_precision(ap: DataFrame) -> DataFrame:
    return ap.groupBy("class_id").agg(F.avg("ap").alias("ap"))


# The COCO range of IoU thresholds.
COCO_THRESHOLDS = [0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]


def curve(preds: DataFrame, matches: DataFrame) -> DataFrame:
    """(class_id, det_id, rank, tp, fp): cumulative hits and misses in confidence order."""
    flags = preds.join(matches.select("row", F.lit(1).alias("hit")), "row", "left")
    flags = flags.withColumn("hit", F.coalesce("hit", F.lit(0)).cast("bigint"))
    out = running(
        flags.select("class_id", "raster_id", "det_id", *BOX, "conf", "row", "hit"), ["class_id"], _by_confidence(),
        {"tp": ("sum", F.col("hit")), "fp": ("sum", 1 - F.col("hit"))},
    )
    return out.select("class_id", "raster_id", "det_id", (F.col("tp") + F.col("fp")).alias("rank"), "tp", "fp")
