"""Round-based operators against brute force."""

import hashlib
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from geoloom.operators import detect, graph, labels, mask, scans, split, vectorise
from geoloom.runtime import cut


def rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def boxes(spark, n=120, seed=3, hot=True):
    rng = np.random.default_rng(seed)
    x, y = rng.integers(0, 300, n), rng.integers(0, 300, n)
    if hot:  # a third of all boxes on one spot
        x[: n // 3], y[: n // 3] = 40 + rng.integers(0, 3, n // 3), 40
    side = rng.integers(20, 60, n)
    pdf = pd.DataFrame({
        "raster_id": rng.integers(0, 2, n), "class_id": rng.integers(0, 2, n), "det_id": np.arange(n),
        "x1": x * 1.0, "y1": y * 1.0, "x2": (x + side) * 1.0, "y2": (y + side) * 1.0,
        "conf": np.round(rng.random(n), 2),
    })
    return spark.createDataFrame(pdf)


def iou(a, b, plus=0.0):
    w = min(a.x2, b.x2) - max(a.x1, b.x1)
    h = min(a.y2, b.y2) - max(a.y1, b.y1)
    inter = max(w, 0) * max(h, 0)
    union = (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - inter
    return inter / (union + plus if plus else max(union, 1e-6))


def test_soft_nms(spark):
    df = boxes(spark)
    one = detect.soft_nms(df, 0.9, 0.1, 64.0)
    cols = ["raster_id", "class_id", "det_id", "score"]
    want = []
    for _, g in df.toPandas().groupby(["raster_id", "class_id"]):
        left = [[r.conf, r] for r in g.itertuples()]
        while left:
            left.sort(key=lambda e: (-e[0], e[1].det_id))
            score, best = left.pop(0)
            want.append((best.raster_id, best.class_id, best.det_id, round(score, 9)))
            left = [[s * np.exp(-iou(b, best, 1e-6) ** 2 / 0.9), b] for s, b in left]
            left = [e for e in left if e[0] > 0.1]
    assert rows(one.select(cols)) == sorted(want)


def test_soft_nms_keeps_a_lone_weak_box(spark):
    df = boxes(spark, 8, hot=False).withColumn("conf", F.lit(0.05))
    kept = detect.soft_nms(df, 0.9, 0.1)
    assert kept.count() == df.select("raster_id", "class_id").distinct().count()


def test_repeated_ids_are_separate_boxes(spark):
    df = boxes(spark, 60, seed=6).withColumn("det_id", F.col("det_id") % 7)
    n = {}
    for k in (1.0, 2.0):
        # The copies lie elsewhere, so both kinds keep the same number of boxes.
        n[k] = detect.soft_nms(df.withColumns({c: F.col(c) + 10_000 * (k - 1) for c in ("x1", "x2")}), 0.9, 0.1, 64.0).count()
    both = df.unionByName(df.withColumns({c: F.col(c) + 10_000 for c in ("x1", "x2")}))
    assert detect.soft_nms(both, 0.9, 0.1, 64.0).count() == n[1.0] + n[2.0] == 2 * n[1.0]
    truth = df.withColumnRenamed("det_id", "gt_id").drop("conf")
    assert detect.match(df, truth, [0.99], 64.0).count() == df.select("raster_id", "class_id", "x1", "y1", "x2", "y2").count()
    objects = df.selectExpr("raster_id", "det_id as obj_id", "cast(y1 as int) as pr", "cast(x1 as int) as pc")
    meta = spark.createDataFrame([(0, 400, 400), (1, 400, 400)], "raster_id long, height int, width int")
    assert labels.centred_tiles(objects, meta, 100).count() == 60


def test_matching(spark):
    preds = boxes(spark)
    truth = boxes(spark, 60, seed=4).withColumnRenamed("det_id", "gt_id").drop("conf")
    cols = ["raster_id", "class_id", "t", "det_id", "gt_id"]
    one = detect.match(preds, truth, [0.3, 0.6], 64.0)
    p, g, want = preds.toPandas(), truth.toPandas(), []
    for t in (0.3, 0.6):
        used = set()
        for a in sorted(p.itertuples(), key=lambda r: (-r.conf, r.det_id)):
            best, pick = 0.0, None
            for b in sorted(g.itertuples(), key=lambda r: r.gt_id):
                if b.gt_id in used or (a.raster_id, a.class_id) != (b.raster_id, b.class_id):
                    continue
                if iou(a, b) > best:
                    best, pick = iou(a, b), b.gt_id
            if best >= t:
                used.add(pick)
                want.append((a.raster_id, a.class_id, t, a.det_id, pick))
    assert rows(one.select(cols)) == sorted(want)


def test_ap_of_known_case(spark):
    preds = spark.createDataFrame(
        [(1, 0, 1, 0.0, 0.0, 10.0, 10.0, 0.9), (1, 0, 2, 50.0, 50.0, 60.0, 60.0, 0.8), (1, 0, 3, 20.0, 0.0, 30.0, 10.0, 0.7)],
        "raster_id long, class_id int, det_id long, x1 double, y1 double, x2 double, y2 double, conf double",
    )
    truth = spark.createDataFrame(
        [(1, 0, 7, 0.0, 0.0, 10.0, 10.0), (1, 0, 8, 20.0, 0.0, 30.0, 10.0)],
        "raster_id long, class_id int, gt_id long, x1 double, y1 double, x2 double, y2 double",
    )
    preds = detect.numbered(preds)
    m = detect.match(preds, truth, [0.5])
    ap = {r.class_id: r.ap for r in detect.average_precision(preds, truth, m, 2, [0.5]).collect()}
    assert abs(ap[0] - (0.5 + 0.5 * 2 / 3)) < 1e-9 and ap[1] == 0.0


def test_centred_tiles(spark):
    rng = np.random.default_rng(1)
    n = 200
    pdf = pd.DataFrame({"raster_id": rng.integers(0, 2, n), "obj_id": rng.permutation(n), "pr": rng.integers(0, 400, n), "pc": rng.integers(0, 400, n)})
    pdf.loc[: n // 3, ["pr", "pc"]] = 77  # one hot spot
    objects = spark.createDataFrame(pdf)
    meta = spark.createDataFrame([(0, 400, 400), (1, 90, 400)], "raster_id long, height int, width int")
    one = labels.centred_tiles(objects, meta, 100)
    want, tiles = [], {0: [], 1: []}
    for o in pdf.sort_values("obj_id").itertuples():
        h = 400 if o.raster_id == 0 else 90
        t = (max(0, min(o.pr - 50, h - 100)), max(0, min(o.pc - 50, 300)))
        hit = next((q for q in tiles[o.raster_id] if abs(q[0] - t[0]) < 50 and abs(q[1] - t[1]) < 50), None)
        if hit is None:
            tiles[o.raster_id].append(t)
            hit = t
        want.append((o.raster_id, o.obj_id, *hit))
    assert rows(one) == sorted(want)


def test_scans_match_windows(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": np.where(rng.random(500) < 0.6, 0, rng.integers(1, 5, 500)), "o": rng.permutation(500), "v": rng.integers(0, 9, 500)})
    got = scans.running(spark.createDataFrame(pdf), ["k"], [F.col("o")], {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}).toPandas()
    pdf = pdf.sort_values(["k", "o"])
    got = got.sort_values(["k", "o"])
    assert list(got.s) == list(pdf.groupby("k").v.cumsum()) and list(got.m) == list(pdf.groupby("k").v.cummax())


def flood(cells, steps):
    """Region code (first pixel) of every cell."""
    out = {}
    for cell in sorted(cells):
        if cell in out:
            continue
        todo = [cell]
        out[cell] = cell
        while todo:
            r, c = todo.pop()
            for dr, dc in steps:
                q = (r + dr, c + dc)
                if q in cells and q not in out:
                    out[q] = cell
                    todo.append(q)
    return out


FOUR = [(0, 1), (1, 0), (0, -1), (-1, 0)]
EIGHT = FOUR + [(1, 1), (1, -1), (-1, 1), (-1, -1)]


def mask_array(h=40, w=52, seed=2, share=0.55):
    rng = np.random.default_rng(seed)
    return np.where(rng.random((h, w)) < share, rng.integers(1, 4, (h, w)), 0)


def as_table(spark, a):
    r, c = np.indices(a.shape)
    return spark.createDataFrame(pd.DataFrame({"raster_id": 1, "r": r.ravel(), "c": c.ravel(), "class_id": a.ravel()})).selectExpr(
        "raster_id", "cast(r as int) r", "cast(c as int) c", "cast(class_id as int) class_id")


def meta_of(spark, a):
    return spark.createDataFrame([(1, *a.shape)], "raster_id long, height int, width int")


def test_regions_across_blocks(spark):
    a = (mask_array(share=0.6) > 0).astype(int)
    df = as_table(spark, a).filter("class_id > 0")
    for connectivity, steps in ((4, FOUR), (8, EIGHT)):
        want = {k: v[0] * mask.CODE + v[1] for k, v in flood({tuple(x) for x in np.argwhere(a)}, steps).items()}
        got = {(r.r, r.c): r.region for r in mask.regions(df, connectivity, 8).collect()}
        assert got == want


def test_star_components_of_a_path(spark):
    edges = spark.range(60).selectExpr("1 as g", "id + 1 as u", "id as v")
    got = graph.components(edges, ["g"])
    assert {r.root for r in got.collect()} == {0} and got.count() == 61


def brute_morph(a, size, op):
    h, w = a.shape
    cells = [(dy, dx) for dy, lo, hi in mask.ellipse_rows(size) for dx in range(lo, hi + 1)]
    out = np.zeros_like(a)
    for r in range(h):
        for c in range(w):
            seen = [a[r + dy, c + dx] for dy, dx in cells if 0 <= r + dy < h and 0 <= c + dx < w]
            out[r, c] = any(seen) if op == "dilate" else all(seen)
    return out


def test_kernels():
    assert [(hi - lo + 1) for _, lo, hi in mask.ellipse_rows(3)] == [1, 3, 1]
    assert [(hi - lo + 1) for _, lo, hi in mask.ellipse_rows(5)] == [1, 5, 5, 5, 1]


def test_clean_mask_brute_force(spark):
    a = mask_array(share=0.35)
    got = np.zeros_like(a)
    for r in mask.clean_mask(as_table(spark, a), meta_of(spark, a), 8, 3, block=16).collect():
        got[r.r, r.c] = r.class_id
    want = a.copy()
    for k, least in ((1, 8), (2, 4), (3, 16)):
        b = a == k
        for op, size in mask.cleanup_steps(3)[k]:
            b = brute_morph(b, size, op)
        lab = flood({tuple(x) for x in np.argwhere(b)}, EIGHT)
        n = pd.Series(list(lab.values())).value_counts()
        keep = np.zeros_like(b)
        for cell, root in lab.items():
            keep[cell] = n[root] >= least
        want[keep] = k
        want[(a == k) & ~keep] = 0
    assert (got == want).all()


def test_rings_enclose_their_regions(spark):
    a = (mask_array(9, 11, seed=9, share=0.7) > 0).astype(int)
    df = as_table(spark, a)
    one = vectorise.ring_vertices(df, 4)
    corners = one.toPandas().sort_values("seq").groupby(["region", "ring"])
    for _, g in corners:
        x, y = g["x"].to_numpy(), g["y"].to_numpy()
        dx, dy = np.roll(x, -1) - x, np.roll(y, -1) - y
        # Sides follow the grid and turn at every corner; positions count from 0.
        assert ((dx == 0) != (dy == 0)).all() and ((dx == 0) != (np.roll(dx, -1) == 0)).all()
        assert g["seq"].tolist() == list(range(len(g)))
    area = {r.region: r.area for r in vectorise.region_summary(one).collect()}
    lab = flood({tuple(x) for x in np.argwhere(a)}, FOUR)
    n = pd.Series([v[0] * mask.CODE + v[1] for v in lab.values()]).value_counts().to_dict()
    assert area == n


def brute_simplify(pts, tol):
    pts = pts + [pts[0]]

    def dist(p, a, b):
        p, a, b = map(np.array, (p, a, b))
        d = b - a
        t = np.clip(np.dot(p - a, d) / np.dot(d, d), 0, 1) if d.any() else 0
        return np.hypot(*(p - a - t * d))

    def split(i, j, level):
        if j - i < 2:
            return []
        d = [dist(pts[k], pts[i], pts[j]) for k in range(i + 1, j)]
        m = int(np.argmax(d))
        if d[m] <= tol and level > 1:
            return []
        k = i + 1 + m
        return split(i, k, level + 1) + [k] + split(k, j, level + 1)

    return [0] + split(0, len(pts) - 1, 1)


def test_valid_rings_drop_whole_regions(spark):
    ring = lambda region, ring, pts: [(1, 1, region, ring, i, x, y) for i, (x, y) in enumerate(pts)]
    square = lambda o, n: [(o, o), (o + n, o), (o + n, o + n), (o, o + n)]
    flat = [(0.0, 0.0), (5.0, 0.0)]
    data = ring(10, 40, square(0.0, 9.0)) + ring(10, 80, square(2.0, 3.0)[::-1]) + ring(10, 90, flat)
    data += ring(20, 41, flat) + ring(20, 81, square(2.0, 3.0)[::-1])
    v = spark.createDataFrame(data, "raster_id bigint, class_id int, region bigint, ring bigint, seq bigint, x double, y double")
    left = {(r.region, r.ring) for r in vectorise.valid_rings(v).collect()}
    assert left == {(10, 40), (10, 80)}


def test_simplify(spark):
    a = (mask_array(12, 12, seed=11, share=0.7) > 0).astype(int)
    v = vectorise.ring_vertices(as_table(spark, a), 8)
    one = rows(vectorise.simplify(v, 0.8).select("region", "ring", "seq"))
    want = []
    for (region, ring), g in v.toPandas().sort_values("seq").groupby(["region", "ring"]):
        want += [(region, ring, k) for k in brute_simplify(list(zip(g.x, g.y)), 0.8)]
    assert one == sorted(want)


def crossing_sides(rings):
    """Pairs of sides, given as lists of points, that meet elsewhere than in common ends; whole numbers."""
    sides = [(tuple(r[i]), tuple(r[(i + 1) % len(r)])) for r in rings for i in range(len(r))]
    side = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])

    def within(a, b, c):
        dot = (c[0] - a[0]) * (b[0] - a[0]) + (c[1] - a[1]) * (b[1] - a[1])
        return side(a, b, c) == 0 and 0 < dot < (b[0] - a[0]) ** 2 + (b[1] - a[1]) ** 2

    bad = 0
    for i, (a, b) in enumerate(sides):
        for c, d in sides[:i]:
            proper = side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0
            bad += proper or {a, b} == {c, d} or within(a, b, c) or within(a, b, d) or within(c, d, a) or within(c, d, b)
    return bad


def spiral(n):
    """One arm, a pixel wide, with a gap of a pixel to the next turn."""
    a = np.zeros((n + 2, n + 2), int)
    r, c, d = 1, 1, 0
    a[r, c] = 1
    free = lambda y, x: 1 <= y <= n and 1 <= x <= n and not a[y, x]
    for _ in range(n * n):
        for turn in (0, 1):
            dy, dx = ((0, 1), (1, 0), (0, -1), (-1, 0))[(d + turn) % 4]
            y, x = r + dy, c + dx
            around = a[y - 1 : y + 2, x - 1 : x + 2].sum() if free(y, x) else 9
            if around <= 2:
                r, c, d = y, x, (d + turn) % 4
                a[r, c] = 1
                break
        else:
            break
    return a


@pytest.mark.parametrize("longest", [20_000, 7])
def test_simplify_keeps_topology(spark, longest):
    neck = np.zeros((20, 20), int)
    neck[1:9, 1:9] = neck[11:19, 11:19] = 1
    for i in range(8, 12):
        neck[i, i] = neck[i, i + 1] = 1
    noisy = (mask_array(20, 20, seed=5, share=0.75) > 0).astype(int)
    shapes = [spiral(20), neck, noisy]
    table = as_table(spark, shapes[0]).filter("false")
    for i, a in enumerate(shapes):
        table = table.unionByName(as_table(spark, a).withColumn("raster_id", F.lit(i).cast("bigint")))
    v = vectorise.ring_vertices(table, 8)
    before = v.toPandas()
    plain_crosses = 0
    for tol in (1.2, 4.0) if longest > 7 else (4.0,):
        after = vectorise.simplify(v, tol, keep_topology=True, longest=longest).toPandas()
        plain = vectorise.simplify(v, tol, longest=longest).toPandas()
        assert len(plain) <= len(after) < len(before)
        for key, g in after.sort_values("seq").groupby(["raster_id", "region"]):
            rings = [list(zip(h.x, h.y)) for _, h in g.groupby("ring")]
            assert crossing_sides(rings) == 0 and min(map(len, rings)) >= 3
            flat = plain[(plain.raster_id == key[0]) & (plain.region == key[1])].sort_values("seq")
            plain_crosses += crossing_sides([list(zip(h.x, h.y)) for _, h in flat.groupby("ring")])
        for key, g in before.sort_values("seq").groupby(["raster_id", "region", "ring"]):
            kept = after[(after.raster_id == key[0]) & (after.ring == key[2])].sort_values("seq")
            pts, ends = list(zip(g.x, g.y)), kept.seq.tolist() + [len(g)]
            for i, j in zip(ends, ends[1:]):
                a, b = np.array(pts[i], float), np.array(pts[j % len(g)], float)
                for k in range(i + 1, j):
                    t = np.clip(np.dot(pts[k] - a, b - a) / max(np.dot(b - a, b - a), 1e-9), 0, 1)
                    assert np.hypot(*(pts[k] - a - t * (b - a))) <= tol + 1e-9
    # The shapes are hard enough for the plain form to fail.
    assert plain_crosses > 0


@pytest.mark.parametrize("block", [3, 5, 64])
def test_rings_do_not_depend_on_blocks(spark, block):
    a = mask_array(23, 17, seed=3, share=0.8)
    key = ["class_id", "region", "ring", "seq", "x", "y"]
    want = getattr(test_rings_do_not_depend_on_blocks, "want", None)
    got = rows(vectorise.ring_vertices(as_table(spark, a), block).select(*key))
    if want is not None:
        assert got == want
    test_rings_do_not_depend_on_blocks.want = got


def test_many_rounds_stay_flat(spark):
    """Rounds of self-joins: neither the plan nor its size estimates grow."""
    t = cut(spark.range(64).withColumn("p", (F.col("id") + 1) % 64))
    took = []
    for _ in range(40):
        start = time.perf_counter()
        there = t.select(F.col("id").alias("p"), F.col("p").alias("q"))
        t = cut(t.join(there, "p").select("id", F.col("q").alias("p")))
        took.append(time.perf_counter() - start)
    assert sum(took[-10:]) < 3 * sum(took[5:15]) + 1


@pytest.mark.parametrize("most", [0, 20_000])
def test_tiles_and_negatives_within_and_across_tasks(spark, most):
    """Rasters settled in a task or in rounds and joins get the same tiles."""
    rng = np.random.default_rng(11)
    n = 300
    pdf = pd.DataFrame({"raster_id": rng.integers(0, 3, n), "obj_id": rng.integers(0, 250, n), "pr": rng.integers(0, 500, n), "pc": rng.integers(0, 500, n)})
    objects = spark.createDataFrame(pdf)
    meta = spark.createDataFrame([(0, 500, 500), (1, 500, 30), (2, 90, 400)], "raster_id long, height int, width int")
    tiled = cut(labels.centred_tiles(objects, meta, 60, most))
    negatives = labels.negative_tiles(tiled, meta, 60, 0.4, 7, most=most)
    want_tiles, want_neg = [], []
    for raster, h, w in ((0, 500, 500), (1, 500, 30), (2, 90, 400)):
        tiles = []
        for o in pdf[pdf.raster_id == raster].assign(tr=lambda d: (d.pr - 30).clip(upper=h - 60).clip(lower=0), tc=lambda d: (d.pc - 30).clip(upper=w - 60).clip(lower=0)).sort_values(["obj_id", "tr", "tc"]).itertuples():
            hit = next((q for q in tiles if abs(q[0] - o.tr) < 30 and abs(q[1] - o.tc) < 30), None)
            if hit is None:
                hit = (o.tr, o.tc)
                tiles.append(hit)
            want_tiles.append((raster, o.obj_id, *hit))
        wanted, got = max(1, int(len(tiles) * 0.4)), 0
        for k in range(wanted * 10):
            r, c = (int(hashlib.md5(f"{raster}/{k}:{s}".encode()).hexdigest()[:8], 16) % (max(0, x - 60) + 1) for s, x in ((7, h), (8, w)))
            if got < wanted and all(abs(p - r) >= 60 or abs(q - c) >= 60 for p, q in tiles):
                got += 1
                want_neg.append((raster, k, r, c))
    assert rows(tiled) == sorted(want_tiles)
    assert rows(negatives) == sorted(want_neg) and want_neg


def test_a_split_computes_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    tiles = spark.range(100).selectExpr("cast(id as string) as name").mapInArrow(look, "name string")
    out = split.prefix_split(tiles, "name", 0.15)
    assert out.filter("split = 'val'").count() == 15
    assert seen.value == 100


def test_boxes_within_and_across_tasks(spark, monkeypatch):
    """Groups settled in a task or in rounds keep the same boxes and pairs."""
    df = boxes(spark, 150, seed=8)
    truth = boxes(spark, 90, seed=9).withColumnRenamed("det_id", "gt_id").drop("conf")
    preds = detect.numbered(df)
    kept, pairs = ([detect.soft_nms(df, 0.9, 0.1, 64.0, most).select("raster_id", "class_id", "det_id", "score") for most in (0, 4000)],
                   [detect.match(preds, truth, [0.2, 0.5], 64.0, most).drop("row") for most in (0, 4000)])
    assert rows(kept[0]) == rows(kept[1]) and rows(pairs[0]) == rows(pairs[1]) and pairs[0].count() > 5
    a, b = (x.toPandas()[["x1", "y1", "x2", "y2"]].to_numpy() for x in (df, truth))
    w = np.minimum(a[:, None, 2:], b[None, :, 2:]) - np.maximum(a[:, None, :2], b[None, :, :2])
    want = sorted(zip(*np.nonzero((w > 0).all(2))))
    for n in (1, 50, 1 << 18):
        monkeypatch.setattr(detect, "PAIRS", n)
        i, j, *_ = detect._overlaps(a, b)
        assert sorted(zip(i, j)) == want


def test_thresholds_share_the_scans(spark):
    """AP at ten thresholds equals AP at each alone and stores its rows as often."""
    from geoloom.operators import scans as S

    preds = detect.numbered(boxes(spark, 150, seed=8))
    truth = boxes(spark, 90, seed=9).withColumnRenamed("det_id", "gt_id").drop("conf")
    m = cut(detect.match(preds, truth, [0.2, 0.5], 64.0))
    sizes, plain = [], S.cut
    S.cut = lambda df: (sizes.append(out.count()), out)[1] if (out := plain(df)) is not None else out
    try:
        both = {(r.class_id, r.t): r.ap for r in detect.average_precision(preds, truth, m, 2, [0.2, 0.5]).collect()}
    finally:
        S.cut = plain
    assert max(sizes[1:]) == m.select("row").distinct().count() < m.count()
    for t in (0.2, 0.5):
        for r in detect.average_precision(preds, truth, m.filter(F.col("t") == t), 2, [t]).collect():
            assert abs(both[r.class_id, t] - r.ap) < 1e-12
