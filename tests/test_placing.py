"""Reference systems, filling, ensembles, the roof chain and sinks against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.functions import ensemble
from geoloom.model import RoofParams, SegmentationParams
from geoloom.operators import blend, vector
from geoloom.plans import workflows
from geoloom.sources import files

RINGS = "array<array<struct<x:double,y:double>>>"


def classical(lon, lat, zone):
    """UTM by the meridian arc, integrated numerically, and powers of the distance from the meridian."""
    e2 = 2 / 298.257223563 - 1 / 298.257223563**2
    phi, away = math.radians(lat), math.radians(lon - (zone * 6 - 183))
    grid = np.linspace(0, phi, 20001)
    f = 6378137 * (1 - e2) / (1 - e2 * np.sin(grid) ** 2) ** 1.5
    m = (f[0] + f[-1] + 4 * f[1:-1:2].sum() + 2 * f[2:-1:2].sum()) * (grid[1] - grid[0]) / 3
    nu, t, c, a = 6378137 / math.sqrt(1 - e2 * math.sin(phi) ** 2), math.tan(phi) ** 2, e2 / (1 - e2) * math.cos(phi) ** 2, away * math.cos(phi)
    x = nu * (a + (1 - t + c) * a**3 / 6 + (5 - 18 * t + t * t + 14 * c - 58 * t * c) * a**5 / 120 + (61 - 479 * t + 179 * t * t - t**3) * a**7 / 5040)
    y = m + nu * math.tan(phi) * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * a**4 / 24 + (61 - 58 * t + t * t + 270 * c - 330 * t * c) * a**6 / 720)
    return 500000 + 0.9996 * x, 0.9996 * y + (1e7 if lat < 0 else 0)


@pytest.mark.parametrize("target", ["EPSG:32645", "EPSG:32731", "EPSG:32601"])
def test_utm_against_the_classical_series(spark, target):
    zone, south = int(target[-2:]), target[7] == "7"
    lon0 = zone * 6 - 183
    points = [(lon0 + d, lat * (-1 if south else 1)) for d in (-2.5, -1.0, 0.0, 0.3, 2.5) for lat in (0.5, 12.25, 45.0, 71.5, 83.0)]
    df = spark.createDataFrame([(i, "EPSG:4326", [[p]]) for i, p in enumerate(points)], f"feature_id long, crs string, rings {RINGS}")
    good, bad = vector.reproject(df, target)
    assert bad.count() == 0
    for r in good.collect():
        x, y = classical(*points[r.feature_id], zone)
        assert abs(r.rings[0][0].x - x) < 1e-4 and abs(r.rings[0][0].y - y) < 1e-4 and r.crs == target
    for r in vector.reproject(good, "EPSG:4326")[0].collect():
        lon, lat = points[r.feature_id]
        assert abs((r.rings[0][0].x - lon + 180) % 360 - 180) < 1e-9 and abs(r.rings[0][0].y - lat) < 1e-9


def test_reach_of_zones_and_odd_rows(spark):
    rows = [
        (1, "EPSG:4326", [[(87.0, 10.0), (200.0, 10.0)]]), (2, "EPSG:4326", [[(87.0, 89.0)]]), (3, "EPSG:32646", [[(500000.0, 1e6)]]),
        (4, None, [[(5.0, 6.0)]]), (5, "EPSG:32661", [[(5.0, 6.0)]]), (6, "EPSG:4326", None), (7, "EPSG:3857", [[(9684795.0, 1e6)]]),
        (8, "EPSG:32646", [[(9e9, 1e6)]]), (9, "EPSG:4326", [[(None, 1.0)]]),
    ]
    df = spark.createDataFrame(rows, f"feature_id long, crs string, rings {RINGS}")
    good, bad = vector.reproject(df, "EPSG:32645")
    assert {r.feature_id for r in good.collect()} == {3, 4, 6, 7}
    assert {r.feature_id: r.reason for r in bad.collect()} == {
        1: "outside the reference system", 2: "outside the reference system", 5: "unknown reference system",
        8: "outside the reference system", 9: "outside the reference system",
    }
    # A neighbouring zone reaches the same place by way of longitude and latitude.
    p = good.filter("feature_id = 3").first().rings[0][0]
    assert math.dist((p.x, p.y), classical(93.0, vector.reproject(df.filter("feature_id = 3"), "EPSG:4326")[0].first().rings[0][0].y, 45)) < 0.02
    assert vector.reproject(df, "EPSG:27700")[0].count() == 1 and vector.reproject(df.limit(0), "EPSG:32645")[0].count() == 0


def star(n, size, seed):
    rng = np.random.default_rng(seed)
    angle = np.sort(rng.random(n)) * 2 * np.pi
    radius = size * (0.3 + 0.7 * rng.random(n))
    ring = [(float(size + r * np.cos(a)) + 0.013, float(size + r * np.sin(a)) + 0.017) for a, r in zip(angle, radius)]
    return ring + ring[:1]


@pytest.mark.parametrize("n,size", [(9, 20), (300, 90), (40, 420)])
def test_filling_is_even_odd(spark, n, size):
    ring, hole = star(n, size, n), [(size - 3.4, size - 3.3), (size + 4.1, size - 2.2), (size + 1.3, size + 5.7), (size - 3.4, size - 3.3)]
    side = 2 * size - 5
    row = (1, 7, 1, 2, side, side, "Polygon", [ring, hole])
    open_row = (2, 7, 1, 2, side, side, "Polygon", [ring[:-1], hole])
    df = spark.createDataFrame([row, row, open_row], f"raster_id long, feature_id long, layer_ord int, class_id int, height int, width int, geom_type string, rings {RINGS}")
    got = {}
    for r in vector.burn(df).collect():
        got.setdefault(r.raster_id, set()).add((r.r, r.c))
    inside = np.zeros((side, side), bool)
    yy, xx = np.mgrid[:side, :side] + 0.5
    for line in (ring, hole):
        for (x1, y1), (x2, y2) in zip(line, line[1:]):
            if y1 != y2:
                inside ^= ((y1 <= yy) != (y2 <= yy)) & (x1 + (yy - y1) / (y2 - y1) * (x2 - x1) < xx)
    want = {(int(r), int(c)) for r, c in zip(*np.nonzero(inside))}
    assert got[1] == want and got[2] == want


def make_lopsided():
    """A predictor whose answer depends on where a pixel lies in its tile."""

    def predict(x):
        side = x.shape[1]
        place = np.arange(side)[None, :, None, None] * 0.05 + np.arange(side)[None, None, :, None] * 0.02
        e = np.exp((x[..., :1].astype("float64") / 255 + place) * np.array([1.0, -1.0, 0.5, 0.0]))
        return (e / e.sum(-1, keepdims=True)).reshape(len(x), -1)

    return predict


def plain_linear(img, h, w):
    out = np.zeros((h, w, img.shape[2]))
    for i in range(h):
        for j in range(w):
            y, x = (min(max((k + 0.5) * n / m - 0.5, 0), n - 1) for k, n, m in ((i, img.shape[0], h), (j, img.shape[1], w)))
            a, b, fy, fx = int(y), int(x), y - int(y), x - int(x)
            c, d = min(a + 1, img.shape[0] - 1), min(b + 1, img.shape[1] - 1)
            out[i, j] = (img[a, b] * (1 - fy) + img[c, b] * fy) * (1 - fx) + (img[a, d] * (1 - fy) + img[c, d] * fy) * fx
    return out


@pytest.mark.parametrize("weights", [blend.FAST_TTA, blend.FULL_TTA])
def test_ensemble_in_the_batch(weights):
    img = np.random.default_rng(4).integers(0, 256, (8, 8, 3)).astype("float32")
    ask = lambda a: make_lopsided()(a[None].astype("float32")).reshape(*a.shape[:2], 4)
    parts = []
    if "flip" in weights:
        parts += [(ask(img), 2), (np.fliplr(ask(np.fliplr(img))), 2)]
    else:
        for k in range(4):
            parts += [(np.rot90(ask(np.rot90(img, k)), -k), 1), (np.fliplr(np.rot90(ask(np.rot90(np.fliplr(img), k)), -k)), 1)]
    parts.append((plain_linear(ask(plain_linear(img, 10, 10)), 8, 8), weights["zoom"]))
    want = sum(p * w for p, w in parts) / sum(w for _, w in parts)
    got = ensemble.over_tiles(make_lopsided, weights, 4)()(np.stack([img, img[::-1]]))
    assert np.allclose(got[0].reshape(8, 8, 4), want, atol=1e-6)


def test_segment_with_an_ensemble(spark):
    meta = spark.createDataFrame([(1, 8, 8)], "raster_id long, height int, width int")
    rgb = spark.range(64).selectExpr("1L as raster_id", "cast(id div 8 as int) as r", "cast(id % 8 as int) as c", "cast(id * 37 % 256 as int) as b1", "0 as b2", "0 as b3")
    seg = SegmentationParams(patch_size=8, overlap=0)
    got = np.zeros((8, 8, 4))
    for r in workflows.segment(meta, rgb, make_lopsided, seg, tta=blend.FULL_TTA).collect():
        got[r.r, r.c] = r.probs
    img = np.zeros((1, 8, 8, 3), "float32")
    img[0, :, :, 0] = (np.arange(64) * 37 % 256).reshape(8, 8)
    assert np.allclose(got, ensemble.over_tiles(make_lopsided, blend.FULL_TTA, 4)()(img).reshape(8, 8, 4), atol=1e-5)


def make_corner():
    def predict(x):
        e = np.exp(x[:, 0, 0, :1].astype("float64") / 60 * np.array([0.0, 1.0, -1.0, 0.2]))
        return e / e.sum(1, keepdims=True)

    return predict


@pytest.mark.parametrize("steps", [1, 3, 16])
def test_roofs_of_buildings(spark, steps):
    side = 40
    img = np.random.default_rng(1).integers(0, 256, (side, side, 3))
    rgb = spark.createDataFrame(
        [(1, r, c, *map(int, img[r, c])) for r in range(side) for c in range(side) if min(r, c) < 32 or max(r, c) > 36], "raster_id long, r int, c int, b1 int, b2 int, b3 int"
    )
    meta = spark.createDataFrame([(1, side, side)], "raster_id long, height int, width int").withColumn(
        "affine", F.expr("named_struct('a', 1D, 'b', 0D, 'c', 0D, 'd', 0D, 'e', -1D, 'f', 0D)"))
    # region: rows, columns; 3 is small, 4 off the raster, 5 holds a gap
    boxes = {1: (2, 16, 3, 13), 2: (10, 30, 20, 33), 3: (5, 8, 5, 30), 4: (60, 80, 60, 80), 5: (28, 39, 28, 39)}
    df = spark.createDataFrame([(1, k, [[(float(c1), -float(r1)), (float(c2), -float(r2))]]) for k, (r1, r2, c1, c2) in boxes.items()], f"raster_id long, region long, rings {RINGS}")
    roof = RoofParams(crop_size=10, min_crop_px=5)
    got = {r.region: r.label for r in workflows.classify_roofs(df, rgb, meta, make_corner, roof, steps, block=16).collect()}
    want = {3: "Other", 4: "Other"}
    for k in (1, 2):
        r1, r2, c1, c2 = boxes[k]
        py, px = int((r2 - r1) * 0.15), int((c2 - c1) * 0.15)
        crop = plain_linear(img[max(0, r1 - py) : min(side, r2 + py), max(0, c1 - px) : min(side, c2 + px)], 10, 10)
        views = [crop] if steps == 1 else [np.fliplr(np.rot90(crop, i % 4)) if i >= 4 else np.rot90(crop, i) for i in range(min(steps, 8))]
        if steps > 8:
            zoomed = plain_linear(crop[1:9, 1:9], 10, 10)
            views += [np.fliplr(np.rot90(zoomed, i % 4)) if i >= 4 else np.rot90(zoomed, i) for i in range(steps - 8)]
        p = np.mean([make_corner()(v[None])[0] for v in views], axis=0)
        want[k] = ("RCC", "Tiled", "Tin", "Other")[int(p.argmax())] if p.max() >= 0.55 else "Other"
    assert got == want


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "raster_id long, v string")
    path = str(tmp_path / "parts")
    files.write_partitioned(rows, path, ["raster_id"])
    files.write_partitioned(spark.createDataFrame([(2, "d")], "raster_id long, v string"), path, ["raster_id"])
    assert sorted((r.raster_id, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (1, "b"), (2, "d")]
    files.write_combined(rows, str(tmp_path / "all"))
    files.write_combined(rows.filter("v = 'c'"), str(tmp_path / "all"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "all")).collect()] == [(2, "c")]
    from geoloom.operators.labels import manifest

    split = spark.createDataFrame([("x", "train"), ("y", "val"), ("z", "train")], "name string, split string")
    files.write_manifest(manifest(split, "/data", ("Well", "Pole")), str(tmp_path / "manifest"))
    m = spark.read.json(str(tmp_path / "manifest")).first()
    assert (m.nc, m.n_train, m.n_val, list(m.names)) == (2, 2, 1, ["Well", "Pole"])
