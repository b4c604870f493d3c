"""Validity and repair of polygons."""

import pytest
from pyspark.sql import functions as F

from geoloom.functions.mend import mended, ring_area
from geoloom.operators import vector

SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
box = lambda x, y, n: [(x, y), (x + n, y), (x + n, y + n), (x, y + n), (x, y)]
# (rings, valid, area after repair)
CASES = {
    "square": ([SQUARE], True, 16),
    "hole": ([SQUARE, box(1.0, 1.0, 1.0)], True, 15),
    "hole touching in a point": ([SQUARE, [(0.0, 2.0), (1.0, 1.0), (1.0, 3.0), (0.0, 2.0)]], True, 15),
    "repeated point": ([[SQUARE[0], *SQUARE]], True, 16),
    "uneven bow-tie": ([[(0.0, 0.0), (6.0, 6.0), (6.0, -2.0), (0.0, 4.0), (0.0, 0.0)]], False, 16),
    "figure eight in a point": ([[(0.0, 0.0), (2.0, 2.0), (4.0, 0.0), (4.0, 4.0), (2.0, 2.0), (0.0, 4.0), (0.0, 0.0)]], False, 8),
    "spike": ([[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (4.0, 6.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]], False, 16),
    "hole outside": ([SQUARE, box(6.0, 6.0, 1.0)], False, 16),
    "hole across the shell": ([SQUARE, box(3.0, 1.0, 2.0)], False, 14),
    "hole along the shell": ([SQUARE, box(0.0, 1.0, 2.0)], False, 12),
    "wound twice": ([[*SQUARE, *box(0.0, 0.0, 2.0)[1:]]], False, 16),
    "flat": ([[(0.0, 0.0), (4.0, 0.0), (0.0, 0.0), (0.0, 0.0)]], False, 0),
    "open": ([SQUARE[:-1]], False, 16),
}


@pytest.mark.parametrize("few", [64, 0])
def test_polygons_are_judged_and_mended(spark, few):
    names = list(CASES)
    data = [(i, "Polygon", [[{"x": x, "y": y} for x, y in r] for r in CASES[n][0]]) for i, n in enumerate(names)]
    data += [(99, "Polygon", None), (98, "Polygon", []), (97, "Point", [[{"x": 1.0, "y": 1.0}]])]
    f = spark.createDataFrame(data, "feature_id bigint, geom_type string, rings array<array<struct<x:double,y:double>>>")
    reasons = {r["feature_id"]: r["reason"] for r in vector.feature_reason(f, few).collect()}
    assert {n: reasons[i] for i, n in enumerate(names)} == {n: None if CASES[n][1] else "invalid geometry" for n in names}
    assert (reasons[99], reasons[98], reasons[97]) == ("missing geometry", "empty geometry", None)
    good, bad = vector.split_features(vector.mend(f, few))
    got = {r["feature_id"]: r for r in good.collect()}
    assert {r["feature_id"] for r in bad.collect()} == {names.index("flat"), 98, 99}
    for i, n in enumerate(names):
        if i in got:
            rings = [[(p["x"], p["y"]) for p in ring] for ring in got[i]["rings"]]
            area = abs(ring_area(rings[0])) - sum(abs(ring_area(r)) for r in rings[1:])
            if got[i]["geom_type"] == "MultiPolygon":
                area = sum(map(ring_area, rings))
            assert area == pytest.approx(CASES[n][2]), n


def test_mended_rings_wind_once():
    star = [(0.0, 3.0), (2.0, -3.0), (-3.0, 1.0), (3.0, 1.0), (-2.0, -3.0), (0.0, 3.0)]
    rings = mended([star[::-1]], False)
    # The pentagram's outline has ten corners, its middle is inside.
    assert len(rings) == 1 and len(rings[0]) == 11
    assert mended([[(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]], False) == [] and mended([], False) == []


def test_pairs_of_edges_in_batches(monkeypatch):
    """The batch form against the column form, whatever the number of pairs at a time."""
    import numpy as np
    import pyarrow as pa
    from geoloom.functions import geometry

    rng = np.random.default_rng(4)
    star = lambda n: [(float(np.cos(2 * k * 2 * np.pi / n)), float(np.sin(2 * k * 2 * np.pi / n))) for k in (*range(n), 0)]
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    hole = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 1.0)]
    crossing = [(1.0, 1.0), (9.0, 1.0), (2.0, 2.0), (1.0, 1.0)]
    cases = [([square], False), ([square, hole], False), ([square, crossing], True), ([star(5)], True), (None, False), ([], False),
             ([[(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0), (0.0, 0.0)]], True), ([square, square], True)]
    cases = [cases[i] for i in rng.integers(0, len(cases), 60)]
    kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
    rings = pa.array([None if r is None else [[{"x": x, "y": y} for x, y in ring] for ring in r] for r, _ in cases], kind)
    for pairs in (1, 7, 1 << 18):
        monkeypatch.setattr(geometry, "PAIRS", pairs)
        assert geometry.clashing(rings).to_pylist() == [bad for _, bad in cases]
        assert geometry.clashing(rings[3:50]).to_pylist() == [bad for _, bad in cases[3:50]]


def test_small_polygons_are_judged_without_a_shuffle(spark):
    """They have no key to join on: with one, all of them met in a single task."""
    square = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]]
    df = spark.createDataFrame([(i, "Polygon", square) for i in range(200)], "feature_id long, geom_type string, rings array<array<struct<x double, y double>>>")
    out = vector.feature_reason(df.repartition(5))
    assert out.filter("reason is null").select(F.spark_partition_id()).distinct().count() == 5


_KIND = "array<array<struct<x:double,y:double>>>"


def _arrow(polygons):
    import pyarrow as pa

    kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
    return pa.array([None if r is None else [[{"x": x, "y": y} for x, y in ring] for ring in r] for r in polygons], kind)


def _random_polygons(seed, n):
    """Rings on a coarse lattice, so that corners, edges and whole rings fall together, and others anywhere."""
    import numpy as np

    rng, out = np.random.default_rng(seed), []
    for _ in range(n):
        rings = []
        for _ in range(rng.integers(0, 4)):
            k = rng.integers(1, 12)
            ring = list(map(tuple, (rng.integers(0, 5, (k, 2)) * 1.0 if rng.random() < 0.6 else rng.random((k, 2)) * 5).tolist()))
            rings.append([*ring, ring[0]] if rng.random() < 0.8 else ring)
        out.append(rings)
    return [*out, *[rings for rings, _, _ in CASES.values()]]


@pytest.mark.parametrize("pairs", [1, 50, 1 << 18])
def test_a_batch_is_mended_as_each_polygon(monkeypatch, pairs):
    """repairs are made for a whole batch at once, with the very rings of the plain form."""
    import numpy as np
    from geoloom.functions import mend

    monkeypatch.setattr(mend, "PAIRS", pairs)
    polygons, oriented, want = _random_polygons(7, 300), [], []
    for i, rings in enumerate(polygons):
        oriented.append(i % 2 == 1)
        want.append(mended(rings, oriented[-1]))
    got, shells = mend.mended_batch(_arrow(polygons), np.array(oriented))
    assert [[[(p["x"], p["y"]) for p in ring] for ring in rings] for rings in got.to_pylist()] == want
    assert shells.tolist() == [sum(ring_area(r) > 0 for r in rings) for rings in want] and max(shells) > 1
    part, _ = mend.mended_batch(_arrow(polygons)[5:40], np.array(oriented[5:40]))
    assert part.to_pylist() == got[5:40].to_pylist()
    odd = [None, [], [[(0.0, 0.0), (None, 1.0), (1.0, 1.0), (0.0, 0.0)]], [[(0.0, 0.0), (float("nan"), 1.0), (1.0, 1.0), (0.0, 0.0)]]]
    assert mend.mended_batch(_arrow(odd), np.zeros(4, bool))[0].to_pylist() == [[]] * 4


def test_polygons_are_mended_without_the_plain_form(spark, monkeypatch):
    """no polygon is repaired by itself, also where rings touch; judging stores its features once."""
    from geoloom.functions import mend

    bow, eight = CASES["uneven bow-tie"][0], CASES["figure eight in a point"][0]
    point = "named_struct('x', double(p[0]), 'y', double(p[1]))"
    rows = [(i, "Polygon", [eight, bow, [SQUARE]][i % 3]) for i in range(300)]
    f = spark.createDataFrame(rows, "feature_id long, geom_type string, rings array<array<array<double>>>")
    f = f.selectExpr("feature_id", "geom_type", f"transform(rings, ring -> transform(ring, p -> {point})) as rings")
    monkeypatch.setattr(mend, "mended", None)
    monkeypatch.setattr(vector, "mended", None, raising=False)
    stored, keep = [], vector.cut
    monkeypatch.setattr(vector, "cut", lambda df: stored.append(1) or keep(df))
    out = vector.mend(f)
    assert len(stored) == 1
    area = F.aggregate("rings", F.lit(0.0), lambda s, ring: s + vector.G.ring_area(ring))
    found = out.groupBy((F.col("feature_id") % 3).alias("k"), "geom_type").agg(F.count("*"), F.round(F.sum(F.abs(area)), 6))
    assert sorted(map(tuple, found.collect())) == [(0, "MultiPolygon", 100, 800.0), (1, "Polygon", 100, 1600.0), (2, "Polygon", 100, 1600.0)]


def test_soundness_in_batches_is_that_of_columns(spark):
    from geoloom.functions import geometry

    nan = float("nan")
    odd = [None, [], [[]], [SQUARE, []], [[(0.0, 0.0), (nan, 1.0), (1.0, 1.0), (0.0, 0.0)]], [[(nan, 0.0), (1.0, 1.0), (2.0, 1.0), (nan, 0.0)]],
           [[(None, 0.0), (1.0, 1.0), (2.0, 1.0), (None, 0.0)]], [[(0.0, 0.0), (1.0, None), (2.0, 1.0), (0.0, 0.0)]], [[(0.0, 0.0), (1e300, 1e300), (2.0, 1e300), (0.0, 0.0)]]]
    polygons = odd + _random_polygons(3, 200)
    dicts = [None if r is None else [[{"x": x, "y": y} for x, y in ring] for ring in r] for r in polygons]
    dicts += [[None], [[None] * 4]]
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(dicts)], f"i int, rings {_KIND}")
    got = rows.select("i", geometry.is_valid_polygon(F.col("rings")).alias("v"), geometry.has_flaw(F.col("rings"), 0).alias("flaw")).collect()
    assert [r["i"] for r in got if r["v"] == r["flaw"]] == [0]
