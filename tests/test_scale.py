"""Plans that hold for large tables: what is shuffled, and what may not pass through the driver."""

from pyspark.sql import functions as F

from geoloom.operators import mask as M
from geoloom.operators import vector as V2
from geoloom.operators import vectorise as V

PIXELS = "raster_id bigint, class_id int, r int, c int"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _raster(spark, height=40, width=40):
    mask = spark.range(height * width).select(
        F.lit(1).cast("bigint").alias("raster_id"), (F.col("id") % 3 + 1).cast("int").alias("class_id"),
        F.expr(f"cast(id div {width} as int)").alias("r"), F.expr(f"cast(id % {width} as int)").alias("c"),
    )
    meta = spark.createDataFrame([(1, height, width)], "raster_id bigint, height int, width int")
    return mask, meta


def test_pixels_are_not_broadcast(spark):
    """small files and explodes made pixels look small enough for the driver."""
    mask, meta = _raster(spark)
    meta = meta.join(mask.select("raster_id").distinct(), "raster_id", "left_semi")
    for out in (M.morphology(mask, meta, M.cleanup_steps(3), 16), M.drop_small(M.regions(mask, 8, 16), {1: 2})):
        joins = [x for x in _plan(out).splitlines() if "HashJoin" in x]
        assert not [x for x in joins if "class_id" in x or "height" in x or "br" in x], joins
    near = M.morphology(mask, meta, {1: [("dilate", 7)], 2: [("erode", 3)], 3: []}, 16)
    assert near.filter("r not between 0 and 39 or c not between 0 and 39").count() == 0


def test_outlines_are_not_broadcast(spark):
    """vertices, chords and the ranks of their rings."""
    mask, _ = _raster(spark, 12, 12)
    rings = V.ring_vertices(mask, 8)
    assert "BroadcastExchange" not in _plan(rings)
    kept = V.simplify(rings, 0.5, keep_topology=True, ends=True)
    assert "BroadcastExchange" not in _plan(V.valid_rings(kept))
    # A mean per raster may travel, one row each; chords and cells may not.
    sent = [x for x in _plan(V.crossing_chords(V.chords(kept))).splitlines() if "BroadcastExchange" in x]
    assert all("List(input[0, bigint, true])" in x for x in sent), sent


def test_simplified_ends_are_the_next_vertices(spark):
    mask, _ = _raster(spark, 12, 12)
    rings = V.ring_vertices(mask.filter("(r + c) % 5 > 0"), 8)
    kept = V.simplify(rings, 1.5, keep_topology=True, ends=True)
    key = ["raster_id", "class_id", "region", "ring"]
    by = lambda df: sorted(tuple(r) for r in df.collect())
    plain = V.simplify(rings, 1.5, keep_topology=True)
    assert by(kept.drop("nx", "ny")) == by(plain)
    assert by(V.valid_rings(kept).drop("nx", "ny")) == by(V.valid_rings(plain))
    ends = lambda df: df.select(*key, "ax", "ay", "bx", "by")
    assert by(ends(V.chords(kept))) == by(ends(V.chords(plain)))


def _polygons(spark, rows, height=300, width=300):
    """(raster_id, feature_id, layer_ord, class_id, geom_type, rings) with the raster's size."""
    schema = (
        "raster_id bigint, feature_id bigint, layer_ord int, class_id int, geom_type string, "
        "rings array<array<struct<x: double, y: double>>>"
    )
    return spark.createDataFrame(rows, schema).withColumn("height", F.lit(height)).withColumn("width", F.lit(width))


def _square(x, y, side):
    return [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]


def test_burning_shuffles_features_and_not_pixels(spark):
    """the only exchange of ``burn`` deals rows of blocks."""
    f = _polygons(spark, [(1, 1, 1, 1, "Polygon", [_square(0.25, 0.25, 290.0)]), (1, 2, 2, 2, "Polygon", [_square(10.25, 10.25, 5.0)])])
    plan = [x for x in _plan(V2.burn(f)).splitlines() if "Exchange" in x or "Aggregate" in x]
    assert len([x for x in plan if "hashpartitioning(raster_id" in x and ", br" in x]) == 1, plan
    assert not [x for x in plan if ", r#" in x and "c#" in x and "_shape" not in x], plan


def test_painted_blocks(spark):
    """Later layers win across block borders; missing classes, empty rings and points keep their rows."""
    far = _square(250.25, 250.25, 10.0)
    rows = [
        (1, 1, 1, 7, "Polygon", [_square(240.25, 240.25, 30.0), _square(242.25, 242.25, 2.0)]), (1, 2, 2, 5, "Polygon", [far]),
        (1, 3, 1, 9, "Polygon", [far]), (1, 4, 3, 4, "Point", [[(255.5, 256.5)]]), (2, 5, 1, None, "Polygon", [_square(-3.75, -3.75, 5.0)]),
        (1, 6, 9, 9, "Polygon", None), (1, 7, 9, 9, "Polygon", []), (1, 8, 9, 9, "LineString", [[(299.5, 0.5), (299.5, 3.5)]]),
        (3, 9, 1, 1, "Polygon", [_square(0.25, 0.25, 400.0)]),
    ]
    got = {(p.raster_id, p.r, p.c): p.class_id for p in V2.burn(_polygons(spark, rows)).collect()}
    want = {(1, r, c): 7 for r in range(240, 270) for c in range(240, 270) if not (r in (242, 243) and c in (242, 243))}
    want |= {(1, r, c): 5 for r in range(250, 260) for c in range(250, 260)} | {(1, 256, 255): 4}
    want |= {(2, r, c): None for r in range(1) for c in range(1)} | {(1, r, 299): 9 for r in range(4)}
    want |= {(3, r, c): 1 for r in range(300) for c in range(300)}
    assert got == want
    listed = V2.burn_pixels(_polygons(spark, rows[:2] + rows[1:2])).groupBy("class_id").count().collect()
    assert {x.class_id: x["count"] for x in listed} == {7: 896, 5: 200}


def test_pieces_of_a_batch(monkeypatch):
    """Crossings and pixels are held in pieces; the result does not depend on their size."""
    import pyarrow as pa

    from geoloom.functions import filling

    kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
    point = lambda p: {"x": p[0], "y": p[1]}
    rings = [[[point(p) for p in _square(k * 7.3, k * 5.1, 20.0 + k)]] if k % 3 else None for k in range(12)]
    args = (pa.array(rings, kind), pa.array([300] * 12), pa.array([90] * 12))
    whole = [tuple(map(int, row)) for found in filling.polygon_spans(*args) for row in zip(*found)]
    monkeypatch.setattr(filling, "PIECE", 8)
    assert [tuple(map(int, row)) for found in filling.polygon_spans(*args) for row in zip(*found)] == whole
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 1, 2]), pa.array([0, 0, 0]), pa.array([0, 0, 0]), pa.array([3, 4, 5]), pa.array([[0, 0, 9, 1, 0, 9], [0, 5, 9], [2, 2, 3]])],
        names=["raster_id", "br", "bc", "class_id", "spans"],
    )
    out = pa.schema([("raster_id", pa.int64()), ("r", pa.int32()), ("c", pa.int32()), ("class_id", pa.int64())])
    for parts in ([batch], [batch.slice(0, 1), batch.slice(1, 2)]):
        painted = pa.Table.from_batches(filling.Painter(out, 16).run(iter(parts)), out).to_pylist()
        assert len(painted) == 22 and sum(p["class_id"] == 4 for p in painted) == 5 and painted[-1] == {"raster_id": 2, "r": 2, "c": 3, "class_id": 5}


def test_reprojection_is_computed_once(spark):
    """filters repeated the whole series, and the system's code in it."""
    rows = [(1, [[(500000.0, 1e6)]], "EPSG:32645"), (2, [[(1.0, 2.0)]], "EPSG:4326"), (3, [[(1.0, 2.0)]], "EPSG:27700"), (4, None, None), (5, [[(9e9, 9e9)]], "EPSG:32601")]
    f = spark.createDataFrame(rows, "feature_id int, rings array<array<struct<x: double, y: double>>>, crs string")
    good, bad = V2.reproject(f, "EPSG:4326")
    assert _plan(good).count("regexp_extract") == 1
    assert sorted(r.feature_id for r in good.collect()) == [1, 2, 4]
    assert {r.feature_id: r.reason for r in bad.collect()} == {3: "unknown reference system", 5: "outside the reference system"}


def test_resizing_is_compiled_and_windows_are_shuffled(spark):
    """weights are plain columns, and pixels are not broadcast."""
    from geoloom.operators import grid, resample

    pixels = spark.range(30).selectExpr("1L as raster_id", "cast(id div 6 as int) as r", "cast(id % 6 as int) as c", "cast(id as double) as b")
    boxes = spark.createDataFrame([(1, 7, 0, 5, 0, 6)], "raster_id bigint, region int, r1 int, r2 int, c1 int, c2 int")
    seen = grid.window_pixels(pixels, boxes, 4)
    assert "BroadcastHashJoin" not in _plan(seen)
    for method in ("linear", "area"):
        out = resample.resize(seen, ["region"], ["b"], F.lit(5), F.lit(6), F.lit(3), F.lit(3), method)
        assert "lambdafunction" not in _plan(out) and out.count() == 9


def test_features_are_judged_once(spark, monkeypatch):
    """sound features are not judged again after the others were mended."""
    bow = [(0.0, 0.0), (6.0, 6.0), (6.0, -2.0), (0.0, 4.0), (0.0, 0.0)]
    flat = [(0.0, 1.0), (2.0, 1.0), (4.0, 1.0), (0.0, 1.0)]
    rows = [
        (1, 1, 1, 1, "Polygon", [_square(0.0, 0.0, 3.0)]), (1, 2, 1, 1, "Polygon", [bow]), (1, 3, 1, 1, "Polygon", [flat]),
        (1, 4, 1, 1, "Polygon", None), (1, 5, 1, 1, "LineString", [[(0.0, 0.0), (1.0, 1.0)]]), (1, 6, 1, 1, "Polygon", []),
    ]
    f = _polygons(spark, rows)
    by = lambda df: sorted(map(str, df.collect()))
    want = [by(x) for x in V2.split_features(V2.mend(f))]
    seen, judge = [], V2.feature_reason
    monkeypatch.setattr(V2, "feature_reason", lambda df, *few: seen.append(df.count()) or judge(df, *few))
    usable, bad = V2.mend_and_split(f)
    assert seen == [6, 2] and [by(usable), by(bad)] == want
    # What was judged is stored: reading it does not judge again.
    assert _plan(usable).count("ArrowEvalPython") <= 3


def test_texts_are_read_once_a_row(spark):
    """a name's stem and an attribute's clean value were worked out again for every key they are compared with."""
    from geoloom.functions.projection import utm_number
    from geoloom.operators import inventory as I

    names = ["Road.shp", "built_up_area_type_.shp", "Utility_Poly_.shp", "Built_Up_Ar.shp", "zzz.shp", None, ""]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    for of, most in ((I.layer_role, 2), (I.roof_label, 1), (I.infra_label, 1)):
        assert _plan(df.select(of(F.col("name")).alias("v"))).count("regexp_replace(") <= most
    roles = [r[0] and r[0]["class_id"] for r in df.select(I.layer_role(F.col("name"))).collect()]
    assert roles == [2, 1, 0, 1, None, None, None]
    labels = df.select(I.roof_label(F.col("name")), I.infra_label(F.lit(" Tube_Well "))).collect()
    assert {tuple(r) for r in labels} == {("Other", "well")}
    codes = spark.createDataFrame([(c,) for c in ("EPSG:32601", "EPSG:32760", "EPSG:32661", "EPSG:3857", "32601", "", None)], "crs string")
    codes = codes.select(utm_number(F.col("crs")).alias("v"))
    # A cast that fails costs an exception for every row of another system.
    assert "try_cast" not in _plan(codes).lower() and [r[0] for r in codes.collect()] == [32601, 32760, None, None, None, None, None]


def test_preprocess_stores_its_features_once(spark, monkeypatch):
    """checked features are stored with their roles; a copy of all of them was made three times."""
    from geoloom.model import DetectParams, RoofParams, SegmentationParams
    from geoloom.plans import workflows as W

    meta = spark.sql("""SELECT id AS raster_id, 'f' AS folder, 64 AS height, 64 AS width, 3 AS n_bands,
        named_struct('a', 1D, 'b', 0D, 'c', 64D * id, 'd', 0D, 'e', -1D, 'f', 0D) AS affine FROM range(2)""")
    ring = lambda x, y, n: [[(x, -y), (x + n, -y), (x, -y - n), (x, -y)]]
    bow = [[(80.0, -10.0), (86.0, -4.0), (86.0, -12.0), (80.0, -6.0), (80.0, -10.0)]]
    rows = [("Road.shp", 1, ring(4.25, 4.25, 9.0)), ("Built_Up_Area_type.shp", 2, ring(70.25, 8.25, 12.0)), ("Road.shp", 3, bow),
            ("Utility.shp", 4, ring(20.25, 20.25, 6.0)), ("Other.shp", 5, ring(30.25, 30.25, 6.0)), ("Road.shp", 6, None)]
    features = spark.createDataFrame(
        [("f", layer, i, "Polygon", rings, {"Utility_Ty": "Well"}, "EPSG:3857") for layer, i, rings in rows],
        "folder string, layer string, feature_id long, geom_type string, rings array<array<struct<x:double,y:double>>>, attrs map<string,string>, crs string",
    )
    judged, others = [], []
    for module, seen in ((V2, judged), (W, others)):
        monkeypatch.setattr(module, "cut", lambda df, keep=module.cut, seen=seen: seen.append(df.columns) or keep(df))
    seg = SegmentationParams(patch_size=32, overlap=8, strip_rows=64, min_building_area=12)
    out = W.preprocess(meta, features, "EPSG:3857", seg=seg, roof=RoofParams(min_crop_px=5), det=DetectParams(tile_size=48))
    total = W.preprocess_totals(meta, out).filter("folder is null").collect()[0]
    assert (total["rasters"], total["failed"], total["crops"], total["infra"]) == (2, 0, 1, 1) and total["patches"] > 0
    assert [tuple(r) for r in out["quarantine"].select("feature_id", "reason").collect()] == [(6, "missing geometry")]
    # All features, then the mended ones; beside them only what lies on rasters is stored with its rings.
    assert [c for c in judged if "attrs" in c and "reason" in c and "seg_class" in c] and not [c for c in others if "attrs" in c]
