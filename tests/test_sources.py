"""Files, layers, sinks and incremental work on real folders."""

import json

from pyspark.sql import functions as F

from geoloom.functions import raster as R
from geoloom.functions import text as X
from geoloom.operators import augment, inventory, labels, split, vector
from geoloom.sources import files
from geoloom.streaming import folder


def test_inventory_of_a_folder(spark, tmp_path):
    for name in ("a.tif", "a.ecw", "b_3857.ecw", "b.tiff", "c.ecw", "a.tif.pyrx", "x.pyrx.bak", "d.aux", "Road.shp", "Road.dbf",
                 "Road.shp.xml", "Road.shp.PC.1.lock", "notes.txt"):
        (tmp_path / name).write_bytes(b"x")
    inv = inventory.drop_duplicate_sources(inventory.classify_files(files.list_files(spark, str(tmp_path))))
    got = {r["name"]: (r["kind"], r["skip_reason"]) for r in inv.collect()}
    assert got["a.ecw"] == ("skipped", "ECW_DUP") and got["b_3857.ecw"] == ("skipped", "ECW_DUP")
    assert got["c.ecw"] == ("raster", None) and got["a.tif.pyrx"][1] == "LOCK" and got["x.pyrx.bak"][1] == "PYRX"
    assert got["d.aux"][1] == "AUX" and got["Road.shp"] == ("layer", None) and got["Road.shp.xml"][1] == "SIDECAR"
    assert got["Road.shp.PC.1.lock"][1] == "LOCK" and got["notes.txt"] == ("other", None)


def test_layers_survive_a_broken_file(spark, tmp_path):
    square = [[[0, 0], [0, 4], [4, 4], [4, 0], [0, 0]]]
    doc = {
        "type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::3857"}},
        "features": [
            {"type": "Feature", "properties": {"Roof_type": "tin"}, "geometry": {"type": "Polygon", "coordinates": square}},
            {"type": "Feature", "properties": {}, "geometry": {"type": "Point", "coordinates": [2.5, 3.5]}},
            {"type": "Feature", "properties": {}, "geometry": {"type": "LineString", "coordinates": [[0, 0], [3, 3]]}},
            {"type": "Feature", "properties": {}, "geometry": None},
        ],
    }
    (tmp_path / "Road.geojson").write_text(json.dumps(doc))
    (tmp_path / "empty.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": []}))
    (tmp_path / "bad.geojson").write_text("{not json")
    feats, bad = files.read_layers(spark, str(tmp_path))
    got = feats.orderBy("feature_id").collect()
    assert [r.geom_type for r in got] == ["Polygon", "Point", "LineString", None]
    assert got[0].crs == "EPSG:3857" and got[0].attrs["Roof_type"] == "tin" and len(got[0].rings[0]) == 5
    assert bad.count() == 1
    usable, broken = vector.split_features(feats)
    assert usable.count() == 3 and broken.first().reason == "missing geometry"
    px = usable.select(
        F.lit(1).alias("raster_id"), "feature_id", F.lit(1).alias("layer_ord"), F.lit(2).alias("class_id"),
        "geom_type", "rings", F.lit(10).alias("height"), F.lit(10).alias("width"),
    )
    cells = {k: set() for k in ("Polygon", "Point", "LineString")}
    for k in cells:
        cells[k] = {(r.r, r.c) for r in vector.burn_pixels(px.filter(F.col("geom_type") == k)).collect()}
    assert cells["Polygon"] == {(r, c) for r in range(4) for c in range(4)}
    assert cells["Point"] == {(3, 2)} and cells["LineString"] == {(i, i) for i in range(4)}


def test_pixel_store_and_window(spark, tmp_path):
    px = spark.range(64).selectExpr("1L as raster_id", "cast(id div 8 as int) r", "cast(id % 8 as int) c", "cast(id as int) b1")
    files.write_pixels(px, str(tmp_path / "px"), block=4)
    got = files.read_window(spark, str(tmp_path / "px"), 1, 2, 5, 1, 7, block=4)
    assert got.count() == 18 and set(got.columns) >= {"raster_id", "r", "c", "b1"}


def test_label_and_point_sinks(spark, tmp_path):
    lab = spark.createDataFrame([(1, 5, 0, 0, 2, 0.5, 0.25, 0.1, 0.1)], "raster_id long, obj_id long, tile_r int, tile_c int, class_id int, cx double, cy double, bw double, bh double")
    neg = spark.createDataFrame([(1, 0, 64, 0)], "raster_id long, try int, tile_r int, tile_c int")
    lab = lab.unionByName(lab.withColumn("obj_id", F.lit(4)).withColumn("class_id", F.lit(0)))
    files.write_label_lines(labels.label_lines(lab, neg), str(tmp_path / "lab"), files=2)
    read = lambda name: files.read_label_text(spark, str(tmp_path / "lab"), 1, name).first()["text"]
    assert read("infra_1_000000_000000") == "0 0.500000 0.250000 0.100000 0.100000\n2 0.500000 0.250000 0.100000 0.100000"
    assert read("infra_neg_1_000064_000000") == "" and len(list((tmp_path / "lab").glob("*.parquet"))) <= 2
    pts = spark.createDataFrame([(1.5, 2.5, 0, "well", 0.5)], "x double, y double, class_id int, class_name string, confidence double")
    files.write_points(pts, str(tmp_path / "pts"))
    doc = json.loads(spark.read.text(str(tmp_path / "pts")).first().value)
    assert doc["geometry"]["coordinates"] == [1.5, 2.5] and doc["properties"]["class_name"] == "well"


def test_incremental_takes_each_file_once(spark, tmp_path):
    src, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    work = lambda df: df.groupBy("source_file").agg(F.sum("v").alias("v"))
    for i in range(2):
        spark.range(3).selectExpr(f"id + {i} as v").coalesce(1).write.mode("append").parquet(src)
        folder.process_new_files(spark, src, "v long", work, out, state)
    got = spark.read.parquet(out)
    assert got.count() == 2 and got.agg(F.sum("v")).first()[0] == 3 + 6
    listed = files.list_files(spark, src).filter("name like '%.parquet'").select("path")
    assert folder.file_status(listed, got).filter("status = 'ok'").count() == 2


def test_incremental_query_on_a_table_of_many_files(spark, sf, tmp_path):
    from geoloom.plans.queries import QUERIES

    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    table.repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    many, one = (QUERIES["incremental_folder"](spark, at).collect() for at in (str(tmp_path), sf))
    assert sorted(many) == sorted(one) and many


def test_broken_files_are_reported(spark, tmp_path):
    src, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    for i in range(3):
        spark.range(2).selectExpr(f"id + {i} as v").coalesce(1).write.mode("append").parquet(src)
    broken = sorted((tmp_path / "in").glob("*.parquet"))[1]
    broken.write_bytes(broken.read_bytes()[: broken.stat().st_size // 2])
    (tmp_path / "in" / f".{broken.name}.crc").unlink()
    folder.process_new_files(spark, src, "v long", lambda df: df, out, state)
    assert spark.read.parquet(out).select("source_file").distinct().count() == 2
    failed = spark.read.parquet(out + "_failed").collect()
    assert len(failed) == 1 and failed[0]["path"].endswith(broken.name) and failed[0]["reason"]


def test_layers_without_or_with_odd_crs(spark, tmp_path):
    point = {"type": "Feature", "properties": {}, "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}}
    for name, crs in (("none", None), ("crs84", "urn:ogc:def:crs:OGC:1.3:CRS84"), ("old", "EPSG:3857"), ("odd", "local grid"), ("v", "urn:ogc:def:crs:EPSG:6.9:4326")):
        doc = {"type": "FeatureCollection", "features": [point]}
        if crs:
            doc["crs"] = {"type": "name", "properties": {"name": crs}}
        (tmp_path / f"{name}.geojson").write_text(json.dumps(doc))
    (tmp_path / "half.geojson").write_text(json.dumps({"type": "FeatureCollection", "crs": "EPSG:4326", "features": [point]}))
    feats, bad = files.read_layers(spark, str(tmp_path))
    got = {r.layer: r.crs for r in feats.collect()}
    assert got == {"none.geojson": "EPSG:4326", "crs84.geojson": "EPSG:4326", "old.geojson": "EPSG:3857", "odd.geojson": "local grid", "v.geojson": "EPSG:4326"}
    assert [(r.path.rsplit("/", 1)[1], r.reason) for r in bad.collect()] == [("half.geojson", "partly unreadable layer")]
    moved, unknown = vector.reproject(feats, "EPSG:3857")
    assert unknown.first().layer == "odd.geojson"
    x = {r.layer: r.rings[0][0].x for r in moved.collect()}
    assert abs(x["none.geojson"] - 111319.49) < 0.01 and x["old.geojson"] == 1.0


def test_features_meet_the_rasters_they_lie_on(spark):
    affine = "named_struct('a', 1D, 'b', 0D, 'c', 100D * id, 'd', 0D, 'e', -1D, 'f', 50D)"
    meta = spark.range(20).selectExpr("id as raster_id", "'f' as folder", "50 as height", "100 as width", f"{affine} as affine")
    ring = "array(array(named_struct('x', x, 'y', 10D), named_struct('x', x + 5, 'y', 10D), named_struct('x', x + 5, 'y', 20D), named_struct('x', x, 'y', 10D)))"
    feats = spark.range(200).selectExpr("id as feature_id", "id * 10D + 7 as x", "'f' as folder").selectExpr("*", f"{ring} as rings")
    got = {(r.feature_id, r.raster_id) for r in vector.place(feats, meta).collect()}
    want = {(i, k) for i in range(200) for k in range(20) if i * 10 + 7 <= 100 * k + 100 and 100 * k <= i * 10 + 12}
    assert got == want and vector.place(feats, meta).count() == len(want)


def test_text_rules(spark):
    df = spark.createDataFrame([("a.tif.pyrx",), ("Utility_Poly_.shp",), (".hidden",), ("no_ext",)], "n string")
    got = [tuple(r) for r in df.select(X.stem(F.col("n")), X.suffix(F.col("n")), X.layer_stem(F.col("n"))).collect()]
    assert got == [("a.tif", ".pyrx", "a.tif"), ("Utility_Poly_", ".shp", "utility_poly"), (".hidden", "", ".hidden"), ("no_ext", "", "no_ext")]
    raw = spark.createDataFrame([(None,), ("",), ("  ",), ("12",), ("TIN ",), ("brick",)], "raw string")
    assert [r[0] for r in raw.select(inventory.roof_label(F.col("raw"))).collect()] == ["Other", "Other", "RCC", "RCC", "Tin", "Other"]
    assert [r[0] for r in raw.select(inventory.infra_label(F.col("raw"))).collect()] == [None, None, None, "transformer", None, None]


def test_reflection_index_and_targets_agree(spark):
    df = spark.range(1, 7).crossJoin(spark.range(12).withColumnRenamed("id", "i")).selectExpr("cast(id as int) n", "cast(i as int) i")
    back = {}
    for r in df.select("n", "i", R.reflect_index(F.col("i"), F.col("n")).alias("j")).collect():
        back.setdefault((r.n, r.j), set()).add(r.i)
    fwd = df.filter("i < n").select("n", "i", R.reflect_targets(F.col("i"), F.col("n"), F.lit(12)).alias("t"))
    assert {(r.n, r.i): set(r.t) for r in fwd.collect()} == back


def test_splits_keep_every_row_once(spark):
    df = spark.range(101).selectExpr("id", "if(id = 0, 'lone', 'many') as label")
    hold = split.holdout_split(df, "id", 0.15, 42)
    assert hold.filter("split = 'val'").count() == 15 and hold.select("id").distinct().count() == 101
    strat = split.stratified_split(df, "id", "label", 0.15, 42)
    assert strat.filter("split = 'val' and label = 'lone'").count() == 0


def test_beta_draws_repeat(spark):
    draw = augment.beta_draw(0.4, 7)
    a, b = ([r[0] for r in spark.range(20).select(draw("id")).collect()] for _ in range(2))
    assert a == b and all(0 <= x <= 1 for x in a) and len(set(a)) == 20
