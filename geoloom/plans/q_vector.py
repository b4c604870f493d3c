"""Queries: vector validity, spatial joins, burning and extents."""

from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.operators import grid
from geoloom.operators import vector as V
from geoloom.plans import sqltables as S
from geoloom.plans import tables as T
from geoloom.plans.registry import query

N = T.POLY_CANVAS
_AFFINE = "named_struct('a', 0.5D, 'b', 0D, 'c', 100D * raster_id, 'd', 0D, 'e', -0.5D, 'f', 1000D)"


def _features(spark, sf):
    return T.triangles(spark, sf).withColumn("height", F.lit(N)).withColumn("width", F.lit(N))


def _geo(spark, sf):
    """The same triangles in map coordinates."""
    t = F.col("affine")
    move = lambda p: F.struct(
        (t["c"] + p["x"] * t["a"]).alias("x"), (t["f"] + p["y"] * t["e"]).alias("y")
    )
    f = _features(spark, sf).withColumn("affine", F.expr(_AFFINE))
    return f.withColumn("rings", F.transform("rings", lambda ring: F.transform(ring, move)))


def _meta(spark, sf):
    return T.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("raster_id"), F.lit(N).alias("height"), F.lit(N).alias("width")
    )


_BURN = S.TRIANGLES + f""", px AS (
  SELECT raster_id, layer_ord, class_id, CAST(floor(y0) + i AS INTEGER) AS r, CAST(floor(x0) + j AS INTEGER) AS c
  FROM tri, range(11) a(i), range(11) b(j)
  WHERE floor(y0) + i + 0.5 > y0 AND floor(x0) + j + 0.5 > x0 AND (floor(x0) + j + 0.5 - x0) + (floor(y0) + i + 0.5 - y0) < leg
    AND floor(y0) + i < {N} AND floor(x0) + j < {N}),
burned AS (SELECT raster_id, r, c, max_by(class_id, layer_ord) AS class_id FROM px GROUP BY ALL)"""


@query("burn_polygons", f"WITH {_BURN} SELECT raster_id, class_id, count(*) AS n, CAST(sum(r) AS BIGINT) AS sum_r, CAST(sum(c) AS BIGINT) AS sum_c FROM px GROUP BY ALL")
def burn_polygons(spark, sf):
    return V.burn_pixels(_features(spark, sf)).groupBy("raster_id", "class_id").agg(
        F.count("*").alias("n"), F.sum("r").alias("sum_r"), F.sum("c").alias("sum_c")
    )


@query("layer_precedence", f"""WITH {_BURN} SELECT raster_id, r, class_id, count(*) AS n, CAST(sum(c) AS BIGINT) AS sum_c,
  CAST(sum(c * c) AS BIGINT) AS sum_c2 FROM burned GROUP BY ALL""")
def layer_precedence(spark, sf):
    return V.burn(_features(spark, sf)).groupBy("raster_id", "r", "class_id").agg(
        F.count("*").alias("n"), F.sum("c").alias("sum_c"), F.sum(F.col("c") * F.col("c")).alias("sum_c2")
    )


@query("burn_coverage", f"""WITH {_BURN}, f AS (SELECT raster_id, count(*) AS features FROM tri GROUP BY ALL),
g AS (SELECT raster_id, count(*) AS fg FROM burned GROUP BY ALL)
SELECT s_suppkey AS raster_id, features, fg, CAST({N * N} AS BIGINT) AS pixels, round(100.0::DOUBLE * fg / {N * N}, 6) AS pct
FROM supplier JOIN f ON f.raster_id = s_suppkey JOIN g ON g.raster_id = s_suppkey""")
def burn_coverage(spark, sf):
    features = _features(spark, sf)
    out = V.coverage(V.burn(features), features, _meta(spark, sf))
    return out.filter("features > 0").withColumn("pct", F.round("pct", 6))


@query("spatial_join_blocks", f"""WITH {S.TRIANGLES}, b AS (SELECT CAST(i AS INTEGER) AS block_r, CAST(j AS INTEGER) AS block_c,
  i * 32.0::DOUBLE AS y1, i * 32.0::DOUBLE + 32 AS y2, j * 32.0::DOUBLE AS x1, j * 32.0::DOUBLE + 32 AS x2 FROM range(9) a(i), range(9) c(j))
SELECT raster_id, block_r, block_c, count(*) AS n FROM tri JOIN b ON x2 >= x0 AND y2 >= y0
  AND greatest(x1, x0) + greatest(y1, y0) <= x0 + y0 + leg GROUP BY ALL""")
def spatial_join_blocks(spark, sf):
    out = V.features_in_blocks(T.triangles(spark, sf), 32, 32)
    return out.groupBy("raster_id", "block_r", "block_c").agg(F.count("*").alias("n"))


@query("spatial_join_strips", f"""WITH {S.TRIANGLES}, s AS (SELECT CAST(i AS INTEGER) AS strip, i * 32 AS off, least(64, {N} - i * 32) AS h FROM range(8) t(i))
SELECT raster_id, strip, count(*) AS n FROM tri JOIN s ON y0 <= off + h AND y0 + leg >= off GROUP BY ALL""")
def spatial_join_strips(spark, sf):
    strips = grid.strips(_meta(spark, sf), 64, 32)
    out = V.features_in_strips(T.triangles(spark, sf), strips, 64)
    return out.groupBy("raster_id", "strip").agg(F.count("*").alias("n"))


_FEAT = S.TRIANGLES + """, feat AS (SELECT l_suppkey AS raster_id, l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS feature_id,
  CASE l_quantity WHEN 1 THEN 'missing geometry' WHEN 2 THEN 'empty geometry' WHEN 3 THEN 'invalid geometry'
       WHEN 4 THEN 'invalid geometry' WHEN 5 THEN 'invalid geometry' END AS reason FROM lineitem)"""


def _mixed(spark, sf):
    """Triangles of which some lost their geometry, their closing point or their area."""
    f = T.triangles(spark, sf, "l_quantity").withColumnRenamed("l_quantity", "q")
    ring = F.element_at("rings", 1)
    flat = F.transform(ring, lambda p: F.struct(p["x"].alias("x"), F.lit(1.0).alias("y")))
    rings = (
        F.when(F.col("q") == 1, F.lit(None)).when(F.col("q") == 2, F.slice("rings", 1, 0))
        .when(F.col("q") == 3, F.array(F.slice(ring, 1, 3))).when(F.col("q") == 4, F.array(flat))
        .when(F.col("q") == 5, F.array(F.concat(F.slice(ring, 1, 3), F.slice(ring, 2, 1)))).otherwise(F.col("rings"))
    )
    return f.withColumn("rings", rings).drop("q")


@query("valid_features", f"WITH {_FEAT} SELECT raster_id, reason, count(*) AS n FROM feat GROUP BY ALL")
def valid_features(spark, sf):
    good, bad = V.split_features(_mixed(spark, sf))
    both = good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad)
    return both.groupBy("raster_id", "reason").agg(F.count("*").alias("n"))


def _crooked(spark, sf):
    """Triangles, some turned into bow-ties with one larger wing, others with a spike."""
    f = T.triangles(spark, sf, "l_quantity")
    p = F.element_at(F.element_at("rings", 1), 1)
    leg = F.element_at(F.element_at("rings", 1), 2)["x"] - p["x"]
    # Columns of their own, so that they are not made again for every point.
    f = f.select("*", p["x"].alias("_x"), p["y"].alias("_y"), leg.alias("_leg"))
    at = lambda x, y: F.struct((F.col("_x") + x * F.col("_leg")).alias("x"), (F.col("_y") + y * F.col("_leg")).alias("y"))
    path = lambda *points: F.array(F.array(*[at(x, y) for x, y in points]))
    bow = path((0, 0), (6, 6), (6, -2), (0, 4), (0, 0))
    spike = path((0, 0), (1, 0), (3, 0), (1, 0), (0, 1), (0, 0))
    kind = (F.col("l_quantity") % 3).cast("int")
    return f.withColumn("rings", F.when(kind == 0, bow).when(kind == 1, spike).otherwise(F.col("rings"))).drop("l_quantity", "_x", "_y", "_leg")


@query("mended_features", f"""WITH {S.TRIANGLES}, q AS (SELECT l_suppkey AS raster_id, CAST(l_quantity % 3 AS INTEGER) AS k, 3 + l_quantity % 7 AS leg FROM lineitem)
SELECT raster_id, count(*) AS features, CAST(sum(CASE WHEN k = 2 THEN 0 ELSE 1 END) AS BIGINT) AS broken,
  round(sum(CASE k WHEN 0 THEN 16 ELSE 0.5 END * leg * leg), 3)::DOUBLE AS area FROM q GROUP BY ALL""")
def mended_features(spark, sf):
    """Bow-ties keep their larger wing and spikes go; all features are valid afterwards."""
    crooked = _crooked(spark, sf)
    broken = V.feature_reason(crooked).groupBy("raster_id").agg(F.count("reason").alias("broken"))
    good, _ = V.split_features(V.mend(crooked))
    area = F.aggregate("rings", F.lit(0.0), lambda s, ring: s + G.ring_area(ring))
    per = good.groupBy("raster_id").agg(F.count("*").alias("features"), F.round(F.sum(F.abs(area)), 3).alias("area"))
    return per.join(broken, "raster_id")


@query("centroids", f"WITH {S.TRIANGLES} SELECT raster_id, feature_id, round(x0 + leg / 3, 6) AS x, round(y0 + leg / 3, 6) AS y FROM tri")
def centroids(spark, sf):
    p = G.centroid(F.col("rings"), F.col("geom_type"))
    return T.triangles(spark, sf).withColumn("p", p).select(
        "raster_id", "feature_id", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y")
    )


@query("object_pixels", f"""WITH {S.TRIANGLES} SELECT raster_id, feature_id, CAST(floor(y0 + leg / 3) AS INTEGER) AS pr,
  CAST(floor(x0 + leg / 3) AS INTEGER) AS pc FROM tri WHERE floor(y0 + leg / 3) < 120 AND floor(x0 + leg / 3) < 120""")
def object_pixels(spark, sf):
    """Objects inside the upper left quarter; its extent plays the raster bounds."""
    quarter = _geo(spark, sf).withColumn("height", F.lit(120)).withColumn("width", F.lit(120))
    return V.object_pixels(quarter).select("raster_id", "feature_id", "pr", "pc")


@query("crop_boxes", f"""WITH {S.TRIANGLES}, b AS (SELECT raster_id, feature_id, least(200, floor(y0)) AS r1, least(200, floor(y0 + leg)) AS r2,
  least(200, floor(x0)) AS c1, least(200, floor(x0 + leg)) AS c2 FROM tri)
SELECT raster_id, feature_id, CAST(r1 AS INTEGER) AS r1, CAST(r2 AS INTEGER) AS r2, CAST(c1 AS INTEGER) AS c1, CAST(c2 AS INTEGER) AS c2
FROM b WHERE r2 - r1 >= 5 AND c2 - c1 >= 5""")
def crop_boxes(spark, sf):
    cut = _geo(spark, sf).withColumn("height", F.lit(200)).withColumn("width", F.lit(200))
    return V.training_crops(cut, 5).select("raster_id", "feature_id", "r1", "r2", "c1", "c2")


@query("inference_crops", f"""WITH {S.TRIANGLES}, b AS (SELECT raster_id, feature_id, trunc(y0) AS y1, trunc(y0 + leg) AS y2, trunc(x0) AS x1, trunc(x0 + leg) AS x2 FROM tri),
p AS (SELECT *, trunc((y2 - y1) * 0.15) AS py, trunc((x2 - x1) * 0.15) AS px FROM b),
q AS (SELECT *, greatest(0, y1 - py) AS r1, least(200, y2 + py) AS r2, greatest(0, x1 - px) AS c1, least(200, x2 + px) AS c2 FROM p)
SELECT raster_id, feature_id, CAST(r1 AS INTEGER) AS r1, CAST(r2 AS INTEGER) AS r2, CAST(c1 AS INTEGER) AS c1, CAST(c2 AS INTEGER) AS c2,
  CASE WHEN y2 - y1 < 5 OR x2 - x1 < 5 OR r2 <= r1 OR c2 <= c1 THEN 'Other' END AS fixed_label FROM q""")
def inference_crops(spark, sf):
    cut = _geo(spark, sf).withColumn("height", F.lit(200)).withColumn("width", F.lit(200))
    return V.inference_crops(cut, 5, 0.15).select("raster_id", "feature_id", "r1", "r2", "c1", "c2", "fixed_label")


@query("geo_pixel", f"""WITH {S.DET}, g AS (SELECT raster_id, det_id, 100 * raster_id + x1 * 0.3::DOUBLE - 90 AS gx, 1000 - y1 * 0.3::DOUBLE + 90 AS gy FROM det)
SELECT raster_id, det_id, CAST(floor((gy - 1000) / -0.5::DOUBLE) AS INTEGER) AS r_floor, CAST(floor((gx - 100 * raster_id) / 0.5::DOUBLE) AS INTEGER) AS c_floor,
  CAST(trunc((gy - 1000) / -0.5::DOUBLE) AS INTEGER) AS r_trunc, CAST(trunc((gx - 100 * raster_id) / 0.5::DOUBLE) AS INTEGER) AS c_trunc FROM g""")
def geo_pixel(spark, sf):
    from geoloom.functions import raster as R

    g = T.detections(spark, sf).selectExpr(
        "raster_id", "det_id", "100 * raster_id + x1 * 0.3D - 90 as gx", "1000 - y1 * 0.3D + 90 as gy"
    )
    fy, fx = (F.lit(1000.0), F.lit(-0.5)), (F.col("raster_id") * 100.0, F.lit(0.5))
    return g.select(
        "raster_id", "det_id", R.floor_index(F.col("gy"), *fy).alias("r_floor"), R.floor_index(F.col("gx"), *fx).alias("c_floor"),
        R.trunc_index(F.col("gy"), *fy).alias("r_trunc"), R.trunc_index(F.col("gx"), *fx).alias("c_trunc"),
    )


_CUST = """cust AS (SELECT c_custkey AS feature_id, CAST(c_custkey * 17 % 360 - 180 AS DOUBLE) AS lon, CAST(c_custkey * 7 % 160 - 80 AS DOUBLE) AS lat,
  CASE WHEN c_nationkey < 15 THEN 'EPSG:4326' WHEN c_nationkey < 20 THEN 'EPSG:3857' ELSE 'EPSG:27700' END AS crs FROM customer)"""


def _points(spark, sf):
    return T.table(spark, sf, "customer").selectExpr(
        "c_custkey as feature_id",
        "array(array(named_struct('x', cast(c_custkey * 17 % 360 - 180 as double), 'y', cast(c_custkey * 7 % 160 - 80 as double)))) as rings",
        "case when c_nationkey < 15 then 'EPSG:4326' when c_nationkey < 20 then 'EPSG:3857' else 'EPSG:27700' end as crs",
    )


@query("reproject_3857", f"""WITH {_CUST} SELECT feature_id, CASE crs WHEN 'EPSG:27700' THEN 'unknown reference system' END AS reason,
  CASE crs WHEN 'EPSG:4326' THEN round(6378137 * radians(lon), 4) WHEN 'EPSG:3857' THEN lon END AS x,
  CASE crs WHEN 'EPSG:4326' THEN round(6378137 * ln(tan(pi() / 4 + radians(lat) / 2)), 4) WHEN 'EPSG:3857' THEN lat END AS y FROM cust""")
def reproject_3857(spark, sf):
    good, bad = V.reproject(_points(spark, sf), "EPSG:3857")
    p = F.element_at(F.element_at("rings", 1), 1)
    ok = good.select("feature_id", F.lit(None).cast("string").alias("reason"), F.round(p["x"], 4).alias("x"), F.round(p["y"], 4).alias("y"))
    null = F.lit(None).cast("double")
    return ok.unionByName(bad.select("feature_id", "reason", null.alias("x"), null.alias("y")))


@query("reproject_4326", f"""WITH {_CUST} SELECT feature_id, CASE crs WHEN 'EPSG:3857' THEN round(degrees(lon / 6378137), 9) ELSE lon END AS x,
  CASE crs WHEN 'EPSG:3857' THEN round(degrees(2 * atan(exp(lat / 6378137)) - pi() / 2), 9) ELSE lat END AS y FROM cust WHERE crs <> 'EPSG:27700'""")
def reproject_4326(spark, sf):
    good, _ = V.reproject(_points(spark, sf), "EPSG:4326")
    p = F.element_at(F.element_at("rings", 1), 1)
    return good.select("feature_id", F.round(p["x"], 9).alias("x"), F.round(p["y"], 9).alias("y"))


# The classical route: meridian arc and powers of the distance from the meridian in cosines of latitude.
_UTM = """p AS (SELECT c_custkey AS feature_id, CAST(c_custkey % 7 - 3 AS DOUBLE) / 1.5 AS away, CAST(c_custkey * 7 % 160 - 80 AS DOUBLE) AS lat,
  c_custkey * 11 % 60 + 1 AS zone FROM customer),
a AS (SELECT *, radians(away) * cos(radians(lat)) AS a, radians(lat) AS phi, 0.0066943799901413165::DOUBLE AS e2, 6378137.0::DOUBLE AS r FROM p),
b AS (SELECT *, r / sqrt(1 - e2 * sin(phi) * sin(phi)) AS nu, tan(phi) * tan(phi) AS t, e2 / (1 - e2) * cos(phi) * cos(phi) AS c,
  r * ((1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256 - 175 * e2 ** 4 / 16384) * phi
    - (3 * e2 / 8 + 3 * e2 ** 2 / 32 + 45 * e2 ** 3 / 1024 + 105 * e2 ** 4 / 4096) * sin(2 * phi)
    + (15 * e2 ** 2 / 256 + 45 * e2 ** 3 / 1024 + 525 * e2 ** 4 / 16384) * sin(4 * phi)
    - (35 * e2 ** 3 / 3072 + 175 * e2 ** 4 / 12288) * sin(6 * phi) + 315 * e2 ** 4 / 131072 * sin(8 * phi)) AS m FROM a),
u AS (SELECT feature_id, zone, lat, zone * 6 - 183 + away AS lon,
  500000 + 0.9996 * nu * (a + (1 - t + c) * a ** 3 / 6 + (5 - 18 * t + t * t + 14 * c - 58 * t * c) * a ** 5 / 120
    + (61 - 479 * t + 179 * t * t - t ** 3) * a ** 7 / 5040) AS x,
  CASE WHEN lat < 0 THEN 10000000 ELSE 0 END + 0.9996 * (m + nu * tan(phi) * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * a ** 4 / 24
    + (61 - 58 * t + t * t + 270 * c - 330 * t * c) * a ** 6 / 720)) AS y FROM b)"""


def _zoned(spark, sf):
    """Customers up to two degrees from the meridians of all sixty zones, in EPSG:4326."""
    return T.table(spark, sf, "customer").selectExpr(
        "c_custkey as feature_id", "cast(c_custkey * 7 % 160 - 80 as double) as lat", "c_custkey * 11 % 60 + 1 as zone",
        "(c_custkey % 7 - 3) / 1.5D as away",
    ).selectExpr("*", "array(array(named_struct('x', zone * 6 - 183 + away, 'y', lat))) as rings", "'EPSG:4326' as crs")


@query("reproject_to_utm", f"""WITH {_UTM}, v AS (SELECT *, least(abs(lon - 87), 360 - abs(lon - 87)) <= 30 AS near FROM u)
SELECT feature_id, CASE WHEN NOT near THEN 'outside the reference system' END AS reason, CASE WHEN zone = 45 THEN round(x, 1) END AS x,
  CASE WHEN zone = 45 THEN round(y - CASE WHEN lat < 0 THEN 10000000 ELSE 0 END, 1) END AS y FROM v""")
def reproject_to_utm(spark, sf):
    """One zone for all: the classical series of the SQL holds in that zone, so coordinates are compared there."""
    good, bad = V.reproject(_zoned(spark, sf), "EPSG:32645")
    p = F.element_at(F.element_at("rings", 1), 1)
    own = F.col("zone") == 45
    ok = good.select(
        "feature_id", F.lit(None).cast("string").alias("reason"),
        F.when(own, F.round(p["x"], 1)).alias("x"), F.when(own, F.round(p["y"], 1)).alias("y"),
    )
    null = F.lit(None).cast("double")
    return ok.unionByName(bad.select("feature_id", "reason", null.alias("x"), null.alias("y")))


@query("reproject_from_utm", f"WITH {_UTM} SELECT feature_id, round(lon, 8) AS x, round(lat, 8) AS y FROM u")
def reproject_from_utm(spark, sf):
    """Grid coordinates of 120 systems in one table, back to EPSG:4326."""
    from geoloom.functions.projection import lonlat_to_utm

    code = F.when(F.col("lat") < 0, 32700).otherwise(32600) + F.col("zone")
    moved = F.transform("rings", lambda ring: F.transform(ring, lambda p: lonlat_to_utm(p["x"], p["y"], code)))
    grid = _zoned(spark, sf).withColumn("rings", moved).withColumn("crs", F.format_string("EPSG:%d", code))
    good, _ = V.reproject(grid, "EPSG:4326")
    p = F.element_at(F.element_at("rings", 1), 1)
    return good.select("feature_id", F.round(p["x"], 8).alias("x"), F.round(p["y"], 8).alias("y"))
