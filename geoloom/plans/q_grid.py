"""Queries: strips, tiles, padding, windows, band policy and resizing."""

from pyspark.sql import functions as F

from geoloom.functions import raster as R
from geoloom.operators import grid as G
from geoloom.operators import resample as RS
from geoloom.plans import sqltables as S
from geoloom.plans import tables as T
from geoloom.plans.registry import query

PATCH, OVERLAP, STRIP = 32, 8, 64

_GRID = S.META + """, grid AS (
  SELECT raster_id, CAST(tr AS INTEGER) AS tile_r, CAST(tc AS INTEGER) AS tile_c,
         CAST(least(32, height - tr) AS INTEGER) AS h, CAST(least(32, width - tc) AS INTEGER) AS w
  FROM (SELECT *, unnest(generate_series(0, height - 1, 24)) AS tr FROM meta) a,
       LATERAL (SELECT unnest(generate_series(0, a.width - 1, 24)) AS tc))"""
_STRIPS = S.META + """, strips AS (
  SELECT raster_id, width, CAST(s AS INTEGER) AS strip, CAST(s * 32 AS INTEGER) AS row_off,
         CAST(least(64, height - s * 32) AS INTEGER) AS h,
         CAST(CASE WHEN s = 0 THEN 0 ELSE s * 32 + 32 END AS INTEGER) AS own_from,
         CAST(s * 32 + least(64, height - s * 32) AS INTEGER) AS own_to
  FROM (SELECT *, unnest(generate_series(0, greatest(1, (height - 32 + 31) // 32 + 1) - 1)) AS s FROM meta)
  WHERE s * 32 < height),
sgrid AS (SELECT raster_id, strip, CAST(row_off + lr AS INTEGER) AS tile_r, CAST(tc AS INTEGER) AS tile_c,
         CAST(least(32, h - lr) AS INTEGER) AS h, CAST(least(32, width - tc) AS INTEGER) AS w
  FROM (SELECT *, unnest(generate_series(0, h - 1, 24)) AS lr FROM strips) a,
       LATERAL (SELECT unnest(generate_series(0, a.width - 1, 24)) AS tc))"""


@query("strip_rows", f"WITH {_STRIPS} SELECT raster_id, strip, row_off, h, own_from, own_to FROM strips")
def strip_rows(spark, sf):
    return G.strips(T.raster_meta(spark, sf), STRIP, PATCH).drop("width")


@query("strip_owner_rows", f"""WITH {_STRIPS}, {S.MASK}
SELECT m.raster_id, s.strip, count(*) AS pixels, count(*) FILTER (class_id > 0) AS fg
FROM mask m JOIN strips s ON m.raster_id = s.raster_id AND m.r >= s.own_from AND m.r < s.own_to GROUP BY ALL""")
def strip_owner_rows(spark, sf):
    rows = G.owner_strip(T.mask(spark, sf), STRIP, PATCH)
    return rows.groupBy("raster_id", "strip").agg(
        F.count("*").alias("pixels"), F.count_if(F.col("class_id") > 0).alias("fg")
    )


@query("patch_grid", f"WITH {_GRID} SELECT * FROM grid")
def patch_grid(spark, sf):
    return G.tile_grid(T.raster_meta(spark, sf), PATCH, OVERLAP).drop("strip")


@query("strip_patch_grid", f"WITH {_STRIPS} SELECT * FROM sgrid")
def strip_patch_grid(spark, sf):
    return G.tile_grid(T.raster_meta(spark, sf), PATCH, OVERLAP, STRIP)


@query("fg_tiles", f"""WITH {_STRIPS}, {S.MASK}
SELECT g.raster_id, strip, tile_r, tile_c, h, w, count(*) AS fg, round(count(*) / 1024, 6) AS fg_frac
FROM sgrid g JOIN mask m ON g.raster_id = m.raster_id AND m.r BETWEEN tile_r AND tile_r + h - 1
  AND m.c BETWEEN tile_c AND tile_c + w - 1 AND class_id > 0
GROUP BY ALL HAVING count(*) / 1024 >= 0.003""")
def fg_tiles(spark, sf):
    out = G.foreground_tiles(T.mask(spark, sf), T.raster_meta(spark, sf), PATCH, OVERLAP, 0.003, STRIP)
    return out.withColumn("fg_frac", F.round("fg_frac", 6))


_REF = lambda i, n: f"(CASE WHEN {n} = 1 THEN 0 ELSE least(({i}) % (2 * ({n} - 1)), 2 * ({n} - 1) - ({i}) % (2 * ({n} - 1))) END)"
_PADDED = _GRID + f""", {S.RGB}, pos AS (
  SELECT g.*, CAST(i AS INTEGER) AS lr, CAST(j AS INTEGER) AS lc,
         {_REF('i', 'h')} AS sr, {_REF('j', 'w')} AS sc FROM grid g, range(32) a(i), range(32) b(j))"""


@query("padded_fg_share", f"""WITH {_PADDED}, {S.MASK_ONLY}
SELECT p.raster_id, tile_r, tile_c, round(count(*) / 1024, 6) AS fg_frac
FROM pos p JOIN mask m ON p.raster_id = m.raster_id AND m.r = tile_r + sr AND m.c = tile_c + sc AND class_id > 0
GROUP BY ALL""")
def padded_fg_share(spark, sf):
    out = G.padded_foreground(T.mask(spark, sf), T.raster_meta(spark, sf), PATCH, OVERLAP)
    return out.withColumn("fg_frac", F.round("fg_frac", 6))


@query("reflect_pad", f"""WITH {_PADDED} SELECT p.raster_id, tile_r, tile_c, lr, lc, b1
FROM pos p JOIN rgb x ON p.raster_id = x.raster_id AND x.r = tile_r + sr AND x.c = tile_c + sc""")
def reflect_pad(spark, sf):
    tiles = G.tile_pixels(T.rgb(spark, sf), T.raster_meta(spark, sf), PATCH, OVERLAP)
    return G.pad_reflect(tiles, PATCH).select("raster_id", "tile_r", "tile_c", "lr", "lc", "b1")


@query("zero_pad", f"""WITH {_PADDED} SELECT p.raster_id, tile_r, tile_c, lr, lc, coalesce(b1, 0) AS b1
FROM pos p LEFT JOIN rgb x ON p.raster_id = x.raster_id AND x.r = tile_r + lr AND x.c = tile_c + lc
  AND lr < h AND lc < w""")
def zero_pad(spark, sf):
    meta = T.raster_meta(spark, sf)
    tiles = G.tile_pixels(T.rgb(spark, sf), meta, PATCH, OVERLAP)
    return G.pad_zero(tiles, G.tile_grid(meta, PATCH, OVERLAP), PATCH, ["b1"])


@query("tile_names", f"""WITH {_GRID} SELECT raster_id, tile_r, tile_c,
  printf('raster_%d_%06d_%06d.png', raster_id, tile_r, tile_c) AS name FROM grid WHERE h > 0 AND w > 0""")
def tile_names(spark, sf):
    grid = G.tile_grid(T.raster_meta(spark, sf), PATCH, OVERLAP).filter("h > 0 and w > 0")
    prefix = F.concat(F.lit("raster_"), F.col("raster_id").cast("string"))
    return grid.select(
        "raster_id", "tile_r", "tile_c", G.tile_name(prefix, F.col("tile_r"), F.col("tile_c")).alias("name")
    )


@query("blank_tiles", f"""WITH {_GRID}, {S.RGB}
SELECT g.raster_id, tile_r, tile_c, max(greatest(b1, b2, b3)) AS brightest, count(*) AS n
FROM grid g JOIN rgb x ON g.raster_id = x.raster_id AND x.r BETWEEN tile_r AND tile_r + h - 1
  AND x.c BETWEEN tile_c AND tile_c + w - 1 GROUP BY ALL HAVING max(greatest(b1, b2, b3)) >= 10""")
def blank_tiles(spark, sf):
    out = G.drop_blank_tiles(T.rgb(spark, sf), T.raster_meta(spark, sf), PATCH, OVERLAP, 10)
    return out.select("raster_id", "tile_r", "tile_c", "brightest", "n")


@query("snapped_tiles", f"""WITH {S.OBJECTS} SELECT raster_id, CAST(pr // 200 * 200 AS INTEGER) AS tile_r,
  CAST(pc // 200 * 200 AS INTEGER) AS tile_c, count(*) AS n_objects FROM objects GROUP BY ALL""")
def snapped_tiles(spark, sf):
    return G.snapped_tiles(T.objects(spark, sf), 200)


@query("band_policy", f"""WITH {S.META}, {S.RGB} SELECT x.raster_id, r, c, b1,
  CASE WHEN n_bands >= 3 THEN b2 ELSE b1 END AS b2, CASE WHEN n_bands >= 3 THEN b3 ELSE b1 END AS b3
FROM rgb x JOIN meta m ON x.raster_id = m.raster_id""")
def band_policy(spark, sf):
    joined = T.rgb(spark, sf).join(T.raster_meta(spark, sf).select("raster_id", "n_bands"), "raster_id")
    bands = R.three_bands(*[F.col(x) for x in ("n_bands", "b1", "b2", "b3")])
    return joined.select("raster_id", "r", "c", *bands)


@query("narrow_dtype", f"""WITH {S.META}, {S.RGB} SELECT x.raster_id, r, c,
  CAST(CASE WHEN dtype = 'uint16' THEN floor(b1 * 200 / 256) ELSE b1 * 200 END AS INTEGER) AS b
FROM rgb x JOIN meta m ON x.raster_id = m.raster_id""")
def narrow_dtype(spark, sf):
    joined = T.rgb(spark, sf).join(T.raster_meta(spark, sf).select("raster_id", "dtype"), "raster_id")
    return joined.select("raster_id", "r", "c", R.narrow_dtype(F.col("b1") * 200, F.col("dtype")).alias("b"))


@query("window_read", f"""WITH {S.RGB}, box AS (
  SELECT vec_id AS box_id, vec_id // 100 AS raster_id, CAST(vec_id % 100 AS INTEGER) AS r1,
         CAST(vec_id % 100 + 5 + label AS INTEGER) AS r2, CAST(vec_id * 7 % 50 AS INTEGER) AS c1,
         CAST(vec_id * 7 % 50 + 9 AS INTEGER) AS c2 FROM embeddings)
SELECT box_id, count(*) AS n, CAST(sum(b1) AS BIGINT) AS total FROM box b JOIN rgb x ON b.raster_id = x.raster_id
  AND r >= r1 AND r < r2 AND c >= c1 AND c < c2 GROUP BY box_id""")
def window_read(spark, sf):
    boxes = T.table(spark, sf, "embeddings").selectExpr(
        "vec_id as box_id", "vec_id div 100 as raster_id", "cast(vec_id % 100 as int) as r1",
        "cast(vec_id % 100 + 5 + label as int) as r2", "cast(vec_id * 7 % 50 as int) as c1",
        "cast(vec_id * 7 % 50 + 9 as int) as c2",
    )
    out = G.window_pixels(T.rgb(spark, sf), boxes, 32)
    return out.groupBy("box_id").agg(F.count("*").alias("n"), F.sum("b1").alias("total"))


@query("raster_health", f"""WITH {S.META}, {S.RGB}, suspects AS (
  SELECT s_suppkey + 1000000 AS raster_id, s_suppkey % 4 AS k FROM supplier)
SELECT raster_id, CAST(NULL AS VARCHAR) AS reason, max(greatest(b1, b2, b3)) = 0 AS all_zero FROM rgb GROUP BY raster_id
UNION ALL SELECT raster_id, CASE k WHEN 0 THEN 'zero-size raster' WHEN 1 THEN 'no bands' WHEN 2 THEN 'read error' END, k = 3 FROM suspects""")
def raster_health(spark, sf):
    """The rasters, and one per supplier that is empty, has no band, cannot be read or is dark."""
    key = T.table(spark, sf, "supplier").selectExpr("s_suppkey + 1000000 as raster_id", "cast(s_suppkey % 4 as int) as k")
    suspects = key.selectExpr(
        "raster_id", "if(k = 0, 0, 8) as height", "8 as width", "if(k = 1, 0, 3) as n_bands", "'uint8' as dtype"
    )
    dark = key.filter("k = 3").selectExpr("raster_id", "0 as r", "0 as c", "0 as b1", "0 as b2", "0 as b3")
    return G.raster_health(T.raster_meta(spark, sf).unionByName(suspects), T.rgb(spark, sf).unionByName(dark))


@query("rescale_u8", f"""WITH {S.PIXELS}, e AS (SELECT raster_id, min(v) AS lo, max(v) AS hi FROM pixels GROUP BY raster_id)
SELECT p.raster_id, r, c, CAST(floor((v - lo) / (hi - lo) * 255) AS INTEGER) AS v FROM pixels p JOIN e ON p.raster_id = e.raster_id""")
def rescale_u8(spark, sf):
    return RS.rescale_uint8(T.pixels(spark, sf), ["raster_id"], ["v"])


@query("rescale_u8_strips", f"""WITH {S.PIXELS}, s AS (SELECT *, r // 25 AS strip FROM pixels),
e AS (SELECT raster_id, strip, min(v) AS lo, max(v) AS hi FROM s GROUP BY ALL)
SELECT p.raster_id, r, c, CAST(floor((v - lo) / (hi - lo) * 255) AS INTEGER) AS v
FROM s p JOIN e ON p.raster_id = e.raster_id AND p.strip = e.strip""")
def rescale_u8_strips(spark, sf):
    strips = T.pixels(spark, sf).withColumn("strip", F.expr("r div 25"))
    return RS.rescale_uint8(strips, ["raster_id", "strip"], ["v"]).drop("strip")


def _resized(spark, sf, size, method):
    out = RS.resize(
        T.pixels(spark, sf), ["raster_id"], ["v"], F.lit(T.EMB_HEIGHT), F.lit(T.EMB_WIDTH),
        F.lit(size), F.lit(size), method,
    )
    return out.withColumn("v", F.round("v", 6))


@query("area_resize", f"""WITH {S.PIXELS}, t AS (SELECT CAST(i AS INTEGER) AS i, CAST(k AS INTEGER) AS k,
  i * 100.0::DOUBLE / 24 AS y1, (i + 1) * 100.0::DOUBLE / 24 AS y2, k * 64.0::DOUBLE / 24 AS x1, (k + 1) * 64.0::DOUBLE / 24 AS x2
  FROM range(24) a(i), range(24) b(k)),
w AS (SELECT raster_id, i, k, v, greatest(0, least(r + 1, y2) - greatest(r, y1)) * greatest(0, least(c + 1, x2) - greatest(c, x1)) AS w
  FROM pixels JOIN t ON r BETWEEN floor(y1) AND ceil(y2) AND c BETWEEN floor(x1) AND ceil(x2))
SELECT raster_id, i AS r, k AS c, round(sum(v * w) / sum(w), 6) AS v FROM w GROUP BY ALL""")
def area_resize(spark, sf):
    return _resized(spark, sf, 24, "area")


@query("linear_resize", f"""WITH {S.PIXELS}, ax AS (SELECT CAST(i AS INTEGER) AS i,
  least(greatest((i + 0.5) * 100.0::DOUBLE / 72 - 0.5, 0), 99) AS y, least(greatest((i + 0.5) * 64.0::DOUBLE / 72 - 0.5, 0), 63) AS x
  FROM range(72) a(i)),
t AS (SELECT a.i, b.i AS k, CAST(floor(a.y) AS INTEGER) AS r0, a.y - floor(a.y) AS fy, CAST(floor(b.x) AS INTEGER) AS c0, b.x - floor(b.x) AS fx FROM ax a, ax b)
SELECT p.raster_id, t.i AS r, t.k AS c, round(p.v * (1 - fy) * (1 - fx) + q.v * (1 - fy) * fx + s.v * fy * (1 - fx) + u.v * fy * fx, 6) AS v
FROM t JOIN pixels p ON p.r = r0 AND p.c = c0
JOIN pixels q ON q.raster_id = p.raster_id AND q.r = r0 AND q.c = least(c0 + 1, 63)
JOIN pixels s ON s.raster_id = p.raster_id AND s.r = least(r0 + 1, 99) AND s.c = c0
JOIN pixels u ON u.raster_id = p.raster_id AND u.r = least(r0 + 1, 99) AND u.c = least(c0 + 1, 63)""")
def linear_resize(spark, sf):
    return _resized(spark, sf, 72, "linear")
