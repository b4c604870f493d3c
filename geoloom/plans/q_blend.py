"""Queries: blending, ensembles, roof labels and augmentations."""

import numpy as np
from pyspark.sql import functions as F

from geoloom.model import ROOF_CLASSES
from geoloom.operators import augment as A
from geoloom.operators import blend as B
from geoloom.operators import grid as G
from geoloom.plans import sqltables as S
from geoloom.plans import tables as T
from geoloom.plans.registry import query

PATCH, OVERLAP = 32, 8

_GRID = S.META + """, grid AS (
  SELECT raster_id, CAST(tr AS INTEGER) AS tile_r, CAST(tc AS INTEGER) AS tile_c, least(32, height - tr) AS h, least(32, width - tc) AS w
  FROM (SELECT *, unnest(generate_series(0, height - 1, 24)) AS tr FROM meta) a,
       LATERAL (SELECT unnest(generate_series(0, a.width - 1, 24)) AS tc))"""
_RAMP = lambda x: f"pow(CASE WHEN {x} >= 24 THEN (cos(pi() * ({x} - 24) / 8) + 1) / 2 WHEN {x} < 8 THEN (cos(pi() * (7 - {x}) / 8) + 1) / 2 ELSE 1 END, 2)"
_TILES = _GRID + f""", tp AS (SELECT g.raster_id, tile_r, tile_c, p.r, p.c, v, {_RAMP('(p.r - tile_r)')} * {_RAMP('(p.c - tile_c)')} AS wt
  FROM grid g JOIN pixels p ON g.raster_id = p.raster_id AND p.r BETWEEN tile_r AND tile_r + h - 1 AND p.c BETWEEN tile_c AND tile_c + w - 1),
z AS (SELECT *, [exp(v * k + ((tile_r + tile_c + k) % 5) / 10) FOR k IN [1, 2, 3, 4]] AS e FROM tp),
pr AS (SELECT raster_id, r, c, wt, [x / list_sum(e) FOR x IN e] AS p FROM z),
bl AS (SELECT raster_id, r, c, [sum(p[1] * wt) / greatest(sum(wt), 1e-6), sum(p[2] * wt) / greatest(sum(wt), 1e-6),
  sum(p[3] * wt) / greatest(sum(wt), 1e-6), sum(p[4] * wt) / greatest(sum(wt), 1e-6)] AS p FROM pr GROUP BY ALL)"""


def _tile_probs(spark, sf):
    """A predictor that depends on the pixel and on the tile it is seen in."""
    tiles = G.tile_pixels(T.pixels(spark, sf), T.raster_meta(spark, sf), PATCH, OVERLAP)
    z = F.array(*[F.col("v") * k + ((F.col("tile_r") + F.col("tile_c") + k) % 5) / 10 for k in (1, 2, 3, 4)])
    return tiles.withColumn("z", z).withColumn("probs", B.softmax(F.col("z"))).drop("z")


def _wide(df):
    return df.select(
        *[c for c in df.columns if c != "probs"], *[F.round(F.get("probs", F.lit(k)), 6).alias(f"p{k}") for k in range(4)]
    )


@query("taper_weights", f"""WITH {S.PIXELS}, {_TILES} SELECT raster_id, tile_r, tile_c, count(*) AS n, round(sum(wt), 6) AS w FROM tp GROUP BY ALL""")
def taper_weights(spark, sf):
    tiles = G.tile_pixels(T.pixels(spark, sf), T.raster_meta(spark, sf), PATCH, OVERLAP)
    return B.with_taper(tiles.drop("w"), PATCH, OVERLAP).groupBy("raster_id", "tile_r", "tile_c").agg(
        F.count("*").alias("n"), F.round(F.sum("w"), 6).alias("w")
    )


@query("blend_overlap", f"WITH {S.PIXELS}, {_TILES} SELECT raster_id, r, c, round(p[1], 6) AS p0, round(p[2], 6) AS p1, round(p[3], 6) AS p2, round(p[4], 6) AS p3 FROM bl")
def blend_overlap(spark, sf):
    return _wide(B.blend(_tile_probs(spark, sf), PATCH, OVERLAP, 4))


@query("argmax_class", f"WITH {S.PIXELS}, {_TILES} SELECT raster_id, r, c, CAST(list_position(p, list_max(p)) - 1 AS INTEGER) AS class_id FROM bl")
def argmax_class(spark, sf):
    out = B.blend(_tile_probs(spark, sf), PATCH, OVERLAP, 4)
    return out.select("raster_id", "r", "c", B.argmax(F.col("probs")).alias("class_id"))


def make_stub():
    """A predictor by arithmetic: the share of each class grows with the first band."""

    def predict(x: np.ndarray) -> np.ndarray:
        z = x[..., :1].astype("float64") / 255.0 * np.array([1.0, 2.0, 3.0, 4.0])
        e = np.exp(z)
        return (e / e.sum(-1, keepdims=True)).reshape(len(x), -1).astype("float32")

    return predict


@query("predict_tiles", f"""WITH {S.RGB}, e AS (SELECT raster_id, r, c, [exp(b1 / 255 * k) FOR k IN [1, 2, 3, 4]] AS e FROM rgb)
SELECT raster_id, r, c, round(e[1] / list_sum(e), 4) AS p0, round(e[2] / list_sum(e), 4) AS p1, round(e[3] / list_sum(e), 4) AS p2, round(e[4] / list_sum(e), 4) AS p3 FROM e""")
def predict_tiles(spark, sf):
    tiles = G.pad_reflect(G.tile_pixels(T.rgb(spark, sf), T.raster_meta(spark, sf), PATCH, OVERLAP), PATCH)
    packed = B.tile_arrays(tiles, PATCH, ["b1", "b2", "b3"])
    probs = B.blend(B.predict_tiles(packed, make_stub, PATCH, 3, 4), PATCH, OVERLAP, 4)
    return probs.select("raster_id", "r", "c", *[F.round(F.get("probs", F.lit(k)), 4).alias(f"p{k}") for k in range(4)])


_VAR = """var AS (SELECT vec_id AS item, i, [exp(embedding[i * 4 + k]::DOUBLE) FOR k IN [1, 2, 3, 4]] AS e
  FROM (SELECT vec_id, embedding, unnest(generate_series(0, 15)) AS i FROM embeddings)),
vp AS (SELECT item, i, [x / list_sum(e) FOR x IN e] AS p FROM var)"""


def _variants(spark, sf):
    e = T.table(spark, sf, "embeddings").select(F.col("vec_id").alias("item"), "embedding", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("i"))
    return e.select("item", "i", B.softmax(F.slice("embedding", F.col("i") * 4 + 1, F.lit(4)).cast("array<double>")).alias("probs"))


def _tta_sql(weight: str) -> str:
    cols = ", ".join(f"round(sum(p[{k + 1}] * w) / sum(w), 6) AS p{k}" for k in range(4))
    return f"WITH {_VAR}, x AS (SELECT *, {weight} AS w FROM vp) SELECT item, {cols} FROM x WHERE w > 0 GROUP BY item"


@query("tta_fast", _tta_sql("CASE WHEN i < 3 THEN 2 ELSE 0 END"))
def tta_fast(spark, sf):
    v = _variants(spark, sf).withColumn("variant", F.get(F.array(*[F.lit(x) for x in B.FAST_TTA]), F.col("i")))
    return _wide(B.tta_mean(v, ["item"], B.FAST_TTA, 4))


@query("tta_full", _tta_sql("CASE WHEN i < 8 THEN 1 WHEN i = 8 THEN 4 ELSE 0 END"))
def tta_full(spark, sf):
    v = _variants(spark, sf).withColumn("variant", F.get(F.array(*[F.lit(x) for x in B.FULL_TTA]), F.col("i")))
    return _wide(B.tta_mean(v, ["item"], B.FULL_TTA, 4))


@query("tta_mean", _tta_sql("1"))
def tta_mean(spark, sf):
    return _wide(B.tta_mean(_variants(spark, sf), ["item"], None, 4))


_GATE = """g AS (SELECT vec_id AS item, [exp(embedding[k]::DOUBLE * 12) FOR k IN [1, 2, 3, 4]] AS e FROM embeddings),
gp AS (SELECT item, [x / list_sum(e) FOR x IN e] AS p FROM g),
roof AS (SELECT item, CASE WHEN list_max(p) < 0.55 THEN 'Other' ELSE ['RCC','Tiled','Tin','Other'][list_position(p, list_max(p))] END AS label FROM gp)"""


def _roofs(spark, sf):
    z = F.transform(F.slice("embedding", 1, 4), lambda x: x.cast("double") * 12)
    e = T.table(spark, sf, "embeddings").select(F.col("vec_id").alias("item"), B.softmax(z).alias("probs"))
    return e.select("item", B.roof_class(F.col("probs"), ROOF_CLASSES, 0.55).alias("label"))


@query("roof_gate", f"WITH {_GATE} SELECT item, label FROM roof")
def roof_gate(spark, sf):
    return _roofs(spark, sf)


@query("roof_merge", f"""WITH {_GATE} SELECT o_orderkey, coalesce(label, 'Unknown') AS roof_pred FROM orders LEFT JOIN roof ON item = o_custkey""")
def roof_merge(spark, sf):
    """Buildings are orders; only customers with a vector have a prediction."""
    buildings = T.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("item"))
    return B.merge_roof_labels(buildings, _roofs(spark, sf), ["item"]).select("o_orderkey", "roof_pred")


# -- augmentations ----------------------------------------------------------------------

_ITEMS = """items AS (SELECT vec_id AS item, CAST((i - 1) // 8 AS INTEGER) AS r, CAST((i - 1) % 8 AS INTEGER) AS c, embedding[i]::DOUBLE AS v, label
  FROM (SELECT vec_id, label, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings))"""


def _items(spark, sf):
    """One 8 x 8 image per vector."""
    e = T.table(spark, sf, "embeddings").select(F.col("vec_id").alias("item"), "label", F.posexplode("embedding").alias("i", "v"))
    return e.select("item", F.expr("cast(i div 8 as int)").alias("r"), (F.col("i") % 8).alias("c"), F.col("v").cast("double"), "label")


@query("normalise", f"""WITH {S.RGB} SELECT raster_id, r, c, round((b1 / 255 - 0.485) / 0.229, 6) AS b1, round((b2 / 255 - 0.456) / 0.224, 6) AS b2,
  round((b3 / 255 - 0.406) / 0.225, 6) AS b3 FROM rgb""")
def normalise(spark, sf):
    out = A.normalise(T.rgb(spark, sf), ["b1", "b2", "b3"])
    return A.with_transform(out, ["b1", "b2", "b3"], lambda x: F.round(x, 6))


@query("d4_symmetries", f"""WITH {S.PIXELS}, q AS (SELECT *, CAST(k AS INTEGER) AS variant FROM pixels, range(8) t(k)),
t AS (SELECT raster_id, v, variant, CASE variant % 4 WHEN 0 THEN r WHEN 1 THEN 63 - c WHEN 2 THEN 99 - r ELSE c END AS rr,
  CASE variant % 4 WHEN 0 THEN c WHEN 1 THEN r WHEN 2 THEN 63 - c ELSE 99 - r END AS cc FROM q)
SELECT raster_id, variant, rr AS r, CASE WHEN variant < 4 THEN cc WHEN variant % 2 = 0 THEN 63 - cc ELSE 99 - cc END AS c, v FROM t""")
def d4_symmetries(spark, sf):
    out = A.symmetries(T.pixels(spark, sf), F.lit(T.EMB_HEIGHT), F.lit(T.EMB_WIDTH))
    return out.select("raster_id", "variant", "r", "c", "v")


@query("symmetry_round_trip", f"WITH {S.PIXELS} SELECT raster_id, CAST(k AS INTEGER) AS variant, r, c, v FROM pixels, range(8) t(k)")
def symmetry_round_trip(spark, sf):
    h, w = F.lit(T.EMB_HEIGHT), F.lit(T.EMB_WIDTH)
    return A.undo_symmetry(A.symmetries(T.pixels(spark, sf), h, w), h, w)


@query("pad_and_crop", f"""WITH {_ITEMS}, pos AS (SELECT CAST(i AS INTEGER) AS r, CAST(k AS INTEGER) AS c,
  CASE WHEN (i + 14) % 16 < 8 THEN (i + 14) % 16 ELSE 15 - (i + 14) % 16 END AS sr, CASE WHEN (k + 14) % 16 < 8 THEN (k + 14) % 16 ELSE 15 - (k + 14) % 16 END AS sc
  FROM range(12) a(i), range(12) b(k))
SELECT item, pos.r - 1 AS r, pos.c - 1 AS c, v FROM pos JOIN items ON items.r = sr AND items.c = sc WHERE pos.r BETWEEN 1 AND 10 AND pos.c BETWEEN 1 AND 10""")
def pad_and_crop(spark, sf):
    padded = A.pad_to(_items(spark, sf).drop("label"), ["item"], F.lit(8), F.lit(8), 12)
    return A.centre_crop(padded, F.lit(12), F.lit(12), 10)


@query("random_crop", f"""WITH {_ITEMS}, o AS (SELECT *, CAST(('0x' || substring(md5(item || ':42'), 1, 8))::BIGINT % 4 AS INTEGER) AS r0,
  CAST(('0x' || substring(md5(item || ':43'), 1, 8))::BIGINT % 4 AS INTEGER) AS c0 FROM items)
SELECT item, r - r0 AS r, c - c0 AS c, v FROM o WHERE r >= r0 AND r < r0 + 5 AND c >= c0 AND c < c0 + 5""")
def random_crop(spark, sf):
    return A.random_crop(_items(spark, sf).drop("label"), F.col("item"), F.lit(8), F.lit(8), 5, 42)


@query("centre_zoom", f"""WITH {_ITEMS}, ax AS (SELECT CAST(i AS INTEGER) AS i, least(greatest((i + 0.5) * 6.0::DOUBLE / 8 - 0.5, 0), 5) AS x FROM range(8) t(i)),
t AS (SELECT a.i AS r, b.i AS c, CAST(floor(a.x) AS INTEGER) + 1 AS r0, a.x - floor(a.x) AS fy, CAST(floor(b.x) AS INTEGER) + 1 AS c0, b.x - floor(b.x) AS fx FROM ax a, ax b)
SELECT p.item, t.r, t.c, round(p.v * (1 - fy) * (1 - fx) + q.v * (1 - fy) * fx + s.v * fy * (1 - fx) + u.v * fy * fx, 6) AS v FROM t
JOIN items p ON p.r = r0 AND p.c = c0 JOIN items q ON q.item = p.item AND q.r = r0 AND q.c = least(c0 + 1, 6)
JOIN items s ON s.item = p.item AND s.r = least(r0 + 1, 6) AND s.c = c0 JOIN items u ON u.item = p.item AND u.r = least(r0 + 1, 6) AND u.c = least(c0 + 1, 6)""")
def centre_zoom(spark, sf):
    return A.zoom(_items(spark, sf), ["item"], ["v"], 8, 8).withColumn("v", F.round("v", 6))


_PAIRS = """b AS (SELECT vec_id AS item, CAST((rn - 1) // 32 AS BIGINT) AS batch_id, (rn - 1) % 32 AS pos
  FROM (SELECT vec_id, row_number() OVER (ORDER BY md5(vec_id || ':7'), vec_id) AS rn FROM embeddings)),
sl AS (SELECT batch_id, item AS partner, row_number() OVER (PARTITION BY batch_id ORDER BY md5(item || ':8'), item) - 1 AS pos FROM b),
pairs AS (SELECT b.item, b.batch_id, partner FROM b JOIN sl ON b.batch_id = sl.batch_id AND b.pos = sl.pos)"""
_H = lambda s, n: f"(('0x' || substring(md5(batch_id || ':{s}'), 1, 8))::BIGINT % {n})"
_BOXES = f"""lam AS (SELECT DISTINCT batch_id, {_H(9, 1000000)} / 1000000 AS lam FROM b),
cuts AS (SELECT batch_id, CAST(trunc(8 * sqrt(1 - lam)) AS INTEGER) // 2 AS hf, CAST({_H(10, 8)} AS INTEGER) AS cx, CAST({_H(11, 8)} AS INTEGER) AS cy FROM lam),
boxes AS (SELECT batch_id, greatest(cy - hf, 0) AS y1, least(cy + hf, 8) AS y2, greatest(cx - hf, 0) AS x1, least(cx + hf, 8) AS x2 FROM cuts)"""


def _mix(spark, sf):
    from geoloom.runtime import cut, seeded_int

    items = T.table(spark, sf, "embeddings").select(F.col("vec_id").alias("item"))
    pairs = cut(A.partners(items, "item", 32, 7))
    lam = pairs.select("batch_id").distinct().withColumn(
        "lam", seeded_int(F.col("batch_id"), 9, F.lit(1000000)) / 1000000
    )
    return pairs, lam


@query("cutmix", f"""WITH {_ITEMS}, {_PAIRS}, {_BOXES}
SELECT i.item, i.r, i.c, CASE WHEN inside THEN q.v ELSE i.v END AS v, CASE WHEN inside THEN q.label ELSE i.label END AS label, round(lam, 6) AS lam FROM (
  SELECT items.*, partner, r >= y1 AND r < y2 AND c >= x1 AND c < x2 AS inside, 1 - (x2 - x1) * (y2 - y1) / 64 AS lam
  FROM items JOIN pairs USING (item) JOIN boxes USING (batch_id)) i JOIN items q ON q.item = i.partner AND q.r = i.r AND q.c = i.c""")
def cutmix(spark, sf):
    pairs, lam = _mix(spark, sf)
    boxes = A.cut_boxes(lam, F.col("lam"), 8, 8, 10)
    mixed = A.cutmix(_items(spark, sf), "item", pairs, boxes.drop("lam"))
    kept = pairs.join(boxes.select("batch_id", "lam"), "batch_id").select("item", F.round("lam", 6).alias("lam"))
    return mixed.join(kept, "item")


@query("mixup", f"""WITH {_ITEMS}, {_PAIRS}, {_BOXES}
SELECT i.item, i.r, i.c, round(lam * i.v + (1 - lam) * q.v, 6) AS v FROM items i JOIN pairs USING (item) JOIN lam USING (batch_id)
JOIN items q ON q.item = partner AND q.r = i.r AND q.c = i.c""")
def mixup(spark, sf):
    pairs, lam = _mix(spark, sf)
    return A.mixup(_items(spark, sf), "item", pairs, lam, ["v"]).withColumn("v", F.round("v", 6))
