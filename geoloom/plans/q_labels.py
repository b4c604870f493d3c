"""Queries: detection labels, splits, batches and histories."""

from pyspark.sql import functions as F

from geoloom.model import INFRA_CLASSES, ROOF_CLASSES
from geoloom.operators import history as H
from geoloom.operators import inventory as I
from geoloom.operators import labels as L
from geoloom.operators import split as P
from geoloom.plans import sqltables as S
from geoloom.plans import tables as T
from geoloom.plans.registry import query

SIZE, RATIO, SEED = 48, 0.3, 42

_CENTRED = S.OBJECTS + """, want AS (
  SELECT raster_id, obj_id, class_id, pr, pc, greatest(0, least(pr - 24, 1952)) AS tr, greatest(0, least(pc - 24, 1952)) AS tc,
         row_number() OVER (PARTITION BY raster_id ORDER BY obj_id) AS k FROM objects),
fit AS (
  SELECT raster_id, 0::BIGINT AS k, NULL::BIGINT AS obj_id, NULL::INTEGER AS tile_r, NULL::INTEGER AS tile_c,
         []::STRUCT(r INTEGER, c INTEGER)[] AS tiles FROM (SELECT DISTINCT raster_id FROM want)
  UNION ALL
  SELECT raster_id, k, obj_id, coalesce(hit.r, tr), coalesce(hit.c, tc),
         CASE WHEN hit IS NULL THEN list_append(tiles, {'r': tr, 'c': tc}) ELSE tiles END
  FROM (SELECT w.*, f.tiles, list_filter(f.tiles, lambda t: abs(w.tr - t.r) < 24 AND abs(w.tc - t.c) < 24)[1] AS hit
        FROM fit f JOIN want w ON w.raster_id = f.raster_id AND w.k = f.k + 1)),
tiled AS (SELECT raster_id, obj_id, tile_r, tile_c FROM fit WHERE k > 0),
lab AS (SELECT t.raster_id, t.obj_id, tile_r, tile_c, class_id,
   round(greatest(0, least(1, (pc - tile_c)::DOUBLE / least(48, 2000 - tile_c))), 6) AS cx,
   round(greatest(0, least(1, (pr - tile_r)::DOUBLE / least(48, 2000 - tile_r))), 6) AS cy,
   round([60, 50, 25][class_id + 1] * 2::DOUBLE / least(48, 2000 - tile_c), 6) AS bw,
   round([60, 50, 25][class_id + 1] * 2::DOUBLE / least(48, 2000 - tile_r), 6) AS bh
  FROM tiled t JOIN objects o ON t.raster_id = o.raster_id AND t.obj_id = o.obj_id)"""

_RAND = lambda s: f"CAST(('0x' || substring(md5(raster_id || '/' || try || ':{s}'), 1, 8))::BIGINT % 1953 AS INTEGER)"
_NEG = _CENTRED + f""", pos AS (SELECT DISTINCT raster_id, tile_r, tile_c FROM tiled),
wanted AS (SELECT raster_id, greatest(1, CAST(floor(count(*) * 0.3) AS INTEGER)) AS wanted FROM pos GROUP BY raster_id),
tries AS (SELECT raster_id, wanted, try, {_RAND(42)} AS tile_r, {_RAND(43)} AS tile_c
  FROM (SELECT raster_id, wanted, CAST(unnest(generate_series(0, wanted * 10 - 1)) AS INTEGER) AS try FROM wanted)),
ok AS (SELECT *, row_number() OVER (PARTITION BY raster_id ORDER BY try) AS rn FROM tries t WHERE NOT EXISTS (
  SELECT 1 FROM pos p WHERE p.raster_id = t.raster_id AND abs(p.tile_r - t.tile_r) < 48 AND abs(p.tile_c - t.tile_c) < 48)),
neg AS (SELECT raster_id, try, tile_r, tile_c FROM ok WHERE rn <= wanted)"""
_INDEX = _NEG + """, idx AS (
  SELECT raster_id, printf('infra_%d_%06d_%06d', raster_id, tile_r, tile_c) AS name, count(*) AS n_objects FROM lab GROUP BY ALL
  UNION ALL SELECT DISTINCT raster_id, printf('infra_neg_%d_%06d_%06d', raster_id, tile_r, tile_c), 0 FROM neg)"""


def _meta(spark, sf):
    """One 2000 x 2000 raster per supplier."""
    return T.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("raster_id"), F.lit(T.BOX_CANVAS).alias("height"), F.lit(T.BOX_CANVAS).alias("width")
    )


def _tiled(spark, sf):
    return L.centred_tiles(T.objects(spark, sf), _meta(spark, sf), SIZE)


def _labels(spark, sf):
    from geoloom.runtime import cut

    tiled = cut(_tiled(spark, sf))
    labels = L.encode_labels(tiled, T.objects(spark, sf), _meta(spark, sf), SIZE, INFRA_CLASSES)
    return labels, L.negative_tiles(tiled, _meta(spark, sf), SIZE, RATIO, SEED)


@query("centred_tiles", f"WITH RECURSIVE {_CENTRED} SELECT * FROM tiled")
def centred_tiles(spark, sf):
    return _tiled(spark, sf)


@query("tile_contents", f"WITH RECURSIVE {_CENTRED} SELECT raster_id, tile_r, tile_c, count(*) AS n_objects FROM tiled GROUP BY ALL")
def tile_contents(spark, sf):
    return L.tile_contents(_tiled(spark, sf))


@query("yolo_encode", f"WITH RECURSIVE {_CENTRED} SELECT * FROM lab")
def yolo_encode(spark, sf):
    return _labels(spark, sf)[0]


@query("negative_tiles", f"WITH RECURSIVE {_NEG} SELECT raster_id, try, tile_r, tile_c FROM neg")
def negative_tiles(spark, sf):
    return _labels(spark, sf)[1]


@query("negatives_on_data", f"""WITH {S.META}, pos AS (SELECT raster_id, raster_id * 31 % 80 AS tile_r, raster_id * 17 % 40 AS tile_c FROM meta),
px AS (SELECT vec_id // 100 AS raster_id, vec_id % 100 AS r, i - 1 AS c FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)
  WHERE i > 33 AND floor(embedding[i]::DOUBLE * 400 + 128) >= 10),
t AS (SELECT raster_id, t AS try, CAST(('0x' || substring(md5(raster_id || '/' || t || ':42'), 1, 8))::BIGINT % (greatest(height - 16, 0) + 1) AS INTEGER) AS tile_r,
  CAST(('0x' || substring(md5(raster_id || '/' || t || ':43'), 1, 8))::BIGINT % (width - 15) AS INTEGER) AS tile_c FROM meta, range(50) a(t)),
ok AS (SELECT raster_id, try, tile_r, tile_c, row_number() OVER (PARTITION BY raster_id ORDER BY try) AS rn FROM t
  WHERE NOT EXISTS (SELECT 1 FROM pos p WHERE p.raster_id = t.raster_id AND abs(p.tile_r - t.tile_r) < 16 AND abs(p.tile_c - t.tile_c) < 16)
    AND EXISTS (SELECT 1 FROM px p WHERE p.raster_id = t.raster_id AND p.r >= t.tile_r AND p.r < t.tile_r + 16 AND p.c >= t.tile_c AND p.c < t.tile_c + 16))
SELECT raster_id, CAST(try AS INTEGER) AS try, tile_r, tile_c FROM ok WHERE rn <= 5""")
def negatives_on_data(spark, sf):
    """Rasters without data left of column 33: tries that see nothing brighter are rejected."""
    meta = T.raster_meta(spark, sf)
    tiles = meta.selectExpr("raster_id", "raster_id * 31 % 80 as tile_r", "raster_id * 17 % 40 as tile_c")
    rgb = T.rgb(spark, sf)
    data = rgb.select("raster_id", "r", "c", *[F.when(F.col("c") < 33, 0).otherwise(F.col("b1")).alias(b) for b in ("b1", "b2", "b3")])
    return L.negative_tiles(tiles, meta, 16, 5.0, SEED, data, 10)


@query("yolo_text", f"""WITH RECURSIVE {_NEG}
SELECT raster_id, printf('infra_%d_%06d_%06d', raster_id, tile_r, tile_c) AS name, obj_id,
  printf('%d %.6f %.6f %.6f %.6f', class_id, cx, cy, bw, bh) AS line FROM lab
UNION ALL SELECT DISTINCT raster_id, printf('infra_neg_%d_%06d_%06d', raster_id, tile_r, tile_c), NULL, '' FROM neg""")
def yolo_text(spark, sf):
    return L.label_lines(*_labels(spark, sf))


@query("label_files", f"""WITH RECURSIVE {_NEG}
SELECT raster_id, printf('infra_%d_%06d_%06d', raster_id, tile_r, tile_c) AS name,
  string_agg(printf('%d %.6f %.6f %.6f %.6f', class_id, cx, cy, bw, bh), chr(10) ORDER BY obj_id) AS text FROM lab GROUP BY ALL
UNION ALL SELECT DISTINCT raster_id, printf('infra_neg_%d_%06d_%06d', raster_id, tile_r, tile_c), '' FROM neg""")
def label_files(spark, sf):
    return L.label_texts(L.label_lines(*_labels(spark, sf)))


@query("extraction_counts", f"""WITH RECURSIVE {_INDEX} SELECT count(*) AS tiles,
  count(*) FILTER (starts_with(name, 'infra_neg_')) AS negatives, CAST(sum(n_objects) AS BIGINT) AS objects FROM idx""")
def extraction_counts(spark, sf):
    return I.extraction_counts(L.tile_index(*_labels(spark, sf)))


@query("split_prefix", f"""WITH RECURSIVE {_INDEX}
SELECT raster_id, name, n_objects, CASE WHEN row_number() OVER (ORDER BY name) <= greatest(1, floor((SELECT count(*) FROM idx) * 0.15))
  THEN 'val' ELSE 'train' END AS split FROM idx""")
def split_prefix(spark, sf):
    return P.prefix_split(L.tile_index(*_labels(spark, sf)), "name", 0.15)


@query("split_label_pairs", f"""WITH RECURSIVE {_INDEX}, s AS (
  SELECT raster_id, name, CASE WHEN row_number() OVER (ORDER BY name) <= greatest(1, floor((SELECT count(*) FROM idx) * 0.15))
  THEN 'val' ELSE 'train' END AS split FROM idx)
SELECT split, count(*) AS lines, count(DISTINCT name) AS tiles FROM (
  SELECT s.split, s.name, l.obj_id FROM s LEFT JOIN lab l ON s.raster_id = l.raster_id
    AND s.name = printf('infra_%d_%06d_%06d', l.raster_id, l.tile_r, l.tile_c)) GROUP BY split""")
def split_label_pairs(spark, sf):
    labels, negatives = _labels(spark, sf)
    split = P.prefix_split(L.tile_index(labels, negatives), "name", 0.15).drop("n_objects")
    pairs = L.pair_labels(split, L.label_lines(labels, negatives))
    tiles = pairs.groupBy("split", "raster_id", "name").agg(F.count("*").alias("n"))
    return tiles.groupBy("split").agg(F.sum("n").alias("lines"), F.count("*").alias("tiles"))


@query("manifest", f"""WITH RECURSIVE {_INDEX}, n AS (SELECT count(*) AS n FROM idx)
SELECT 'yolo' AS path, 'train/images' AS train, 'val/images' AS val, 3 AS nc, 'transformer,overhead_tank,well' AS names,
  n - CAST(greatest(1, floor(n * 0.15)) AS BIGINT) AS n_train, CAST(greatest(1, floor(n * 0.15)) AS BIGINT) AS n_val FROM n""")
def manifest(spark, sf):
    split = P.prefix_split(L.tile_index(*_labels(spark, sf)), "name", 0.15)
    return L.manifest(split, "yolo", INFRA_CLASSES).withColumn("names", F.concat_ws(",", "names"))


@query("split_holdout", """SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id)
  <= greatest(1, floor((SELECT count(*) FROM documents) * 0.15)) THEN 'val' ELSE 'train' END AS split FROM documents""")
def split_holdout(spark, sf):
    return P.holdout_split(T.table(spark, sf, "documents").select("doc_id"), "doc_id", 0.15, 42)


@query("split_stratified", f"""WITH {S.CLS_PAIR} SELECT item, target, CASE WHEN row_number() OVER (PARTITION BY target ORDER BY md5(item || ':42'), item)
  <= (SELECT CASE WHEN count(*) > 1 THEN greatest(1, floor(count(*) * 0.15)) ELSE 0 END FROM pair q WHERE q.target = pair.target)
  THEN 'val' ELSE 'train' END AS split FROM pair""")
def split_stratified(spark, sf):
    items = T.cls_pair(spark, sf).select("item", "target")
    return P.stratified_split(items, "item", "target", 0.15, 42)


@query("batching", """SELECT conv_id, turn, CAST((row_number() OVER (ORDER BY conv_id, turn) - 1) // 16 AS BIGINT) AS batch_id,
  CAST((row_number() OVER (ORDER BY conv_id, turn) - 1) % 16 AS INTEGER) AS pos FROM conversations""")
def batching(spark, sf):
    return P.batches(T.table(spark, sf, "conversations").select("conv_id", "turn"), ["conv_id", "turn"], 16)


@query("full_batches", """SELECT doc_id, CAST((rn - 1) // 64 AS BIGINT) AS batch_id, CAST((rn - 1) % 64 AS INTEGER) AS pos
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents) WHERE rn <= (SELECT count(*) // 64 * 64 FROM documents)""")
def full_batches(spark, sf):
    return P.batches(T.table(spark, sf, "documents").select("doc_id"), ["doc_id"], 64, drop_last=True)


@query("image_mask_pairs", f"""WITH {S.MASK}, {S.META} SELECT m.raster_id, r, c,
  CASE WHEN m.raster_id % 2 = 0 AND class_id > 0 THEN least(2, class_id) ELSE 0 END AS class_id FROM mask m""")
def image_mask_pairs(spark, sf):
    """Masks exist for every second raster and hold foreground only."""
    mask = T.mask(spark, sf).filter("class_id > 0 and raster_id % 2 = 0")
    return P.image_mask_pairs(T.pixels(spark, sf).drop("v"), mask, 3)


@query("labelled_images", """SELECT 'crops/' || label || '/' || page_id || '.png' AS path, label, class_id FROM (
  SELECT page_id, ['RCC','Tiled','Tin','Other','Unused'][page_id % 5 + 1] AS label, CAST(page_id % 5 AS INTEGER) AS class_id FROM pages)
WHERE class_id < 4""")
def labelled_images(spark, sf):
    names = F.array(*[F.lit(n) for n in (*ROOF_CLASSES, "Unused")])
    label = F.element_at(names, (F.col("page_id") % 5 + 1).cast("int"))
    paths = T.table(spark, sf, "pages").select(F.concat(F.lit("crops/"), label, F.lit("/"), "page_id", F.lit(".png")).alias("path"))
    return P.labelled_images(paths, ROOF_CLASSES)


_EPOCHS = """h AS (SELECT user_id AS run_id, value AS metric, event_id AS step,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS epoch FROM events),
b AS (SELECT *, max(metric) OVER (PARTITION BY run_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM h),
i AS (SELECT *, metric > greatest(coalesce(best, 0), 0) AS improved FROM b),
p AS (SELECT *, epoch - max(CASE WHEN improved THEN epoch ELSE 0 END) OVER (PARTITION BY run_id ORDER BY epoch) AS streak FROM i)"""


def _epochs(spark, sf):
    return H.numbered_epochs(T.history(spark, sf), "run_id", [F.col("ts"), F.col("step")]).drop("ts")


@query("progress", f"WITH {_EPOCHS} SELECT run_id, epoch, step, metric, improved, streak FROM p")
def progress(spark, sf):
    return H.progress(_epochs(spark, sf), "run_id", "metric")


def _stop_sql(patience: int) -> str:
    return f"""WITH {_EPOCHS}, s AS (SELECT run_id, min(CASE WHEN streak >= {patience} THEN epoch END) AS stop_epoch FROM p GROUP BY run_id)
SELECT s.run_id, stop_epoch, max(CASE WHEN improved THEN epoch END) AS best_epoch, max(CASE WHEN improved THEN metric END) AS best
FROM s JOIN p ON s.run_id = p.run_id AND (stop_epoch IS NULL OR epoch <= stop_epoch) GROUP BY ALL"""


@query("early_stop", _stop_sql(12))
def early_stop(spark, sf):
    return H.early_stops(_epochs(spark, sf), "run_id", "metric", 12)


@query("early_stop_patient", _stop_sql(18))
def early_stop_patient(spark, sf):
    return H.early_stops(_epochs(spark, sf), "run_id", "metric", 18)


@query("resume_state", f"WITH {_EPOCHS} SELECT run_id, epoch, step, metric FROM h QUALIFY epoch = max(epoch) OVER (PARTITION BY run_id)")
def resume_state(spark, sf):
    return H.resume_state(_epochs(spark, sf), "run_id")
