"""The derived inputs of ``tables.py`` once more, as common table expressions."""

from geoloom.model import INFRA_LABELS, LAYER_ROLES, ROOF_LABELS
from geoloom.plans.tables import BOX_CANVAS, POLY_CANVAS


def _list(values) -> str:
    return "[" + ",".join(f"'{v}'" for v in values) + "]"


PIXELS = """pixels AS (
  SELECT vec_id // 100 AS raster_id, CAST(vec_id % 100 AS INTEGER) AS r,
         CAST(i - 1 AS INTEGER) AS c, CAST(embedding[i] AS DOUBLE) AS v
  FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings))"""

MASK_ONLY = """mask AS (
  SELECT raster_id, r, c,
         CASE WHEN v > 0.18 THEN 3 WHEN v > 0.12 THEN 2 WHEN v > 0.06 THEN 1 ELSE 0 END AS class_id
  FROM pixels)"""

MASK = PIXELS + ", " + MASK_ONLY

MASK_PAIR = PIXELS + """, pair AS (
  SELECT raster_id, r, c,
         CASE WHEN v > 0.18 THEN 3 WHEN v > 0.12 THEN 2 WHEN v > 0.06 THEN 1 ELSE 0 END AS target,
         CASE WHEN v > 0.17 THEN 3 WHEN v > 0.13 THEN 2 WHEN v > 0.05 THEN 1 ELSE 0 END AS pred
  FROM pixels)"""

RGB = PIXELS + """, rgb AS (
  SELECT raster_id, r, c, b1, (b1 * 3 + r) % 256 AS b2, (b1 * 7 + c) % 256 AS b3
  FROM (SELECT raster_id, r, c,
               CAST(least(255, greatest(0, floor(v * 400 + 128))) AS INTEGER) AS b1 FROM pixels))"""

META = """meta AS (
  SELECT vec_id // 100 AS raster_id, CAST(count(*) AS INTEGER) AS height,
         CAST(max(len(embedding)) AS INTEGER) AS width,
         CASE WHEN (vec_id // 100) % 2 = 0 THEN 3 ELSE 1 END AS n_bands,
         CASE WHEN (vec_id // 100) % 3 = 0 THEN 'uint16' ELSE 'uint8' END AS dtype
  FROM embeddings GROUP BY vec_id // 100)"""

CLS_PAIR = """pair AS (
  SELECT vec_id AS item, CAST(label % 4 AS INTEGER) AS target,
         CAST((list_position(embedding, list_max(embedding)) - 1) % 4 AS INTEGER) AS pred
  FROM embeddings)"""

SCORES = """scores AS (
  SELECT vec_id AS image, CAST(i AS INTEGER) AS i, CAST((label + i) % 4 AS INTEGER) AS target,
         CAST(embedding[i * 4 + 1] AS DOUBLE) * 4 AS z1, CAST(embedding[i * 4 + 2] AS DOUBLE) * 4 AS z2,
         CAST(embedding[i * 4 + 3] AS DOUBLE) * 4 AS z3, CAST(embedding[i * 4 + 4] AS DOUBLE) * 4 AS z4
  FROM (SELECT vec_id, label, embedding, unnest(generate_series(0, 15)) AS i FROM embeddings))"""

DET = f"""det AS (
  SELECT raster_id, class_id, det_id, x1, y1, x1 + side AS x2, y1 + side AS y2, conf, l_returnflag
  FROM (SELECT l_suppkey AS raster_id, l_linenumber % 3 AS class_id,
               l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS det_id,
               CAST((l_partkey * 37 + l_linenumber * 101) % {BOX_CANVAS} AS DOUBLE) AS x1,
               CAST((l_orderkey * 53) % {BOX_CANVAS} AS DOUBLE) AS y1,
               40 + l_quantity AS side,
               CAST((l_orderkey * 31 + l_partkey * 17 + l_linenumber * 7) % 1000 AS DOUBLE) / 1000 AS conf,
               l_returnflag
        FROM lineitem))"""

TRUTH = DET + """, truth AS (
  SELECT raster_id, class_id, det_id AS gt_id,
         x1 + (det_id % 7) - 3 AS x1, y1 + (det_id % 5) - 2 AS y1,
         x2 + (det_id % 7) - 3 AS x2, y2 + (det_id % 5) - 2 AS y2
  FROM det WHERE l_returnflag = 'R')"""

OBJECTS = DET + """, objects AS (
  SELECT raster_id, det_id AS obj_id, class_id, CAST(y1 AS INTEGER) AS pr, CAST(x1 AS INTEGER) AS pc
  FROM det)"""

TRIANGLES = f"""tri AS (
  SELECT l_suppkey AS raster_id, l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS feature_id,
         l_linenumber % 3 + 1 AS layer_ord, l_linenumber % 3 + 1 AS class_id,
         CAST((l_partkey * 37) % {POLY_CANVAS - 20} AS DOUBLE) + 0.25 AS x0,
         CAST((l_orderkey * 53) % {POLY_CANVAS - 20} AS DOUBLE) + 0.25 AS y0,
         3 + l_quantity % 7 AS leg
  FROM lineitem)"""

FILES = """files AS (
  SELECT folder || '/' || name AS path, folder, name, size FROM (
    SELECT CASE (page_id // 8) % 8 WHEN 5 THEN 'data' WHEN 6 THEN 'data2/f1' WHEN 7 THEN 'data/masks'
             ELSE 'data/f' || ((page_id // 8) % 8) END AS folder,
           'village_' || (page_id // 8) || CASE page_id % 8
             WHEN 0 THEN CASE WHEN (page_id // 8) % 4 < 3 THEN '.tif' ELSE '.img' END
             WHEN 1 THEN CASE WHEN page_id % 3 = 0 THEN '_3857.ecw' ELSE '.ecw' END
             WHEN 2 THEN '.tif.pyrx' WHEN 3 THEN '.tif.aux' WHEN 4 THEN '.shp'
             WHEN 5 THEN '.dbf' WHEN 6 THEN '.shp.xml' ELSE '.shp.PC.1.lock' END AS name,
           CAST(length(html) AS BIGINT) AS size
    FROM pages))"""

LAYER_NAMES = f"""names AS (
  SELECT id, CASE d WHEN 0 THEN key WHEN 1 THEN upper(key) WHEN 2 THEN key || '_'
             WHEN 3 THEN substring(key, 1, 11) WHEN 4 THEN key || '_north' ELSE 'zzz_' || key END
             || '.shp' AS name
  FROM (SELECT p_partkey AS id, {_list(LAYER_ROLES)}[p_partkey % 12 + 1] AS key,
               (p_partkey // 12) % 6 AS d FROM part))"""


def _decorated(keys) -> str:
    return f"""SELECT id, CASE d WHEN 0 THEN key WHEN 1 THEN upper(key) || ' '
             WHEN 2 THEN 'new ' || key || ' roof' WHEN 3 THEN substring(key, 1, 3)
             WHEN 4 THEN '' ELSE 'zzz' END AS raw
  FROM (SELECT p_partkey AS id, {_list(keys)}[p_partkey % {len(keys)} + 1] AS key,
               p_partkey % 6 AS d FROM part)"""


ROOF = f"attrs AS ({_decorated(ROOF_LABELS)})"
INFRA = f"attrs AS (SELECT id, CASE WHEN id % 97 = 0 THEN '12' ELSE raw END AS raw FROM ({_decorated(INFRA_LABELS)}))"


def keyed(table: dict) -> str:
    """An ordered table as VALUES rows (ord, key, label)."""
    return ",".join(f"({i},'{k}','{v}')" for i, (k, v) in enumerate(table.items()))
