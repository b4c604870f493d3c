"""Queries: morphology, regions, composition, outlines and gradients."""

from pyspark.sql import functions as F

from geoloom.model import SEG_CLASSES
from geoloom.operators import mask as M
from geoloom.operators import vectorise as V
from geoloom.plans import sqltables as S
from geoloom.plans import tables as T
from geoloom.plans.registry import query
from geoloom.runtime import cut

BLOCK = 32
AREA, ROAD = 12, 3


def _inputs(spark, sf):
    return T.mask(spark, sf), T.raster_meta(spark, sf)


def _kernel(name: str, size: int) -> str:
    r = size // 2
    return f"""{name} AS (SELECT dy, dx FROM (SELECT unnest(range({-r}, {size - r})) AS dy) a, (SELECT unnest(range({-r}, {size - r})) AS dx) b
      WHERE abs(dx) <= round_even({r} * sqrt(({r * r} - dy * dy) / {r * r}::DOUBLE), 0))"""


def _dilate(out: str, src: str, k: str) -> str:
    return f"""{out} AS (SELECT DISTINCT m.raster_id, class_id, r - dy AS r, c - dx AS c FROM {src} m JOIN size s ON s.raster_id = m.raster_id, {k}
      WHERE r - dy BETWEEN 0 AND height - 1 AND c - dx BETWEEN 0 AND width - 1)"""


def _erode(out: str, src: str, k: str) -> str:
    return f"""{out} AS (SELECT m.raster_id, m.class_id, m.r, m.c FROM {src} m JOIN size s ON s.raster_id = m.raster_id, {k}
      LEFT JOIN {src} q ON q.raster_id = m.raster_id AND q.class_id = m.class_id AND q.r = m.r + dy AND q.c = m.c + dx
      WHERE m.r + dy BETWEEN 0 AND height - 1 AND m.c + dx BETWEEN 0 AND width - 1
      GROUP BY ALL HAVING count(*) = count(q.r))"""


_SIZE = S.META.replace("meta AS", "size AS", 1)
_MORPH = ",\n".join([
    S.MASK, _SIZE, _kernel("k7", 7), _kernel("k18", 18), _kernel("k3", 3), _kernel("k11", 11),
    *[f"m{k} AS (SELECT raster_id, class_id, r, c FROM mask WHERE class_id = {k})" for k in (1, 2, 3)],
    _dilate("b1", "m1", "k7"), _erode("b2", "b1", "k7"),
    _dilate("r1", "m2", "k18"), _dilate("r2", "r1", "k18"), _erode("r3", "r2", "k18"), _erode("r4", "r3", "k18"),
    _erode("r5", "r4", "k3"), _dilate("r6", "r5", "k3"),
    _dilate("w1", "m3", "k11"), _erode("w2", "w1", "k11"),
    "closed AS (SELECT * FROM b2 UNION ALL SELECT * FROM r6 UNION ALL SELECT * FROM w2)",
])


def _regions_sql(src: str, near: str) -> str:
    """Smallest pixel code reached, by spreading minima until nothing changes."""
    code = "(r::BIGINT * 2147483648 + c)"
    return f"""nodes AS (SELECT raster_id, class_id, r, c, {code} AS code FROM {src}),
nb AS (SELECT a.raster_id, a.class_id, a.code, b.code AS other FROM nodes a JOIN nodes b
  ON a.raster_id = b.raster_id AND a.class_id = b.class_id AND {near}),
reach AS (SELECT raster_id, class_id, code, code AS root FROM nodes
  UNION SELECT n.raster_id, n.class_id, n.other, w.root FROM reach w JOIN nb n
  ON w.raster_id = n.raster_id AND w.class_id = n.class_id AND w.code = n.code AND w.root < n.other),
lab AS (SELECT raster_id, class_id, CAST(code // 2147483648 AS INTEGER) AS r, CAST(code % 2147483648 AS INTEGER) AS c, min(root) AS region
  FROM reach GROUP BY raster_id, class_id, code)"""


_NEAR8 = "abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 AND a.code <> b.code"
_NEAR4 = "abs(a.r - b.r) + abs(a.c - b.c) = 1"
_COMPOSED = f"""{_MORPH},
px AS (SELECT raster_id, r, c, class_id AS was FROM mask),
fin AS (SELECT p.raster_id, p.r, p.c, p.was,
  bool_or(coalesce(k.class_id = 1, false)) AS n1, bool_or(coalesce(k.class_id = 2, false)) AS n2, bool_or(coalesce(k.class_id = 3, false)) AS n3
  FROM px p LEFT JOIN closed k ON k.raster_id = p.raster_id AND k.r = p.r AND k.c = p.c GROUP BY ALL),
cleaned AS (SELECT raster_id, r, c, CASE WHEN n3 THEN 3 WHEN was = 3 THEN 0 WHEN n2 THEN 2 WHEN was = 2 THEN 0
  WHEN n1 THEN 1 WHEN was = 1 THEN 0 ELSE was END AS class_id FROM fin)"""


@query("morph_close", f"WITH {_MORPH} SELECT raster_id, class_id, CAST(r AS INTEGER) AS r, CAST(c AS INTEGER) AS c FROM closed")
def morph_close(spark, sf):
    mask, meta = _inputs(spark, sf)
    return M.morphology(mask, meta, M.cleanup_steps(ROAD), BLOCK)


@query("components", f"WITH RECURSIVE {S.MASK}, fg AS (SELECT * FROM mask WHERE class_id > 0), {_regions_sql('fg', _NEAR8)} SELECT * FROM lab")
def components(spark, sf):
    return M.regions(T.mask(spark, sf).filter("class_id > 0"), 8, BLOCK)


@query("region_areas", f"""WITH RECURSIVE {S.MASK}, fg AS (SELECT * FROM mask WHERE class_id > 0), {_regions_sql('fg', _NEAR4)}
SELECT raster_id, class_id, region, count(*) AS area FROM lab GROUP BY ALL""")
def region_areas(spark, sf):
    return M.region_areas(M.regions(T.mask(spark, sf).filter("class_id > 0"), 4, BLOCK))


@query("min_area", f"""WITH RECURSIVE {S.MASK}, fg AS (SELECT * FROM mask WHERE class_id > 0), {_regions_sql('fg', _NEAR8)},
a AS (SELECT raster_id, class_id, region, count(*) AS n FROM lab GROUP BY ALL)
SELECT l.raster_id, l.class_id, l.r, l.c FROM lab l JOIN a USING (raster_id, class_id, region)
WHERE n >= CASE class_id WHEN 1 THEN 3 WHEN 2 THEN 2 ELSE 4 END""")
def min_area(spark, sf):
    labelled = M.regions(T.mask(spark, sf).filter("class_id > 0"), 8, BLOCK)
    return M.drop_small(labelled, {1: 3, 2: 2, 3: 4}).drop("region")


@query("compose_mask", f"WITH {_COMPOSED} SELECT raster_id, r, c, class_id FROM cleaned WHERE class_id > 0")
def compose_mask(spark, sf):
    mask, meta = _inputs(spark, sf)
    return M.compose(mask, M.morphology(mask, meta, M.cleanup_steps(ROAD), BLOCK))


@query("clean_mask")
def clean_mask(spark, sf):
    """The whole clean-up; its large closed regions are too slow for recursive SQL, so
    tests check it against brute force."""
    mask, meta = _inputs(spark, sf)
    return M.clean_mask(mask, meta, AREA, ROAD, BLOCK)


# Outline measures of 4-linked regions: sides shared with another class or nothing, and
# corners counted from the 2 x 2 pixels around every lattice point.
_OUTLINE = f"""{S.MASK}, fg AS (SELECT * FROM mask WHERE class_id > 0), {_regions_sql('fg', _NEAR4)},
sides AS (SELECT l.raster_id, l.class_id, l.region, count(*) AS n FROM lab l, (VALUES (0, 1), (1, 0), (0, -1), (-1, 0)) o(dy, dx)
  WHERE NOT EXISTS (SELECT 1 FROM lab q WHERE q.raster_id = l.raster_id AND q.class_id = l.class_id AND q.r = l.r + dy AND q.c = l.c + dx) GROUP BY ALL),
around AS (SELECT l.raster_id, l.class_id, l.region, l.r + dy AS y, l.c + dx AS x, sum(CASE WHEN dy = dx THEN 1 ELSE 16 END) AS s, count(*) AS n
  FROM lab l, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) o(dy, dx) GROUP BY ALL),
corners AS (SELECT raster_id, class_id, region, sum(CASE WHEN n IN (1, 3) THEN 1 WHEN n = 2 AND s IN (2, 32) THEN 2 ELSE 0 END) AS n FROM around GROUP BY ALL),
areas AS (SELECT raster_id, class_id, region, count(*) AS n FROM lab GROUP BY ALL)"""


@query("region_vectors", f"""WITH RECURSIVE {_OUTLINE}
SELECT a.raster_id, a.class_id, a.region, CAST(c.n AS BIGINT) AS corners, a.n AS area, s.n AS perimeter
FROM areas a JOIN sides s USING (raster_id, class_id, region) JOIN corners c USING (raster_id, class_id, region)""")
def region_vectors(spark, sf):
    return V.region_summary(V.ring_vertices(T.mask(spark, sf), BLOCK)).drop("rings")


@query("class_layers", f"""WITH RECURSIVE {S.MASK}, fg AS (SELECT * FROM mask WHERE class_id > 0), {_regions_sql('fg', _NEAR4)}
SELECT raster_id, ['background','building','road','waterbody'][class_id + 1] AS class_name, count(DISTINCT region) AS features FROM lab GROUP BY ALL""")
def class_layers(spark, sf):
    named = V.with_class_names(V.ring_vertices(T.mask(spark, sf), BLOCK), SEG_CLASSES)
    regions = named.select("raster_id", "class_name", "region").distinct()
    return regions.groupBy("raster_id", "class_name").agg(F.count("*").alias("features"))


@query("simplified_vectors")
def simplified_vectors(spark, sf):
    """Simplification has no SQL form; tests check it against brute force, and SQL its rings."""
    kept = V.simplify(V.ring_vertices(T.mask(spark, sf), BLOCK), 0.5, keep_topology=True, ends=True)
    return V.valid_rings(kept).drop("nx", "ny")


# Rings by Euler's number of the 2 x 2 pixels around every lattice point; none may be lost or cross.
@query("simplified_rings", f"""WITH RECURSIVE {_OUTLINE},
euler AS (SELECT raster_id, class_id, region, sum(CASE WHEN n = 1 THEN 1 WHEN n = 3 THEN -1 WHEN n = 2 AND s IN (2, 32) THEN 2 ELSE 0 END) AS e FROM around GROUP BY ALL)
SELECT raster_id, class_id, count(*) AS regions, CAST(sum(2 - e / 4) AS BIGINT) AS rings, CAST(0 AS BIGINT) AS crossings FROM euler GROUP BY ALL""")
def simplified_rings(spark, sf):
    """Regions, rings and crossing chords of the simplified outlines."""
    kept = cut(V.valid_rings(V.simplify(V.ring_vertices(T.mask(spark, sf), BLOCK), 1.5, keep_topology=True, ends=True)))
    per = kept.groupBy("raster_id", "class_id").agg(
        F.count_distinct("region").alias("regions"), F.count_distinct("region", "ring").alias("rings")
    )
    bad = V.crossing_chords(V.chords(kept)).groupBy("raster_id", "class_id").agg(F.count("*").alias("crossings"))
    return per.join(bad, ["raster_id", "class_id"], "left").fillna(0, ["crossings"])


@query("gradient", f"""WITH {S.PIXELS}, {_SIZE}, pos AS (SELECT p.raster_id, p.r, p.c, height, width, dy, dx,
    abs((height - 1) - abs((height - 1) - (p.r + dy))) AS rr, abs((width - 1) - abs((width - 1) - (p.c + dx))) AS cc
  FROM pixels p JOIN size s ON s.raster_id = p.raster_id, (SELECT unnest([-1, 0, 1]) AS dy) a, (SELECT unnest([-1, 0, 1]) AS dx) b),
g AS (SELECT o.raster_id, o.r, o.c, sqrt(pow(sum(q.v * dx * (2 - abs(dy))), 2) + pow(sum(q.v * dy * (2 - abs(dx))), 2)) AS g
  FROM pos o JOIN pixels q ON q.raster_id = o.raster_id AND q.r = o.rr AND q.c = o.cc GROUP BY ALL),
e AS (SELECT raster_id, min(g) AS lo, max(g) AS hi FROM g GROUP BY ALL)
SELECT g.raster_id, r, c, round((g - lo) / (hi - lo), 6) AS g FROM g JOIN e ON g.raster_id = e.raster_id""")
def gradient(spark, sf):
    out = M.gradient(T.pixels(spark, sf), T.raster_meta(spark, sf), "v", BLOCK)
    return out.withColumn("g", F.round("g", 6))
