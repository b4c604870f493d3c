"""Queries: files, layers, attributes and batch summaries."""

from pyspark.sql import functions as F

from geoloom.functions import text as X
from geoloom.model import INFRA_LABELS, LAYER_ROLES, ROOF_LABELS
from geoloom.operators import inventory as I
from geoloom.plans import sqltables as S
from geoloom.plans import tables as T
from geoloom.plans.registry import query

_INV = S.FILES + r""", a AS (
  SELECT *, lower(regexp_extract(name, '[^.](\.[^.]+)$', 1)) AS suffix,
         regexp_replace(name, '([^.])\.[^.]+$', '\1') AS stem, lower(name) AS low FROM files),
b AS (SELECT *, CASE
    WHEN regexp_matches(low, '\.shp\..+\.lock$|\.shp\.ed\.lock$|\.tif\.pyrx$|\.ecw\.aux$|\.tif\.aux$|\.tif\.aux\.xml$') THEN 'LOCK'
    WHEN contains(low, '.pyrx') THEN 'PYRX'
    WHEN suffix = '.aux' OR ends_with(low, '.aux.xml') THEN 'AUX'
    WHEN suffix IN ('.dbf','.prj','.shx','.sbn','.sbx','.cpg','.xml') THEN 'SIDECAR' END AS reason FROM a),
d AS (SELECT *, reason IS NULL AND suffix = '.ecw' AND EXISTS (
        SELECT 1 FROM a t WHERE t.suffix IN ('.tif', '.tiff') AND t.folder = b.folder
          AND (lower(t.stem) = lower(b.stem) OR lower(t.stem) = replace(lower(b.stem), '_3857', ''))) AS dup FROM b),
inv AS (SELECT folder, name, size, suffix, stem, CASE WHEN dup THEN 'ECW_DUP' ELSE reason END AS skip_reason,
        CASE WHEN dup OR reason IS NOT NULL THEN 'skipped' WHEN suffix = '.shp' THEN 'layer'
             WHEN suffix IN ('.tif','.tiff','.ecw','.img','.vrt','.jp2') THEN 'raster' ELSE 'other' END AS kind FROM d)"""


def _inventory(spark, sf):
    return I.drop_duplicate_sources(I.classify_files(T.files(spark, sf)))


@query("file_inventory", f"WITH {_INV} SELECT folder, name, size, kind, skip_reason FROM inv")
def file_inventory(spark, sf):
    return _inventory(spark, sf).select("folder", "name", "size", "kind", "skip_reason")


@query("inventory_summary", f"WITH {_INV} SELECT kind, skip_reason, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes FROM inv GROUP BY ALL")
def inventory_summary(spark, sf):
    return I.inventory_summary(_inventory(spark, sf))


@query("ecw_dedup", f"WITH {_INV} SELECT folder, name, skip_reason IS NULL AS kept FROM inv WHERE suffix = '.ecw'")
def ecw_dedup(spark, sf):
    return _inventory(spark, sf).filter("suffix = '.ecw'").select(
        "folder", "name", F.col("skip_reason").isNull().alias("kept")
    )


@query("candidate_folders", f"""WITH {_INV} SELECT folder, count(*) FILTER (suffix IN ('.tif','.tiff','.ecw','.img')) AS rasters
FROM inv WHERE folder = 'data' OR regexp_matches(folder, '^data/[^/]*$') GROUP BY folder
HAVING count(*) FILTER (suffix IN ('.tif','.tiff','.ecw','.img')) > 0""")
def candidate_folders(spark, sf):
    return I.candidate_folders(T.files(spark, sf), "data")


@query("detection_folders", f"""WITH {_INV} SELECT folder, count(*) FILTER (suffix IN ('.tif','.tiff','.ecw','.img')) AS rasters
FROM inv WHERE regexp_matches(folder, '^data/[^/]*$') AND folder NOT IN ('data/patches', 'data/patch_masks', 'data/building_crops', 'data/yolo_infra', 'data/masks')
GROUP BY folder HAVING count(*) FILTER (suffix IN ('.tif','.tiff','.ecw','.img')) > 0""")
def detection_folders(spark, sf):
    return I.candidate_folders(T.files(spark, sf), "data", without_derived=True)


@query("recursive_rasters", f"""WITH {_INV} SELECT folder, name FROM inv WHERE suffix IN ('.tif', '.tiff')
  AND (folder = 'data' OR starts_with(folder, 'data/'))""")
def recursive_rasters(spark, sf):
    return I.rasters_below(T.files(spark, sf), "data").select("folder", "name")


_ROLES = ",".join(f"({i},'{k}',{c},'{a}')" for i, (k, (c, a)) in enumerate(LAYER_ROLES.items()))
_ROLE_SQL = S.LAYER_NAMES + rf""", roles(ord, key, class_id, attr_col) AS (VALUES {_ROLES}),
s AS (SELECT id, name, regexp_replace(lower(regexp_replace(name, '\.shp$', '')), '_+$', '') AS stem FROM names),
hit AS (SELECT id, name, class_id, attr_col, row_number() OVER (
          PARTITION BY id ORDER BY CASE WHEN stem = key THEN 0 ELSE 1 END, ord) AS rn
        FROM s JOIN roles ON stem = key OR starts_with(stem, substring(key, 1, 10))),
role AS (SELECT id, name, class_id, attr_col FROM hit WHERE rn = 1)"""


@query("layer_roles", f"WITH {_ROLE_SQL} SELECT * FROM role")
def layer_roles(spark, sf):
    return I.with_layer_role(T.layer_names(spark, sf)).select("id", "name", "class_id", "attr_col")


@query("segmentation_layers", f"WITH {_ROLE_SQL} SELECT class_id, count(*) AS n FROM role WHERE class_id <> 0 GROUP BY class_id")
def segmentation_layers(spark, sf):
    roles = I.with_layer_role(T.layer_names(spark, sf), segmentation_only=True)
    return roles.groupBy("class_id").agg(F.count("*").alias("n"))


@query("layer_selection", rf"""WITH {S.LAYER_NAMES},
s AS (SELECT 'data/f' || (id % 5) AS folder, regexp_replace(lower(regexp_replace(name, '\.shp$', '')), '_+$', '') AS layer_stem, name FROM names),
u AS (SELECT folder, layer_stem, max(name) AS name FROM s GROUP BY ALL),
p AS (SELECT *, CASE layer_stem WHEN 'built_up_area_type' THEN 0 WHEN 'built_up_area_typ' THEN 1 END AS prio FROM u)
SELECT folder, layer_stem, name, 'buildings' AS use FROM p WHERE prio IS NOT NULL
  AND prio = (SELECT min(prio) FROM p q WHERE q.folder = p.folder)
UNION ALL SELECT folder, layer_stem, name, 'utilities' FROM u WHERE starts_with(layer_stem, 'utility')""")
def layer_selection(spark, sf):
    layers = T.layer_names(spark, sf).selectExpr("'data/f' || (id % 5) as folder", "name")
    return I.selected_layers(layers)


@query("shared_layers", f"""WITH {_INV} SELECT r.folder, r.name AS raster, count(*) AS layers
FROM inv r JOIN inv l ON r.folder = l.folder AND r.kind = 'raster' AND l.kind = 'layer' GROUP BY ALL""")
def shared_layers(spark, sf):
    inv = _inventory(spark, sf)
    rasters = inv.filter("kind = 'raster'").select("folder", F.col("name").alias("raster"))
    # Layers are counted per folder first: the pairs themselves are never needed here.
    layers = I.layer_files(inv).groupBy("folder").agg(F.count("*").alias("layers"))
    return I.shared_layers(rasters, layers)


def _attr_sql(base: str, table: dict, both: bool, default: str) -> str:
    contained = "contains(v, key)" + (" OR contains(key, v)" if both else "")
    return base + rf""", dims(ord, key, label) AS (VALUES {S.keyed(table)}),
v AS (SELECT id, raw, regexp_replace(lower(coalesce(nullif(raw, ''), '{default}')), '^\s+|\s+$', '', 'g') AS v FROM attrs),
hit AS (SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY CASE WHEN v = key THEN 0 ELSE 1 END, ord) AS rn
        FROM v JOIN dims ON v = key OR {contained}),
lab AS (SELECT v.id, v.raw, hit.label FROM v LEFT JOIN hit ON v.id = hit.id AND rn = 1)"""


@query("roof_labels", f"WITH {_attr_sql(S.ROOF, ROOF_LABELS, True, 'other')} SELECT id, raw, coalesce(label, 'Other') AS label FROM lab")
def roof_labels(spark, sf):
    return T.roof_attrs(spark, sf).select("id", "raw", I.roof_label(F.col("raw")).alias("label"))


@query("infra_labels", f"""WITH {_attr_sql(S.INFRA, INFRA_LABELS, False, '')}
SELECT id, raw, label AS class_name, CASE label WHEN 'transformer' THEN 0 WHEN 'overhead_tank' THEN 1 ELSE 2 END AS class_id
FROM lab WHERE label IS NOT NULL""")
def infra_labels(spark, sf):
    return I.infra_objects(T.infra_attrs(spark, sf)).select("id", "raw", "class_name", "class_id")


@query("class_discovery", f"""WITH {S.INFRA}, dims(ord, key, label) AS (VALUES {S.keyed(INFRA_LABELS)})
SELECT DISTINCT coalesce(label, raw) AS class_name FROM attrs LEFT JOIN dims ON lower(raw) = key""")
def class_discovery(spark, sf):
    return I.discovered_classes(T.infra_attrs(spark, sf)).orderBy("class_name")


@query("safe_names", r"""SELECT doc_id, substring(regexp_replace(text, '[^\p{L}\p{M}\p{N}_]', '_', 'g'), 1, 40) AS long_name,
  substring(regexp_replace(text, '[^\p{L}\p{M}\p{N}_]', '_', 'g'), 1, 20) AS short_name FROM documents""")
def safe_names(spark, sf):
    return T.table(spark, sf, "documents").select(
        "doc_id", X.safe_name(F.col("text"), 40).alias("long_name"), X.safe_name(F.col("text"), 20).alias("short_name")
    )


# One raster per order: its status and yields.
_RESULTS = """results AS (SELECT 'f' || (o_custkey % 7) AS folder, CASE o_orderstatus WHEN 'P' THEN 'failed' ELSE 'ok' END AS status,
  CAST(floor(o_totalprice) AS BIGINT) % 100 AS patches, o_orderkey % 13 AS crops, o_custkey % 5 AS infra FROM orders)"""


def _results(spark, sf):
    return T.table(spark, sf, "orders").selectExpr(
        "'f' || (o_custkey % 7) as folder", "if(o_orderstatus = 'P', 'failed', 'ok') as status",
        "floor(o_totalprice) % 100 as patches", "o_orderkey % 13 as crops", "o_custkey % 5 as infra",
    )


@query("folder_summary", f"""WITH {_RESULTS} SELECT folder, count(*) FILTER (status = 'ok') AS rasters,
  count(*) FILTER (status <> 'ok') AS failed, CAST(sum(CASE WHEN status = 'ok' THEN patches ELSE 0 END) AS BIGINT) AS patches,
  CAST(sum(CASE WHEN status = 'ok' THEN crops ELSE 0 END) AS BIGINT) AS crops,
  CAST(sum(CASE WHEN status = 'ok' THEN infra ELSE 0 END) AS BIGINT) AS infra FROM results GROUP BY ROLLUP (folder)""")
def folder_summary(spark, sf):
    return I.folder_totals(_results(spark, sf), ["patches", "crops", "infra"])


@query("batch_status", f"WITH {_RESULTS} SELECT status, count(*) AS n FROM results GROUP BY status")
def batch_status(spark, sf):
    return I.status_counts(_results(spark, sf))
