"""Inputs of the registered queries, derived row by row from the given tables.

Every recipe keeps all rows of its source table; only arithmetic on columns turns
them into pixels, boxes, polygons, files and histories.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.model import INFRA_LABELS, LAYER_ROLES, ROOF_LABELS

# Size of the derived rasters.
EMB_HEIGHT, EMB_WIDTH = 100, 64
BOX_CANVAS = 2000
POLY_CANVAS = 240


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _pick(values, index: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.expr(index).cast("int"))


# -- rasters from embeddings ---------------------------------------------------


def pixels(spark: SparkSession, sf: str) -> DataFrame:
    """(raster_id, r, c, v): one row of 64 pixels per vector, 100 vectors per raster."""
    return table(spark, sf, "embeddings").select(
        F.expr("vec_id div 100").alias("raster_id"),
        F.expr("cast(vec_id % 100 as int)").alias("r"),
        F.posexplode("embedding").alias("c", "e"),
    ).select("raster_id", "r", "c", F.col("e").cast("double").alias("v"))


def rgb(spark: SparkSession, sf: str) -> DataFrame:
    """(raster_id, r, c, b1, b2, b3) with values 0..255."""
    return pixels(spark, sf).selectExpr(
        "raster_id", "r", "c", "cast(least(255, greatest(0, floor(v * 400 + 128))) as int) as b1"
    ).selectExpr("*", "(b1 * 3 + r) % 256 as b2", "(b1 * 7 + c) % 256 as b3")


def raster_meta(spark: SparkSession, sf: str) -> DataFrame:
    """Extent of every raster with a mixed band count and data type."""
    return (
        table(spark, sf, "embeddings")
        .groupBy(F.expr("vec_id div 100").alias("raster_id"))
        .agg(
            F.count("*").cast("int").alias("height"),
            F.max(F.size("embedding")).alias("width"),
        )
        .withColumn("n_bands", F.expr("cast(if(raster_id % 2 = 0, 3, 1) as int)"))
        .withColumn("dtype", F.expr("if(raster_id % 3 = 0, 'uint16', 'uint8')"))
    )


def mask_class(v: Column) -> Column:
    return F.when(v > 0.18, 3).when(v > 0.12, 2).when(v > 0.06, 1).otherwise(0)


def mask(spark: SparkSession, sf: str) -> DataFrame:
    """(raster_id, r, c, class_id) for every pixel."""
    return pixels(spark, sf).select("raster_id", "r", "c", mask_class(F.col("v")).alias("class_id"))


def mask_pair(spark: SparkSession, sf: str) -> DataFrame:
    """Target and predicted class of every pixel; the prediction uses shifted thresholds."""
    v = F.col("v")
    pred = F.when(v > 0.17, 3).when(v > 0.13, 2).when(v > 0.05, 1).otherwise(0)
    return pixels(spark, sf).select(
        "raster_id", "r", "c", mask_class(v).alias("target"), pred.alias("pred")
    )


def cls_pair(spark: SparkSession, sf: str) -> DataFrame:
    """(item, target, pred) of a four-class classifier."""
    best = F.array_position(F.col("embedding"), F.array_max("embedding")) - 1
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("item"),
        (F.col("label") % 4).cast("int").alias("target"),
        (best % 4).cast("int").alias("pred"),
    )


def class_scores(spark: SparkSession, sf: str) -> DataFrame:
    """(image, i, target, z1..z4): sixteen four-class score vectors per image."""
    e = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("image"), "label", "embedding", F.explode(F.expr("sequence(0, 15)")).alias("i")
    )
    score = lambda k: F.element_at("embedding", F.col("i") * 4 + k).cast("double") * 4
    return e.select(
        "image",
        "i",
        ((F.col("label") + F.col("i")) % 4).cast("int").alias("target"),
        *[score(k).alias(f"z{k}") for k in (1, 2, 3, 4)],
    )


# -- boxes, objects and polygons from line items --------------------------------


def detections(spark: SparkSession, sf: str) -> DataFrame:
    """(raster_id, class_id, det_id, x1, y1, x2, y2, conf); (raster_id, det_id) is the key."""
    return table(spark, sf, "lineitem").selectExpr(
        "l_suppkey as raster_id",
        "l_linenumber % 3 as class_id",
        "l_orderkey * 1000000 + l_partkey * 10 + l_linenumber as det_id",
        f"cast((l_partkey * 37 + l_linenumber * 101) % {BOX_CANVAS} as double) as x1",
        f"cast((l_orderkey * 53) % {BOX_CANVAS} as double) as y1",
        "40 + l_quantity as side",
        "((l_orderkey * 31 + l_partkey * 17 + l_linenumber * 7) % 1000) / 1000D as conf",
        "l_returnflag",
    ).selectExpr(
        "raster_id", "class_id", "det_id", "x1", "y1", "x1 + side as x2", "y1 + side as y2",
        "conf", "l_returnflag",
    )


def truth(spark: SparkSession, sf: str) -> DataFrame:
    """Ground-truth boxes: the returned items, moved by a few pixels."""
    return detections(spark, sf).filter("l_returnflag = 'R'").selectExpr(
        "raster_id", "class_id", "det_id as gt_id",
        "x1 + (det_id % 7) - 3 as x1", "y1 + (det_id % 5) - 2 as y1",
        "x2 + (det_id % 7) - 3 as x2", "y2 + (det_id % 5) - 2 as y2",
    )


def objects(spark: SparkSession, sf: str) -> DataFrame:
    """(raster_id, obj_id, class_id, pr, pc): labelled points in 2000 x 2000 rasters."""
    return detections(spark, sf).selectExpr(
        "raster_id", "det_id as obj_id", "class_id", "cast(y1 as int) as pr", "cast(x1 as int) as pc"
    )


def triangles(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    """Features: right triangles whose edges miss every pixel centre.

    ``extra`` columns of the line items are passed through.
    """
    p = lambda x, y: F.struct(F.expr(x).alias("x"), F.expr(y).alias("y"))
    ring = F.array(p("x0", "y0"), p("x0 + leg", "y0"), p("x0", "y0 + leg"), p("x0", "y0"))
    return table(spark, sf, "lineitem").selectExpr(
        "l_suppkey as raster_id",
        "l_orderkey * 1000000 + l_partkey * 10 + l_linenumber as feature_id",
        "l_linenumber % 3 + 1 as layer_ord",
        f"(l_partkey * 37) % {POLY_CANVAS - 20} + 0.25D as x0",
        f"(l_orderkey * 53) % {POLY_CANVAS - 20} + 0.25D as y0",
        "3 + l_quantity % 7 as leg",
        *extra,
    ).select(
        *extra, "raster_id", "feature_id", "layer_ord", F.col("layer_ord").alias("class_id"),
        F.lit("Polygon").alias("geom_type"), F.array(ring).alias("rings"),
    )


# -- files, names and attributes -------------------------------------------------


def files(spark: SparkSession, sf: str) -> DataFrame:
    """File listing: one file per page."""
    ext = """case cast(page_id % 8 as int)
        when 0 then if((page_id div 8) % 4 < 3, '.tif', '.img')
        when 1 then if(page_id % 3 = 0, '_3857.ecw', '.ecw')
        when 2 then '.tif.pyrx' when 3 then '.tif.aux' when 4 then '.shp'
        when 5 then '.dbf' when 6 then '.shp.xml' else '.shp.PC.1.lock' end"""
    return table(spark, sf, "pages").selectExpr(
        # Besides five data folders: the root itself, a sibling whose name begins like it, and a derived folder.
        """case cast((page_id div 8) % 8 as int) when 5 then 'data' when 6 then 'data2/f1' when 7 then 'data/masks'
           else 'data/f' || ((page_id div 8) % 8) end as folder""",
        f"'village_' || (page_id div 8) || {ext} as name",
        "cast(length(html) as bigint) as size",
    ).selectExpr("folder || '/' || name as path", "folder", "name", "size")


def layer_names(spark: SparkSession, sf: str) -> DataFrame:
    """(id, name): layer file names with case, suffix and truncation variants."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), _pick(LAYER_ROLES, "p_partkey % 12 + 1").alias("key"),
        F.expr("(p_partkey div 12) % 6").alias("d"),
    ).selectExpr(
        "id",
        """case d when 0 then key when 1 then upper(key) when 2 then key || '_'
           when 3 then substring(key, 1, 11) when 4 then key || '_north' else 'zzz_' || key end
           || '.shp' as name""",
    )


def _decorated(spark: SparkSession, sf: str, keys, out: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), _pick(keys, f"p_partkey % {len(keys)} + 1").alias("key"),
        F.expr("p_partkey % 6").alias("d"),
    ).selectExpr(
        "id",
        f"""case d when 0 then key when 1 then upper(key) || ' ' when 2 then 'new ' || key || ' roof'
            when 3 then substring(key, 1, 3) when 4 then '' else 'zzz' end as {out}""",
    )


def roof_attrs(spark: SparkSession, sf: str) -> DataFrame:
    return _decorated(spark, sf, ROOF_LABELS, "raw")


def infra_attrs(spark: SparkSession, sf: str) -> DataFrame:
    return _decorated(spark, sf, INFRA_LABELS, "raw").selectExpr(
        "id", "if(id % 97 = 0, '12', raw) as raw"
    )


def history(spark: SparkSession, sf: str) -> DataFrame:
    """(run_id, ts, step, metric): one run per user, ordered by time."""
    return table(spark, sf, "events").selectExpr(
        "user_id as run_id", "ts", "event_id as step", "value as metric"
    )
