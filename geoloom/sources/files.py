"""Readers and writers on shared storage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import text as X


def list_files(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """(path, folder, name, size, mtime) of every file; contents are never read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    return reader.load(root).select(
        "path", X.folder(F.col("path")).alias("folder"), X.file_name(F.col("path")).alias("name"),
        F.col("length").alias("size"), F.col("modificationTime").alias("mtime"),
    )


# -- vector layers ------------------------------------------------------------------

# Fixed value: the system of GeoJSON coordinates.
DEFAULT_CRS = "EPSG:4326"

_FEATURE = "type string, properties map<string,string>, geometry struct<type:string, coordinates:string>"
_CRS = "crs struct<properties:struct<name:string>>"


def _rings(kind: Column, coordinates: Column) -> Column:
    """Coordinates text of any geometry type as array<array<struct<x,y>>>."""
    pt, line, poly = "array<double>", "array<array<double>>", "array<array<array<double>>>"
    parse = lambda schema: F.from_json(coordinates, schema)
    nested = (
        F.when(kind == "Point", F.array(F.array(parse(pt))))
        .when(kind.isin("LineString", "MultiPoint"), F.array(parse(line)))
        .when(kind.isin("Polygon", "MultiLineString"), parse(poly))
        .when(kind == "MultiPolygon", F.flatten(parse(f"array<{poly}>")))
    )
    return F.transform(
        nested,
        lambda ring: F.transform(ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))),
    )


def read_layers(spark: SparkSession, path: str, whole_files: bool = True) -> tuple[DataFrame, DataFrame]:
    """GeoJSON layers as (features, unreadable files).

    ``whole_files`` reads feature collections, one document per file; otherwise each line
    is a feature and large files are split between tasks.  Empty layers give no rows and
    a broken file does not stop the others: every document that does not parse as a whole
    is listed with its path, whatever else of it could be read.  Coordinates are longitude
    and latitude (EPSG:4326) unless the document names another system.
    """
    if whole_files:
        inner = "type:string,properties:map<string,string>,geometry:struct<type:string,coordinates:string>"
        schema = f"features array<struct<{inner}>>, {_CRS}, _bad string"
    else:
        schema = f"{_FEATURE}, _bad string"
    raw = (
        spark.read.schema(schema).option("multiLine", str(whole_files).lower()).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{json,geojson,geojsonl}").json(path)
        .withColumn("path", F.col("_metadata.file_path"))
    )
    name = X.file_name(F.col("path"))
    broken = F.col("_bad").isNotNull()
    # The parser checks only fields that a query asks for, so every field is looked at here too.
    if whole_files:
        empty = F.col("features").isNull()
        unnamed = F.col("crs.properties.name").isNull().cast("int")
        listed = F.greatest(broken.cast("int"), empty.cast("int"), F.least(F.lit(0), unnamed)) == 1
    else:
        empty = F.col("geometry").isNull()
        fields = [F.col(c).isNull().cast("int") for c in ("type", "properties", "geometry")]
        listed = broken & (F.greatest(*fields) >= 0)
    reason = F.when(~broken, "not a feature collection").when(empty, "unreadable layer").otherwise("partly unreadable layer")
    bad = raw.filter(listed).select("path", reason.alias("reason"))
    good = raw.filter("_bad is null")
    if whole_files:
        named = F.col("crs.properties.name")
        number = F.regexp_extract(named, r"EPSG:+(?:[0-9.]*:)?(\d+)$", 1)
        # A name that is not understood stays as it is and is quarantined on placement.
        crs = (
            F.when(named.isNull() | named.rlike(r"CRS:?84$"), DEFAULT_CRS)
            .when(number != "", F.concat(F.lit("EPSG:"), number)).otherwise(named)
        )
        rows = good.select("path", crs.alias("crs"), F.posexplode("features").alias("feature_id", "f"))
    else:
        rows = good.select(
            "path", F.lit(DEFAULT_CRS).alias("crs"),
            F.xxhash64("path", "properties.id", "geometry.coordinates").alias("feature_id"),
            F.struct("type", "properties", "geometry").alias("f"),
        )
    return rows.select(
        X.folder(F.col("path")).alias("folder"), name.alias("layer"), F.col("feature_id").cast("bigint"),
        F.col("f.geometry.type").alias("geom_type"), _rings(F.col("f.geometry.type"), F.col("f.geometry.coordinates")).alias("rings"),
        F.col("f.properties").alias("attrs"), "crs",
    ), bad


def attribute(column: str) -> Column:
    """A layer attribute, null where the layer has no such column."""
    return F.try_element_at(F.col("attrs"), F.lit(column))


# -- rasters --------------------------------------------------------------------------


def write_pixels(pixels: DataFrame, path: str, block: int = 256) -> None:
    """Pixels partitioned by raster and ordered by block, so window reads skip row groups.

    A raster is spread over tasks by block row; one task does not write a whole raster.
    """
    keyed = pixels.withColumn("block_r", F.floor(F.col("r") / block)).withColumn("block_c", F.floor(F.col("c") / block))
    (
        keyed.repartition("raster_id", "block_r").sortWithinPartitions("raster_id", "block_r", "block_c")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("raster_id").parquet(path)
    )


def read_window(spark: SparkSession, path: str, raster_id: int, r1: int, r2: int, c1: int, c2: int, block: int = 256) -> DataFrame:
    """One box of one raster: partition pruning on the raster, statistics on the blocks."""
    return spark.read.parquet(path).filter(
        (F.col("raster_id") == raster_id)
        & F.col("block_r").between(r1 // block, (r2 - 1) // block) & F.col("block_c").between(c1 // block, (c2 - 1) // block)
        & (F.col("r") >= r1) & (F.col("r") < r2) & (F.col("c") >= c1) & (F.col("c") < c2)
    ).drop("block_r", "block_c")


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """One folder per value of ``by`` (raster, label or class); only those present are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_combined(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


# -- labels and features ------------------------------------------------------------------


def write_label_lines(lines: DataFrame, path: str, files: int = 16) -> None:
    """One row (raster_id, name, text) per tile in ``files`` files: all its lines in object order.

    Negatives hold an empty text.  ``read_label_text`` gives the text file of one tile; a
    folder or file for each of millions of tiles would overload the storage's listing.
    """
    from geoloom.operators.labels import label_texts

    label_texts(lines).repartitionByRange(files, "raster_id", "name").sortWithinPartitions("raster_id", "name").write.mode(
        "overwrite"
    ).parquet(path)


def read_label_text(spark: SparkSession, path: str, raster_id: int, name: str) -> DataFrame:
    """The text of one tile; the order of the files prunes all others."""
    return spark.read.parquet(path).filter((F.col("raster_id") == raster_id) & (F.col("name") == name)).select("text")


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.write.mode("overwrite").json(path)


def point_features(points: DataFrame) -> DataFrame:
    """Point rows as GeoJSON features, one JSON document per line."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array("x", "y").alias("coordinates")).alias("geometry"),
        F.struct(*[c for c in points.columns if c not in ("x", "y")]).alias("properties"),
    )
    return points.select(F.to_json(feature).alias("value"))


def write_points(points: DataFrame, path: str) -> None:
    point_features(points).write.mode("overwrite").text(path)
