"""File inventory, layer and attribute mapping, folder summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions import text as X
from geoloom.functions.geometry import let
from geoloom.model import (
    CANDIDATE_SUFFIXES,
    INFRA_CLASSES,
    INFRA_LABELS,
    LAYER_PREFIX_LEN,
    LAYER_ROLES,
    LAYER_SIDECARS,
    RASTER_SUFFIXES,
    ROOF_LABELS,
)


def classify_files(files: DataFrame) -> DataFrame:
    """Add ``suffix``, ``stem``, ``kind`` and ``skip_reason`` to (folder, name, size).

    One projection; only the duplicate check of compressed rasters, ``drop_duplicate_sources``,
    needs a join.
    """
    name = F.col("name")
    low = F.lower(name)
    suffix = X.suffix(name)
    reason = (
        F.when(X.is_lock(name), "LOCK")
        .when(low.contains(".pyrx"), "PYRX")
        .when(low.endswith(".aux") | low.endswith(".aux.xml"), "AUX")
        .when(suffix.isin(*LAYER_SIDECARS) | low.contains(".shp.xml"), "SIDECAR")
    )
    return (
        files.withColumn("suffix", suffix)
        .withColumn("stem", X.stem(name))
        .withColumn("skip_reason", reason)
        .withColumn(
            "kind",
            F.when(F.col("skip_reason").isNotNull(), "skipped")
            .when(F.col("suffix") == ".shp", "layer")
            .when(F.col("suffix").isin(*RASTER_SUFFIXES), "raster")
            .otherwise("other"),
        )
    )


def drop_duplicate_sources(inventory: DataFrame) -> DataFrame:
    """Mark a compressed raster as ECW_DUP when an uncompressed one has its stem.

    The stem is compared as it is and without ``_3857``.  Both keys of a row go
    through one equi-join with the distinct stems of the same folder.
    """
    tif = (
        inventory.filter(F.col("suffix").isin(".tif", ".tiff"))
        .select("folder", F.lower("stem").alias("key"))
        .distinct()
    )
    ecw = inventory.filter((F.col("suffix") == ".ecw") & (F.col("kind") == "raster"))
    low = F.lower("stem")
    keyed = ecw.select(
        "folder", "name", F.explode(F.array_distinct(F.array(low, F.replace(low, F.lit("_3857"), F.lit(""))))).alias("key")
    )
    hits = keyed.join(tif, ["folder", "key"], "left_semi").select("folder", "name").distinct()
    marked = inventory.join(hits.withColumn("dup", F.lit(True)), ["folder", "name"], "left")
    dup = F.coalesce("dup", F.lit(False))
    return marked.withColumn(
        "kind", F.when(dup, "skipped").otherwise(F.col("kind"))
    ).withColumn("skip_reason", F.when(dup, "ECW_DUP").otherwise(F.col("skip_reason"))).drop("dup")


def inventory_summary(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("kind", "skip_reason").agg(
        F.count("*").alias("n"), F.sum("size").alias("bytes")
    )


# Folders written by the workflow itself.
DERIVED_FOLDERS = ("patches", "patch_masks", "building_crops", "yolo_infra", "masks")


def candidate_folders(files: DataFrame, root: str, without_derived: bool = False) -> DataFrame:
    """The root and its direct subfolders that hold a raster.

    ``without_derived`` leaves out the root and the folders the workflow itself writes, as
    the search for detection data does.
    """
    parent = F.regexp_extract("folder", r"^(.*)/[^/]*$", 1)
    leaf = F.regexp_extract("folder", r"([^/]*)$", 1)
    near = (parent == root) & ~leaf.isin(*DERIVED_FOLDERS) if without_derived else (F.col("folder") == root) | (parent == root)
    is_raster = X.suffix(F.col("name")).isin(*CANDIDATE_SUFFIXES)
    return (
        files.filter(near)
        .groupBy("folder")
        .agg(F.count_if(is_raster).alias("rasters"))
        .filter("rasters > 0")
    )


def rasters_below(files: DataFrame, root: str) -> DataFrame:
    """All ``.tif`` and ``.tiff`` files at any depth, without lock and pyramid files."""
    low = F.lower("name")
    return files.filter(
        ((F.col("folder") == root) | F.col("folder").startswith(root.rstrip("/") + "/"))
        & X.suffix(F.col("name")).isin(".tif", ".tiff")
        & ~low.contains(".pyrx")
        & ~low.contains(".lock")
    )


def layer_role(name: Column) -> Column:
    """struct<class_id, attr_col> of a layer file: exact stem, else first key whose
    leading characters start the stem; null when nothing fits."""
    roles = F.array(
        *[
            F.struct(
                F.lit(key).alias("key"), F.lit(class_id).alias("class_id"), F.lit(attr).alias("attr_col")
            )
            for key, (class_id, attr) in LAYER_ROLES.items()
        ]
    )
    exact = lambda stem: F.get(F.filter(roles, lambda d: d["key"] == stem), 0)
    prefix = lambda stem: F.get(
        F.filter(roles, lambda d: F.startswith(stem, F.substring(d["key"], 1, LAYER_PREFIX_LEN))), 0
    )
    return let(X.layer_stem(name), lambda stem: F.coalesce(exact(stem), prefix(stem)))


def with_layer_role(layers: DataFrame, segmentation_only: bool = False) -> DataFrame:
    out = layers.withColumn("role", layer_role(F.col("name"))).filter("role is not null")
    out = out.select(*layers.columns, "role.class_id", "role.attr_col")
    return out.filter("class_id != 0") if segmentation_only else out


def roof_label(raw: Column) -> Column:
    """Exact, else containment either way in table order, else ``Other``."""
    return let(X.clean_attr(raw, "other"), lambda value: F.coalesce(
        X.exact_match(value, ROOF_LABELS), X.first_contained(value, ROOF_LABELS, True), F.lit("Other")
    ))


def infra_label(raw: Column) -> Column:
    """Exact, else first key inside the value, else null (the row is dropped)."""
    return let(X.clean_attr(raw, ""), lambda value: F.coalesce(
        X.exact_match(value, INFRA_LABELS), X.first_contained(value, INFRA_LABELS, False)
    ))


def class_index(name: Column, names: tuple[str, ...]) -> Column:
    """Position of a class name, null when unknown."""
    pos = F.array_position(F.array(*[F.lit(n.lower()) for n in names]), name)
    return F.when(pos > 0, pos - 1).cast("int")


def infra_objects(attrs: DataFrame, raw: str = "raw") -> DataFrame:
    """Rows with a known infrastructure class, with ``class_name`` and ``class_id``."""
    named = attrs.withColumn("class_name", infra_label(F.col(raw)))
    return named.withColumn("class_id", class_index(F.col("class_name"), INFRA_CLASSES)).filter(
        "class_id is not null"
    )


def discovered_classes(attrs: DataFrame, raw: str = "raw") -> DataFrame:
    """Distinct class names: mapped by the exact lower-case value, else the value itself.

    The configured classes stand in when there is no value at all.
    """
    value = F.col(raw)
    found = attrs.filter(value.isNotNull()).select(
        F.coalesce(X.exact_match(F.lower(value), INFRA_LABELS), value).alias("class_name")
    ).distinct()
    spark = attrs.sparkSession
    names = spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in INFRA_CLASSES])).alias("class_name"))
    present = found.limit(1).select(F.lit(1).alias("present"))
    fallback = names.join(present, F.lit(True), "left_anti")
    return found.unionByName(fallback)


def selected_layers(layers: DataFrame) -> DataFrame:
    """The layers a folder contributes: buildings by priority name, and all utilities.

    A stem that occurs twice in a folder keeps its last file.
    """
    stem = X.layer_stem(F.col("name"))
    by_stem = layers.groupBy("folder", stem.alias("layer_stem")).agg(F.max("name").alias("name"))
    prio = F.when(F.col("layer_stem") == "built_up_area_type", 0).when(
        F.col("layer_stem") == "built_up_area_typ", 1
    )
    buildings = (
        by_stem.withColumn("prio", prio)
        .filter("prio is not null")
        .groupBy("folder")
        .agg(F.min_by(F.struct("layer_stem", "name"), "prio").alias("pick"))
        .select("folder", "pick.layer_stem", "pick.name", F.lit("buildings").alias("use"))
    )
    utilities = by_stem.filter(F.col("layer_stem").startswith("utility")).select(
        "folder", "layer_stem", "name", F.lit("utilities").alias("use")
    )
    return buildings.unionByName(utilities)


def folder_totals(results: DataFrame, measures: list[str]) -> DataFrame:
    """Sums per folder and the grand total (folder is null) in one rollup.

    ``results`` has one row per raster with ``status`` and the measures; failed
    rasters count as failures and contribute nothing else.
    """
    ok = F.col("status") == "ok"
    return results.rollup("folder").agg(
        F.count_if(ok).alias("rasters"),
        F.count_if(~ok).alias("failed"),
        *[F.coalesce(F.sum(F.when(ok, F.col(m))), F.lit(0)).alias(m) for m in measures],
    )


def status_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("n"))


def extraction_counts(tiles: DataFrame, name: str = "name") -> DataFrame:
    """Tiles, negative tiles (told by their name prefix) and objects in one row."""
    negative = F.col(name).startswith("infra_neg_")
    return tiles.agg(
        F.count("*").alias("tiles"),
        F.count_if(negative).alias("negatives"),
        F.coalesce(F.sum("n_objects"), F.lit(0)).alias("objects"),
    )


def layer_files(inventory: DataFrame) -> DataFrame:
    return inventory.filter("kind = 'layer'")


def shared_layers(rasters: DataFrame, layers: DataFrame) -> DataFrame:
    """Every raster of a folder with every layer of that folder."""
    return rasters.join(layers, "folder")


def latest_by(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the greatest ``order`` per key, by partial aggregation."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("row"))
    return picked.select(*keys, "row.*")


