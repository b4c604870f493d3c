"""Schemas, fixed dimension values and parameters shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

FEATURE_SCHEMA = (
    "folder string, layer string, feature_id bigint, geom_type string, "
    "rings array<array<struct<x:double,y:double>>>, attrs map<string,string>, crs string"
)
RASTER_META_SCHEMA = (
    "raster_id bigint, folder string, width int, height int, n_bands int, dtype string, "
    "crs string, affine struct<a:double,b:double,c:double,d:double,e:double,f:double>"
)

# Layer name -> (class id, attribute column), in match order.
LAYER_ROLES = {
    "built_up_area_type": (1, "type"),
    "built_up_area_typ": (1, "type"),
    "road": (2, "road_type"),
    "road_centre_line": (2, "road_type"),
    "water_body": (3, "water_type"),
    "water_body_line": (3, "water_type"),
    "waterbody_point": (3, "water_type"),
    "bridge": (2, "bridge_type"),
    "railway": (2, "railway_type"),
    "utility": (0, "utility_type"),
    "utility_poly": (0, "utility_type"),
    "utility_poly_": (0, "utility_type"),
}
LAYER_PREFIX_LEN = 10

# Raw roof attribute -> label, in match order.
ROOF_LABELS = {
    "pucca_rcc": "RCC",
    "rcc": "RCC",
    "pucca_rcc_slab": "RCC",
    "rcc_slab": "RCC",
    "pucca_tiled": "Tiled",
    "tiled": "Tiled",
    "mangalore_tile": "Tiled",
    "pucca_tin": "Tin",
    "tin": "Tin",
    "galvanized": "Tin",
    "pucca_asbestos": "Tin",
    "asbestos": "Tin",
    "semi_pucca": "Other",
    "kuccha": "Other",
    "other": "Other",
    "others": "Other",
    "1": "RCC",
    "2": "Tiled",
    "3": "Tin",
    "4": "Other",
}

# Raw infrastructure attribute -> class name, in match order.
INFRA_LABELS = {
    "electric_transformer": "transformer",
    "transformer": "transformer",
    "electrical_transformer": "transformer",
    "overhead_water_tank": "overhead_tank",
    "water_tank": "overhead_tank",
    "overhead_tank": "overhead_tank",
    "hand_pump": "well",
    "well": "well",
    "tube_well": "well",
    "1": "transformer",
    "2": "well",
    "3": "overhead_tank",
    "11": "transformer",
    "14": "well",
}

# Class names in id order.
SEG_CLASSES = ("background", "building", "road", "waterbody")
ROOF_CLASSES = ("RCC", "Tiled", "Tin", "Other")
INFRA_CLASSES = ("transformer", "overhead_tank", "well")

# Half size of a labelled object in pixels.
CLASS_BUFFER_PX = {"transformer": 60, "overhead_tank": 50, "well": 25}
DEFAULT_BUFFER_PX = 20

# File names.
RASTER_SUFFIXES = (".tif", ".tiff", ".ecw", ".img", ".vrt", ".jp2")
CANDIDATE_SUFFIXES = (".tif", ".tiff", ".ecw", ".img")
LAYER_SIDECARS = (".dbf", ".prj", ".shx", ".sbn", ".sbx", ".cpg", ".xml")
LOCK_PATTERNS = (
    r"\.shp\..+\.lock$",
    r"\.shp\.ed\.lock$",
    r"\.tif\.pyrx$",
    r"\.ecw\.aux$",
    r"\.tif\.aux$",
    r"\.tif\.aux\.xml$",
)

# Per-channel mean and standard deviation.
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)


@dataclass(frozen=True)
class SegmentationParams:
    """Fixed values of the segmentation stage."""

    num_classes: int = 4
    patch_size: int = 512
    overlap: int = 128
    strip_rows: int = 4096
    min_foreground: float = 0.003
    min_building_area: int = 80
    min_road_width: int = 3
    val_fraction: float = 0.15
    seed: int = 42
    class_weights: tuple = (0.05, 1.6, 3.0, 2.0)
    dice_weight: float = 0.6
    ce_weight: float = 0.2
    focal_weight: float = 0.2
    focal_gamma: float = 2.0
    label_smoothing: float = 0.05
    smooth: float = 1e-6
    patience: int = 18


@dataclass(frozen=True)
class RoofParams:
    """Fixed values of the roof stage."""

    crop_size: int = 160
    min_crop_px: int = 24
    pad_fraction: float = 0.15
    min_confidence: float = 0.55
    batch_size: int = 64
    patience: int = 12


@dataclass(frozen=True)
class DetectParams:
    """Fixed values of the detection stage."""

    tile_size: int = 1280
    overlap: int = 512
    conf_threshold: float = 0.10
    sigma: float = 0.9
    neg_ratio: float = 0.3
    blank_level: int = 10
