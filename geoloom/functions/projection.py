"""Transverse Mercator zones (UTM on WGS 84) as column arithmetic, both ways.

The series in the third flattening ``n`` is cut after its fourth power: what is left out
is below a micrometre within ``REACH`` degrees of a zone's meridian.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoloom.functions.geometry import let

# WGS 84 and the UTM grid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING = 10000000.0

# Coefficients of n, n^2, n^3, n^4 in the terms of each series.
TO_GRID = (
    (1 / 2, -2 / 3, 5 / 16, 41 / 180),
    (0, 13 / 48, -3 / 5, 557 / 1440),
    (0, 0, 61 / 240, -103 / 140),
    (0, 0, 0, 49561 / 161280),
)
FROM_GRID = (
    (1 / 2, -2 / 3, 37 / 96, -1 / 360),
    (0, 1 / 48, 1 / 15, -437 / 1440),
    (0, 0, 17 / 480, -37 / 840),
    (0, 0, 0, 4397 / 161280),
)
TO_LATITUDE = (
    (2, -2 / 3, -2, 116 / 45),
    (0, 7 / 3, -8 / 5, -227 / 45),
    (0, 0, 56 / 15, -136 / 35),
    (0, 0, 0, 4279 / 630),
)

# Degrees from a zone's meridian, and of latitude, up to which the grid is used.
REACH = 30.0
MOST_LATITUDE = 84.5

_N = FLATTENING / (2 - FLATTENING)
_ECC = math.sqrt(FLATTENING * (2 - FLATTENING))
# Radius of the sphere with the meridian's length, times the scale of the grid.
RECTIFYING = SCALE * SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)


def terms(series: tuple) -> list[float]:
    return [sum(c * _N ** (k + 1) for k, c in enumerate(row)) for row in series]


def utm_number(crs: Column) -> Column:
    """The code of a UTM system (32601 to 32660, 32701 to 32760), else null."""
    found = F.regexp_extract(crs, r"^EPSG:(32[67]\d\d)$", 1)
    # Only what is a number is cast: each cast that fails costs an exception.
    code = lambda text: F.when(text != "", text.cast("int"))
    return let(let(found, code), lambda n: F.when((n % 100).between(1, 60), n))


def utm_zone(crs: str) -> int | None:
    """``utm_number`` of a system known to the driver."""
    named = re.fullmatch(r"EPSG:(32[67](?:0[1-9]|[1-5]\d|60))", crs)
    return int(named[1]) if named else None


def meridian(code: Column) -> Column:
    """Degrees of a zone's central meridian."""
    return (code % 100 * 6 - 183).cast("double")


def _northing(code: Column) -> Column:
    return F.when(code >= 32700, F.lit(FALSE_NORTHING)).otherwise(F.lit(0.0))


def _waves(x: Column, y: Column, coefficients: list[float], sign: int) -> tuple[Column, Column]:
    """x and y moved along sum c_j (sin 2jx cosh 2jy, cos 2jx sinh 2jy)."""
    along, across = x, y
    for j, c in enumerate(coefficients, 1):
        along = along + sign * c * F.sin(2 * j * x) * F.cosh(2 * j * y)
        across = across + sign * c * F.cos(2 * j * x) * F.sinh(2 * j * y)
    return along, across


def lonlat_to_utm(lon: Column, lat: Column, code: Column) -> Column:
    """EPSG:4326 to the UTM zone ``code``; null out of reach."""
    away = F.pmod(lon - meridian(code) + 180, F.lit(360.0)) - 180
    usable = (F.abs(away) <= REACH) & (F.abs(lat) <= MOST_LATITUDE)

    def on_sphere(s: Column) -> Column:
        # The tangent of the conformal latitude, then the plain transverse projection.
        t = F.tan(s["phi"])
        root = F.sqrt(1 + t * t)
        sigma = F.sinh(_ECC * F.atanh(_ECC * t / root))
        tc = t * F.sqrt(1 + sigma * sigma) - sigma * root
        return let(F.struct(tc.alias("t"), s["lam"].alias("lam")), lambda q: F.struct(
            F.atan2(q["t"], F.cos(q["lam"])).alias("x"),
            F.asinh(F.sin(q["lam"]) / F.sqrt(q["t"] * q["t"] + F.cos(q["lam"]) * F.cos(q["lam"]))).alias("y"),
        ))

    def on_grid(p: Column) -> Column:
        along, across = _waves(p["x"], p["y"], terms(TO_GRID), 1)
        return F.struct(
            (RECTIFYING * across + FALSE_EASTING).alias("x"), (RECTIFYING * along + _northing(code)).alias("y")
        )

    start = F.struct(F.radians(lat).alias("phi"), F.radians(away).alias("lam"))
    return F.when(usable, let(let(start, on_sphere), on_grid))


def utm_to_lonlat(x: Column, y: Column, code: Column) -> Column:
    """The UTM zone ``code`` to EPSG:4326; null out of reach."""
    place = F.struct(((y - _northing(code)) / RECTIFYING).alias("x"), ((x - FALSE_EASTING) / RECTIFYING).alias("y"))

    def on_sphere(p: Column) -> Column:
        along, across = _waves(p["x"], p["y"], terms(FROM_GRID), -1)
        return F.struct(along.alias("x"), across.alias("y"))

    def angles(p: Column) -> Column:
        side = F.sinh(p["y"])
        return F.struct(
            F.atan2(F.sin(p["x"]), F.sqrt(side * side + F.cos(p["x"]) * F.cos(p["x"]))).alias("chi"),
            F.atan2(side, F.cos(p["x"])).alias("lam"),
        )

    def on_ellipsoid(q: Column) -> Column:
        phi = q["chi"]
        for j, c in enumerate(terms(TO_LATITUDE), 1):
            phi = phi + c * F.sin(2 * j * q["chi"])
        lon = F.pmod(F.degrees(q["lam"]) + meridian(code) + 180, F.lit(360.0)) - 180
        return F.struct(lon.alias("x"), F.degrees(phi).alias("y"), F.degrees(q["lam"]).alias("away"))

    # The grid is periodic: only the quadrant between the poles is read back.
    inside = lambda start: (F.abs(start["x"]) < math.pi / 2) & (F.abs(start["y"]) < 1)
    out = lambda start: let(let(let(start, on_sphere), angles), on_ellipsoid)
    checked = lambda start: let(out(start), lambda q: F.when(
        (F.abs(q["away"]) <= REACH + 1e-9) & (F.abs(q["y"]) <= MOST_LATITUDE + 1e-9), F.struct(q["x"].alias("x"), q["y"].alias("y"))
    ))
    return let(place, lambda start: F.when(inside(start), checked(start)))
