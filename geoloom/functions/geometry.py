"""Geometry as column arithmetic over ``rings``: array<array<struct<x,y>>>."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Pairs of edges that are looked at together.
PAIRS = 1 << 18


def let(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` computed once: it becomes a lambda variable, where a
    plain reuse would repeat its whole expression."""
    return F.get(F.transform(F.array(value), fn), 0)


def xs(rings: Column) -> Column:
    return F.transform(F.flatten(rings), lambda p: p["x"])


def ys(rings: Column) -> Column:
    return F.transform(F.flatten(rings), lambda p: p["y"])


def is_present(rings: Column) -> Column:
    """Not null and not empty."""
    return F.coalesce(F.size(F.flatten(rings)) > 0, F.lit(False))


def ring_edges(ring: Column) -> Column:
    """Consecutive point pairs of one ring as struct<x1,y1,x2,y2>."""
    edge = lambda i: F.struct(
        F.element_at(ring, i)["x"].alias("x1"),
        F.element_at(ring, i)["y"].alias("y1"),
        F.element_at(ring, i + 1)["x"].alias("x2"),
        F.element_at(ring, i + 1)["y"].alias("y2"),
    )
    steps = F.sequence(F.lit(1), F.greatest(F.size(ring) - 1, F.lit(1)))
    return F.transform(F.filter(steps, lambda i: i < F.size(ring)), edge)


def edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, ring_edges))


def _cross_sum(ring: Column) -> Column:
    return F.aggregate(
        ring_edges(ring),
        F.lit(0.0),
        lambda acc, e: acc + e["x1"] * e["y2"] - e["x2"] * e["y1"],
    )


def ring_area(ring: Column) -> Column:
    """Signed shoelace area."""
    return _cross_sum(ring) / 2


def is_valid_polygon(rings: Column) -> Column:
    """Every ring is closed, has four points or more, and encloses some area."""
    ok = lambda ring: (
        (F.size(ring) >= 4)
        & (F.element_at(ring, 1) == F.element_at(ring, -1))
        & (F.abs(ring_area(ring)) > 0)
    )
    return is_present(rings) & F.coalesce(F.forall(rings, ok), F.lit(False))


def numbered_edges(rings: Column) -> Column:
    """All edges of some length as struct<x1,y1,x2,y2,ring,k>: the ring's number and the edge's in it."""
    of_ring = lambda ring, i: F.transform(
        ring_edges(ring),
        lambda e, k: F.struct(*[e[c].alias(c) for c in ("x1", "y1", "x2", "y2")], i.alias("ring"), k.alias("k")),
    )
    return F.filter(F.flatten(F.transform(rings, of_ring)), lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))


def edges_clash(e: Column, f: Column) -> Column:
    """Two edges make a polygon invalid: they cross or run along each other, or belong to one
    ring and touch.  Neighbours may share the point between them, rings may touch in points."""
    turn = lambda g, x, y: (g["x2"] - g["x1"]) * (y - g["y1"]) - (g["y2"] - g["y1"]) * (x - g["x1"])

    def within(g: Column, x: Column, y: Column) -> Column:
        ux, uy = g["x2"] - g["x1"], g["y2"] - g["y1"]
        along = (x - g["x1"]) * ux + (y - g["y1"]) * uy
        return (turn(g, x, y) == 0) & (along > 0) & (along < ux * ux + uy * uy)

    ends = lambda g: [(g["x1"], g["y1"]), (g["x2"], g["y2"])]
    (a, b), (c, d) = [[turn(g, *p) for p in ends(h)] for g, h in ((e, f), (f, e))]
    touch = within(e, *ends(f)[0]) | within(e, *ends(f)[1]) | within(f, *ends(e)[0]) | within(f, *ends(e)[1])
    at = lambda p, q: (p[0] == q[0]) & (p[1] == q[1])
    same = (at(ends(e)[0], ends(f)[0]) & at(ends(e)[1], ends(f)[1])) | (at(ends(e)[0], ends(f)[1]) & at(ends(e)[1], ends(f)[0]))
    one_ring = e["ring"] == f["ring"]
    # Every corner of a ring begins one of its edges only.
    twice = one_ring & at(ends(e)[0], ends(f)[0])
    return ((a * b < 0) & (c * d < 0)) | same | twice | (touch & (one_ring | ((a == 0) & (b == 0))))


def later_edge(e: Column, f: Column) -> Column:
    return (e["ring"] < f["ring"]) | ((e["ring"] == f["ring"]) & (e["k"] < f["k"]))


def has_flaw(rings: Column, few: int) -> Column:
    """Not a valid polygon, or, where it has up to ``few`` points, any two edges clash; false where ``rings`` is null."""

    def flawed(rings: pa.Array) -> pa.Array:
        sound, points = _sound(rings)
        out, small = ~sound & rings.is_valid().to_numpy(zero_copy_only=False), np.flatnonzero(sound & (points <= few))
        out[small] = clashing(rings if len(small) == len(rings) else rings.take(pa.array(small))).to_numpy(zero_copy_only=False)
        return pa.array(out)

    return F.arrow_udf(flawed, "boolean")(rings)


def _sizes(a: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(a), 0).to_numpy()


# As in SQL, nan equals nan.
_equal = lambda a, b: (a == b) | (np.isnan(a) & np.isnan(b))


def _sound(rings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Polygons that ``is_valid_polygon`` finds valid, and their numbers of points."""
    ring = rings.flatten()
    points, size = ring.flatten(), _sizes(ring)
    field = dict(zip((f.name for f in points.type), points.flatten()))
    known = pc.and_(*[field[c].is_valid() for c in ("x", "y")]).to_numpy(zero_copy_only=False)
    x, y = (field[c].to_numpy(zero_copy_only=False).astype("float64") for c in ("x", "y"))
    ring_of, polygon_of = np.repeat(np.arange(len(ring)), size), np.repeat(np.arange(len(rings)), _sizes(rings))
    k = np.flatnonzero(ring_of[1:] == ring_of[:-1])
    with np.errstate(invalid="ignore", over="ignore"):
        # Added one after the other, as the column form adds them.
        parts = np.stack([x[k] * y[k + 1], -(x[k + 1] * y[k])], 1).ravel()
        area = np.bincount(np.repeat(ring_of[k], 2), parts, len(ring))
        ok = (size >= 4) & ~(area == 0) & (np.bincount(ring_of[~known], minlength=len(ring)) == 0)
    first, last = (np.cumsum(size) - size)[ok], np.cumsum(size)[ok] - 1
    ok[ok] = _equal(x[first], x[last]) & _equal(y[first], y[last])
    out = _sizes(rings) > 0
    out[polygon_of[~ok]] = False
    return out, np.bincount(polygon_of, size, len(rings))


def clashing(rings: pa.Array) -> pa.Array:
    """Polygons of which two edges clash, by the rules of ``edges_clash``.

    Every pair of a polygon's edges is looked at, some of them at a time for a whole batch.
    """
    ring = rings.flatten()
    points = ring.flatten()
    x, y = (points.field(c).to_numpy(zero_copy_only=False).astype("float64") for c in ("x", "y"))
    ring_of = np.repeat(np.arange(len(ring)), _sizes(ring))
    polygon_of = np.repeat(np.arange(len(rings)), _sizes(rings))
    k = np.flatnonzero(ring_of[1:] == ring_of[:-1])
    k = k[~(_equal(x[k], x[k + 1]) & _equal(y[k], y[k + 1]))]
    edge, of_ring = np.stack([x[k], y[k], x[k + 1], y[k + 1]]), ring_of[k]
    owner = polygon_of[of_ring]
    later = np.searchsorted(owner, owner, "right") - 1 - np.arange(len(owner))
    ends, out = np.cumsum(later), np.zeros(len(rings), bool)
    stops = np.searchsorted(ends, np.arange(0, ends[-1] if len(ends) else 0, PAIRS), "right")
    with np.errstate(invalid="ignore", over="ignore"):
        for lo, hi in zip(stops, [*stops[1:], len(owner)]):
            i = np.repeat(np.arange(lo, hi), later[lo:hi])
            j = i + 1 + np.arange(len(i)) - np.repeat(ends[lo:hi] - later[lo:hi] - (ends[lo - 1] if lo else 0), later[lo:hi])
            e, f = edge[:, i], edge[:, j]
            turn = lambda g, px, py: (g[2] - g[0]) * (py - g[1]) - (g[3] - g[1]) * (px - g[0])

            def within(g, px, py, side):
                ux, uy = g[2] - g[0], g[3] - g[1]
                along = (px - g[0]) * ux + (py - g[1]) * uy
                return (side == 0) & (along > 0) & (along < ux * ux + uy * uy)

            a, b, c, d = turn(e, f[0], f[1]), turn(e, f[2], f[3]), turn(f, e[0], e[1]), turn(f, e[2], e[3])
            touch = within(e, f[0], f[1], a) | within(e, f[2], f[3], b) | within(f, e[0], e[1], c) | within(f, e[2], e[3], d)
            at = lambda p, q: _equal(e[p], f[q]) & _equal(e[p + 1], f[q + 1])
            begin, one_ring = at(0, 0), of_ring[i] == of_ring[j]
            same = (begin & at(2, 2)) | (at(0, 2) & at(2, 0))
            clash = ((a * b < 0) & (c * d < 0)) | same | (one_ring & begin) | (touch & (one_ring | ((a == 0) & (b == 0))))
            out[owner[i[clash]]] = True
    return pa.array(out)


def hole_outside(rings: Column) -> Column:
    """A corner of a ring after the first lies outside the first one."""
    shell = F.slice(rings, 1, 1)

    def outside(p: Column) -> Column:
        edge = lambda e: (
            ((e["x2"] - e["x1"]) * (p["y"] - e["y1"]) == (e["y2"] - e["y1"]) * (p["x"] - e["x1"]))
            & p["x"].between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & p["y"].between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        )
        return ~contains_point(shell, p["x"], p["y"]) & ~F.exists(edges(shell), edge)

    return F.exists(F.flatten(F.slice(rings, 2, F.greatest(F.size(rings) - 1, F.lit(1)))), outside)


def polygon_centroid(rings: Column, by_orientation: bool = False) -> Column:
    """Area centroid.  Rings after the first are holes, or, ``by_orientation``, those
    that run against the first one (parts of a multipolygon)."""
    origin = F.element_at(F.element_at(rings, 1), 1)
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def weighted(m: Column, i: Column) -> Column:
        sign = F.lit(1.0) if by_orientation else F.signum(m["a"]) * F.when(i == 0, 1.0).otherwise(-1.0)
        return F.struct(*[(m[f] * sign).alias(f) for f in ("a", "x", "y")])

    def moments(ring: Column, i: Column) -> Column:
        total = F.aggregate(ring_edges(ring), zero, lambda acc, e: _add_moment(acc, e, origin))
        return let(total, lambda m: weighted(m, i))

    add = lambda acc, m: F.struct(*[(acc[f] + m[f]).alias(f) for f in ("a", "x", "y")])
    return let(
        F.aggregate(F.transform(rings, moments), zero, add),
        lambda m: F.struct(
            (origin["x"] + m["x"] / (3 * m["a"])).alias("x"),
            (origin["y"] + m["y"] / (3 * m["a"])).alias("y"),
        ),
    )


def _add_moment(acc: Column, e: Column, origin: Column) -> Column:
    x1, y1 = e["x1"] - origin["x"], e["y1"] - origin["y"]
    x2, y2 = e["x2"] - origin["x"], e["y2"] - origin["y"]
    cross = x1 * y2 - x2 * y1
    return F.struct(
        (acc["a"] + cross).alias("a"),
        (acc["x"] + (x1 + x2) * cross).alias("x"),
        (acc["y"] + (y1 + y2) * cross).alias("y"),
    )


def line_centroid(rings: Column) -> Column:
    """Length-weighted midpoint of all segments."""
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(acc: Column, e: Column) -> Column:
        n = F.hypot(e["x2"] - e["x1"], e["y2"] - e["y1"])
        return F.struct(
            (acc["n"] + n).alias("n"),
            (acc["x"] + n * (e["x1"] + e["x2"]) / 2).alias("x"),
            (acc["y"] + n * (e["y1"] + e["y2"]) / 2).alias("y"),
        )

    return let(
        F.aggregate(edges(rings), zero, add),
        lambda m: F.struct((m["x"] / m["n"]).alias("x"), (m["y"] / m["n"]).alias("y")),
    )


def point_centroid(rings: Column) -> Column:
    n = F.size(F.flatten(rings))
    mean = lambda v: F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x) / n
    return F.struct(mean(xs(rings)).alias("x"), mean(ys(rings)).alias("y"))


def centroid(rings: Column, geom_type: Column) -> Column:
    return (
        F.when(geom_type == "Polygon", polygon_centroid(rings))
        .when(geom_type == "MultiPolygon", polygon_centroid(rings, by_orientation=True))
        .when(geom_type.isin("LineString", "MultiLineString"), line_centroid(rings))
        .otherwise(point_centroid(rings))
    )


def contains_point(rings: Column, x: Column, y: Column) -> Column:
    """Even-odd rule."""
    crosses = lambda e: (
        ((e["y1"] <= y) != (e["y2"] <= y))
        & (x < e["x1"] + (y - e["y1"]) / (e["y2"] - e["y1"]) * (e["x2"] - e["x1"]))
    )
    hits = F.size(F.filter(edges(rings), crosses))
    return (hits % 2) == 1


def edge_meets_box(e: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Segment and closed box share a point: extents overlap and the box is not to one side."""
    side = lambda x, y: (
        (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
    )
    corners = [side(x, y) for x in (x1, x2) for y in (y1, y2)]
    return (
        (F.least(e["x1"], e["x2"]) <= x2)
        & (F.greatest(e["x1"], e["x2"]) >= x1)
        & (F.least(e["y1"], e["y2"]) <= y2)
        & (F.greatest(e["y1"], e["y2"]) >= y1)
        & (F.least(*corners) <= 0)
        & (F.greatest(*corners) >= 0)
    )


def meets_box(
    rings: Column, geom_type: Column, x1: Column, y1: Column, x2: Column, y2: Column
) -> Column:
    """Exact test of a feature against a closed box."""
    on_edge = F.exists(edges(rings), lambda e: edge_meets_box(e, x1, y1, x2, y2))
    has_vertex = F.exists(
        F.flatten(rings), lambda p: p["x"].between(x1, x2) & p["y"].between(y1, y2)
    )
    covers = geom_type.isin("Polygon", "MultiPolygon") & contains_point(
        rings, (x1 + x2) / 2, (y1 + y2) / 2
    )
    return has_vertex | on_edge | covers


def box_iou(a: str, b: str, eps_added: bool = False) -> Column:
    """IoU of two boxes held in columns ``{a}x1 ..`` and ``{b}x1 ..``.

    The denominator is floored at 1e-6, or has 1e-6 added for suppression.
    """
    col = lambda s, n: F.col(f"{s}{n}")
    w = F.least(col(a, "x2"), col(b, "x2")) - F.greatest(col(a, "x1"), col(b, "x1"))
    h = F.least(col(a, "y2"), col(b, "y2")) - F.greatest(col(a, "y1"), col(b, "y1"))
    inter = F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))
    area = lambda s: (col(s, "x2") - col(s, "x1")) * (col(s, "y2") - col(s, "y1"))
    union = area(a) + area(b) - inter
    return inter / (union + F.lit(1e-6) if eps_added else F.greatest(union, F.lit(1e-6)))


def lonlat_to_mercator(lon: Column, lat: Column) -> Column:
    """EPSG:4326 to EPSG:3857 on the sphere of radius 6378137 m."""
    radius = F.lit(6378137.0)
    return F.struct(
        (radius * F.radians(lon)).alias("x"),
        (radius * F.log(F.tan(F.lit(0.7853981633974483) + F.radians(lat) / 2))).alias("y"),
    )


def mercator_to_lonlat(x: Column, y: Column) -> Column:
    radius = F.lit(6378137.0)
    return F.struct(
        F.degrees(x / radius).alias("x"),
        F.degrees(2 * F.atan(F.exp(y / radius)) - F.lit(1.5707963267948966)).alias("y"),
    )
