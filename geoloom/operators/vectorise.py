"""Class regions to polygons, as ring vertices in long form.

A ring is never held in one value: its vertices are rows with a position, so a region's
outline may be as long as it likes.  Every block follows its own edges to chains; only chains
that cross block borders are put together by pointer doubling, so what a round shuffles grows
with the borders of the blocks and not with the outlines.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import hypot

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.operators.mask import BLOCK, CODE, REGION, into_blocks, regions
from geoloom.operators.scans import ranked
from geoloom.runtime import any_rows, cut, shuffled, slices

_KEY = [*REGION, "region"]
_CHAIN_SCHEMA = (
    "raster_id bigint, class_id int, r int, c int, first bigint, nxt bigint, xs array<int>, ys array<int>"
)
# By direction (right, down, left, up): the step, and where a pixel's edge begins.
_DX, _DY = np.array([1, 0, -1, 0]), np.array([0, 1, 0, -1])
_SX, _SY = np.array([0, 1, 1, 0]), np.array([0, 0, 1, 1])


def _successors(a: np.ndarray, y: np.ndarray, x: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pixel and direction of the edge after each edge; ``a`` holds classes with a margin of one.

    The class lies to the right of its edges.  Right turn first, then straight on, then left,
    so pixels of a region that touch at a corner only stay apart.
    """
    own = a[y, x]
    ay, ax = y + _DY[d], x + _DX[d]
    left = (d + 3) % 4
    by, bx = ay + _DY[left], ax + _DX[left]
    right, straight = a[ay, ax] != own, a[by, bx] != own
    return (
        np.where(right, y, np.where(straight, ay, by)), np.where(right, x, np.where(straight, ax, bx)),
        np.where(right, (d + 1) % 4, np.where(straight, d, left)),
    )


def _paths(after: np.ndarray) -> list[list[int]]:
    """Edges in order along every path and cycle of ``after`` (-1: leaves the block)."""
    n = len(after)
    follows = np.zeros(n, bool)
    follows[after[after >= 0]] = True
    step, seen, out = after.tolist(), [False] * n, []
    # Paths from their heads; what is left are cycles, entered at their least edge.
    for start in [*np.flatnonzero(~follows).tolist(), *range(n)]:
        if seen[start]:
            continue
        path, at = [], start
        while at >= 0 and not seen[at]:
            seen[at] = True
            path.append(at)
            at = step[at]
        out.append(path)
    return out


def boundary_chains(mask: DataFrame, block: int = BLOCK) -> DataFrame:
    """Chains of unit edges between a class and anything else, one row each.

    ``first`` is the code of a chain's first edge and ``nxt`` that of the edge after its last,
    ``xs``, ``ys`` are the corners at which its edges end, (r, c) is the pixel inside its first
    edge.  A chain begins where its outline enters the block or at the least edge that the
    outline has there; an outline within a block is one chain that follows itself.
    """
    typed = mask.filter("class_id > 0").select(
        F.col("raster_id").cast("bigint"), F.col("class_id").cast("int"), "r", "c"
    )

    def run(g: pd.DataFrame) -> pd.DataFrame:
        first = g.iloc[0]
        r0, c0 = int(first["br"]) * block - 1, int(first["bc"]) * block - 1
        a = np.zeros((block + 4, block + 4), "int8")
        a[g["r"].to_numpy() - r0, g["c"].to_numpy() - c0] = g["class_id"].to_numpy()
        own = a[1 : block + 1, 1 : block + 1]
        around = [a[:block, 1 : block + 1], a[1 : block + 1, 2 : block + 2], a[2 : block + 2, 1 : block + 1], a[1 : block + 1, :block]]
        found = [np.nonzero((own > 0) & (own != other)) for other in around]
        y = np.concatenate([f[0] for f in found]) + 1
        x = np.concatenate([f[1] for f in found]) + 1
        d = np.repeat(np.arange(4), [len(f[0]) for f in found])
        code = ((y + r0 + _SY[d]).astype("int64") * CODE + x + c0 + _SX[d]) * 4 + d
        order = np.argsort(code)
        y, x, d, code = y[order], x[order], d[order], code[order]
        ny, nx, nd = _successors(a, y, x, d)
        number = np.full((4, block + 4, block + 4), -1)
        number[d, y, x] = np.arange(len(d))
        after = number[nd, ny, nx]
        n_code = ((ny + r0 + _SY[nd]).astype("int64") * CODE + nx + c0 + _SX[nd]) * 4 + nd
        ex, ey, turns = x + c0 + _SX[d] + _DX[d], y + r0 + _SY[d] + _DY[d], d != nd
        rows = []
        for path in map(np.array, _paths(after)):
            least = int(np.argmin(code[path]))
            for part in (path[:least], path[least:]):
                if len(part):
                    ends = part[turns[part]]
                    head = part[0]
                    rows.append((class_of(a, y[head], x[head]), y[head] + r0, x[head] + c0, code[head], n_code[part[-1]], ex[ends], ey[ends]))
        out = pd.DataFrame(rows, columns=["class_id", "r", "c", "first", "nxt", "xs", "ys"])
        return out.assign(raster_id=first["raster_id"])[["raster_id", "class_id", "r", "c", "first", "nxt", "xs", "ys"]]

    def class_of(a, y, x):
        return int(a[y, x])

    blocks = into_blocks(typed, block, F.lit(1))
    return blocks.groupBy("raster_id", "br", "bc").applyInPandas(run, _CHAIN_SCHEMA)


def ring_vertices(mask: DataFrame, block: int = BLOCK) -> DataFrame:
    """(raster_id, class_id, region, ring, seq, x, y): corners of every region's rings.

    Regions link pixels that share a side.  Where two pixels of one region touch at a
    corner only, the rings stay apart.  ``ring`` is the code of the ring's first edge;
    outer rings run clockwise on screen, holes the other way.
    """
    labelled = regions(mask.filter("class_id > 0"), 4, block)
    chains = cut(boundary_chains(mask, block).withColumn("n", F.size("xs").cast("bigint")))
    links = chains.select("raster_id", "first", "nxt", "n")
    closed = links.filter("first = nxt").select("raster_id", "first", F.col("first").alias("ring"), F.lit(0).cast("bigint").alias("at"), F.col("n").alias("total"))
    whole = closed.unionByName(_put_together(cut(links.filter("first != nxt"))))
    whole = cut(whole)
    # The pixel inside a ring's first edge tells its region.
    heads = shuffled(chains).join(whole.filter("first = ring").select("raster_id", "first"), ["raster_id", "first"])
    named = shuffled(heads).join(labelled, [*REGION, "r", "c"]).select("raster_id", F.col("first").alias("ring"), "region")
    placed = shuffled(chains.select("raster_id", "class_id", "first", "xs", "ys")).join(whole, ["raster_id", "first"])
    placed = shuffled(placed).join(named, ["raster_id", "ring"])
    corners = placed.select(*_KEY, "ring", "at", "total", F.posexplode(F.arrays_zip("xs", "ys")).alias("k", "p"))
    # A ring begins with the corner at which its first edge starts, the last one to be an end.
    return corners.select(*_KEY, "ring", ((F.col("at") + F.col("k") + 1) % F.col("total")).alias("seq"), F.col("p.xs").alias("x"), F.col("p.ys").alias("y"))


def _put_together(links: DataFrame) -> DataFrame:
    """(raster_id, first, ring, at, total): the least chain of each ring, corners before a chain, corners of all.

    ``links`` are chains with successors in other blocks.  Both numbers come by pointer
    doubling: log2(chains of a ring) self-joins of a row per chain.
    """
    key = ["raster_id", "first"]
    if not any_rows(links):
        return links.select(*key, F.col("first").alias("ring"), F.lit(0).cast("bigint").alias("at"), F.col("n").alias("total"))

    def least(t: DataFrame) -> DataFrame:
        there = t.select("raster_id", F.col("first").alias("p"), F.col("ring").alias("q_ring"), F.col("p").alias("q"))
        return shuffled(t).join(there, ["raster_id", "p"]).select(
            *key, F.least("ring", "q_ring").alias("ring"), F.col("q").alias("p"), (F.col("q_ring") < F.col("ring")).alias("moved")
        )

    ring = links.select(*key, F.col("first").alias("ring"), F.col("nxt").alias("p"))
    while True:
        # Windows of equal minima tile the ring, so a round without change is the last.
        ring = cut(least(least(ring)))
        if not any_rows(ring.filter("moved")):
            break
    found = ring.select(*key, "ring")
    last = F.col("nxt") == F.col("ring")
    rest = shuffled(links).join(found, key).select(*key, "ring", F.col("n").alias("sum"), F.when(~last, F.col("nxt")).alias("p"))

    def further(t: DataFrame) -> DataFrame:
        there = t.select("raster_id", F.col("first").alias("p"), F.col("sum").alias("q_sum"), F.col("p").alias("q"))
        return shuffled(t).join(there, ["raster_id", "p"], "left").select(
            *key, "ring", (F.col("sum") + F.coalesce("q_sum", F.lit(0))).alias("sum"), F.col("q").alias("p")
        )

    rest = cut(rest)
    while any_rows(rest.filter("p is not null")):
        rest = cut(further(further(rest)))
    total = rest.filter("first = ring").select("raster_id", "ring", F.col("sum").alias("total"))
    return shuffled(rest).join(total, ["raster_id", "ring"]).select(*key, "ring", (F.col("total") - F.col("sum")).alias("at"), "total")


# -- measures, simplification, output ---------------------------------------------------------


def _next_vertex(vertices: DataFrame) -> DataFrame:
    """Add the following vertex (``nx``, ``ny``) of the ring by an equi-join on its position."""
    key = [*_KEY, "ring"]
    n = vertices.groupBy(*key).agg(F.count("*").alias("_n"))
    v = shuffled(vertices).join(n, key).withColumn("_to", (F.col("seq") + 1) % F.col("_n"))
    ahead = vertices.select(*key, F.col("seq").alias("_to"), F.col("x").alias("nx"), F.col("y").alias("ny"))
    return shuffled(v).join(ahead, [*key, "_to"]).drop("_to", "_n")


def region_summary(vertices: DataFrame) -> DataFrame:
    """(raster_id, class_id, region, rings, corners, area, perimeter) per region."""
    v = _next_vertex(vertices)
    cross = F.col("x").cast("bigint") * F.col("ny") - F.col("nx").cast("bigint") * F.col("y")
    side = F.abs(F.col("nx") - F.col("x")) + F.abs(F.col("ny") - F.col("y"))
    ring = v.groupBy(*_KEY, "ring").agg(F.count("*").alias("corners"), F.sum(cross).alias("a2"), F.sum(side).alias("p"))
    return ring.groupBy(*_KEY).agg(
        F.count("*").alias("rings"), F.sum("corners").alias("corners"),
        (F.sum("a2") / 2).cast("bigint").alias("area"), F.sum("p").alias("perimeter"),
    )


def to_map(vertices: DataFrame, meta: DataFrame) -> DataFrame:
    t = F.col("affine")
    joined = shuffled(vertices).join(meta.select("raster_id", "affine"), "raster_id")
    return joined.select(
        *_KEY, "ring", "seq", (t["c"] + F.col("x") * t["a"]).alias("x"), (t["f"] + F.col("y") * t["e"]).alias("y")
    )


_RING = [*_KEY, "ring"]
# Sections of more vertices are split in rounds, one level each.
SECTION = 20_000
FEW = 48
_STATE = [*_RING, "seq", "x", "y", "a", "b", "ax", "ay", "bx", "by"]
_STATE_SCHEMA = (
    "raster_id bigint, class_id int, region bigint, ring bigint, seq bigint, x double, y double, "
    "a bigint, b bigint, ax double, ay double, bx double, by double"
)


def _distance() -> Column:
    """From (x, y) to the chord of the vertex's section."""
    ux, uy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    length = ux * ux + uy * uy
    along = ((F.col("x") - F.col("ax")) * ux + (F.col("y") - F.col("ay")) * uy) / length
    t = F.when(length > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), along))).otherwise(0.0)
    return F.hypot(F.col("x") - F.col("ax") - t * ux, F.col("y") - F.col("ay") - t * uy)


def _kept(px: np.ndarray, py: np.ndarray, tolerance: float, force: bool) -> np.ndarray:
    """Positions kept of one section; the last point is its end and not among them."""
    kept, stack = [0], [(0, len(px) - 1, force)]
    while stack:
        i, j, split = stack.pop()
        if j - i < 2:
            continue
        ux, uy = px[j] - px[i], py[j] - py[i]
        dx, dy = px[i + 1 : j] - px[i], py[i + 1 : j] - py[i]
        length = ux * ux + uy * uy
        t = np.clip((dx * ux + dy * uy) / length, 0.0, 1.0) if length > 0 else 0.0
        far = np.hypot(dx - t * ux, dy - t * uy)
        m = int(np.argmax(far))
        if far[m] <= tolerance and not split:
            continue
        kept.append(i + 1 + m)
        stack += [(i, i + 1 + m, False), (i + 1 + m, j, False)]
    return np.sort(kept)


def _kept_of_few(px: np.ndarray, py: np.ndarray, tolerance: float, force: bool) -> np.ndarray:
    """As ``_kept``, without arrays: of few points it takes a tenth of the time."""
    x, y = px.tolist(), py.tolist()
    kept, stack = [0], [(0, len(x) - 1, force)]
    while stack:
        i, j, split = stack.pop()
        if j - i < 2:
            continue
        x0, y0, ux, uy = x[i], y[i], x[j] - x[i], y[j] - y[i]
        length, best, m = ux * ux + uy * uy, -1.0, i
        for k in range(i + 1, j):
            dx, dy = x[k] - x0, y[k] - y0
            t = min(1.0, max(0.0, (dx * ux + dy * uy) / length)) if length > 0 else 0.0
            far = hypot(dx - t * ux, dy - t * uy)
            if far > best:
                best, m = far, k
        if best <= tolerance and not split:
            continue
        kept.append(m)
        stack += [(i, m, False), (m, j, False)]
    return np.sort(kept)


def _settle_small(sections: DataFrame, tolerance: float, force: bool) -> DataFrame:
    """Sections of bounded length: each is split to its end where its rows, in order, pass by."""

    def done(part: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        # One set of columns for the whole batch: most sections have few vertices.
        px, py, ps = part["x"].to_numpy(), part["y"].to_numpy(), part["seq"].to_numpy()
        new = {c: part[c].to_numpy().copy() for c in ("a", "b", "ax", "ay", "bx", "by")}
        for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(part)]):
            if j - i < 2:
                continue
            x, y, seq = (np.append(v[i:j], new[e][i]) for v, e in ((px, "bx"), (py, "by"), (ps, "b")))
            kept = (_kept_of_few if j - i <= FEW else _kept)(x, y, tolerance, force)
            mine = np.searchsorted(kept, np.arange(j - i), "right") - 1
            lo, hi = kept[mine], np.append(kept, j - i)[mine + 1]
            for name, value in (("a", seq[lo]), ("b", seq[hi]), ("ax", x[lo]), ("ay", y[lo]), ("bx", x[hi]), ("by", y[hi])):
                new[name][i:j] = value
        return part.assign(**new)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for part in parts:
            part = part if held is None else pd.concat([held, part], ignore_index=True)
            if not len(part):
                continue
            ids = part[[*_RING, "a"]].to_numpy()
            starts = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]).any(axis=1)))
            # The last section may go on in the next batch.
            held = part.iloc[starts[-1] :]
            if len(starts) > 1:
                yield done(part.iloc[: starts[-1]], starts[:-1])
        if held is not None:
            yield done(held, np.zeros(1, int))

    ordered = sections.repartition(slices(sections.sparkSession), *_RING, "a").sortWithinPartitions(*_RING, "a", "seq")
    return ordered.select(*_STATE).mapInPandas(run, _STATE_SCHEMA)


def _settle(sections: DataFrame, tolerance: float, force: bool, longest: int) -> DataFrame:
    """Split sections at their farthest vertex until all vertices are within ``tolerance``.

    Rows of a section share (a, b), its ends, and their coordinates; the row of ``a`` itself
    is the section's first.  With ``force`` the first split is made however near the vertices
    are.  A section's outcome depends on its own vertices alone, so those of up to ``longest``
    are settled in one pass; longer ones are split in rounds, by partial aggregates, first.
    """
    at = [*_RING, "a"]
    out = None
    while True:
        size = sections.groupBy(*at).agg(F.count("*").alias("_n")).filter(F.col("_n") > longest)
        long = cut(size.select(*at))
        if not any_rows(long):
            done = _settle_small(sections, tolerance, force)
            return done if out is None else out.unionByName(done)
        short = sections.join(long, at, "left_anti")
        out_now = _settle_small(short, tolerance, force)
        out = out_now if out is None else out.unionByName(out_now)
        wide = cut(sections.join(long, at, "left_semi"))
        far = wide.filter("seq > a").withColumn("d", _distance()).groupBy(*at).agg(
            F.max_by(F.struct("seq", "x", "y", "d"), F.struct(F.col("d"), -F.col("seq"))).alias("m")
        )
        far = far.select(*at, F.col("m.seq").alias("ms"), F.col("m.x").alias("mx"), F.col("m.y").alias("my"), F.col("m.d").alias("md"))
        if not force:
            far = far.filter(F.col("md") > tolerance)
        far = cut(far)
        out = out.unionByName(wide.join(far, at, "left_anti"))
        before = F.col("seq") < F.col("ms")
        pick = lambda yes, no, name: F.when(before, F.col(yes)).otherwise(F.col(no)).alias(name)
        sections = cut(wide.join(far, at).select(
            *_RING, "seq", "x", "y", pick("a", "ms", "a"), pick("ms", "b", "b"), pick("ax", "mx", "ax"),
            pick("ay", "my", "ay"), pick("mx", "bx", "bx"), pick("my", "by", "by"),
        ))
        out, force = cut(out), False


def _crossing() -> Column:
    """Chords p and q meet in a point that is inside at least one of them, or are the same."""
    eps = 1e-9

    def side(a: str, b: str, c: str) -> Column:
        ux, uy = F.col(f"{b}x") - F.col(f"{a}x"), F.col(f"{b}y") - F.col(f"{a}y")
        vx, vy = F.col(f"{c}x") - F.col(f"{a}x"), F.col(f"{c}y") - F.col(f"{a}y")
        turn = ux * vy - uy * vx
        # Points of a raster's grid in map units are on a line up to rounding.
        return F.when(F.abs(turn) <= eps * (ux * ux + uy * uy + vx * vx + vy * vy), 0).otherwise(F.signum(turn))

    def inside(a: str, b: str, c: str) -> Column:
        ux, uy = F.col(f"{b}x") - F.col(f"{a}x"), F.col(f"{b}y") - F.col(f"{a}y")
        dot = (F.col(f"{c}x") - F.col(f"{a}x")) * ux + (F.col(f"{c}y") - F.col(f"{a}y")) * uy
        length = ux * ux + uy * uy
        return (side(a, b, c) == 0) & (dot > eps * length) & (dot < (1 - eps) * length)

    same = lambda a, b: (F.col(f"{a}x") == F.col(f"{b}x")) & (F.col(f"{a}y") == F.col(f"{b}y"))
    proper = (side("pa", "pb", "qa") * side("pa", "pb", "qb") < 0) & (side("qa", "qb", "pa") * side("qa", "qb", "pb") < 0)
    touch = inside("pa", "pb", "qa") | inside("pa", "pb", "qb") | inside("qa", "qb", "pa") | inside("qa", "qb", "pb")
    return proper | touch | (same("pa", "qa") & same("pb", "qb")) | (same("pa", "qb") & same("pb", "qa"))


def _in_cells(chords: DataFrame) -> DataFrame:
    """A row per grid cell that a chord passes; cells are about two chords wide.

    A chord is walked column by column, so its rows follow its length and not its extent.
    """
    size = chords.groupBy("raster_id").agg(
        F.greatest(2 * F.avg(F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))), F.lit(1e-12)).alias("cell")
    )
    at = lambda v: F.floor(v / F.col("cell"))
    spread = chords.join(size, "raster_id").withColumn("cx", F.explode(F.sequence(at(F.least("ax", "bx")), at(F.greatest("ax", "bx")))))
    slope = (F.col("by") - F.col("ay")) / (F.col("bx") - F.col("ax"))
    edge = lambda k: F.greatest(F.least("ax", "bx"), F.least(F.greatest("ax", "bx"), (F.col("cx") + k) * F.col("cell")))
    y_at = lambda x: F.when(F.col("ax") == F.col("bx"), F.lit(None)).otherwise(F.col("ay") + slope * (x - F.col("ax")))
    y1, y2 = F.coalesce(y_at(edge(0)), F.col("ay")), F.coalesce(y_at(edge(1)), F.col("by"))
    pad = F.col("cell") * 1e-9
    return spread.withColumn("cy", F.explode(F.sequence(at(F.least(y1, y2) - pad), at(F.greatest(y1, y2) + pad)))).drop("cell")


def crossing_chords(chords: DataFrame) -> DataFrame:
    """Pairs of chords of one region that meet elsewhere than in common ends.

    ``chords`` have the ring's keys, a, b and both ends; the result has the keys of one chord
    (ring, a, b) and the other (q_ring, q_a), in both orders.
    """
    cells = _in_cells(chords.select(*_RING, "a", "b", "ax", "ay", "bx", "by"))
    ends = [("ax", "ax"), ("ay", "ay"), ("bx", "bx"), ("by", "by")]
    p = cells.select(*_KEY, "cx", "cy", "ring", "a", "b", *[F.col(c).alias(f"p{c}") for c, _ in ends])
    q = cells.select(*_KEY, "cx", "cy", F.col("ring").alias("q_ring"), F.col("a").alias("q_a"), *[F.col(c).alias(f"q{c}") for c, _ in ends])
    other = (F.col("ring") != F.col("q_ring")) | (F.col("a") != F.col("q_a"))
    met = shuffled(p).join(q, [*_KEY, "cx", "cy"]).filter(other & _crossing())
    return met.select(*_RING, "a", "b", "q_ring", "q_a").distinct()


def _sides(vertices: DataFrame) -> DataFrame:
    """Vertices with the next one, ``nx`` and ``ny``, which is looked for only if they have none."""
    if "nx" in vertices.columns:
        return vertices
    dense = ranked(vertices, _RING, [F.col("seq")], "_at").withColumn("seq", F.col("_at") - 1).drop("_at")
    return _next_vertex(cut(dense))


def chords(vertices: DataFrame) -> DataFrame:
    """Sides of rings (positions in ``seq``, gaps allowed) with both ends, numbered along the ring.

    Vertices that know the next one (``simplify`` with ``ends``) keep their positions.
    """
    return _sides(vertices).select(
        *_RING, F.col("seq").alias("a"), (F.col("seq") + 1).alias("b"),
        *[F.col(v).cast("double").alias(n) for v, n in (("x", "ax"), ("y", "ay"), ("nx", "bx"), ("ny", "by"))],
    )


def simplify(
    vertices: DataFrame, tolerance: float, keep_topology: bool = False, longest: int = SECTION, ends: bool = False
) -> DataFrame:
    """Drop vertices within ``tolerance`` of the line that replaces them (farthest-point
    splitting).

    A ring is cut at its first vertex and at the one farthest from it, since a closed line
    has no chord of its own; both halves then split wherever a vertex lies farther than
    ``tolerance`` from their chord.

    With ``keep_topology`` a chord is accepted only if it meets no other chord of its region
    but in common ends: sections of chords that do are split once more, and what they leave is
    looked at again.  Original edges meet in corners alone, so this ends, and no ring crosses
    itself or another ring of its region, nor does one collapse to a line.

    With ``ends`` vertices also have the next one of their ring, ``nx`` and ``ny``.
    """
    v = vertices.select(*_RING, "seq", F.col("x").cast("double"), F.col("y").cast("double"))
    n = v.groupBy(*_RING).agg(F.count("*").alias("b"), F.min_by(F.struct("x", "y"), "seq").alias("s"))
    at_start = [F.col(f"s.{c}").alias(f"{e}{c}") for e in "ab" for c in "xy"]
    whole = shuffled(v).join(n, _RING).select(*_RING, "seq", "x", "y", F.lit(0).cast("bigint").alias("a"), "b", *at_start)
    state = _settle(cut(whole), tolerance, True, longest)
    if keep_topology:
        state, done = cut(state), None
        while True:
            bad = crossing_chords(state.filter("seq = a")).filter("b - a > 1").select(*_RING, "a").distinct()
            bad = cut(bad)
            if not any_rows(bad):
                break
            # Chords meet within a region only: regions without a crossing are done, and neither read nor written again.
            crossed = bad.select(*_KEY).distinct()
            rest = shuffled(state.filter("seq = a")).join(crossed, _KEY, "left_anti")
            done = rest if done is None else done.unionByName(rest)
            state = cut(shuffled(state).join(crossed, _KEY, "left_semi"))
            again = cut(shuffled(state).join(bad, [*_RING, "a"], "left_semi"))
            state = cut(shuffled(state).join(bad, [*_RING, "a"], "left_anti").unionByName(_settle(again, tolerance, True, longest)))
        if done is not None:
            state = cut(done.select(*_STATE)).unionByName(state.filter("seq = a").select(*_STATE))
    out = state.filter("seq = a").select(*_RING, "seq", "x", "y", F.col("bx").alias("nx"), F.col("by").alias("ny"))
    return out if ends else out.drop("nx", "ny")


def valid_rings(vertices: DataFrame) -> DataFrame:
    """Rings with three corners and some area, of regions whose outer ring is such a ring.

    A region whose outer ring collapsed goes whole; a hole that collapsed goes alone.  The
    outer ring is the one of largest extent, the first vertex of the region lies on it.
    """
    key = [*_KEY, "ring"]
    area = _sides(vertices).groupBy(*key).agg(
        F.count("*").alias("n"), F.sum(F.col("x") * F.col("ny") - F.col("nx") * F.col("y")).alias("a2")
    ).withColumn("good", (F.col("n") >= 3) & (F.abs(F.col("a2")) > 0))
    # Ring codes grow along rows and a region's first pixel is on its outer ring, so that has the least code.
    outer = area.groupBy(*_KEY).agg(F.min_by("good", "ring").alias("whole")).filter("whole").select(*_KEY)
    good = shuffled(area.filter("good")).join(outer, _KEY, "left_semi").select(*key)
    return shuffled(vertices).join(good, key, "left_semi")


def with_class_names(vertices: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """All classes in one table, named; the background has no regions."""
    return vertices.withColumn("class_name", F.element_at(F.array(*[F.lit(n) for n in names]), F.col("class_id") + 1))
