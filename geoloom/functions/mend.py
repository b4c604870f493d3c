"""Repair of polygons: nodes where the edges of one meet, and the area it winds around."""

from __future__ import annotations

from collections.abc import Iterator
from math import atan2, pi

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

Point = tuple[float, float]
ROWS = 512
# Pairs of edges that are looked at together for a batch.
PAIRS = 1 << 18


def ring_area(ring: list[Point]) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2


def _cuts(a: np.ndarray, b: np.ndarray) -> list[list[float]]:
    """Per edge the places (0 to 1) where another edge meets it, a band of rows at a time."""
    d, out = b - a, [[0.0, 1.0] for _ in a]
    length = np.maximum((d * d).sum(1), 1e-300)
    cross = lambda u, v: u[..., 0] * v[..., 1] - u[..., 1] * v[..., 0]
    for at in range(0, len(a), ROWS):
        p, u = a[at : at + ROWS, None], d[at : at + ROWS, None]
        bend, gap = cross(u, d[None]), a[None] - p
        with np.errstate(divide="ignore", invalid="ignore"):
            t, s = cross(gap, d[None]) / bend, cross(gap, u) / bend
        flat = np.abs(bend) <= 1e-12 * np.sqrt(length[at : at + ROWS, None] * length[None])
        hit = ~flat & (t > 1e-9) & (t < 1 - 1e-9) & (s > -1e-9) & (s < 1 + 1e-9)
        for i, j in zip(*np.nonzero(hit)):
            out[at + i].append(float(t[i, j]))
        # Edges on one line meet in each other's ends.
        on_line = flat & (np.abs(cross(gap, u)) <= 1e-9 * length[at : at + ROWS, None])
        for i, j in zip(*np.nonzero(on_line)):
            for q in (a[j], b[j]):
                where = float((q - a[at + i]) @ d[at + i] / length[at + i])
                if 1e-9 < where < 1 - 1e-9:
                    out[at + i].append(where)
    return out


def _winding(x: float, y: float, a: np.ndarray, b: np.ndarray) -> int:
    """Turns of the edges around a point on none of them."""
    side = (b[:, 0] - a[:, 0]) * (y - a[:, 1]) - (x - a[:, 0]) * (b[:, 1] - a[:, 1])
    up, down = (a[:, 1] <= y) & (b[:, 1] > y), (a[:, 1] > y) & (b[:, 1] <= y)
    return int((up & (side > 0)).sum()) - int((down & (side < 0)).sum())


def _walked(out: dict[Point, list[Point]]) -> tuple[list[list[Point]], list[list[Point]]]:
    """Shells and holes along edges from point to points; ``out`` is used up."""
    shells, holes = [], []
    while out:
        start = min(out)
        ring, at, prev, place = [start], start, None, {start: 0}
        while True:
            ends = out[at]
            if prev is None or len(ends) == 1:
                nxt = ends[0]
            else:
                back = atan2(prev[1] - at[1], prev[0] - at[0])
                nxt = min(ends, key=lambda e: (back - atan2(e[1] - at[1], e[0] - at[0])) % (2 * pi) or 2 * pi)
            ends.remove(nxt)
            if not ends:
                del out[at]
            prev, at = at, nxt
            if at in place:
                # What has closed is a ring of its own, also where it began later than the walk.
                first = place[at]
                loop = [*ring[first:], at]
                (shells if ring_area(loop) > 0 else holes).append(loop)
                for p in ring[first + 1 :]:
                    del place[p]
                ring = ring[: first + 1]
                prev = ring[-2] if first else None
                if first == 0:
                    break
            else:
                place[at] = len(ring)
                ring.append(at)
    return shells, holes


def mended(rings: list[list[Point]], oriented: bool) -> list[list[Point]]:
    """Simple rings of the area that ``rings`` wind around once or more; none if there is no such area.

    The first ring is a shell, the others are holes or, with ``oriented``, what their direction
    says.  Parts that run against the larger rest, such as the smaller wing of a bow-tie, are
    wound around negatively and go, as do spikes.  Shells run against the clock (in axes that
    point right and up), each before the holes that follow; rings may touch in points.
    """
    rings = [r if r[0] == r[-1] else [*r, r[0]] for r in rings if len(r) > 2]
    if not rings:
        return []
    if oriented:
        flip = ring_area(rings[0]) < 0
        rings = [r[::-1] if flip else r for r in rings]
    else:
        rings = [r[::-1] if (ring_area(r) < 0) == (i == 0) else r for i, r in enumerate(rings)]
    pairs = [(p, q) for r in rings for p, q in zip(r, r[1:]) if p != q]
    if not pairs:
        return []
    a, b = np.array([p for p, _ in pairs]), np.array([q for _, q in pairs])
    span = max(float((np.maximum(a.max(0), b.max(0)) - np.minimum(a.min(0), b.min(0))).max()), 1e-300)
    nodes: dict[tuple[int, int], Point] = {}

    def node(x: float, y: float) -> Point:
        # Nodes nearer than a billionth of the extent are one.
        return nodes.setdefault((round(x / span * 1e9), round(y / span * 1e9)), (x, y))

    for p in [*map(tuple, a.tolist()), *map(tuple, b.tolist())]:
        node(*p)
    net: dict[tuple[Point, Point], int] = {}
    for (p, q), places in zip(pairs, _cuts(a, b)):
        stops = [node(p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])) for t in sorted(places)]
        for u, v in zip(stops, stops[1:]):
            if u != v:
                key, way = ((u, v), 1) if u < v else ((v, u), -1)
                net[key] = net.get(key, 0) + way
    out: dict[Point, list[Point]] = {}
    for (u, v), n in net.items():
        if n == 0:
            continue
        dx, dy = v[0] - u[0], v[1] - u[1]
        # A point just left of the edge's middle; to its right the edge itself counts n less.
        left = _winding((u[0] + v[0]) / 2 - dy * 1e-6, (u[1] + v[1]) / 2 + dx * 1e-6, a, b)
        if (left > 0) != (left - n > 0):
            s, e = (u, v) if left > 0 else (v, u)
            out.setdefault(s, []).append(e)
    shells, holes = _walked(out)
    return shells + holes if shells else []


def _next(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first`` and the numbers after it, ``count`` of them, one row after the other."""
    return np.arange(count.sum()) + np.repeat(first - np.cumsum(count) + count, count)


def _with_edges(of: np.ndarray, starts: np.ndarray, edges: np.ndarray):
    """Pairs (i, j) of rows and the edges of their polygon, ``PAIRS`` or one row's at a time."""
    count = edges[of]
    ends = np.cumsum(count)
    stops = np.searchsorted(ends, np.arange(0, ends[-1] if len(ends) else 0, PAIRS), "right")
    for lo, hi in zip(stops, [*stops[1:], len(of)]):
        if lo < hi:
            yield np.repeat(np.arange(lo, hi), count[lo:hi]), _next(starts[of[lo:hi]], count[lo:hi])


def _closed(first: np.ndarray, size: np.ndarray, long: np.ndarray, flip: np.ndarray | None = None) -> np.ndarray:
    """Places of the points of rings of ``size`` from ``first`` on, round to the first again if ``long`` is one more."""
    place, size = _next(np.zeros_like(long), long), np.repeat(size, long)
    if flip is not None:
        place = np.where(np.repeat(flip, long), np.repeat(long, long) - 1 - place, place)
    return np.repeat(first, long) + place % size


def _signs(x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The sign of the area of rings, closed and of ``size`` points each."""
    of, ends = np.repeat(np.arange(len(size)), size), np.cumsum(size)
    k = np.flatnonzero(of[1:] == of[:-1])
    part = x[k] * y[k + 1] - x[k + 1] * y[k]
    area, bulk = np.bincount(of[k], part, len(size)), np.bincount(of[k], np.abs(part), len(size))
    # Where the parts cancel out the order of adding decides: as for one ring.
    for i in np.flatnonzero(np.abs(area) <= 1e-12 * bulk):
        ring = slice(ends[i] - size[i], ends[i])
        area[i] = ring_area([*zip(x[ring].tolist(), y[ring].tolist())])
    return np.sign(area)


def mended_batch(rings: pa.Array, oriented: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """As ``mended`` for every polygon of a batch: its rings and how many of them are shells.

    Cuts, nodes, windings and walks are made for all polygons at once; only walks through points
    where rings touch are made one by one.  Polygons with a point that is null or not finite give none.
    """
    sizes = lambda a: pc.fill_null(pc.list_value_length(a), 0).to_numpy()
    ring = rings.flatten()
    points = ring.flatten()
    field = dict(zip((f.name for f in points.type), points.flatten()))
    x, y = (field[c].to_numpy(zero_copy_only=False).astype("float64") for c in ("x", "y"))
    size, of = sizes(ring), np.repeat(np.arange(len(rings)), sizes(rings))
    lost = np.zeros(len(rings), bool)
    lost[np.repeat(of, size)[~(np.isfinite(x) & np.isfinite(y))]] = True
    lost[of[ring.is_null().to_numpy(zero_copy_only=False)]] = True

    # Rings of some length, closed and turned.
    first = np.cumsum(size) - size
    keep = (size > 2) & ~lost[of]
    first, size, of = first[keep], size[keep], of[keep]
    end = first + size - 1
    long = size + ~((x[first] == x[end]) & (y[first] == y[end]))
    at = _closed(first, size, long)
    below = _signs(x[at], y[at], long) < 0
    shell = np.flatnonzero(np.diff(of, prepend=-1))
    flip = ~below
    flip[shell] = below[shell]
    flip = np.where(oriented[of], np.repeat(below[shell], np.diff(np.append(shell, len(of)))), flip)
    at = _closed(first, size, long, flip)
    x, y, ring_of = x[at], y[at], np.repeat(np.arange(len(of)), long)
    k = np.flatnonzero(ring_of[1:] == ring_of[:-1])
    k = k[(x[k] != x[k + 1]) | (y[k] != y[k + 1])]
    ax, ay, bx, by, of = x[k], y[k], x[k + 1], y[k + 1], of[ring_of[k]]
    edges = np.bincount(of, minlength=len(rings))
    starts = np.cumsum(edges) - edges

    # Places where edges meet.
    dx, dy = bx - ax, by - ay
    length = np.maximum(dx * dx + dy * dy, 1e-300)
    every = np.arange(len(of))
    cut, where = [every, every], [np.zeros(len(of)), np.ones(len(of))]
    for i, j in _with_edges(of, starts, edges):
        ux, uy, vx, vy, gx, gy = dx[i], dy[i], dx[j], dy[j], ax[j] - ax[i], ay[j] - ay[i]
        bend, off = ux * vy - uy * vx, gx * uy - gy * ux
        with np.errstate(divide="ignore", invalid="ignore"):
            t, s = (gx * vy - gy * vx) / bend, off / bend
        flat = np.abs(bend) <= 1e-12 * np.sqrt(length[i] * length[j])
        hit = ~flat & (t > 1e-9) & (t < 1 - 1e-9) & (s > -1e-9) & (s < 1 + 1e-9)
        cut.append(i[hit])
        where.append(t[hit])
        # Edges on one line meet in each other's ends.
        line = flat & (np.abs(off) <= 1e-9 * length[i]) & (i != j)
        i, j = i[line], j[line]
        for qx, qy in ((ax, ay), (bx, by)):
            t = ((qx[j] - ax[i]) * dx[i] + (qy[j] - ay[i]) * dy[i]) / length[i]
            hit = (t > 1e-9) & (t < 1 - 1e-9)
            cut.append(i[hit])
            where.append(t[hit])
    cut, where = np.concatenate(cut), np.concatenate(where)
    order = np.lexsort((where, cut))
    cut, where = cut[order], where[order]

    # Nodes nearer than a billionth of the extent are one, the first of them.
    px, py = np.append(ax, ax[cut] + where * dx[cut]), np.append(ay, ay[cut] + where * dy[cut])
    owner = np.append(of, of[cut])
    span = np.ones(len(rings))
    some = np.flatnonzero(edges)
    if len(some):
        wide = lambda v: np.maximum.reduceat(v, starts[some]) - np.minimum.reduceat(v, starts[some])
        span[some] = np.maximum(np.maximum(wide(ax), wide(ay)), 1e-300)
    kx, ky = np.rint(px / span[owner] * 1e9), np.rint(py / span[owner] * 1e9)
    order = np.lexsort((ky, kx, owner))
    new = np.ones(len(order), bool)
    new[1:] = np.diff(owner[order]).astype(bool) | (np.diff(kx[order]) != 0) | (np.diff(ky[order]) != 0)
    node = np.empty(len(order), "int64")
    node[order] = np.cumsum(new) - 1
    x, y, owner = px[order[new]], py[order[new]], owner[order[new]]

    # The edges between nodes, each once, and how often it is run along.
    stop = node[len(of) :]
    k = np.flatnonzero((cut[1:] == cut[:-1]) & (stop[1:] != stop[:-1]))
    u, v = stop[k], stop[k + 1]
    less = (x[u] < x[v]) | ((x[u] == x[v]) & (y[u] < y[v]))
    key, begin, same = np.unique(np.where(less, u, v) * len(x) + np.where(less, v, u), return_index=True, return_inverse=True)
    n = np.bincount(same, np.where(less, 1, -1), len(key)).astype("int64")
    order = np.argsort(begin)
    key, n = key[order][n[order] != 0], n[order][n[order] != 0]
    u, v = key // max(len(x), 1), key % max(len(x), 1)

    # A point just left of the edge's middle; to its right the edge itself counts n less.
    mx, my = (x[u] + x[v]) / 2 - (y[v] - y[u]) * 1e-6, (y[u] + y[v]) / 2 + (x[v] - x[u]) * 1e-6
    left = np.zeros(len(u), "int64")
    for i, j in _with_edges(owner[u], starts, edges):
        qx, qy = mx[i], my[i]
        side = dx[j] * (qy - ay[j]) - (qx - ax[j]) * dy[j]
        up, down = (ay[j] <= qy) & (by[j] > qy) & (side > 0), (ay[j] > qy) & (by[j] <= qy) & (side < 0)
        lo, rows = i[0], i[-1] - i[0] + 1
        left[lo : lo + rows] = np.bincount(i[up] - lo, minlength=rows) - np.bincount(i[down] - lo, minlength=rows)
    keep = (left > 0) != (left - n > 0)
    s, e = np.where(left > 0, u, v)[keep], np.where(left > 0, v, u)[keep]

    # Where every point begins one edge and ends one, rings are the cycles, each from its least point.
    goes, comes = np.bincount(s, minlength=len(x)), np.bincount(e, minlength=len(x))
    touch = np.zeros(len(rings), bool)
    touch[owner[(goes > 1) | (goes != comes)]] = True
    plain = ~touch[owner[s]]
    of, size, at = _cycles(s[plain], e[plain], x, y, owner)
    by_walk = list(_walks(s[~plain], e[~plain], x, y, owner))
    of, size = np.append(of, np.array([p for p, _ in by_walk], "int64")), np.append(size, np.array([len(r) for _, r in by_walk], "int64"))
    more = np.array([p for _, r in by_walk for p in r]).reshape(-1, 2)
    x, y = np.append(x[at], more[:, 0]), np.append(y[at], more[:, 1])

    # Shells before holes; polygons without any shell have no ring.
    above = _signs(x, y, size) > 0
    shells = np.bincount(of[above], minlength=len(rings))
    order = np.lexsort((~above, of))
    order = order[shells[of[order]] > 0]
    at = _next((np.cumsum(size) - size)[order], size[order])
    starts = lambda count: pa.array(np.append(0, np.cumsum(count)).astype("int32"))
    found = {"x": x[at], "y": y[at]}
    parts = [pa.array(found[f.name]).cast(f.type) if f.name in found else pa.nulls(len(at), f.type) for f in points.type]
    every = pa.ListArray.from_arrays(starts(size[order]), pa.StructArray.from_arrays(parts, fields=list(points.type)))
    return pa.ListArray.from_arrays(starts(np.bincount(of[order], minlength=len(rings))), every), shells


def _cycles(s: np.ndarray, e: np.ndarray, x: np.ndarray, y: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rings of edges (s to e) that leave every node once: polygon and number of points of each, and the nodes of all."""
    order = np.lexsort((y[s], x[s], owner[s]))
    s, e = s[order], e[order]
    every, at = np.arange(len(s)), np.zeros(len(owner), "int64")
    at[s] = every
    after = at[e]
    least, to = every, after
    for _ in range(int(np.bincount(owner[s]).max(initial=0)).bit_length()):
        least, to = np.minimum(least, least[to]), to[to]
    begin, place = np.flatnonzero(least == every), np.zeros(len(s), "int64")
    home, now, step = begin, after[begin], 0
    while len(now):
        on, step = now != home, step + 1
        home, now = home[on], now[on]
        place[now] = step
        now = after[now]
    size = np.bincount(least, minlength=len(s))[begin]
    return owner[s[begin]], size + 1, s[np.lexsort((place, least))][_closed(np.cumsum(size) - size, size, size + 1)]


def _walks(s: np.ndarray, e: np.ndarray, x: np.ndarray, y: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, list[Point]]]:
    """Polygon and points of the rings of edges that may leave a node more than once."""
    outs: dict[int, dict[Point, list[Point]]] = {}
    xy = [np.stack([x[k], y[k]], 1).tolist() for k in (s, e)]
    for polygon, u, v in zip(owner[s].tolist(), *xy):
        outs.setdefault(polygon, {}).setdefault(tuple(u), []).append(tuple(v))
    for polygon, out in outs.items():
        for rings in _walked(out):
            yield from ((polygon, ring) for ring in rings)
