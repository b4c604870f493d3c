"""Pixels of polygons and painted blocks, a batch of Arrow rows at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Crossings or pixels that are held at once.
PIECE = 1 << 20


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype("int64")


def _counted(n: np.ndarray) -> np.ndarray:
    """0, 1, ... n[0]-1, 0, 1, ... n[1]-1 and so on."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _pieces(n: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose ``n`` sum up to about ``PIECE``, or single ones."""
    total, at = np.cumsum(n), 0
    while at < len(n):
        upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PIECE, "right")))
        yield at, upto
        at = upto


def polygon_spans(rings: pa.Array, height: pa.Array, width: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """(polygon, r, c1, c2) of the runs of pixels whose centre lies inside, in pieces of whole polygons.

    Open rings are closed.  An edge crosses row r where its centre r + 0.5 lies in [low, high); the
    crossings of a row in order pair up, and a pair spans the centres right of the first and up to the second.
    """
    ring = rings.flatten()
    points, size = ring.flatten(), _lengths(ring)
    x1, y1 = (pc.cast(pc.struct_field(points, n), pa.float64()).to_numpy(zero_copy_only=False) for n in "xy")
    after, some = np.arange(len(x1)) + 1, size > 0
    ends = np.cumsum(size)[some]
    after[ends - 1] = ends - size[some]
    x2, y2 = x1[after], y1[after]
    owner = np.repeat(np.repeat(np.arange(len(rings)), _lengths(rings)), size)
    h, w = (pc.fill_null(n, 0).to_numpy(zero_copy_only=False).astype("int64") for n in (height, width))
    clipped = lambda v: np.clip(np.nan_to_num(np.ceil(v - 0.5)), 0, h[owner]).astype("int64")
    first, end = clipped(np.minimum(y1, y2)), clipped(np.maximum(y1, y2))
    n = np.where(np.isfinite(x1 + x2 + y1 + y2), np.maximum(end - first, 0), 0)
    edges = np.searchsorted(owner, np.arange(len(rings) + 1))
    per = np.append(np.cumsum(n), 0)[edges - 1] if len(n) else np.zeros(len(rings) + 1, "int64")
    per[edges == 0] = 0
    for a, b in _pieces(np.diff(per)):
        e = np.repeat(np.arange(edges[a], edges[b]), n[edges[a] : edges[b]])
        if not len(e):
            continue
        r = first[e] + _counted(n[edges[a] : edges[b]])
        x = x1[e] + (r + 0.5 - y1[e]) / (y2[e] - y1[e]) * (x2[e] - x1[e])
        order = np.lexsort((x, r, owner[e]))
        of, r, x = owner[e][order], r[order], np.floor(x[order] + 0.5)
        new = np.append(True, (of[1:] != of[:-1]) | (r[1:] != r[:-1]))
        start = np.flatnonzero(new)
        place = np.arange(len(r)) - np.repeat(start, np.diff(np.append(start, len(r))))
        left = np.flatnonzero((place[:-1] % 2 == 0) & ~new[1:])
        c1 = np.maximum(x[left], 0)
        c2 = np.minimum(x[left + 1] - 1, w[of[left]] - 1)
        some = c1 <= c2
        left = left[some]
        yield of[left], r[left], c1[some].astype("int64"), c2[some].astype("int64")


def by_block(of: np.ndarray, r: np.ndarray, c1: np.ndarray, c2: np.ndarray, block: int) -> tuple:
    """(polygon, br, bc, spans): runs of each polygon within each block, as a list r, c1, c2, r, c1, c2, ..."""
    n = c2 // block - c1 // block + 1
    k = _counted(n)
    of, r, c1, c2 = (np.repeat(v, n) for v in (of, r, c1, c2))
    bc = c1 // block + k
    c1, c2, br = np.maximum(c1, bc * block), np.minimum(c2, bc * block + block - 1), r // block
    order = np.lexsort((bc, br, of))
    of, br, bc = of[order], br[order], bc[order]
    start = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (br[1:] != br[:-1]) | (bc[1:] != bc[:-1])))
    values = np.stack([r[order], c1[order], c2[order]], 1).ravel().astype("int32")
    lists = pa.ListArray.from_arrays(pa.array(np.append(start, len(of)).astype("int32") * 3), pa.array(values))
    return of[start], br[start], bc[start], lists


class Painter:
    """Rows of (raster_id, br, bc, class_id, spans), sorted by block, to the class of each pixel.

    Later rows of a block paint over earlier ones.  One block is held, however many rows it has.
    """

    def __init__(self, schema: pa.Schema, block: int):
        self.schema, self.block = schema, block
        self.key, self.out, self.rows = None, [], 0
        # 0: not painted, 1: painted, 2: painted with a missing class.
        self.state, self.value = np.zeros(block * block, "int8"), np.zeros(block * block, "int64")

    def _close(self) -> None:
        at = np.flatnonzero(self.state)
        if self.key is not None and len(at):
            raster, br, bc = self.key
            columns = [
                pa.repeat(raster, len(at)), pa.array((at // self.block + br * self.block).astype("int32")),
                pa.array((at % self.block + bc * self.block).astype("int32")),
                pa.array(self.value[at], mask=self.state[at] == 2).cast(self.schema.field("class_id").type),
            ]
            self.out.append(pa.RecordBatch.from_arrays(columns, schema=self.schema))
            self.rows += len(at)
            self.state[at] = 0

    def _flush(self) -> Iterator[pa.RecordBatch]:
        if self.out:
            yield from pa.Table.from_batches(self.out).combine_chunks().to_batches()
        self.out, self.rows = [], 0

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = self.block
        for batch in batches:
            if not batch.num_rows:
                continue
            col = {n: batch.column(n) for n in ("raster_id", "br", "bc", "class_id", "spans")}
            br, bc = (col[n].to_numpy(zero_copy_only=False) for n in ("br", "bc"))
            raster = pc.fill_null(col["raster_id"].dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
            known = pc.is_valid(col["class_id"]).to_numpy(zero_copy_only=False)
            value = pc.fill_null(col["class_id"], 0).to_numpy(zero_copy_only=False).astype("int64")
            new = (raster[1:] != raster[:-1]) | (br[1:] != br[:-1]) | (bc[1:] != bc[:-1])
            start = np.flatnonzero(np.append(True, new))
            runs = np.append(0, np.cumsum(_lengths(col["spans"]) // 3))
            r, c1, c2 = col["spans"].flatten().to_numpy(zero_copy_only=False).astype("int64").reshape(-1, 3).T
            of, n = np.repeat(np.arange(batch.num_rows), np.diff(runs)), c2 - c1 + 1
            first = (r % b) * b + c1 % b
            state = np.where(known, 1, 2).astype("int8")
            for i, j in zip(start.tolist(), [*start[1:].tolist(), batch.num_rows]):
                key = (col["raster_id"][i], int(br[i]), int(bc[i]))
                if key != self.key:
                    self._close()
                    self.key = key
                lo, hi = int(runs[i]), int(runs[j])
                for s, t in _pieces(n[lo:hi]):
                    part = slice(lo + s, lo + t)
                    at = np.repeat(first[part], n[part]) + _counted(n[part])
                    row = np.repeat(of[part], n[part])
                    # Of a pixel named twice the last row stays.
                    self.state[at], self.value[at] = state[row], value[row]
                if self.rows > PIECE // 8:
                    yield from self._flush()
        self._close()
        yield from self._flush()
