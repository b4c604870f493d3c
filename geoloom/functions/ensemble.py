"""Ensembles inside a batch predictor: variants are made, predicted and undone in the worker,
so that no pixel is shuffled once per variant.

A predictor is a function of (batch, side, side, channels); every function here takes what
makes one and returns what makes another, as ``blend.predict_tiles`` and
``blend.predict_items`` call it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

# How much larger a tile is seen, and the part of an item that is.
ZOOM_IN = 1.25
KEEP = 0.8


def linear(x: np.ndarray, height: int, width: int) -> np.ndarray:
    """(batch, rows, columns, bands) on a new grid: half-pixel centres, edges clamped."""
    def along(values: np.ndarray, size: int, axis: int) -> np.ndarray:
        n = values.shape[axis]
        at = np.clip((np.arange(size) + 0.5) * n / size - 0.5, 0, n - 1)
        low = np.floor(at).astype(int)
        shape = [1] * values.ndim
        shape[axis] = size
        part = (at - low).reshape(shape)
        return np.take(values, low, axis) * (1 - part) + np.take(values, np.minimum(low + 1, n - 1), axis) * part

    return along(along(x, height, 1), width, 2)


def _seen(x: np.ndarray, k: int) -> np.ndarray:
    """Symmetry ``k``: quarter turns counter-clockwise, from 4 on mirrored left to right after them."""
    turned = np.rot90(x, k % 4, axes=(1, 2))
    return turned[:, :, ::-1] if k >= 4 else turned


def _undone(y: np.ndarray, k: int) -> np.ndarray:
    return np.rot90(y[:, :, ::-1] if k >= 4 else y, -(k % 4), axes=(1, 2))


def over_tiles(make_predict_fn: Callable, weights: dict[str, float], num_classes: int) -> Callable:
    """Weighted mean of per-pixel class probabilities over the variants in ``weights``:
    ``original``, ``flip``, ``d4_0`` to ``d4_7``, ``zoom`` (the tile seen ``ZOOM_IN`` times as
    large; the predictor gets that side then)."""
    numbers = {"original": 0, "flip": 4, **{f"d4_{k}": k for k in range(8)}}

    def make() -> Callable:
        predict = make_predict_fn()

        def ask(x: np.ndarray) -> np.ndarray:
            return np.asarray(predict(np.ascontiguousarray(x)), "float64").reshape(*x.shape[:3], num_classes)

        def run(x: np.ndarray) -> np.ndarray:
            side = x.shape[1]
            total = np.zeros((*x.shape[:3], num_classes))
            for name, weight in weights.items():
                if name == "zoom":
                    large = int(side * ZOOM_IN)
                    y = linear(ask(linear(x, large, large).astype(x.dtype)), side, side)
                else:
                    y = _undone(ask(_seen(x, numbers[name])), numbers[name])
                total += weight * y
            return (total / sum(weights.values())).reshape(len(x), -1).astype("float32")

        return run

    return make


def over_items(make_predict_fn: Callable, steps: int = 16) -> Callable:
    """Plain mean of an item's class probabilities over up to eight symmetries of the whole
    item and, beyond eight ``steps``, of its centre brought back to full size."""

    def make() -> Callable:
        predict = make_predict_fn()

        def run(x: np.ndarray) -> np.ndarray:
            side = x.shape[1]
            kept = int(side * KEEP)
            off = (side - kept) // 2
            views = [_seen(x, k) for k in range(min(steps, 8))]
            if steps > 8:
                centre = linear(x[:, off : off + kept, off : off + kept], side, side).astype(x.dtype)
                views += [_seen(centre, k) for k in range(min(steps - 8, 8))]
            return np.mean([predict(np.ascontiguousarray(v)) for v in views], axis=0).astype("float32")

        return run

    return make
